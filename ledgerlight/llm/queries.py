"""Registered queries of the operators, each over its whole table, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.llm.stage import read, scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return wrap


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


@register("op5_token_output")
def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as plane blocks and read back."""
    from ledgerlight.llm import token_output
    path = f"{scratch_path(spark, 'tokens')}/data"
    token_output.write_tokens(read(spark, sf_dir, "documents"), path)
    return token_output.read_documents(spark.read.schema(token_output.FILE_SCHEMA).parquet(path))


@register("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    from ledgerlight.llm import packing
    return packing.pack(read(spark, sf_dir, "documents"), capacity=1024, end_id=2)


_ESCAPED = r"replace(text, '\', '\\')"
for _c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"

CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM turns),
sized AS (SELECT *, pos = 1 AND role = 'system' AS is_lead,
  CASE WHEN pos = 1 AND role = 'system' THEN 0 ELSE cast(ceil(strlen(text) / 4.0) + 4 AS bigint) END AS tokens,
  22 + length(url_encode(role)) + 1 + length({_ESCAPED}) + 1 AS chars FROM placed),
summed AS (SELECT *, sum(tokens) OVER w AS stop, max(CASE WHEN is_lead THEN strlen(text) END) OVER w AS sys_bytes,
  max(CASE WHEN is_lead THEN chars END) OVER w AS sys_chars
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
strided AS (SELECT *, stop - tokens AS start,
  greatest(1024 - 256 - coalesce(cast(ceil(sys_bytes / 4.0) + 4 AS bigint), 0), 256) AS stride FROM summed),
spans AS (SELECT *, CASE WHEN NOT is_lead THEN 2 * (start // stride)
  + CASE WHEN (stop - 1) // stride > start // stride THEN 1 ELSE 0 END END AS span FROM strided),
opened AS (SELECT *, NOT is_lead AND span IS DISTINCT FROM lag(span) OVER (PARTITION BY conv_id ORDER BY pos) AS opens
  FROM spans),
extra AS (
  SELECT o.conv_id, sum(h.chars) AS chars FROM opened o JOIN opened h ON o.conv_id = h.conv_id
    AND h.pos BETWEEN o.pos - 2 AND o.pos - 1 AND NOT h.is_lead AND o.start - h.start <= 256 AND h.span <> o.span
  WHERE o.opens GROUP BY 1
  UNION ALL
  SELECT conv_id, sum(sys_chars) FROM opened WHERE opens AND start > 0 AND sys_chars IS NOT NULL GROUP BY 1)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  cast(sum(chars) + coalesce((SELECT sum(e.chars) FROM extra e WHERE e.conv_id IS NOT DISTINCT FROM o.conv_id), 0) AS bigint)
    AS formatted_chars
FROM opened o GROUP BY conv_id
"""


@register("op1_chat_format", CHAT_SQL)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the control-string probe, formatted in windows and read back."""
    from ledgerlight.llm import chat_format
    probe = spark.sql("SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digest(chat_format.format_windows(rows.unionByName(probe)))


@register("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a network fitted on labels that are not held out."""
    from ledgerlight.llm import quality
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, read(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, model)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@register("op4_minhash_dedup")
def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: three-word shingles, similarity 0.85."""
    from ledgerlight.llm import minhash_dedup
    return minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), k=3, percent=85)


@register("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 35-word windows removed from all documents."""
    from ledgerlight.llm import substring_dedup
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i,
    len(string_split(coalesce(text, ''), chr(10))) AS n FROM documents),
rolled AS (SELECT *, CASE WHEN i > 0 THEN md5(lag(md5(line)) OVER w || md5(line)) END AS r
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
cut AS (SELECT *, i BETWEEN 1 AND n - 3 AND r < coalesce(lag(r) OVER w, '~') AND r < lead(r) OVER w AS ends
  FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
placed AS (SELECT *, coalesce(sum(ends::int) OVER (PARTITION BY doc_id ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM cut),
chunks AS (SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n,
  count(*) FILTER (length(trim(line)) > 0) >= 2 AS whole FROM placed GROUP BY ALL),
judged AS (SELECT *, whole AND row_number() OVER (PARTITION BY body, whole ORDER BY doc_id, chunk) > 1 AS gone FROM chunks)
SELECT doc_id, cast(sum(n) AS bigint) AS n_lines, cast(coalesce(sum(n) FILTER (gone), 0) AS bigint) AS n_removed,
  count(*) AS n_chunks, count(*) FILTER (gone) AS n_chunks_removed,
  sha256(coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@register("op6_line_dedup", LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks removed from all documents."""
    from ledgerlight.llm import line_dedup
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.col("n_chunks").cast("bigint").alias("n_chunks"),
                      F.col("n_chunks_removed").cast("bigint").alias("n_chunks_removed"),
                      F.sha2("text", 256).alias("kept_sha256"))


@register("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item, with the item."""
    from ledgerlight.llm import decontaminate
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op7_learned_partitions")
def op7_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth id, against all vectors."""
    from ledgerlight.llm import ann
    return ann.search(read(spark, sf_dir, "embeddings"), every=20, k=20)


@register("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All licence notices in all documents."""
    from ledgerlight.llm import license_scan
    return license_scan.scan(read(spark, sf_dir, "documents"))


TOPK_SQL = """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM s QUALIFY rank <= 5
"""


@register("op11_exact_topk", TOPK_SQL)
def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer products of every fiftieth id, against all vectors."""
    from ledgerlight.llm import exact_topk
    return exact_topk.search(read(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


@register("op13_vector_codes")
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as codes of four codebooks of 256 entries after four rounds."""
    from ledgerlight.llm import vector_codes
    return vector_codes.report(read(spark, sf_dir, "embeddings"))


COLLOCATIONS_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS p, piece FROM pieces),
split AS (SELECT lang, p, [w FOR w IN string_split_regex(piece, '[\x20\x09]+') IF w <> ''] AS ws FROM numbered),
words AS (SELECT lang, p, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM split),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY 1),
grown AS (SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4
  FROM words WINDOW o AS (PARTITION BY p ORDER BY i)),
counted AS (
  SELECT lang, [w1] AS ws, count(*) AS f FROM grown GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2], count(*) FROM grown WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM grown WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM grown WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
known AS (SELECT lang, ws, len(ws) AS m, array_to_string(ws, ' ') AS phrase, f FROM counted),
cut AS (SELECT lang, ws, phrase, f AS a, unnest(range(1, m)) AS k FROM known WHERE m >= 2 AND f >= 30),
cuts AS MATERIALIZED (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail FROM cut),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.a // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = c.head JOIN known y ON y.lang = c.lang AND y.phrase = c.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
runs AS (SELECT lang, f, array_to_string(ws[i:i + s - 1], ' ') AS phrase FROM known, range(1, 4) AS a(i), range(2, 4) AS b(s)
  WHERE m >= 3 AND f >= 30 AND s < m AND i + s - 1 <= m),
held AS (SELECT lang, phrase, max(f) AS inside FROM runs GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase,
  b.a, b.l, b.r, t.n, b.score
FROM best b JOIN total t ON t.lang = b.lang LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
WHERE h.inside IS NULL OR 100 * h.inside < 80 * b.a QUALIFY rank <= 2000
"""


@register("op12_collocations", COLLOCATIONS_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of every language in all documents."""
    from ledgerlight.llm import collocations
    return collocations.mine(read(spark, sf_dir, "documents"))
