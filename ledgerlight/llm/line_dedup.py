"""Removal of globally repeated multi-line chunks, with native functions only.

Lines are split at newlines and hashed.  The rolling hash at a line covers it and
the line before; a chunk ends after a line whose rolling hash is smaller than both
neighbours', so borders depend on nearby content only, survive shifts, and leave
chunks of at least two lines (a short document is one chunk).

A chunk with at least two lines that are not blank is removed when the same text
occurs in a document with a smaller doc_id or earlier in its own document; the first
occurrence stays.  Chunk hashes choose the candidates; a chunk goes only after its
text has been compared with the first occurrence's.  Hashes and places are shuffled
for all chunks, texts once by document and then only for candidates.

Null text is one empty line.  Rows that share a doc_id count as one document.  Rows
with a null doc_id only lose repeats of their own.  An empty table gives no rows;
other columns are kept (a clash with the added names replaces that column).

The borders of chunks are a lottery for short passages, so ``dedup_runs`` does without
them: it compares every two successive lines that are not blank, whatever blank lines
are between them, and removes a line (with the blank lines after it) when it is in a
pair that a document with a smaller doc_id has too, or that its own document has
earlier.  So every run of two or more lines that an earlier document has goes, wherever
it lies; the first place of each line always stays.  Pairs are chosen by hash and
compared as text before they go; within one document a pair is told by 64 hash bits.

``dedup_chunks_and_runs`` does both on one input: repeated chunks go as in ``dedup_lines``,
and of the lines outside them those go that ``dedup_runs`` finds, so that a short passage
whose borders fell badly goes too.  Chunks and pairs share one pass over hashes and texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.llm.stage import put_back, set_apart, stage

MIN_LINES = 2


def chunk_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_chunks``: per chunk its text, number of lines and whether it may be compared.

    Lambdas refer to their arguments only, so each runs once per line.  Lines get a
    one-letter prefix, B where a chunk begins; no line holds a newline, so cutting the
    joined text at newline and B is exact.
    """
    out = docs.withColumn("_lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    out = out.withColumn("_n", F.size("_lines")).withColumn("_hash", F.transform("_lines", lambda x: F.md5(x)))
    rest = F.col("_n") - 1  # rolling hashes: one per line but the first
    out = out.withColumn("_roll", F.zip_with(F.slice("_hash", F.lit(1), rest), F.slice("_hash", F.lit(2), rest),
                                             lambda a, b: F.md5(F.concat(a, b))))
    m = F.greatest(F.col("_n") - 3, F.lit(0))  # lines that may end a chunk: the second to the last but two
    here, after = F.slice("_roll", F.lit(1), m), F.slice("_roll", F.lit(2), m)
    before = F.concat(F.array(F.lit("~")), F.slice("_roll", F.lit(1), F.greatest(m - 1, F.lit(0))))
    before = F.slice(before, F.lit(1), m)
    low = F.zip_with(F.zip_with(before, here, lambda a, b: b < a), F.zip_with(here, after, lambda a, b: a < b),
                     lambda x, y: x & y)
    mark = F.when(F.col("_n") >= 3, F.concat(F.array(F.lit("L"), F.lit("L")), F.transform(
        low, lambda e: F.when(e, "B").otherwise("L")), F.array(F.lit("L")))).otherwise(
            F.array_repeat(F.lit("L"), F.col("_n")))
    out = out.withColumn("_mark", mark)
    joined = F.array_join(F.zip_with("_mark", "_lines", lambda f, x: F.concat(f, x)), "\n")
    pieces = F.split(F.substring(joined, 2, 2**31 - 1), "\nB")
    split = lambda c: F.split(c, "\nL")
    full = lambda c: F.size(F.filter(split(c), lambda x: F.length(F.trim(x)) > 0)) >= MIN_LINES
    out = out.withColumn("_chunks", F.transform(pieces, lambda c: F.struct(
        F.replace(c, F.lit("\nL"), F.lit("\n")).alias("text"), F.size(split(c)).alias("lines"), full(c).alias("full"))))
    return out.drop("_lines", "_n", "_hash", "_roll", "_mark")


def _first_places(chunked: DataFrame) -> DataFrame:
    """doc_id, place, chunk text of every comparable chunk, once per document row."""
    rows = chunked.select("doc_id", F.posexplode_outer("_chunks").alias("place", "c"), F.col("_chunks.text").alias("_texts"))
    rows = rows.filter("c.full AND doc_id IS NOT NULL").filter(
        F.array_position("_texts", F.col("c.text")) == F.col("place") + 1)
    return rows.select("doc_id", "place", F.col("c.text").alias("chunk"))


def repeated_places(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, places: chunks whose text a document with a smaller id has too."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # outer explodes: the inferred "size > 0" filter of the others would compute all chunks once more
    key = [F.xxhash64("chunk").alias("h1"), F.xxhash64(F.lit(1), F.col("chunk")).alias("h2")]
    hashed = stage(_first_places(chunk_columns(keyed)).select("doc_id", *key), "chunk-hashes")
    first = (hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .filter("first < last").drop("last"))
    name = F.concat_ws(":", "h1", "h2")
    wanted = (hashed.join(first, ["h1", "h2"]).groupBy("doc_id")
              .agg(F.map_from_entries(F.collect_set(F.struct(name, "first"))).alias("wanted")))
    found = (chunk_columns(keyed.join(wanted, "doc_id"))
             .select("doc_id", "wanted", F.posexplode_outer("_chunks").alias("place", "c")).filter("c.full")
             .select("doc_id", "wanted", "place", F.col("c.text").alias("chunk")).select("*", *key))
    found = (found.select("doc_id", "place", "h1", "h2", "chunk", F.try_element_at("wanted", name).alias("first"))
             .filter("first IS NOT NULL"))
    source = (found.filter("doc_id = first").groupBy("h1", "h2").agg(F.min("chunk").alias("source")))
    later = found.filter("doc_id > first").join(source, ["h1", "h2"]).filter("chunk = source")
    return later.groupBy("doc_id").agg(F.collect_set("place").alias("_places"))


def dedup_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the kept ``text`` and n_lines, n_removed (lines), n_chunks, n_chunks_removed (instead of columns of these names)."""
    counts = ["n_lines", "n_removed", "n_chunks", "n_chunks_removed"]
    out = _dedup_lines(set_apart(docs, "doc_id", text), text)
    return out.select(*put_back(out, [c for c in docs.columns if c not in counts], "doc_id", text), *counts)


def _dedup_lines(docs: DataFrame, text: str) -> DataFrame:
    base = docs.drop("n_lines", "n_removed", "n_chunks", "n_chunks_removed")
    base = base.withColumn(text, F.col(text).cast("string"))
    places = repeated_places(base, text)
    joined = base.withColumn("_id", F.col("doc_id").cast("bigint")).join(places.withColumnRenamed("doc_id", "_id"), "_id", "left").drop("_id")
    out = chunk_columns(joined, text).withColumn("_texts", F.col("_chunks.text"))
    out = out.withColumn("_gone", F.transform("_chunks", lambda c, j: c["full"] & (
        F.coalesce(F.array_contains("_places", j), F.lit(False))
        | (F.array_position(F.col("_texts"), c["text"]) < j + 1))))
    kept = F.zip_with("_chunks", "_gone", lambda c, g: F.when(~g, c["text"]))
    lines = lambda only: F.aggregate(
        F.zip_with("_chunks", "_gone", lambda c, g: F.when(g | F.lit(not only), c["lines"]).otherwise(0)),
        F.lit(0).cast("bigint"), lambda a, x: a + x)
    gone = F.size(F.filter("_gone", lambda g: g))
    return (out.withColumn("n_lines", lines(False)).withColumn("n_removed", lines(True))
            .withColumn("n_chunks", F.size("_chunks")).withColumn("n_chunks_removed", gone)
            .withColumn(text, F.array_join(kept, "\n"))
            .drop("_chunks", "_texts", "_gone", "_places"))


def pair_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_units`` (a line and the blank lines after it), and ``_pairs``: the lines of successive units."""
    out = docs.withColumn("_units", F.split(F.coalesce(F.col(text), F.lit("")), r"\n(?= *[^ \n])"))
    out = out.withColumn("_lines", F.transform("_units", lambda u: F.substring_index(u, "\n", 1)))
    rest = F.size("_lines") - 1
    return out.withColumn("_pairs", F.zip_with(
        F.slice("_lines", F.lit(1), rest), F.slice("_lines", F.lit(2), rest),
        lambda a, b: F.when(F.length(F.trim(a)) > 0, F.concat(a, F.lit("\n"), b)))).drop("_lines")


def repeated_pairs(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, _repeated: hashes of the pairs that a document with a smaller id has too."""
    return _repeated(docs, text, pair_columns, F.array_distinct("_pairs"))


def _repeated(docs: DataFrame, text: str, columns: Callable[[DataFrame], DataFrame], pieces: Column) -> DataFrame:
    """doc_id, _repeated: hashes of the ``pieces`` (distinct strings over ``columns`` of a row) that a document with a smaller id has too."""
    keyed = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    key = [F.xxhash64("piece").alias("h1"), F.xxhash64(F.lit(1), F.col("piece")).alias("h2")]
    # outer explodes, as above
    rows = columns(keyed).select("doc_id", F.explode_outer(pieces).alias("piece"))
    hashed = stage(rows.filter("piece IS NOT NULL").select("doc_id", *key), "piece-hashes")
    first = (hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .filter("first < last").drop("last"))
    name = F.concat_ws(":", "h1", "h2")
    wanted = (hashed.join(first, ["h1", "h2"]).groupBy("doc_id")
              .agg(F.map_from_entries(F.collect_set(F.struct(name, "first"))).alias("wanted")))
    found = columns(keyed.join(wanted, "doc_id")).select(
        "doc_id", "wanted", F.explode_outer(pieces).alias("piece")).filter("piece IS NOT NULL")
    found = (found.select("*", *key).select("doc_id", "h1", "h2", "piece", F.try_element_at("wanted", name).alias("first"))
             .filter("first IS NOT NULL"))
    source = found.filter("doc_id = first").groupBy("h1", "h2").agg(F.min("piece").alias("source"))
    later = found.filter("doc_id > first").join(source, ["h1", "h2"]).filter("piece = source")
    return later.groupBy("doc_id").agg(F.collect_set("h1").alias("_repeated"))


def _seen(keys: str) -> Column:
    """Per hash of a document's array ``keys``: it is one of ``_repeated``, or came earlier in the array."""
    own = F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.transform(
        keys, lambda k, j: F.coalesce(F.array_position(F.col(keys), k) < j + 1, F.lit(False)))).otherwise(
            F.transform(keys, lambda k: F.lit(False)))
    known = F.when(F.col("_repeated").isNull(), F.transform(keys, lambda k: F.lit(False))).otherwise(
        F.transform(keys, lambda k: F.coalesce(F.array_contains("_repeated", k), F.lit(False))))
    return F.zip_with(own, known, lambda a, b: a | b)


def _of_pairs(pair: str) -> Column:
    """Per unit: the pair that it begins or the one that it ends goes."""
    no = F.array(F.lit(False))
    return F.zip_with(F.concat(pair, no), F.concat(no, pair), lambda a, b: a | b)


def dedup_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the kept ``text`` and n_lines, n_removed, n_left (kept lines that are not blank; instead of columns of these names)."""
    counts = ["n_lines", "n_removed", "n_left"]
    out = _dedup_runs(set_apart(docs, "doc_id", text), text)
    return out.select(*put_back(out, [c for c in docs.columns if c not in counts], "doc_id", text), *counts)


def _dedup_runs(docs: DataFrame, text: str) -> DataFrame:
    base = docs.drop("n_lines", "n_removed", "n_left").withColumn(text, F.col(text).cast("string"))
    keyed = (pair_columns(base, text).withColumn("_keys", F.transform("_pairs", lambda p: F.when(p.isNotNull(), F.xxhash64(p))))
             .drop("_pairs").withColumn("_id", F.col("doc_id").cast("bigint")))
    # keys and units come out of the join as columns, so the lambdas below don't compute them again for each line
    out = keyed.join(repeated_pairs(base, text).withColumnRenamed("doc_id", "_id"), "_id", "left").drop("_id")
    out = out.withColumn("_pair", _seen("_keys"))
    out = out.withColumn("_gone", _of_pairs("_pair"))
    lines = lambda c: F.regexp_count(c, F.lit("\n")) + 1
    total = lambda each: F.aggregate(each, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return (out.withColumn("n_lines", total(F.transform("_units", lines)))
            .withColumn("n_removed", total(F.zip_with("_units", "_gone", lambda u, g: F.when(g, lines(u)).otherwise(0))))
            .withColumn("n_left", total(F.zip_with("_units", "_gone", lambda u, g: F.when(
                g | (F.length(F.trim(F.substring_index(u, "\n", 1))) == 0), 0).otherwise(1))))
            .withColumn(text, F.array_join(F.zip_with("_units", "_gone", lambda u, g: F.when(~g, u)), "\n"))
            .drop("_units", "_keys", "_repeated", "_pair", "_gone"))


def dedup_chunks_and_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without repeated chunks and, outside those, without repeated pairs of lines; columns as of ``dedup_runs``.

    Both are judged on the input, so it makes no difference that the removal of a chunk brings other lines together.
    """
    counts = ["n_lines", "n_removed", "n_left"]
    out = _dedup_chunks_and_runs(set_apart(docs, "doc_id", text), text)
    return out.select(*put_back(out, [c for c in docs.columns if c not in counts], "doc_id", text), *counts)


def _chunks_and_pairs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_chunks``, ``_units`` and ``_pairs``, and the texts to compare of both kinds, each with a letter before it."""
    out = pair_columns(chunk_columns(docs, text), text)
    return (out.withColumn("_chunk_texts", F.transform("_chunks", lambda c: F.when(c["full"], F.concat(F.lit("C"), c["text"]))))
            .withColumn("_pair_texts", F.transform("_pairs", lambda p: F.concat(F.lit("P"), p))).drop("_pairs"))


def _dedup_chunks_and_runs(docs: DataFrame, text: str) -> DataFrame:
    base = docs.drop("n_lines", "n_removed", "n_left").withColumn(text, F.col(text).cast("string"))
    hashes = lambda c: F.transform(c, lambda x: F.when(x.isNotNull(), F.xxhash64(x)))
    keyed = (_chunks_and_pairs(base, text).withColumn("_chunk_keys", hashes("_chunk_texts")).withColumn("_keys", hashes("_pair_texts"))
             .withColumn("_chunk_lines", F.transform("_chunks", lambda c: c["lines"]))
             .withColumn("_unit_lines", F.transform("_units", lambda u: F.regexp_count(u, F.lit("\n")) + 1))
             .withColumn("_id", F.col("doc_id").cast("bigint")).drop("_chunks", "_units", "_chunk_texts", "_pair_texts"))
    repeated = _repeated(base, text, _chunks_and_pairs, F.array_distinct(F.concat("_chunk_texts", "_pair_texts")))
    # as in dedup_runs, keys and sizes come out of the join as columns
    out = keyed.join(repeated.withColumnRenamed("doc_id", "_id"), "_id", "left").drop("_id")
    out = out.withColumn("_chunk", _seen("_chunk_keys")).withColumn("_pair", _seen("_keys"))
    by_line = lambda gone, lines: F.flatten(F.zip_with(gone, lines, lambda g, n: F.array_repeat(g, n)))
    out = out.withColumn("_gone", F.zip_with(by_line("_chunk", "_chunk_lines"), by_line(_of_pairs("_pair"), "_unit_lines"),
                                             lambda a, b: a | b))
    out = out.withColumn("_kept", F.zip_with(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), "_gone",
                                             lambda x, g: F.when(~g, x)))
    number = lambda c, test: F.size(F.filter(c, test)).cast("bigint")
    return (out.withColumn("n_lines", F.size("_gone").cast("bigint"))
            .withColumn("n_removed", number("_gone", lambda g: g))
            .withColumn("n_left", number("_kept", lambda x: F.length(F.trim(x)) > 0))
            .withColumn(text, F.array_join("_kept", "\n"))
            .drop("_chunk_keys", "_keys", "_chunk_lines", "_unit_lines", "_repeated", "_chunk", "_pair", "_gone", "_kept"))
