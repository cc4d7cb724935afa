"""Near-duplicate documents: universal hash minima, banding, verification, connected components.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased.  A
document's set holds its distinct shingles of ``k`` words; a shorter document has
its whole word sequence as the only element; one without words has an empty set
and no link.  Documents are linked when ``100 * |A & B| >= percent * |A | B|``.

1. One pass over the texts makes the set size, a 128-bit fingerprint of the set
   and ``BANDS * ROWS`` minima of multiply-shift hashes.  Documents with one
   fingerprint have equal sets; the smallest doc_id stands for them.
2. Representatives share a bucket when a band of minima is equal.  At similarity
   0.85 a pair misses all 32 bands of 4 with probability 5e-11 (0.8: 5e-8).
   Every member is compared with its bucket's smallest member.
3. A pair goes on when its sizes allow the threshold and its minima agree well
   enough (``threshold - 0.2``, six standard deviations), and is confirmed on the
   full shingle sets, rebuilt from the texts of documents that share a bucket.
4. Members of a bucket that are in different components after that are compared
   exhaustively, on full sets, in bounded blocks, so no link is lost and no bucket is
   ever held by one task.

Rows that share a doc_id are one vertex: their sets are compared each, and the components of
all of them are one.  ``copies`` judges texts instead, for a filter that must lose none.  A null doc_id takes no part (component
null, kept).  Null text is an empty text.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.llm.components import connected_components
from ledgerlight.llm.stage import share_package, small_batches, stage
from ledgerlight.llm.text_arrays import mix, span_hashes, utf8_buffer, window_hashes, word_spans

BANDS, ROWS = 32, 4
SLACK = 0.2
GROUP_BYTES = 1 << 20
SALTS = (0, 0x5851F42D4C957F2D)  # of the two halves of a set's fingerprint
BLOCK_MINORS, BLOCK_MEMBERS, ELEMENTS = 256, 512, 8192
_U = np.uint64

_seeds = np.random.default_rng(20240607)
_A = _seeds.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * _U(2) + _U(1)
_B = _seeds.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of documents: (first document, sorted distinct shingle hashes, offsets per document)."""
    data, offsets = utf8_buffer(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + GROUP_BYTES, side="right")) - 1)
        part, offs = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, first = word_spans(part, offs)
        words = span_hashes(part, starts, ends, lower=True)
        count = np.diff(first)
        size = np.where(count >= k, count - k + 1, 0)
        doc = np.repeat(np.arange(j - i), size)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size) + first[:-1][doc]
        hashes = window_hashes(words, k)[at] if len(at) else np.zeros(0, _U)
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            whole = np.array([_fold(words[first[d]:first[d + 1]]) for d in short], _U)
            hashes, doc = np.concatenate([hashes, whole]), np.concatenate([doc, short])
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        hashes, doc = hashes[new], doc[new]
        yield i, hashes, np.searchsorted(doc, np.arange(j - i + 1))
        i = j


def _fold(words: np.ndarray) -> np.uint64:
    value = np.array([len(words)], _U)
    for w in words:
        value = mix(value * _U(31) + w)
    return value[0]


def _sketch(k: int):
    """Rows of doc_id, n_shingles, fingerprint (fp1, fp2) and minima (16 bits each) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            size, fp = np.zeros(n, np.int64), np.zeros((2, n), np.int64)
            minima = np.zeros((n, BANDS * ROWS), np.uint32)
            for base, sets, offs in shingle_sets(batch.column("text"), k):
                count = np.diff(offs)
                size[base:base + len(count)] = count
                full = np.flatnonzero(count)
                if not len(full):
                    continue
                at = offs[:-1][full]
                for which, salt in enumerate(SALTS):
                    fp[which, base + full] = np.add.reduceat(mix(sets ^ _U(salt)), at).view(np.int64)
                key = sets >> _U(32)
                for m in range(BANDS * ROWS):
                    minima[base + full, m] = np.minimum.reduceat((key * _A[m] + _B[m]) >> _U(32), at)
            bands = minima.reshape(n, BANDS, ROWS).astype(_U)
            keys = np.zeros((n, BANDS), _U)
            for r in range(ROWS):
                keys = mix(keys * _U(0x100000001B3) + bands[:, :, r])
            keys = mix(keys + np.arange(BANDS, dtype=_U))
            bytes_ = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(2 * BANDS * ROWS), n, [None, pa.py_buffer(minima.astype("<u2").tobytes())])
            flat = pa.array(keys.ravel().view(np.int64))
            bounds = pa.array(np.arange(n + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("th"), pa.array(size), pa.array(fp[0]), pa.array(fp[1]),
                 bytes_.cast(pa.binary()), pa.ListArray.from_arrays(bounds, flat)],
                ["doc_id", "th", "n_shingles", "fp1", "fp2", "minima", "bands"])
    return run


def _agreement(column_a: str, column_b: str, least: float) -> Column:
    """Minima agree in at least a share ``least`` of places."""
    @F.pandas_udf("boolean")
    def agree(a, b):
        import pandas as pd
        x = np.frombuffer(b"".join(a), "<u2").reshape(-1, BANDS * ROWS)
        y = np.frombuffer(b"".join(b), "<u2").reshape(-1, BANDS * ROWS)
        return pd.Series((x == y).mean(axis=1) >= least)
    return agree(column_a, column_b)


def _full_sets(texts: DataFrame, ids: DataFrame, k: int, repeats: bool) -> DataFrame:
    """(id, elements): the full shingle sets of some (id, doc_id, fp1, fp2), written once."""
    def sets(batches):
        for batch in batches:
            want = [batch.column(c).to_numpy() for c in ("fp1", "fp2")]
            for base, hashes, offs in shingle_sets(batch.column("text"), k):
                n = len(offs) - 1
                full = np.flatnonzero(np.diff(offs))
                mine = np.zeros(n, bool)
                mine[full] = True
                for which, salt in enumerate(SALTS):
                    if len(full):
                        fp = np.add.reduceat(mix(hashes ^ _U(salt)), offs[:-1][full]).view(np.int64)
                        mine[full] &= fp == want[which][base + full]
                bound = pa.array((offs * 8).astype(np.int32))
                column = pa.BinaryArray.from_buffers(pa.binary(), n, [None, bound.buffers()[1], pa.py_buffer(hashes.tobytes())])
                found = pa.RecordBatch.from_arrays([batch.column("id").slice(base, n), column], ["id", "elements"])
                yield found.filter(pa.array(mine))  # a doc_id may have other texts too

    found = texts.join(ids, "doc_id").select("id", "text", "fp1", "fp2").mapInArrow(sets, "id bigint, elements binary")
    return stage(found.dropDuplicates(["id"]) if repeats else found, "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    def check(batches):
        for batch in batches:
            a, b = batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()
            keep = []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (pairs.join(sets.select(F.col("id").alias("b"), F.col("elements").alias("set_b")), "b")
              .join(sets.select(F.col("id").alias("a"), F.col("elements").alias("set_a")), "a"))
    return joined.select("a", "b", "set_a", "set_b").mapInArrow(check, "a bigint, b bigint")


def _plausible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose sizes allow the threshold and whose minima agree well enough."""
    side = lambda c: reps.select(F.col("id").alias(c), F.col("n_shingles").alias(f"n_{c}"),
                                 F.col("minima").alias(f"m_{c}"))
    joined = pairs.filter("a <> b").distinct().join(side("a"), "a").join(side("b"), "b")
    sized = joined.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return sized.filter(_agreement("m_a", "m_b", percent / 100 - SLACK)).select("a", "b")


def _block_links(percent: int):
    """Links between one block of minors and one block of members, by exact intersection sizes.

    Intersections are products of 0/1 matrices over the elements both blocks have,
    some thousand elements at a time.  One link per minor and other component is enough.
    """
    def compare(table: pa.Table) -> pa.Table:
        minor = np.array(table["minor"].to_pylist(), bool)
        ids, comp = table["id"].to_numpy(), table["c"].to_numpy()
        sets = [np.frombuffer(e, _U) for e in table["elements"].to_pylist()]
        size = np.array([len(e) for e in sets])
        xs, ms = np.flatnonzero(minor), np.flatnonzero(~minor)
        out = ([], [])
        if len(xs) and len(ms):
            flat = [(np.repeat(np.arange(len(w)), size[w]), np.concatenate([sets[i] for i in w])) for w in (xs, ms)]
            shared = np.intersect1d(flat[0][1], flat[1][1])
            both = np.zeros((len(xs), len(ms)), np.float32)
            sides = []
            for row, element in flat:
                at = np.searchsorted(shared, element)
                hit = shared[np.minimum(at, len(shared) - 1)] == element if len(shared) else np.zeros(len(at), bool)
                order = np.argsort(at[hit], kind="stable")
                sides.append((row[hit][order], at[hit][order]))
            for lo in range(0, len(shared), ELEMENTS):
                blocks = []
                for w, (row, at) in zip((xs, ms), sides):
                    i, j = np.searchsorted(at, (lo, lo + ELEMENTS))
                    m = np.zeros((len(w), min(ELEMENTS, len(shared) - lo)), np.float32)
                    m[row[i:j], at[i:j] - lo] = 1
                    blocks.append(m)
                both += blocks[0] @ blocks[1].T
            total = size[xs][:, None] + size[ms] - both
            linked = (100 * both >= percent * total) & (comp[xs][:, None] != comp[ms])
            for i in np.flatnonzero(linked.any(axis=1)):
                to = np.flatnonzero(linked[i])
                to = to[np.unique(comp[ms[to]], return_index=True)[1]]
                out[0].extend([ids[xs[i]]] * len(to))
                out[1].extend(ids[ms[to]])
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})
    return compare


def _across_components(members: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of one bucket, which the comparison with the centre left open.

    Buckets that still hold several components are joined to clusters (buckets with
    a common member).  In a cluster the members outside its largest component (minors)
    meet all members, block by block: a task holds one block of each side, whatever the
    size of the bucket, and only links leave it.
    """
    placed = members.join(found.withColumnRenamed("component", "c"), "id", "left").withColumn("c", F.coalesce("c", "id"))
    placed = stage(placed.filter("n > 2").select("bucket", "id", "centre", "c"), "placed")
    open_ = placed.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("bucket")
    inside = placed.join(open_, "bucket").select("id", "c", "centre").distinct()
    cluster = connected_components(inside.select(F.col("id").alias("u"), F.col("centre").alias("v")))
    docs = (inside.select("id", "c").distinct()
            .join(cluster.withColumnRenamed("component", "cluster"), "id", "left")
            .withColumn("cluster", F.coalesce("cluster", "id")))
    parts = docs.groupBy("cluster", "c").agg(F.count(F.lit(1)).alias("n"))
    sizes = (parts.groupBy("cluster").agg(F.sum("n").alias("k"), F.max(F.struct("n", "c")).alias("top"))
             .select("cluster", F.col("top.c").alias("main"), F.ceil(F.col("k") / BLOCK_MEMBERS).alias("nm"),
                     F.ceil((F.col("k") - F.col("top.n")) / BLOCK_MINORS).alias("nx")))
    rows = docs.join(sizes, "cluster").withColumn("h", F.abs(F.xxhash64("id") % 1_000_003))
    minors = (rows.filter("c <> main").withColumn("x", F.col("h") % F.col("nx"))
              .withColumn("m", F.explode(F.sequence(F.lit(0), F.col("nm") - 1))).withColumn("minor", F.lit(True)))
    every = (rows.withColumn("m", F.col("h") % F.col("nm"))
             .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn("minor", F.lit(False)))
    cols = ["cluster", "x", "m", "minor", "id", "c"]
    dealt = minors.select(cols).unionByName(every.select(cols)).join(sets, "id")
    return dealt.groupBy("cluster", "x", "m").applyInArrow(_block_links(percent), "a bigint, b bigint")


def _components_of_sets(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, bool]:
    """``_linked_sets`` in small Arrow batches; all its Python stages are written inside."""
    with small_batches(docs.sparkSession):
        return _linked_sets(docs, k, percent)


def _linked_sets(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, bool]:
    """The sketches of all rows, (fp1, fp2, doc_id, component) of the sets that are not empty, whether a doc_id is repeated.

    Each distinct set is a vertex with an id of its own, so a doc_id with several texts has several;
    ``doc_id`` is the smallest that has the set.
    """
    share_package(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = stage(texts.withColumn("th", F.xxhash64("text")).mapInArrow(
        _sketch(k), "doc_id bigint, th bigint, n_shingles bigint, fp1 bigint, fp2 bigint, minima binary, bands array<bigint>"),
        "sketch")
    linkable = sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    repeats = bool(sketch.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").limit(1).count())
    same = linkable.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("doc_id"))
    # written before it is used: the ids stay what they are
    reps = stage(linkable.drop("th").join(same, ["fp1", "fp2", "doc_id"]).dropDuplicates(["fp1", "fp2"])
                 .withColumn("id", F.monotonically_increasing_id()), "reps")
    members = reps.select("id", F.explode("bands").alias("bucket"))
    centres = members.groupBy("bucket").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stage(members.join(centres, "bucket"), "members")
    ids = members.select("id").distinct().join(reps.select("id", "doc_id", "fp1", "fp2"), "id")
    sets = _full_sets(texts, ids, k, repeats)
    star = members.select(F.col("centre").alias("a"), F.col("id").alias("b"))
    links = stage(_confirmed(stage(_plausible(star, reps, percent), "pairs"), sets, percent), "links")
    found = stage(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "found")
    rest = stage(_across_components(members, found, sets, percent), "rest")
    if rest.limit(1).count():
        found = connected_components(rest.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            found.select(F.col("id").alias("u"), F.col("component").alias("v"))))
    named = reps.select("id", "doc_id", "fp1", "fp2").join(found, "id", "left")
    return sketch, named.select("fp1", "fp2", "doc_id", F.coalesce("component", "id").alias("component")), repeats


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    sketch, named, repeats = _components_of_sets(docs, k, percent)
    rows = sketch.select("doc_id", "n_shingles", "fp1", "fp2")
    own = None
    if repeats:  # a doc_id is one vertex: its sets' components are one, and its rows without words belong there
        named = stage(named, "named")
        placed = stage(rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(
            named.select("fp1", "fp2", "component"), ["fp1", "fp2"]).select("doc_id", "component").distinct(), "placed")
        lowest = placed.groupBy("doc_id").agg(F.min("component").alias("to"))
        edges = placed.join(lowest, "doc_id").filter("component <> to").select(F.col("component").alias("u"), F.col("to").alias("v"))
        merged = stage(connected_components(edges).toDF("component", "to"), "merged")
        joined = lambda rows: (rows.join(merged, "component", "left")
                               .withColumn("component", F.coalesce("to", "component")).drop("to"))
        named, own = joined(named), joined(placed).distinct()
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_set = named.select("fp1", "fp2", "component").join(least, "component").drop("component")
    has_set = (sketch.n_shingles > 0) & sketch.doc_id.isNotNull()
    out = (rows.join(by_set.toDF("g1", "g2", "component_id"),
                     has_set & (rows.fp1 == F.col("g1")) & (rows.fp2 == F.col("g2")), "left")
           .select("doc_id", "n_shingles", "component_id"))
    if own is not None:
        of_id = own.join(least, "component").select("doc_id", F.col("component_id").alias("own"))
        out = out.join(of_id, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "own")).drop("own")
    return (out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, th = xxhash64 of the text) of the texts that go when one text of each group of near duplicates stays.

    Of a group the text with the smallest (doc_id, th) stays.  Texts are judged one by one, so a text that
    is like no other stays whatever its doc_id also names.
    """
    sketch, named, _ = _components_of_sets(docs, k, percent)
    texts = (sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "th", "fp1", "fp2")
             .join(named.select("fp1", "fp2", "component"), ["fp1", "fp2"]))
    first = texts.groupBy("component").agg(F.min(F.struct("doc_id", "th")).alias("first"))
    return (texts.join(first, "component").filter("doc_id <> first.doc_id OR th <> first.th")
            .select("doc_id", "th").distinct())
