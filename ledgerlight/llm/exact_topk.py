"""Exact top-k search by integer inner product: a Voronoi join of queries and vectors.

Components become integers ``floor(scale * x)``.  Pivots (means of a bounded sample) cut
the space into at most ``MAX_CELLS`` cells; vectors and queries go to the cell of their
nearest pivot and are packed there into blocks of about ``BLOCK`` vectors and
``QUERY_BLOCK`` queries.  Two things bound what has to meet:

* a summary of each cell: the largest distance of a vector from the pivot, the range of
  the vectors' components along the pivot, the largest length of what is left of them.
  From it follows the most that a query's product with any vector of the cell can be;
* for each query the ``k``-th best product with the sample, which its ``k``-th best
  answer can't be below.

A block of queries is copied only to the cells that may hold an answer of one of its
queries, there to each block of vectors, and searched exactly.  Where bounds are loose
(vectors of many independent components) most cells are needed, and the search is whole
anyway.  Nothing but the sample and the cell summaries reaches the driver.

Groups stay bounded however vectors repeat: of the rows with one vector only those of the
``k + 1`` smallest ids can be answers to any query, and a window limit drops the others
before the vectors are shuffled; cells with many vectors have many blocks; the queries
that meet a block are dealt into groups of about ``QUERY_GROUP``.

Rows whose vector is null or holds null or non-finite components, and rows without an
id, take no part.  Missing components of shorter vectors count as zero (an empty vector
is a zero vector).  Rows equal in id and vector count once.  Rows that share an id with
different vectors are queries and answers of their own, but no row is an answer to its
own id.  An empty table gives no rows, nor does a query without candidates.  Products
that may not fit 64 bits raise OverflowError.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.llm.stage import share_package, smallest_keys, stage

SAMPLE, MAX_CELLS, MEANS = 2048, 64, 8
BLOCK, QUERY_BLOCK, QUERY_GROUP = 1024, 256, 8192


def floor_components(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component as bigint."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint"))


def is_finite_vector(vector: Column) -> Column:
    """True for a vector that is not null and holds neither null nor non-finite components."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & sound, F.lit(False))


def padded(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column of integers as a matrix of ``width`` columns, zeros where a row has fewer."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and sizes.min() == sizes.max() == width:
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def products(queries: np.ndarray, x: np.ndarray, exact_float: bool) -> np.ndarray:
    """Integer inner products; in double precision where every partial sum stays below 2**53."""
    if exact_float:
        return (queries.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return queries.astype(np.int64) @ x.astype(np.int64).T


def pivots(sample: np.ndarray, cells: int, seed: int = 3) -> np.ndarray:
    """At most ``cells`` means of the sample (at least one)."""
    rng = np.random.default_rng(seed)
    x = np.unique(sample.astype(float), axis=0)
    centres = x[np.sort(rng.choice(len(x), min(cells, len(x)), replace=False))]
    for _ in range(MEANS):
        near = nearest(x, centres)
        size = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)


def split(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector and pivot: the component along the pivot, and the length of the rest."""
    length = np.linalg.norm(centres, axis=1)
    unit = centres / np.where(length > 0, length, 1)[:, None]
    along = x @ unit.T
    return along, np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] - along * along, 0))


def upper_bounds(x: np.ndarray, centres: np.ndarray, summary: np.ndarray) -> np.ndarray:
    """The most that each query's product with a vector of each cell can be (a little more, for rounding).

    ``summary`` has per cell: largest distance, least and largest component along the pivot,
    largest rest; cells without vectors have -inf.
    """
    filled = np.isfinite(summary[:, 0])
    summary = np.where(filled[:, None], summary, 0)
    length = np.linalg.norm(x, axis=1)[:, None]
    ball = x @ centres.T + length * summary[:, 0]
    along, rest = split(x, centres)
    cone = np.maximum(along * summary[:, 1], along * summary[:, 2]) + rest * summary[:, 3]
    slack = 1e-9 * (1 + length * (np.linalg.norm(centres, axis=1) + np.abs(summary).max(axis=1, initial=0)))
    bound = np.minimum(ball, cone) + slack
    return np.where(filled, bound, -np.inf)


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """Each row's ``k``-th largest value, the smallest integer where there are fewer columns."""
    if scores.shape[1] < k:
        return np.full(len(scores), np.iinfo(np.int64).min)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


NONE = np.iinfo(np.int64).min


def best_of_block(qids: np.ndarray, q: np.ndarray, least: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int,
                  exact_float: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, score) of each query's ``k`` best vectors of a block, ``ids`` ascending; none below ``least``."""
    score = products(q, x, exact_float)
    own = qids[:, None] == ids[None, :]
    score[own] = NONE
    floor = np.maximum(kth_best(score, min(k, len(ids))), least)
    asked, found = np.nonzero((score >= floor[:, None]) & ~own)
    value = score[asked, found]
    order = np.lexsort((found, -value, asked))
    asked, found, value = asked[order], found[order], value[order]
    first = np.searchsorted(asked, np.arange(len(qids)))
    keep = np.arange(len(asked)) - first[asked] < k
    return asked[keep], ids[found[keep]], value[keep]


def _pack(width: int):
    """The rows of one block as one row of binary columns, by ascending id."""
    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        x = padded(table["vector"], width)[order]
        return pa.table({"cell": table["cell"][:1].cast(pa.int32()), "block": table["block"][:1].cast(pa.int32()),
                         "ids": pa.array([ids[order].tobytes()], pa.binary()),
                         "vectors": pa.array([x.astype("<i8").tobytes()], pa.binary())})
    return run


_PACKED = "cell int, block int, ids binary, vectors binary"


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows with a block number within their cell, about ``size`` rows a block."""
    many = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("many"))  # a row per cell
    return (rows.join(F.broadcast(many), "cell")
            .withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.col("many")).cast("int")).drop("many"))


def search(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` largest integer products; queries are rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    share_package(spark)
    raw = vectors.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("raw"))
    raw = raw.filter(F.col("id").isNotNull() & is_finite_vector(F.col("raw").cast("array<double>")))
    rows = stage(raw.select("id", floor_components(F.col("raw"), scale).alias("vector")).distinct(), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"),
                    F.max(F.array_max(F.transform("vector", lambda v: F.greatest(v, -v)))).alias("top")).first()
    width, top = max(size.width or 0, 1), size.top or 0
    if width * top * top >= 1 << 63:
        raise OverflowError(f"products of {width} components up to {top} do not fit a 64-bit integer")
    exact_float = width * top * top < 1 << 53
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not size.n:
        return spark.createDataFrame([], schema)
    picked = smallest_keys(rows.select("id", "vector", F.xxhash64("vector", "id").alias("key")), "key", size.n, SAMPLE)
    sample = np.zeros((len(picked), width), np.int64)
    for i, r in enumerate(picked):
        sample[i, :len(r.vector)] = r.vector
    sample_ids = np.array([r.id for r in picked], np.int64)
    centres = pivots(sample, min(MAX_CELLS, max(2, math.isqrt(size.n))))
    known = spark.sparkContext.broadcast((centres, sample_ids, sample))  # bounded by SAMPLE and MAX_CELLS

    def place(batches):
        for batch in batches:
            x = padded(batch.column("vector"), width).astype(float)
            c = known.value[0]
            cell = nearest(x, c)
            along, rest = split(x, c)
            pick = np.arange(len(x)), cell
            parts = [pa.array(cell.astype(np.int32)), pa.array(np.linalg.norm(x - c[cell], axis=1)),
                     pa.array(along[pick]), pa.array(rest[pick])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *parts], ["id", "vector", "cell", "dist", "along", "rest"])

    placed = "id bigint, vector array<bigint>, cell int, dist double, along double, rest double"
    same = Window.partitionBy("vector").orderBy("id")
    answers = (rows.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1).select("id", "vector"))
    index = stage(answers.mapInArrow(place, placed), "cells")
    per_cell = index.groupBy("cell").agg(F.max("dist"), F.min("along"), F.max("along"), F.max("rest"),
                                         F.count(F.lit(1))).collect()  # at most MAX_CELLS rows
    summary = np.full((len(centres), 4), -np.inf)
    for r in per_cell:
        summary[r[0]] = r[1:5]
    packed = stage(_blocks(index.select("id", "vector", "cell"), block).groupBy("cell", "block")
                   .applyInArrow(_pack(width), _PACKED), "blocks")
    asking = rows.filter(F.col("id") % every == 0).mapInArrow(place, placed).select("id", "vector", "cell")
    asked = stage(_blocks(stage(asking, "asking"), QUERY_BLOCK).groupBy("cell", "block")
                  .applyInArrow(_pack(width), _PACKED), "queries")
    cells = spark.sparkContext.broadcast(summary)

    def route(batches):
        """The cells that each block of queries must visit, and what its queries' answers can't be below."""
        for batch in batches:
            needed, least = [], []
            for ids, x in zip(batch.column("ids"), batch.column("vectors")):
                qids = np.frombuffer(ids.as_py(), "<i8")
                q = np.frombuffer(x.as_py(), "<i8").reshape(len(qids), width)
                c, sids, near = known.value
                score = products(q, near, exact_float)
                score[qids[:, None] == sids[None, :]] = NONE
                bar = kth_best(score, k)
                bound = upper_bounds(q.astype(float), c, cells.value)
                hit = (bound >= bar.astype(float)[:, None] - 1e-9 * np.abs(bar)[:, None]) & np.isfinite(bound)
                needed.append(np.flatnonzero(hit.any(axis=0)).astype(np.int32).tolist())
                least.append(bar.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least, pa.binary()), pa.array(needed, pa.list_(pa.int32()))],
                ["qcell", "qblock", "qids", "qvectors", "least", "needed"])

    routed = asked.mapInArrow(route, "qcell int, qblock int, qids binary, qvectors binary, least binary, needed array<int>")
    groups = max(1, -(-size.n // (every * QUERY_GROUP)))
    listed = packed.select(F.col("cell").alias("cell"), F.col("block").alias("block"))  # the numbers alone
    sent = (routed.withColumn("cell", F.explode("needed")).drop("needed")
            .hint("merge").join(listed, "cell")  # copies of query blocks: never a broadcast side
            .withColumn("part", F.pmod(F.xxhash64("qcell", "qblock"), F.lit(groups)).cast("int")))
    held = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def solve(questions: pa.Table, block_row: pa.Table) -> pa.Table:
        out = {n: [] for n in ("qcell", "qblock", "qpos", "query_id", "vec_id", "score")}
        if block_row.num_rows:
            ids = np.frombuffer(block_row["ids"][0].as_py(), "<i8")
            x = np.frombuffer(block_row["vectors"][0].as_py(), "<i8").reshape(len(ids), width)
            for i in range(questions.num_rows):
                qids = np.frombuffer(questions["qids"][i].as_py(), "<i8")
                q = np.frombuffer(questions["qvectors"][i].as_py(), "<i8").reshape(len(qids), width)
                at, vec, score = best_of_block(qids, q, np.frombuffer(questions["least"][i].as_py(), "<i8"), ids, x, k,
                                               exact_float)
                for name, values in (("qcell", np.full(len(at), questions["qcell"][i].as_py())),
                                     ("qblock", np.full(len(at), questions["qblock"][i].as_py())), ("qpos", at),
                                     ("query_id", qids[at]), ("vec_id", vec), ("score", score)):
                    out[name].append(values)
        return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for n, v in out.items()})

    found = (sent.groupBy("cell", "block", "part").cogroup(held.groupBy("cell", "block", "part"))
             .applyInArrow(solve, "qcell bigint, qblock bigint, qpos bigint, query_id bigint, vec_id bigint, score bigint"))
    best = Window.partitionBy("qcell", "qblock", "qpos").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
