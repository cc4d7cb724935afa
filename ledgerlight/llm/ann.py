"""Approximate nearest neighbours by learned partitions.

On a bounded sample (an eighth of the rows, but ``SAMPLE`` to ``MAX_SAMPLE``: the distinct
vectors with the smallest hashes) an exact neighbour graph is built and cut into balanced
parts, one for every 40 vectors of the sample at most: balanced clustering, then
sweeps that move vertices to the part of most of their neighbours while parts stay
near equal size.  A small network learns, for a vector, how its neighbours spread
over the parts.  Every vector is indexed in its most probable part; a query goes to
its most probable parts, as many as hold ``TARGET`` of the true neighbours on
the sample, and is reranked there exactly (inner product in double precision, ties to
the smaller id).

Equal vectors score alike, so for each distinct vector only its smallest ``k + 1`` ids
can be answers; a window limit drops the others before the shuffle.  Distinct query
vectors are searched once.  The vectors of a part are dealt into blocks of about
``BLOCK_ROWS``, its queries likewise; a task holds one block of each.

Vectors that are null, empty, all zero, hold null or non-finite components, or differ
in length from the most common length take no part.  Rows that share an id
are one answer, at the best score of them; no row is an answer to its own id.  Empty tables
give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlight.llm.stage import share_package, smallest_keys, stage

SAMPLE, MAX_SAMPLE, NEIGHBOURS = 6000, 24_000, 20
PART_ROWS, MIN_PARTS = 1000, 16
TARGET = 0.97
BLOCK_ROWS = 4096
HIDDEN, STEPS, RATE = 128, 300, 4e-3


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vector")).filter("vec_id IS NOT NULL")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vector").isNotNull() & sound & F.exists("vector", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (size.n if size else 0))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of each vector's ``k`` nearest others by inner product."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int32)
    for i in range(0, len(x), 512):
        score = x[i:i + 512] @ x.T
        score[np.arange(len(score)), np.arange(i, i + len(score))] = -np.inf
        out[i:i + 512] = np.argpartition(-score, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """A part for each vertex: near-equal sizes, few neighbours across."""
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(1.05 * len(x) / parts))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = unit[rng.choice(len(x), parts, replace=False)]
    for _ in range(12):
        part = _fill(unit @ centres.T, limit)
        sums = np.zeros_like(centres)
        np.add.at(sums, part, unit)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    for _ in range(6):  # refine on the graph
        votes = np.zeros((len(x), parts), np.float32)
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        votes[np.arange(len(x)), part] += 0.5
        part = _fill(votes + 1e-3 * (unit @ centres.T), limit)
    return part


def _fill(gain: np.ndarray, limit: int) -> np.ndarray:
    """Each row to its best column with room, rows with the clearest choice first."""
    order = np.argsort(-gain, axis=1)
    top = np.take_along_axis(gain, order[:, :2], axis=1)
    first = np.argsort(-(top[:, 0] - top[:, -1]), kind="stable")
    room = np.full(gain.shape[1], limit)
    part = np.empty(len(gain), np.int64)
    for i in first:
        for p in order[i]:
            if room[p]:
                part[i] = p
                room[p] -= 1
                break
    return part


class Router:
    """A one-hidden-layer network from a vector to probabilities of parts."""

    def __init__(self, x: np.ndarray, part: np.ndarray, graph: np.ndarray, parts: int, seed: int = 9) -> None:
        rng = np.random.default_rng(seed)
        unit = self._unit(x).astype(np.float32)
        target = np.zeros((len(x), parts), np.float32)
        if graph.shape[1]:
            np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1 / graph.shape[1])
        target = 0.7 * target + 0.3 * np.eye(parts, dtype=np.float32)[part]
        f = np.float32
        w = [rng.normal(0, 1, (x.shape[1], HIDDEN)).astype(f), np.zeros(HIDDEN, f),
             rng.normal(0, HIDDEN**-0.5, (HIDDEN, parts)).astype(f), np.zeros(parts, f)]
        m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
        for t in range(1, STEPS + 1):
            pick = rng.choice(len(x), min(len(x), 1024), replace=False)
            a, y = unit[pick], target[pick]
            h = np.maximum(a @ w[0] + w[1], 0)
            d = (_softmax(h @ w[2] + w[3]) - y) / len(pick)
            dh = (d @ w[2].T) * (h > 0)
            for j, g in enumerate((a.T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                m[j] += f(0.1) * (g - m[j])
                v[j] += f(0.001) * (g * g - v[j])
                w[j] -= f(RATE * (1 - t / (STEPS + 1))) * (m[j] / f(1 - 0.9**t)) / (np.sqrt(v[j] / f(1 - 0.999**t)) + f(1e-8))
        self.weights, self.parts = w, parts

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        scale = np.abs(x).max(axis=1, keepdims=True)
        y = x / np.where(scale > 0, scale, 1)
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, most probable first."""
        w = self.weights
        return np.argsort(-(np.maximum(self._unit(x).astype(np.float32) @ w[0] + w[1], 0) @ w[2] + w[3]), axis=1,
                          kind="stable")


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_router(sample: np.ndarray, rows: int, target: float = TARGET) -> tuple[Router, int]:
    """The router for about ``rows`` vectors and the number of parts a query visits.

    A part has 40 or more vectors of the sample, so samples under 80 vectors make one part.
    """
    parts = max(1, min(max(MIN_PARTS, rows // PART_ROWS), len(sample) // 40))
    graph = neighbour_graph(sample, NEIGHBOURS)
    part = balanced_parts(sample, graph, parts)
    router = Router(sample, part, graph, parts)
    ranked = router.ranked(sample)
    place = np.argsort(ranked, axis=1)  # rank of each part for each query
    depth = np.take_along_axis(place, ranked[:, 0][graph], axis=1)
    found = np.array([(depth < m).sum() >= target * depth.size for m in range(1, parts + 1)])
    return router, int(np.argmax(found)) + 1


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _rerank(k: int):
    """The ``k`` best ids of one block for each query sent to it, by exact scores in double precision."""
    def run(table: pa.Table) -> pa.Table:
        query = np.array(table["is_query"].to_pylist(), bool)
        x, ids = _matrix(table["vector"]), table["id"].to_numpy()
        rows, asked = np.flatnonzero(~query), np.flatnonzero(query)
        # the best row of an id is among so many best rows, however often other ids repeat
        wide = k + len(rows) - len(np.unique(ids[rows]))
        out = {"qid": [], "best": []}
        for i in range(0, len(asked) if len(rows) else 0, 256):
            some = asked[i:i + 256]
            rough = x[some] @ x[rows].T
            for q, r in zip(some, rough):
                least = np.partition(r, len(r) - wide)[len(r) - wide] if len(r) > wide else -np.inf
                near = rows[r >= least - 1e-9 * max(1.0, np.abs(r).max())]  # rounding may hide ties
                score = (x[near] * x[q]).sum(axis=1)
                order = np.lexsort((ids[near], -score))
                if wide > k:
                    order = order[np.sort(np.unique(ids[near][order], return_index=True)[1])]
                order = order[:k]
                out["qid"].append(int(ids[q]))
                out["best"].append([{"neg": -float(score[o]), "vec_id": int(ids[near[o]])} for o in order])
        best = pa.list_(pa.struct([("neg", pa.float64()), ("vec_id", pa.int64())]))
        return pa.table({"qid": pa.array(out["qid"], pa.int64()), "best": pa.array(out["best"], best)})
    return run


def search(vectors: DataFrame, every: int = 20, k: int = 20, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    share_package(spark)
    rows = usable(vectors)
    count = rows.count()
    picked = smallest_keys(rows.select("vector", F.xxhash64("vector").alias("key")), "key", count, min(MAX_SAMPLE, max(SAMPLE, count // 8)))
    sample = np.array([r.vector for r in picked], float)
    router, probes = fit_router(sample, count, target) if count else (None, 1)
    shared = spark.sparkContext.broadcast(router)  # a fixed number of weights per part

    def route(batches):
        for batch in batches:
            x = _matrix(batch.column("vector"))
            many = probes if batch.num_rows and batch.column("is_query")[0].as_py() else 1
            ranked = shared.value.ranked(x)[:, :many]
            bounds = pa.array(np.arange(len(x) + 1, dtype=np.int32) * ranked.shape[1])
            parts = pa.ListArray.from_arrays(bounds, pa.array(ranked.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts], [*batch.schema.names, "parts"])

    same = Window.partitionBy("vector").orderBy("vec_id")
    index = (rows.dropDuplicates().withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1)
             .select(F.col("vec_id").alias("id"), "vector", F.lit(False).alias("is_query")))
    asking = rows.filter(F.col("vec_id") % every == 0)
    distinct = (asking.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= 1)
                .select(F.col("vec_id").alias("id"), "vector", F.lit(True).alias("is_query")))
    schema = "id bigint, vector array<double>, is_query boolean, parts array<int>"
    routed = stage(index.mapInArrow(route, schema).unionByName(distinct.mapInArrow(route, schema)), "routed")
    routed = routed.select("id", "vector", "is_query", F.explode("parts").alias("part"))
    blocks_of = lambda asked: F.ceil(F.count_if(F.col("is_query") == asked) / BLOCK_ROWS).cast("int")
    sizes = (routed.groupBy("part").agg(blocks_of(False).alias("rows"), blocks_of(True).alias("asks"))
             .filter("rows > 0 AND asks > 0"))  # a row per part
    placed = routed.join(sizes, "part")
    deal = lambda own, n: F.explode(F.when(own, F.array(F.pmod(F.xxhash64("id"), F.col(n)).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.col(n) - 1)))
    dealt = (placed.withColumn("block", deal(~F.col("is_query"), "rows"))
             .withColumn("ask", deal(F.col("is_query"), "asks")).drop("rows", "asks"))
    found = dealt.groupBy("part", "block", "ask").applyInArrow(
        _rerank(k + 1), "qid bigint, best array<struct<neg:double,vec_id:bigint>>")
    best = found.groupBy("qid").agg(F.array_sort(F.flatten(F.collect_list("best"))).alias("best"))
    ids = F.col("best.vec_id")
    once = F.filter("best", lambda b, i: F.array_position(ids, b["vec_id"]) == i + 1)  # an id may come from several blocks
    best = best.select("qid", F.slice(F.when(F.size(F.array_distinct(ids)) < F.size(ids), once).otherwise(F.col("best")),
                                      1, k + 1).alias("best"))
    answers = best.join(distinct.select(F.col("id").alias("qid"), "vector"), "qid").select("vector", "best")
    own_out = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    listed = asking.select(F.col("vec_id").alias("query_id"), "vector").distinct().join(answers, "vector")
    return (listed.select("query_id", F.posexplode(own_out).alias("rank", "b"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), "b.vec_id", (-F.col("b.neg")).alias("score")))
