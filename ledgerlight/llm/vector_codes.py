"""Vector code compression: product codebooks by Lloyd rounds over partition-local cover trees.

Components become integers ``floor(scale * x)`` and vectors are cut into ``parts`` equal
consecutive parts; each part position has a codebook, which starts as that part of the
vectors with the smallest ids.  A round assigns every part to the nearest entry of its
codebook (squared Euclidean distance, ties to the lower index) and moves each entry to
``floor(sum / count)`` of its parts; entries without parts stay.

Each task cuts its vectors into blocks and builds, per block and part position, a cover
tree: a node is a centre and all points within its radius, its children are centres more
than ``SHRINK`` of the radius apart that cover them.  Points lie in tree order, so a node
is a range, and prefix sums over that order give the sum of any node.  The trees are
written once.  A round walks all nodes of a depth together: where the nearest entry
stays nearest for everything in the node by the triangle inequality, the range is
assigned whole and only its sum is taken; the other nodes descend, at last to exact
comparisons of points.  All arithmetic that decides anything is on integers below 2**53
held in doubles, or on 64-bit integers.  A task gives one sum and count per entry, Spark
adds them, and only the codebooks (``parts * entries`` rows) reach the driver.

Vectors that are null or hold null or non-finite components are dropped; other rows are
kept, repeated ones too.  Rows without an id come after all others when the first
codebook is chosen, rows that share an id in the order of their components.  Shorter
vectors count as filled up with zeros to the longest one, and that to a multiple of
``parts``.  With fewer rows than entries there are as many entries as rows.  An empty
table gives no rows.  Without a label column all labels are null.  Components whose
distances may not stay exact raise OverflowError.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from ledgerlight.llm.exact_topk import floor_components, is_finite_vector, padded
from ledgerlight.llm.stage import share_package, stage

PARTS, ENTRIES, ROUNDS = 4, 256, 4
BLOCK_ROWS, LEAF, SHRINK = 1024, 8, 0.7
LABEL_SALTS = 16


class CoverTree:
    """A cover tree over integer points, as arrays; ``order`` lists the points in tree order."""

    FIELDS = ("order", "start", "end", "low", "high", "radius", "gap")

    def __init__(self, points: np.ndarray, **arrays: np.ndarray) -> None:
        self.points = points  # in tree order
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, points: np.ndarray) -> "CoverTree":
        n = len(points)
        x = points.astype(np.float64)
        norm = (x * x).sum(axis=1)
        apart = np.sqrt(np.maximum(norm[:, None] + norm[None, :] - 2 * (x @ x.T), 0))  # one block only
        order = np.arange(n)
        start, end, radius, gap = [0], [n], [float(apart[0].max())], [0.0]
        low, high = [], []
        i = 0
        while i < len(start):
            s, e, r = start[i], end[i], radius[i]
            low.append(len(start))
            if r > 0 and e - s > LEAF:
                centre, rest, at, pieces = order[s], order[s:e], s, []
                while len(rest):
                    d = apart[rest[0], rest]
                    near = d <= SHRINK * r
                    mine = rest[near]
                    start.append(at)
                    at += len(mine)
                    end.append(at)
                    radius.append(float(d[near].max()))
                    gap.append(float(apart[centre, mine[0]]))
                    pieces.append(mine)
                    rest = rest[~near]
                order[s:e] = np.concatenate(pieces)
            high.append(len(start))
            i += 1
        ints = {"order": order, "start": start, "end": end, "low": low, "high": high}
        up = {k: np.array(v) * (1 + 1e-12) for k, v in (("radius", radius), ("gap", gap))}  # never too small
        return cls(points[order], **{k: np.array(v, np.int32) for k, v in ints.items()}, **up)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, points=self.points, **{n: getattr(self, n) for n in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> "CoverTree":
        with np.load(io.BytesIO(raw)) as held:
            return cls(**{n: held[n] for n in ("points", *cls.FIELDS)})

    def assign(self, book: np.ndarray) -> "Assigned":
        """Each point's nearest entry, with the ranges that were decided whole."""
        centres = book.astype(np.float64)
        length = (centres * centres).sum(axis=1)

        def two_best(x):
            x = x.astype(np.float64)
            d = (x * x).sum(axis=1)[:, None] + length - 2 * (x @ centres.T)
            first = d.argmin(axis=1)
            rows = np.arange(len(x))
            least = d[rows, first]
            d[rows, first] = np.inf
            return first, np.sqrt(least), np.sqrt(d.min(axis=1, initial=np.inf))

        def ranges(lo, hi):
            """The numbers of all ranges lo:hi, and for each the range it is from."""
            size = hi - lo
            owner = np.repeat(np.arange(len(lo)), size)
            return np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size), owner

        codes = np.empty(len(self.points), np.int32)
        whole_nodes, whole_codes, loose = [], [], []
        nodes = np.zeros(1 if len(codes) else 0, np.int64)
        while len(nodes):
            first, d1, d2 = two_best(self.points[self.start[nodes]])
            radius = self.radius[nodes]
            whole = (radius == 0) | ((d1 + 2 * radius) * (1 + 1e-9) < d2)
            whole_nodes.append(nodes[whole])
            whole_codes.append(first[whole])
            inner = self.high[nodes] > self.low[nodes]
            points, _ = ranges(self.start[nodes[~whole & ~inner]].astype(np.int64), self.end[nodes[~whole & ~inner]])
            loose.append(points)
            down = ~whole & inner
            children, owner = ranges(self.low[nodes[down]].astype(np.int64), self.high[nodes[down]])
            # what the parent's distances already tell about a child
            reach = self.gap[children] + self.radius[children]
            near = (d1[down][owner] + 2 * reach) * (1 + 1e-9) < d2[down][owner]
            whole_nodes.append(children[near])
            whole_codes.append(first[down][owner][near])
            nodes = children[~near]
        decided = np.concatenate(whole_nodes) if whole_nodes else np.zeros(0, np.int64)
        entry = np.concatenate(whole_codes) if whole_codes else np.zeros(0, np.int64)
        covered, owner = ranges(self.start[decided].astype(np.int64), self.end[decided])
        codes[covered] = entry[owner]
        single = np.concatenate(loose) if loose else np.zeros(0, np.int64)
        for i in range(0, len(single), 4096):
            some = single[i:i + 4096]
            codes[some] = two_best(self.points[some])[0]
        return Assigned(codes, decided, entry, single)

    def sums(self, found: "Assigned", entries: int) -> tuple[np.ndarray, np.ndarray]:
        """Sum and count of the points of each entry: ranges by prefix sums, the other points one by one."""
        total = np.zeros((entries, self.points.shape[1]), np.int64)
        count = np.zeros(entries, np.int64)
        prefix = np.zeros((len(self.points) + 1, self.points.shape[1]), np.int64)
        np.cumsum(self.points, axis=0, out=prefix[1:])
        s, e = self.start[found.nodes], self.end[found.nodes]
        np.add.at(total, found.entry, prefix[e] - prefix[s])
        np.add.at(count, found.entry, (e - s).astype(np.int64))
        np.add.at(total, found.codes[found.single], self.points[found.single])
        np.add.at(count, found.codes[found.single], 1)
        return total, count


class Assigned:
    def __init__(self, codes: np.ndarray, nodes: np.ndarray, entry: np.ndarray, single: np.ndarray) -> None:
        self.codes, self.nodes, self.entry, self.single = codes, nodes, entry, single


def first_rows(rows: DataFrame, n: int, count: int) -> list[Row]:
    """The ``n`` rows with the smallest ids (null ids last), then components.

    Only rows up to an id that lets about ``2 * n`` pass (were ids spread evenly) are sorted, so the
    tasks together send that many to the driver; where fewer pass, the limit is raised.
    """
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    span = rows.agg(F.min("vec_id"), F.max("vec_id")).first()
    share = 2 * n / max(count, 1)
    while True:
        everything = share >= 1 or span[0] is None
        some = rows if everything else rows.filter(F.col("vec_id") <= span[0] + int((span[1] - span[0]) * share))
        got = some.orderBy(*order).limit(n).collect()
        if everything or len(got) == n:
            return got
        share *= 8


def _forest(width: int, parts: int):
    """Blocks of rows with one cover tree per part position."""
    def run(batches):
        for batch in batches:
            x = padded(batch.column("vector"), width)
            row = batch.column("row")
            for i in range(0, len(x), BLOCK_ROWS):
                some = x[i:i + BLOCK_ROWS]
                trees = [CoverTree.build(p).dump() for p in np.split(some, parts, axis=1)]
                bounds = pa.array([0, len(some)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(bounds, row.slice(i, len(some))), pa.array([trees], pa.list_(pa.binary()))],
                    ["rows", "trees"])
    return run


def codebooks_hash(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for book in books for v in book.ravel()).encode()).hexdigest()


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
           scale: int = 1024) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) for every kept row, and the final codebooks (one array of entries per part)."""
    spark = vectors.sparkSession
    share_package(spark)
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    kept = vectors.filter(is_finite_vector(F.col("embedding").cast("array<double>")))
    rows = stage(kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"),
                             floor_components(F.col("embedding"), scale).alias("vector")), "vectors")
    out = f"vec_id bigint, label {rows.schema['label'].dataType.simpleString()}, code string, error bigint"
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"),
                    F.max(F.array_max(F.transform("vector", lambda v: F.greatest(v, -v)))).alias("top")).first()
    if not size.n:
        return spark.createDataFrame([], out), []
    each = max(1, -(-(size.width or 0) // parts))
    width, top = each * parts, size.top or 0
    if width * 4 * (top + 1) ** 2 >= 1 << 53:
        raise OverflowError(f"distances of {width} components up to {top} may not stay exact")
    seed = np.zeros((min(entries, size.n), width), np.int64)
    for i, r in enumerate(first_rows(rows.select("vec_id", "vector"), entries, size.n)):
        seed[i, :len(r.vector)] = r.vector
    books = np.split(seed, parts, axis=1)
    forest = stage(rows.select(F.struct("vec_id", "label").alias("row"), "vector").mapInArrow(
        _forest(width, parts), f"rows array<struct<vec_id:bigint,label:{rows.schema['label'].dataType.simpleString()}>>, "
                               "trees array<binary>"), "trees")
    columns = [f"s{i}" for i in range(each)]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)  # parts * entries rows
        grown = forest.select("trees").mapInArrow(
            _partial_sums(shared, parts, columns),
            "part int, entry int, " + ", ".join(f"{c} bigint" for c in columns) + ", n bigint")
        moved = grown.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in columns], F.sum("n").alias("n"))
        books = [b.copy() for b in books]
        for r in moved.collect():  # a row per entry
            books[r.part][r.entry] = [r[c] // r.n for c in columns]
        shared.unpersist()
    final = spark.sparkContext.broadcast(books)
    coded = forest.mapInArrow(_codes(final, parts, rows.schema["label"].dataType), out)
    return stage(coded, "codes"), books


def _partial_sums(shared, parts: int, columns: list[str]):
    def run(batches):
        books = shared.value
        total = [np.zeros(b.shape, np.int64) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for trees in batch.column("trees"):
                for p, raw in enumerate(trees.as_py()):
                    tree = CoverTree.load(raw)
                    add, n = tree.sums(tree.assign(books[p]), len(books[p]))
                    total[p] += add
                    count[p] += n
        for p in range(parts):
            some = np.flatnonzero(count[p])
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), p, np.int32)), pa.array(some.astype(np.int32)),
                     *(pa.array(total[p][some, i]) for i in range(len(columns))), pa.array(count[p][some])],
                    ["part", "entry", *columns, "n"])
    return run


def _codes(shared, parts: int, label_type):
    def run(batches):
        books = shared.value
        digits = max(2, len(f"{max(len(b) for b in books) - 1:x}"))
        names = np.array([f"{i:0{digits}x}" for i in range(max(len(b) for b in books))])
        for batch in batches:
            rows = batch.column("rows")
            for i in range(batch.num_rows):
                here = rows[i].values
                code = np.zeros((len(here), parts), np.int64)
                error = np.zeros(len(here), np.int64)
                for p, raw in enumerate(batch.column("trees")[i].as_py()):
                    tree = CoverTree.load(raw)
                    found = tree.assign(books[p])
                    away = tree.points - books[p][found.codes]
                    code[tree.order, p] = found.codes
                    error[tree.order] += (away * away).sum(axis=1)
                text = names[code[:, 0]]
                for p in range(1, parts):
                    text = np.char.add(text, names[code[:, p]])
                yield pa.RecordBatch.from_arrays([here.field("vec_id"), here.field("label"), pa.array(text.tolist(), pa.string()),
                                                  pa.array(error)], ["vec_id", "label", "code", "error"])
    return run


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors of all rows with an equal label (nulls together), summed.

    Sums are combined before the shuffle; they are joined back to the rows of a label in ``LABEL_SALTS`` shares,
    so a label that most rows have is not one task's.
    """
    sums = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    shares = sums.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    share = F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(LABEL_SALTS)).cast("int")
    dealt = coded.withColumn("_ll_share", share)
    return dealt.join(shares, F.col("label").eqNullSafe(F.col("same")) & (F.col("_ll_share") == F.col("share"))).select(
        *coded.columns, "label_error")


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 with the default parameters."""
    coded, books = encode(vectors)
    return (with_label_error(coded).withColumn("codebooks_sha256", F.lit(codebooks_hash(books)))
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))
