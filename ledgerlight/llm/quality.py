"""Document quality by a byte-level convolutional network in numpy.

A document is cut into chunks of ``CHUNK`` bytes, one every ``STEP`` bytes, so
neighbouring chunks overlap and the whole text is covered (the last chunk is
padded with zero bytes; an empty text is one padded chunk).  Bytes are embedded,
learned filters run over windows of ``WIDTH`` bytes, each filter is max-pooled
over its chunk, a hidden layer follows, and its mean over all chunks gives one
logit and one probability per document.

The network is fitted on a bounded sample: at most ``PER_LABEL`` documents of
each label (those with the smallest hashes of their id), at most ``FIT_CHUNKS``
chunks of each, spread evenly over the document, and one short excerpt of each.  Scoring reads every chunk of every
document.  Only the text is an input.  Labels of rows with
``crc32(doc_id as text) mod 3 = 1`` are held out and never read.

Null text scores as empty text; a null doc_id is not held out and never a
training row; a document labelled more than once takes its smallest label.
Without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.llm.stage import share_package
from ledgerlight.llm.text_arrays import utf8_buffer

CHUNK, STEP, WIDTH, HOP = 400, 384, 12, 4
DIMS, FILTERS, HIDDEN = 8, 64, 24
WINDOWS = (CHUNK - WIDTH) // HOP + 1
PER_LABEL, FIT_CHUNKS = 2500, 16
EPOCHS, BATCH_DOCS, RATE = 12, 32, 3e-3
GROUP = 64  # chunks pushed through the network at once

Model = dict[str, np.ndarray]


def held_out(doc_id: Column | str) -> Column:
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def chunk_starts(size: int) -> np.ndarray:
    """Where the chunks of a document of ``size`` bytes start."""
    return np.arange(max(1, -(-(size - (CHUNK - STEP)) // STEP))) * STEP


def chunk_matrix(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Bytes of chunks from ``starts``, zero from each document's stop on."""
    at = starts[:, None] + np.arange(CHUNK)
    if not len(data):
        return np.zeros(at.shape, np.uint8)
    return np.where(at < stops[:, None], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)


def _windows(model: Model, chunks: np.ndarray) -> np.ndarray:
    x = np.ascontiguousarray(model["bytes"][chunks])
    s = x.strides
    view = as_strided(x, (len(chunks), WINDOWS, WIDTH * DIMS), (s[0], HOP * s[1], s[2]))
    return view.reshape(-1, WIDTH * DIMS)


def _pool(model: Model, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = _windows(model, chunks)
    y = (x @ model["filters"]).reshape(len(chunks), WINDOWS, FILTERS)
    return x, y, np.maximum(y.max(axis=1) + model["bias"], 0)


def _filled(chunks: np.ndarray) -> np.ndarray:
    """The share of each chunk that is text, not padding."""
    return (chunks != 0).mean(axis=1, dtype=np.float32)


def _middle(model: Model, pooled: np.ndarray, filled: np.ndarray) -> np.ndarray:
    return np.maximum(pooled @ model["mid"] + filled[:, None] * model["fill"] + model["mid_bias"], 0)


def hidden(model: Model, chunks: np.ndarray) -> np.ndarray:
    """Hidden layer of each chunk."""
    out = [_middle(model, _pool(model, chunks[i:i + GROUP])[2], _filled(chunks[i:i + GROUP]))
           for i in range(0, len(chunks), GROUP)]
    return np.concatenate(out) if out else np.zeros((0, HIDDEN), np.float32)


def _doc_mean(rows: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    sums = np.zeros((docs, rows.shape[1]))
    np.add.at(sums, doc, rows)
    return sums / np.maximum(np.bincount(doc, minlength=docs), 1)[:, None]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(texts: list[list[bytes]], labels: list[int], seed: int = 7, epochs: int = EPOCHS) -> Model | None:
    """Adam over mini-batches of documents (lists of chunks); None without both labels."""
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    chunks = [np.frombuffer(b"".join(t), np.uint8).reshape(-1, CHUNK) for t in texts]
    short, short_labels = _excerpts(chunks, labels, rng)
    chunks += short
    y = np.array([*labels, *short_labels], dtype=np.float64)
    f = np.float32
    model: Model = {
        "bytes": rng.normal(0, 0.5, (256, DIMS)).astype(f), "filters": rng.normal(0, 0.15, (WIDTH * DIMS, FILTERS)).astype(f),
        "bias": np.zeros(FILTERS, f), "mid": rng.normal(0, 0.2, (FILTERS, HIDDEN)).astype(f),
        "fill": np.zeros(HIDDEN, f), "mid_bias": np.full(HIDDEN, 0.1, f), "out": rng.normal(0, 0.3, HIDDEN).astype(f), "out_bias": np.zeros(1, f)}
    model["bytes"][0] = 0  # padding
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    steps = max(epochs, -(-600 // max(1, len(y) // BATCH_DOCS)))  # small samples take more passes
    t = 0
    for epoch in range(min(steps, 60)):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH_DOCS):
            pick = order[i:i + BATCH_DOCS]
            x = np.concatenate([chunks[p] for p in pick])
            doc = np.repeat(np.arange(len(pick)), [len(chunks[p]) for p in pick])
            grads = _gradients(model, x, doc, y[pick], weight[pick])
            t += 1
            rate = RATE * (1 - epoch / min(steps, 60)) + 1e-4
            for k, g in grads.items():
                first[k] += f(0.1) * (g - first[k])
                second[k] += f(0.001) * (g * g - second[k])
                model[k] -= (rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(f)
            model["bytes"][0] = 0
    return model


def _excerpts(chunks: list[np.ndarray], labels: list[int], rng) -> tuple[list[np.ndarray], list[int]]:
    """Short excerpts, one per document, so that short texts are judged by what they hold and not by their padding."""
    out, y = [], []
    for c, label in zip(chunks, labels):
        row = c[rng.integers(len(c))]
        least = 12 if label else 60  # a few bytes of a bad text need not look bad
        size = int(least * (300 / least) ** rng.random())
        at = rng.integers(0, max(1, int((row != 0).sum()) - size))
        part = np.zeros((1, CHUNK), np.uint8)
        part[0, :size] = row[at:at + size]
        if (part != 0).sum() >= least:
            out.append(part)
            y.append(label)
    return out, y


def _gradients(model: Model, x: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    xs, pooled, best = [], [], []
    for i in range(0, len(x), GROUP):  # only the winning window of each filter is kept for the way back
        flat, act, p = _pool(model, x[i:i + GROUP])
        at = act.argmax(axis=1)
        rows = np.arange(len(at))[:, None] * WINDOWS + at
        xs.append(flat[rows])
        pooled.append(p)
        best.append(at)
    won, p, at = np.concatenate(xs), np.concatenate(pooled), np.concatenate(best)
    filled = _filled(x)
    h = _middle(model, p, filled)
    share = (1 / np.bincount(doc, minlength=len(y)))[doc]
    mean = _doc_mean(h, doc, len(y))
    prob = sigmoid(mean @ model["out"] + model["out_bias"])
    d_logit = (prob - y) * weight / len(y)
    d_h = (d_logit[doc] * share)[:, None] * model["out"] * (h > 0)
    d_p = (d_h @ model["mid"].T) * (p > 0)
    d_p = d_p.astype(np.float32)
    d_won = d_p[:, :, None] * model["filters"].T  # chunk, filter, window input
    hit = x[np.arange(len(x))[:, None, None], (at * HOP)[:, :, None] + np.arange(WIDTH)].ravel()
    d_bytes = np.stack([np.bincount(hit, d_won.reshape(-1, DIMS)[:, k], 256) for k in range(DIMS)], axis=1)
    return {"bytes": d_bytes.astype(np.float32), "filters": np.einsum("cf,cfk->kf", d_p, won, optimize=True),
            "bias": d_p.sum(0), "mid": (p.T @ d_h).astype(np.float32), "mid_bias": d_h.sum(0).astype(np.float32), "fill": (filled @ d_h).astype(np.float32),
            "out": (mean.T @ d_logit).astype(np.float32), "out_bias": np.array([d_logit.sum()], np.float32)}


def score_column(model: Model | None, column: pa.Array) -> np.ndarray:
    """One probability per text of an Arrow column, from all its chunks."""
    data, offsets = utf8_buffer(column)
    n = len(offsets) - 1
    if model is None or not n:
        return np.full(n, 0.5)
    sizes = np.diff(offsets)
    count = np.maximum(1, -(-(sizes - (CHUNK - STEP)) // STEP))
    doc = np.repeat(np.arange(n), count)
    starts = offsets[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * STEP
    stops = offsets[1:][doc]
    sums = np.zeros((n, HIDDEN))
    for i in range(0, len(doc), 4096):
        part = slice(i, i + 4096)
        np.add.at(sums, doc[part], hidden(model, chunk_matrix(data, starts[part], stops[part])))
    return sigmoid(sums / count[:, None] @ model["out"] + model["out_bias"])


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL,
                    fit_chunks: int = FIT_CHUNKS) -> tuple[list[list[bytes]], list[int]]:
    """Chunks and labels of the bounded sample (at most ``2 * per_label * fit_chunks * CHUNK`` bytes)."""
    share_package(docs.sparkSession)
    known = (labels.filter(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    key = F.xxhash64(F.col("doc_id"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                raw = np.frombuffer((text or "").encode(), np.uint8)
                starts = chunk_starts(len(raw))
                if len(starts) > fit_chunks:
                    starts = starts[np.linspace(0, len(starts) - 1, fit_chunks).astype(int)]
                out.append([r.tobytes() for r in chunk_matrix(raw, starts, np.full(len(starts), len(raw)))])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"),
                                              pa.array(out, pa.list_(pa.binary()))], ["doc_id", "quality", "chunks"])

    picked = [known.filter(F.col("quality") == q).orderBy(key, "doc_id").limit(per_label) for q in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * per_label rows
    # of a doc_id with several rows one, by the hash of its text
    one = (texts.join(ids, "doc_id").withColumn("t", F.struct(F.xxhash64("text").alias("h"), "text"))
           .groupBy("doc_id", "quality").agg(F.min("t").alias("t")).select("doc_id", "quality", "t.text"))
    rows = (one.mapInArrow(run, "doc_id bigint, quality int, chunks array<binary>")
            .orderBy(key, "doc_id", F.xxhash64("chunks")).collect())
    return [[bytes(c) for c in r.chunks] for r in rows], [int(r.quality) for r in rows]


def fit_quality(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model | None:
    return fit(*training_sample(docs, labels.withColumn("quality", F.col("quality").cast("int")), per_label))


def score_documents(docs: DataFrame, model: Model | None, column: str = "score") -> DataFrame:
    """``docs`` with one more column, the probability of label 1 (replaces a column of that name)."""
    share_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 60 kB, fixed by the network's shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = pa.array(score_column(shared.value, b.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], [*b.schema.names, column])

    base = docs.drop(column).withColumn("text", F.col("text").cast("string"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, `{column}` double")
