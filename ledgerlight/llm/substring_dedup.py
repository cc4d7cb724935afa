"""Removal of repeated word windows: fixed-block anchors, rolling probes, extension to maximal repeats.

A window is ``WIDTH`` (35) consecutive words of one document.  Every word covered
by a window whose words also start anywhere else, in the same document or another,
is removed; all occurrences go, and windows are judged on the input.

Anchors: the non-overlapping blocks of 18 words at places 0, 18, 36, ... of each
document.  Each window holds exactly one whole anchor, and its twin shows the same
18 words at some place.  So

1. all anchors are indexed and probed with every rolling 18-word window; an anchor
   is hit when its words occur at another place;
2. every hit is extended: the windows around a hit anchor are compared on two
   independent hashes of all 35 words (84 bits), and runs of repeated windows
   are the maximal exact repeats.

Documents are dealt once into chunks of about ``CHUNK_BYTES`` by hash; that exchange
is read three times.  A chunk sends, per hash bucket, only its sorted distinct
hashes (differences, transposed to byte planes) with bits for "anchor" and "twice in
this chunk", and gets one bit back for each.  So a passage that occurs in very many
documents costs each chunk one entry, and no pair of places is ever written.

Null text has no words; rows that share a doc_id are separate documents; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.stage import share_package
from ledgerlight.llm.text_arrays import (BASE_A, BASE_B, ragged_take, span_hashes, utf8_buffer, window_hashes,
                                         word_spans)

WIDTH = 35
CHUNK_BYTES = 6 << 20
BUCKET_CHUNKS = 3  # a bucket holds about as many hashes as this many chunks
_U = np.uint64
_LOW = 28  # bits of a hash that choose its bucket; the other 36 are its value there


class _Chunk:
    """Words and window hashes of the documents of one chunk."""

    def __init__(self, table: pa.Table, width: int, buckets: int) -> None:
        self.width, self.block, self.buckets = width, (width + 1) // 2, buckets
        self.data, offsets = utf8_buffer(table["text"])
        self.starts, self.ends, self.first = word_spans(self.data, offsets)
        self.count = np.diff(self.first)
        self.words = span_hashes(self.data, self.starts, self.ends, BASE_A)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)
        self.place = np.arange(len(self.doc)) - self.first[:-1][self.doc]
        self.left = self.count[self.doc] - self.place  # words from here to the document's end

    def _keys(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes & _U((1 << _LOW) - 1)) % _U(self.buckets) << _U(36)) | (hashes >> _U(_LOW))

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys of all blocks, their multiplicity bits, anchor bits; key of each anchor by word index."""
        at = np.flatnonzero(self.left >= self.block)
        keys = self._keys(window_hashes(self.words, self.block)[at]) if len(at) else np.zeros(0, _U)
        anchor = self.place[at] % self.block == 0
        distinct, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
        is_anchor = np.zeros(len(distinct), bool)
        is_anchor[inverse[anchor]] = True
        return distinct, n > 1, is_anchor, np.stack([at[anchor], inverse[anchor]])

    def candidates(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows around hit anchors: sorted distinct (key, second hash), multiplicity, window starts, their entry."""
        _, _, is_anchor, (word, entry) = self.probes()
        rank = np.cumsum(is_anchor) - 1
        good = np.zeros(len(self.words) + self.block, bool)
        good[word[hit[rank[entry]]]] = True
        start = np.flatnonzero(self.left >= self.width)
        start = start[good[start + (-self.place[start]) % self.block]]
        if not len(start):
            none = np.zeros(0, _U)
            return none, none, np.zeros(0, bool), start, start
        second = window_hashes(span_hashes(self.data, self.starts, self.ends, BASE_B), self.width, BASE_A)[start]
        second >>= _U(16)
        keys = self._keys(window_hashes(self.words, self.width)[start])
        order = np.lexsort((second, keys))
        keys, second = keys[order], second[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (second[1:] != second[:-1])
        group = np.cumsum(new) - 1
        entry = np.empty(len(keys), np.int64)
        entry[order] = group
        return keys[new], second[new], np.bincount(group) > 1, start, entry


def _pack(values: np.ndarray, extra: np.ndarray | None, *flags: np.ndarray) -> bytes:
    """Sorted 36-bit values as byte planes of their differences, 48-bit extras, and bit flags."""
    steps = np.diff(values, prepend=_U(0)).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T[:5])
    more = [] if extra is None else [np.ascontiguousarray(extra.astype("<u8").view(np.uint8).reshape(-1, 8).T[:6])]
    return zstandard.ZstdCompressor(level=1).compress(
        b"".join(x.tobytes() for x in (planes, *more, *map(np.packbits, flags))))


def _unpack(blob: bytes, n: int, extra: bool, flags: int) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)

    def wide(part: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((n, 8), np.uint8)
        out[:, :width] = part.reshape(width, n).T
        return out.view("<u8").ravel()

    parts, at = [np.cumsum(wide(raw[:5 * n], 5), dtype=_U)], 5 * n
    if extra:
        parts.append(wide(raw[at:at + 6 * n], 6))
        at += 6 * n
    size = -(-n // 8)
    for k in range(flags):
        parts.append(np.unpackbits(raw[at + k * size:at + (k + 1) * size], count=n).astype(bool))
    return tuple(parts)


_MESSAGE = "chunk int, bucket int, n int, body binary"
_REPLY = "chunk int, bucket int, phase int, bits binary"


def _messages(chunk: int, keys: np.ndarray, extra: np.ndarray | None, *flags: np.ndarray) -> pa.Table:
    bucket = (keys >> _U(36)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = {"chunk": [], "bucket": [], "n": [], "body": []}
    for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)]):
        rows["chunk"].append(chunk)
        rows["bucket"].append(int(bucket[i]))
        rows["n"].append(j - i)
        rows["body"].append(_pack(keys[i:j] & _U((1 << 36) - 1), None if extra is None else extra[i:j],
                                  *(f[i:j] for f in flags)))
    return pa.table(rows, schema=pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()),
                                            ("body", pa.binary())]))


def _answer(extra: bool):
    """For one bucket: which entries of each chunk occur at two places or more."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_unpack(b, n, extra, 1 if extra else 2)
                 for b, n in zip(table["body"].to_pylist(), table["n"].to_pylist())]
        values = np.concatenate([p[0] for p in parts])
        order = np.lexsort((np.concatenate([p[1] for p in parts]), values)) if extra else np.argsort(values, kind="stable")
        new = np.ones(len(values), bool)
        ranked = values[order]
        new[1:] = ranked[1:] != ranked[:-1]
        if extra:
            second = np.concatenate([p[1] for p in parts])[order]
            new[1:] |= second[1:] != second[:-1]
        group = np.empty(len(values), np.int64)
        group[order] = np.cumsum(new) - 1
        multi = np.concatenate([p[2 if extra else 1] for p in parts])
        repeated = (np.bincount(group, 1.0 + multi) >= 2)[group]
        bits, at = [], 0
        for p in parts:
            mine = repeated[at:at + len(p[0])]
            bits.append(np.packbits(mine if extra else mine[p[2]]).tobytes())
            at += len(p[0])
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"],
                         "phase": pa.array([2 if extra else 1] * len(parts), pa.int32()),
                         "bits": pa.array(bits, pa.binary())})
    return run


def _flags(replies: pa.Table, phase: int, entries: np.ndarray) -> np.ndarray:
    """Bits of all buckets in order; ``entries``: bucket of each entry the bits speak of (sorted)."""
    known = {b: bits for b, p, bits in zip(*(replies[c].to_pylist() for c in ("bucket", "phase", "bits"))) if p == phase}
    cuts = np.flatnonzero(np.diff(entries, prepend=-1)).tolist()
    out = [np.unpackbits(np.frombuffer(known[int(entries[i])], np.uint8), count=j - i)
           for i, j in zip(cuts, [*cuts[1:], len(entries)])]
    return np.concatenate(out).astype(bool) if out else np.zeros(0, bool)


def remove_repeats(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK_BYTES, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row (``keep_text``: and ``kept``, the words left, by one space)."""
    share_package(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    buckets = max(1, -(-chunks // BUCKET_CHUNKS))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", text), F.lit(chunks)).cast("int").alias("chunk"),
                        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))

    def probe(table: pa.Table) -> pa.Table:
        keys, multi, anchor, _ = _Chunk(table, width, buckets).probes()
        return _messages(table["chunk"][0].as_py(), keys, None, multi, anchor)

    def hits(chunk: _Chunk, replies: pa.Table) -> np.ndarray:
        keys, _, anchor, _ = chunk.probes()
        return _flags(replies, 1, (keys[anchor] >> _U(36)).astype(np.int64))

    def extend(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _messages(0, np.zeros(0, _U), None)
        chunk = _Chunk(table, width, buckets)
        keys, second, multi, _, _ = chunk.candidates(hits(chunk, replies))
        return _messages(table["chunk"][0].as_py(), keys, second, multi)

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = _Chunk(table, width, buckets)
        keys, _, _, start, entry = chunk.candidates(hits(chunk, replies))
        repeated = _flags(replies, 2, (keys >> _U(36)).astype(np.int64))
        begun = start[repeated[entry]] if len(start) else start
        cover = np.zeros(len(chunk.words) + 1, np.int64)
        np.add.at(cover, begun, 1)
        np.add.at(cover, begun + width, -1)
        kept = np.cumsum(cover)[:-1] == 0
        of = np.concatenate([[0], np.cumsum(kept)])
        n_kept = of[chunk.first[1:]] - of[chunk.first[:-1]]
        size = (chunk.ends - chunk.starts)[kept] + 1
        out = ragged_take(np.append(chunk.data, np.uint8(0)), chunk.starts[kept], size).copy()
        stop = np.cumsum(size)
        out[stop - 1] = 0x20
        bounds = np.concatenate([[0], stop])[of[chunk.first]]
        raw = out.tobytes()
        texts = [raw[i:max(i, j - 1)] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        columns = {"doc_id": table["doc_id"], "n_words": pa.array(chunk.count.astype(np.int64)),
                   "n_removed": pa.array((chunk.count - n_kept).astype(np.int64)),
                   "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())}
        if keep_text:
            columns["kept"] = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.table(columns)

    def finish_or_nothing(table: pa.Table, replies: pa.Table) -> pa.Table:
        if table.num_rows:
            return finish(table, replies)
        fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
        return pa.schema(fields + [("kept", pa.string())] * keep_text).empty_table()

    by_chunk = dealt.groupBy("chunk")
    first = by_chunk.applyInArrow(probe, _MESSAGE).groupBy("bucket").applyInArrow(_answer(False), _REPLY)
    second = (by_chunk.cogroup(first.groupBy("chunk")).applyInArrow(extend, _MESSAGE)
              .groupBy("bucket").applyInArrow(_answer(True), _REPLY))
    replies = first.unionByName(second)
    result = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept string" if keep_text else "")
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(finish_or_nothing, result)
