"""Best-fit packing of documents into sequences of a fixed number of tokens.

Every document becomes its ids plus an end id.  Only documents longer than a
sequence are cut, into whole-sequence pieces; the first piece takes the
remainder.  Whole pieces fill a sequence by themselves.  The others are packed
online by bounded-space best fit: a fixed number of open sequences, kept in a
bitset keyed by free space, so the tightest one that still fits is the lowest
set bit from the piece's length on.  When the limit of open sequences is
reached, the fullest closes first.

Packing needs only piece lengths, so only small piece rows are shuffled.  They
are dealt by hash into groups of about ``group_pieces``; each group is packed
in a streaming pass by one task, whatever the documents' keys.

Null text is an empty document (one piece with the end id).  Rows that share a
doc_id are packed as separate documents.  An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.stage import share_package, stage
from ledgerlight.llm.tokens import append_id, default_tokenizer, encode_column

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
OPEN_SEQUENCES = 4096
GROUP_PIECES = 64_000


class BestFit:
    """Bounded-space online best fit over free spaces 1..capacity."""

    def __init__(self, capacity: int, max_open: int) -> None:
        self.capacity, self.max_open = capacity, max_open
        self.spaces = 0  # bit f is set while an open sequence has f tokens free
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """(sequence number, offset in it) for a piece of ``length`` tokens."""
        fits = self.spaces >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.n_open >= self.max_open:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
            number, free = self.made, self.capacity
            self.made += 1
        left = free - length
        if left:
            self.open[left].append(number)
            self.spaces |= 1 << left
            self.n_open += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.open[free].pop()
        if not self.open[free]:
            self.spaces &= ~(1 << free)
        self.n_open -= 1
        return number


def cut_pieces(docs: DataFrame, capacity: int, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """One row per piece of every document: place in the document, length and checksum of its ids."""
    share_package(docs.sparkSession)
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bounds = append_id(*encode_column(batch.column(1), path), end_id)
            sizes = np.diff(bounds)
            count = -(-sizes // capacity)
            first = sizes - (count - 1) * capacity
            doc = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[doc], capacity)
            raw, at = ids.astype("<u4").tobytes(), 4 * (bounds[:-1][doc] + start)
            crc = [zlib.crc32(raw[a:a + 4 * n]) for a, n in zip(at.tolist(), length.tolist())]
            keys = batch.column(0).cast(pa.int64()).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, PIECE_SCHEMA)


def pack(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2,
         max_open: int = OPEN_SEQUENCES, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence)."""
    pieces = stage(cut_pieces(docs, capacity, tokenizer, end_id), "pieces")
    part = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-part.count() // group_pieces))
    whole = (pieces.filter(F.col("length") == capacity)
             .withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1)
             .withColumn("offset", F.lit(0).cast("bigint")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, bins = TaskContext.get().partitionId() << 34, BestFit(capacity, max_open)
        for batch in batches:
            got = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([(base + s) * 2 for s, _ in got], pa.int64()),
                 pa.array([o for _, o in got], pa.int64())], [*batch.schema.names, "sequence_id", "offset"])

    deal = F.xxhash64("doc_id", "piece", "ids_crc32")
    packed = (part.repartition(groups, deal).sortWithinPartitions(deal, "doc_id", "length")
              .mapInArrow(run, f"{PIECE_SCHEMA}, sequence_id bigint, offset bigint"))
    return whole.unionByName(packed)
