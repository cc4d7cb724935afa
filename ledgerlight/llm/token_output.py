"""Binary token output: fixed-size blocks of ids, transposed to planes, each plane compressed with zstandard.

Documents are encoded in ascending ``doc_id`` order (nulls first; equal ids by
text hash), an end id closes each document, and the id stream of every range
partition is cut into blocks of ``block_ids`` ids.  A block holds one zstandard
frame per byte plane (plane k has byte k of every id) or per bit plane.  The
written table is the file format: one row per block, its binary ``payload`` plus
the chunk index (part, block, first id, count, and where documents start).

Block payload: ``BPL1``, mode (1 byte: 0 byte planes, 1 bit planes), planes (1
byte), id count (u32), compressed size of each plane (u32), then the frames.
Planes above the highest used one are left out and read as zero.

Null text is an empty document (only the end id); an empty table gives an empty
file table.  Other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlight.llm.stage import share_package
from ledgerlight.llm.tokens import append_id, default_tokenizer, encode_column

MAGIC = b"BPL1"
BLOCK_IDS = 1 << 16
FILE_SCHEMA = ("part int, block int, first_id bigint, n_ids int, first_doc bigint, "
               "doc_ids array<bigint>, doc_starts array<int>, payload binary")


def pack_block(ids: np.ndarray, bits: bool = False, level: int = 3) -> bytes:
    """One block of uint32 ids as compressed byte or bit planes."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    planes = ids.view(np.uint8).reshape(-1, 4).T
    if bits:
        rows = [np.packbits((planes[k // 8] >> (k % 8)) & 1) for k in range(32)]
    else:
        rows = [np.ascontiguousarray(p) for p in planes]
    while rows and not rows[-1].any():
        rows.pop()
    zip_ = zstandard.ZstdCompressor(level=level)
    frames = [zip_.compress(r.tobytes()) for r in rows]
    head = MAGIC + struct.pack("<BBI", int(bits), len(frames), len(ids))
    return head + b"".join(struct.pack("<I", len(f)) for f in frames) + b"".join(frames)


def unpack_block(payload: bytes) -> np.ndarray:
    """The ids of a block."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token block")
    bits, n_planes, n = struct.unpack_from("<BBI", payload, 4)
    sizes = struct.unpack_from(f"<{n_planes}I", payload, 10)
    at, unzip = 10 + 4 * n_planes, zstandard.ZstdDecompressor()
    planes = np.zeros((4, n), dtype=np.uint8)
    for k, size in enumerate(sizes):
        raw = np.frombuffer(unzip.decompress(payload[at:at + size]), np.uint8)
        if bits:
            planes[k // 8] |= np.unpackbits(raw, count=n) << np.uint8(k % 8)
        else:
            planes[k] = raw
        at += size
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def encode_blocks(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, block_ids: int = BLOCK_IDS,
                  bits: bool = False) -> DataFrame:
    """The file table (``FILE_SCHEMA``) of ``docs`` (doc_id, text)."""
    share_package(docs.sparkSession)
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first, doc_no = TaskContext.get().partitionId(), 0, 0, 0
        hold, ids_held, starts_held = np.zeros(0, np.uint32), [], []
        schema = _arrow_schema()

        def emit(n: int) -> pa.RecordBatch:
            nonlocal hold, ids_held, starts_held, block, first
            inside = [k for k, s in enumerate(starts_held) if s < n]
            m = len(inside)
            lead = doc_no - len(starts_held) - (0 if m and starts_held[0] == 0 else 1)
            row = {"part": [part], "block": [block], "first_id": [first], "n_ids": [n], "first_doc": [lead],
                   "doc_ids": [ids_held[:m]], "doc_starts": [starts_held[:m]], "payload": [pack_block(hold[:n], bits)]}
            hold, ids_held, starts_held = hold[n:], ids_held[m:], [s - n for s in starts_held[m:]]
            block, first = block + 1, first + n
            return pa.RecordBatch.from_pydict(row, schema=schema)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            ids, bounds = append_id(*encode_column(batch.column(1), path), end_id)
            starts_held += (bounds[:-1] + len(hold)).tolist()
            ids_held += keys
            doc_no += len(keys)
            hold = np.concatenate([hold, ids])
            while len(hold) >= block_ids:
                yield emit(block_ids)
        if len(hold):
            yield emit(len(hold))

    tie = F.xxhash64("text")
    ordered = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", tie))
    return ordered.mapInArrow(run, FILE_SCHEMA)


def _arrow_schema() -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()),
                      ("first_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("doc_starts", pa.list_(pa.int32())), ("payload", pa.binary())])


def write_tokens(docs: DataFrame, path: str, **options) -> None:
    """Encode ``docs`` and write the block table to ``path`` (options of ``encode_blocks``)."""
    encode_blocks(docs, **options).write.parquet(path)


def read_documents(files: DataFrame) -> DataFrame:
    """Per document, read back from the blocks: doc_id, start, n_tokens, ids_crc32.

    Blocks decode independently.  A document inside one block gets its checksum
    there; pieces of one that spans blocks meet in one row (a document's ids, which
    its text bounded already).
    """
    piece = "part int, doc bigint, doc_id bigint, at bigint, n bigint, crc bigint, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {k: [] for k in ("part", "doc", "doc_id", "at", "n", "crc", "ids")}
            for b in batch.to_pylist():
                raw = unpack_block(b["payload"]).astype("<u4").tobytes()
                starts, keys, n = b["doc_starts"], b["doc_ids"], b["n_ids"]
                if not starts or starts[0]:  # a document of an earlier block goes on here
                    starts, keys = [0, *starts], [None, *keys]
                for k, (s, e) in enumerate(zip(starts, [*starts[1:], n])):
                    edge = s == 0 or e == n
                    rows["part"].append(b["part"])
                    rows["doc"].append(b["first_doc"] + k)
                    rows["doc_id"].append(keys[k])
                    rows["at"].append(b["first_id"] + s)
                    rows["n"].append(e - s)
                    rows["crc"].append(None if edge else zlib.crc32(raw[4 * s:4 * e]))
                    rows["ids"].append(raw[4 * s:4 * e] if edge else None)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("part", pa.int32()), ("doc", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
                ("n", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())]))

    blocks = files.select("part", "first_id", "n_ids", "first_doc", "doc_ids", "doc_starts", "payload")
    pieces = blocks.mapInArrow(run, piece)
    whole = pieces.filter("crc IS NOT NULL").select("part", "doc_id", "at", F.col("n").alias("n_tokens"),
                                                    F.col("crc").alias("ids_crc32"))
    joined = F.aggregate(F.array_sort(F.collect_list(F.struct("at", "ids"))), F.lit(b"").cast("binary"),
                         lambda acc, x: F.concat(acc, x["ids"]))
    cut = (pieces.filter("crc IS NULL").groupBy("part", "doc")
           .agg(F.max("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
                F.crc32(joined).alias("ids_crc32")).drop("doc"))
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))  # one row per written part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return (whole.unionByName(cut).join(offsets, "part")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))
