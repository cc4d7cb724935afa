"""Token output and packing against the tokenizer itself and simple loops."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerlight.llm import packing, token_output
from ledgerlight.llm.tokens import default_tokenizer, encode_column

TEXTS = ["", None, " a  b", "x\ty z  q", "end ", "<|endoftext|> a<|endoftext|>", "a\n\nb \n c   d",
         "it's 12 %%  x", "a  ", "\n", " ", "the cat sat   down", "naïve été ciónñ 日本 語",
         "word " * 9000, "same text", "same text"]


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_tokenizer())


def frame(spark, texts):
    rows = [(i * 3 - 5, t, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, piece string, start int")


def test_segments_encode_like_whole_texts(tok):
    ids, bounds = encode_column(pa.array(TEXTS), default_tokenizer())
    for i, t in enumerate(TEXTS):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [False, True])
def test_blocks_round_trip(bits):
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0), np.zeros(9), rng.integers(0, 50257, 1000), rng.integers(0, 2**32, 77)):
        ids = ids.astype(np.uint32)
        assert np.array_equal(token_output.unpack_block(token_output.pack_block(ids, bits)), ids)


@pytest.mark.parametrize("block_ids", [7, 4096])
def test_token_files(spark, tok, workdir, block_ids):
    docs = frame(spark, TEXTS)
    token_output.write_tokens(docs, workdir + "/tokens", block_ids=block_ids, bits=block_ids == 7)
    got = {r.doc_id: r for r in token_output.read_documents(spark.read.parquet(workdir + "/tokens")).collect()}
    at = 0
    for r in sorted(docs.collect()):
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert got[r.doc_id][1:] == (at, len(ids), crc)
        at += len(ids)
    assert len(got) == len(TEXTS)


def test_token_files_of_nothing(spark, workdir):
    token_output.write_tokens(frame(spark, []), workdir + "/tokens")
    files = spark.read.schema(token_output.FILE_SCHEMA).parquet(workdir + "/tokens")
    assert token_output.read_documents(files).count() == 0


def test_best_fit_takes_tightest_and_closes_fullest():
    bins = packing.BestFit(10, 2)
    assert bins.place(4) == (0, 0)
    assert bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # exactly the three left in the second
    assert bins.place(7) == (2, 0)
    assert bins.place(9) == (3, 0)  # the limit of two is reached: sequence 2 closes
    assert bins.place(6) == (0, 4)


def test_packing_keeps_every_token_once(spark, tok):
    docs = frame(spark, TEXTS)
    rows = packing.pack(docs, capacity=64, group_pieces=5).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for d in docs.collect():
        ids = tok.encode(d.text or "", add_special_tokens=False).ids + [2]
        at = 0
        for k, p in enumerate(sorted(by_doc[d.doc_id], key=lambda p: p.piece)):
            part = ids[at:at + p.length]
            assert (p.piece, p.start) == (k, at) and zlib.crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32
            assert p.length == 64 or k == 0
            at += p.length
        assert at == len(ids)
    for spans in by_seq.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= 64
    assert packing.pack(frame(spark, [])).count() == 0
