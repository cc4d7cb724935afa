"""Token ids of whole documents with a public tokenizer, many times faster than document by document.

The pre-tokenizer always breaks before a space that follows a visible
character, so a text falls into segments (a space and what follows up to the
next such space) that encode independently of each other.  Each distinct
segment is encoded once per worker by the ``tokenizers`` library; the ids of
all documents are then gathered.  Segments are compared by a 64-bit and a second
64-bit hash; documents with unusual white space are encoded whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from ledgerlight.llm.text_arrays import BASE_A, BASE_B, ragged_take, span_hashes, utf8_buffer

GROUP_BYTES = 4 << 20
JOINED = 300  # segments per string given to the library
KNOWN_SEGMENTS = 600_000  # a worker forgets its segments beyond this many (memory bound, not a limit on results)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    table = np.zeros(tok.get_vocab_size(), dtype=bool)
    for token, i in tok.get_vocab().items():
        table[i] = token.startswith("Ġ")
    return tok, table


def _unusual(data: np.ndarray) -> np.ndarray:
    """Positions of bytes that begin white space (or format characters) other than space and newline."""
    ctrl = (data < 0x20) & (data != 0x0A) | (data == 0x7F)
    hit = ctrl
    if len(data) > 2 and (data >= 0xC2).any():
        a, b = data[:-1], data[1:]
        c = np.append(data[2:], np.uint8(0))
        two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        e2 = (a == 0xE2) & ((b == 0x80) & ((c < 0x90) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
                            | (b == 0x81) & ((c == 0x9F) | (c == 0xA0)))
        rest = (a == 0xE1) & ((b == 0x9A) | (b == 0xA0)) | (a == 0xE3) & (b == 0x80) | (a == 0xEF) & (b == 0xBB)
        hit = ctrl.copy()
        hit[:-1] |= two | e2 | rest
    return np.flatnonzero(hit)


def encode_column(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all documents one after another as uint32, offsets per document)."""
    data, offsets = utf8_buffer(column)
    ids, counts = [], []
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + GROUP_BYTES, side="right")) - 1)
        a, b = _encode_group(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], path)
        ids.append(a)
        counts.append(b)
        i = j
    if not ids:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    sizes = np.concatenate(counts)
    return np.concatenate(ids), np.concatenate([[0], np.cumsum(sizes)])


def _encode_group(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    n, docs = len(data), len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint32), np.zeros(docs, np.int64)
    odd_docs = np.zeros(docs, dtype=bool)
    odd = _unusual(data)
    if len(odd):
        odd_docs[np.searchsorted(offsets, odd, side="right") - 1] = True
    space = data == 0x20
    cut = np.zeros(n, dtype=bool)
    cut[1:] = space[1:] & (data[:-1] > 0x20)
    if odd_docs.any():
        cut &= np.repeat(~odd_docs, np.diff(offsets))
    cut[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    first = span_hashes(data, starts, ends, BASE_A)
    second = span_hashes(data, starts, ends, BASE_B)
    keys, index, inverse = np.unique(first, return_index=True, return_inverse=True)
    checks = second[index]
    if not np.array_equal(second, checks[inverse]):  # two segments under one hash: every segment by itself, no cache
        places, lengths, ids = _encode_spans(data, space, starts, ends, path)
        inverse = np.arange(len(starts))
    else:
        places, lengths, ids = _cached(data, space, starts[index], ends[index], keys, checks, path)
    size = lengths[inverse]
    total = np.concatenate([[0], np.cumsum(size)])
    return ragged_take(ids, places[inverse], size), np.diff(total[np.searchsorted(starts, offsets)])


class _Known:
    """Segments a worker has already encoded: sorted hashes, second hashes, places and lengths in one id array."""

    def __init__(self) -> None:
        self.keys = self.checks = np.zeros(0, np.uint64)
        self.places = self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)


_known: dict[str, _Known] = {}


def _cached(data, space, starts, ends, keys, checks, path):
    """Places, lengths and ids of distinct segments (sorted by ``keys``), encoding only those not yet known."""
    known = _known.get(path)
    if known is None or len(known.keys) > KNOWN_SEGMENTS:
        known = _known[path] = _Known()
    at = np.searchsorted(known.keys, keys)
    near = np.minimum(at, max(len(known.keys) - 1, 0))
    hit = (known.keys[near] == keys) & (known.checks[near] == checks) if len(known.keys) else np.zeros(len(keys), bool)
    new = np.flatnonzero(~hit)
    n_places, n_lengths, n_ids = _encode_spans(data, space, starts[new], ends[new], path)
    places, lengths = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    places[hit], lengths[hit] = known.places[near[hit]], known.lengths[near[hit]]
    places[new], lengths[new] = n_places + len(known.ids), n_lengths
    ids = np.concatenate([known.ids, n_ids])
    where = at[new]
    known.keys, known.checks = np.insert(known.keys, where, keys[new]), np.insert(known.checks, where, checks[new])
    known.places, known.lengths = np.insert(known.places, where, places[new]), np.insert(known.lengths, where, n_lengths)
    known.ids = ids
    return places, lengths, ids


def _encode_spans(data, space, s, e, path):
    """Places, lengths and ids of byte spans.

    Spans with one space, at their start, are joined to strings of a few hundred
    spans each: only their first token begins with a space, which tells them apart
    in the ids.  The others are encoded one by one.
    """
    tok, begins_word = _load(path)
    lengths, places, ids_of = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64), [np.zeros(0, np.uint32)]
    white = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(space | (data == 0x0A), out=white[1:])
    low = (white[e] - white[s] == 1) & space[s] & (e - s > 1) if len(s) else np.zeros(0, bool)
    raw = data.tobytes()
    if b"<|" in raw:
        low &= np.fromiter((b"<|" not in raw[p:q] for p, q in zip(s.tolist(), e.tolist())), bool, len(s))
    plain, at = np.flatnonzero(low), 0
    for k in range(0, len(plain), JOINED * 64):
        some = plain[k:k + JOINED * 64]
        texts = [ragged_take(data, s[part], e[part] - s[part]).tobytes().decode()
                 for part in (some[m:m + JOINED] for m in range(0, len(some), JOINED))]
        ids = np.concatenate([np.array(x.ids, dtype=np.uint32)
                              for x in tok.encode_batch_fast(texts, add_special_tokens=False)])
        heads = np.flatnonzero(begins_word[ids])
        if len(heads) != len(some):
            low[some] = False
            continue
        lengths[some], places[some] = np.diff(np.append(heads, len(ids))), heads + at
        ids_of.append(ids)
        at += len(ids)
    rest = np.flatnonzero(~low)
    for k in range(0, len(rest), 512):
        some = rest[k:k + 512]
        texts = [raw[p:q].decode() for p, q in zip(s[some].tolist(), e[some].tolist())]
        got = [np.array(x.ids, dtype=np.uint32) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
        lengths[some] = [len(x) for x in got]
        places[some] = at + np.cumsum(lengths[some]) - lengths[some]
        ids_of += got
        at += int(lengths[some].sum())
    return places, lengths, np.concatenate(ids_of)


def append_id(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same documents, each with ``end_id`` after its last token."""
    docs = len(offsets) - 1
    out = np.full(len(ids) + docs, end_id, dtype=np.uint32)
    keep = np.ones(len(out), dtype=bool)
    bounds = offsets + np.arange(docs + 1)
    keep[bounds[1:] - 1] = False
    out[keep] = ids
    return out, bounds
