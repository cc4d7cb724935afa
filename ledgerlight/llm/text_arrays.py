"""Numpy helpers over Arrow text columns, used inside tasks.

A batch of documents is one UTF-8 buffer plus offsets.  Words are maximal runs
of bytes other than space, tab, newline, vertical tab, form feed and carriage
return; a document border always ends a word.  Words are hashed eight bytes at a time;
hashes of windows of words come from prefix sums of a polynomial modulo 2**64 over word
hashes, so a whole batch is hashed without a Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_MASK = (1 << 64) - 1
# odd multipliers of the polynomials (any odd numbers serve)
BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xC2B2AE3D27D4EB4F
BLOCK_BYTES = 1 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_TAIL = np.array([(1 << (8 * n)) - 1 for n in range(9)], _U)  # the first n of eight bytes

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n (kept per worker)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 4096)
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, b, dtype=_U)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        have = _powers[base] = (tables[0], tables[1])
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (shift, multiply, shift)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def utf8_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offs = offs.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document the index of its first word (plus the total)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~_WHITE[data]
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | border[1:n]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | border[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def span_blocks(starts: np.ndarray, ends: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive spans covering at most ``limit`` bytes (one longer span makes its own range)."""
    i, n = 0, len(starts)
    while i < n:
        j = int(np.searchsorted(ends, starts[i] + limit, side="right"))
        j = max(j, i + 1)
        yield i, j
        i = j


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE_A,
                lower: bool = False) -> np.ndarray:
    """One 64-bit hash per byte span; ``lower`` maps A-Z to a-z first.

    A span is read in groups of eight bytes; each group is mixed by a bijection that depends on its
    place and on ``base``, and the sum is mixed with the length.  Hashes under different bases are
    independent.  (A polynomial of the bytes modulo 2**64 won't do: some texts, such as the Thue-Morse
    sequence and its complement, are equal under every multiplier.)
    """
    out = np.empty(len(starts), dtype=_U)
    seed = mix(np.array([base], _U))[0]
    for i, j in span_blocks(starts, ends):
        lo, hi = int(starts[i]), int(ends[j - 1])
        part = np.zeros(hi - lo + 8, np.uint8)
        part[:hi - lo] = _LOWER[data[lo:hi]] if lower else data[lo:hi]
        eights = np.ndarray((hi - lo + 1,), "<u8", part, strides=(1,))  # the eight bytes from each place on
        size = ends[i:j] - starts[i:j]
        groups = np.maximum((size + 7) >> 3, 1)
        first = np.cumsum(groups) - groups
        place = np.arange(int(groups.sum())) - np.repeat(first, groups)
        at = np.repeat(starts[i:j] - lo, groups) + 8 * place
        left = np.clip(np.repeat(size, groups) - 8 * place, 0, 8)
        value = eights[at] & _TAIL[left]
        value = mix(value ^ mix(place.astype(_U) * _U(BASE_A) + seed))
        out[i:j] = mix(np.add.reduceat(value, first) + size.astype(_U) * _U(BASE_B) ^ seed) if j > i else 0
    return out


def window_hashes(hashes: np.ndarray, width: int, base: int = BASE_B) -> np.ndarray:
    """Hash of every ``width`` consecutive values (callers drop windows that cross a document border)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    out = np.empty(n, dtype=_U)
    step = 1 << 17
    for i in range(0, n, step):
        j = min(n, i + step)
        part = hashes[i:j + width - 1]
        up, down = powers(base, len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=_U)
        np.cumsum(part * up[:len(part)], out=sums[1:])
        out[i:j] = mix((sums[width:width + j - i] - sums[:j - i]) * down[:j - i])
    return out


def ragged_take(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[s:s+n]`` for each pair, concatenated."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    index = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
    return values[index]
