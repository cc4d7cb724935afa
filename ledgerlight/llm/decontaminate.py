"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap checks.

Items and documents are normalised alike: ASCII letters lower-cased, ASCII
punctuation and white space separate words.  The items form an inverted index:
per term, postings in item order with BM25 weights divided by the item's score for
its own text (so 1 means the whole item), in blocks of ``BLOCK`` postings with the
block's largest weight.  Documents are cut into passages of twice the longest
item's words (64 at least), one every half passage, so an item lies whole in some
passage.  Each passage is a query: block-max WAND returns every item with at least
``THRESHOLD`` of its own score.  Passages whose terms' largest weights cannot add up
to that are skipped, which loses nothing.

A hit is confirmed when the passage holds enough of the item's word trigrams, in
its question (all but the last sentence) and in its answer (the last sentence; the
last third of a one-sentence item), or, whatever the parts, at least ``WHOLE`` of the
item: both shares weighted by the words of the part.  A part of fewer than ``SHORT``
words counts by its words in a stretch of its own length and one word more, where that
is the better share, as one changed word takes most of its trigrams.

Only the index is broadcast.  Items are split into shards of at most
``SHARD_ITEMS`` items and ``SHARD_BYTES`` bytes, and each shard makes its own pass
over the documents.  Document frequencies, mean length and passage size are those of all
items, counted by Spark, so a pair's result does not depend on the number of shards.  Items without words and null texts take no part.  Null
document texts have no hits.  Rows that share a doc_id give one row per item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.stage import share_package, stage
from ledgerlight.llm.text_arrays import ragged_take, span_hashes, utf8_buffer, window_hashes, word_spans

K1, B = 1.2, 0.75
THRESHOLD, QUESTION, ANSWER = 0.5, 0.6, 0.6
WHOLE = 0.7  # share of an item that is enough without its other part
SHORT = 8  # words from which a part is told by trigrams alone
BLOCK = 16  # postings per block
BOUND_ITEMS = 4  # items per block of the batch bound
GRAM = 3
MIN_PASSAGE = 64
SHARD_ITEMS, SHARD_BYTES = 20_000, 16 << 20
GROUP_BYTES = 2 << 20

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
for _a, _b in ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E), (0x00, 0x1F)):
    _PLAIN[_a:_b + 1] = 0x20


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the normalised words, and the first word of each text."""
    plain = _PLAIN[data]
    starts, ends, first = word_spans(plain, offsets)
    return span_hashes(plain, starts, ends), first


def _text_words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return _words(raw, np.array([0, len(raw)]))[0]


def split_item(text: str) -> tuple[str, str]:
    """(question, answer) of a test item."""
    cuts = [m.end() for m in re.finditer(r"[.?!]\s+(?=\S)", text)]
    if cuts:
        return text[:cuts[-1]], text[cuts[-1]:]
    words = text.split()
    n = len(words) - max(1, len(words) // 3)
    return " ".join(words[:n]), " ".join(words[n:])


def _grams(words: np.ndarray) -> np.ndarray:
    return np.unique(window_hashes(words, GRAM) if len(words) >= GRAM else words)


@dataclass(frozen=True)
class Overall:
    """Figures of all items: how many have words, their words, the longest, and how many items hold each of ``terms``."""

    items: int
    words: int
    longest: int
    terms: np.ndarray
    df: np.ndarray


class Index:
    """Inverted index of some items, small enough to broadcast."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD,
                 overall: Overall | None = None) -> None:
        """``overall`` has the figures of all items where ``items`` are only a part of them."""
        self.threshold = threshold
        words = [(i, t, _text_words(t)) for i, t in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1]))]
        words = sorted((x for x in words if len(x[2])), key=lambda x: len(x[2]))  # blocks of like items bound tightly
        self.ids = [i for i, _, _ in words]
        self.longest = overall.longest if overall else max((len(w) for _, _, w in words), default=0)
        parts = [split_item(t) for _, t, _ in words]
        split = [(_text_words(q), _text_words(a)) for q, a in parts]
        self.question = [_grams(q) for q, _ in split]
        self.answer = [_grams(a) for _, a in split]
        self.short = [[p if GRAM <= len(p) < SHORT else None for p in pair] for pair in split]
        self.answer_part = [len(a) / max(1, len(q) + len(a)) for q, a in split]
        lengths = np.array([len(w) for _, _, w in words], float)
        flat = np.concatenate([w for _, _, w in words]) if words else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(words)), lengths.astype(int))
        self.terms, term = np.unique(flat, return_inverse=True)
        pair, tf = np.unique(term.astype(np.int64) * max(1, len(words)) + item, return_counts=True)
        term, self.items = pair // max(1, len(words)), pair % max(1, len(words))
        df = np.bincount(term, minlength=len(self.terms))
        all_items, all_df, mean = len(words), df, lengths.mean() if words else 1.0
        if overall:
            all_items, mean = overall.items, overall.words / max(1, overall.items)
            all_df = overall.df[np.searchsorted(overall.terms, self.terms)]
        idf = np.log(1 + (all_items - all_df + 0.5) / (all_df + 0.5))
        norm = K1 * (1 - B + B * lengths / mean)
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.items])
        own = np.bincount(self.items, weight, minlength=len(words))
        self.weight = weight / own[self.items]
        self.start = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.common = df >= max(8, len(words) / 20)  # in too many items to look up for every passage
        self.common_row = np.cumsum(self.common) - 1
        blocks = -(-len(words) // BOUND_ITEMS)
        dense = np.zeros((int(self.common.sum()), blocks * BOUND_ITEMS), np.float32)
        often = self.common[term]
        dense[self.common_row[term[often]], self.items[often]] = self.weight[often]
        self.common_bound = dense.reshape(len(dense), blocks, BOUND_ITEMS).max(axis=2)
        self.largest = np.maximum.reduceat(self.weight, self.start[:-1]) if len(term) else np.zeros(0)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of each word, -1 where no item has it."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def search(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """Items whose score for the distinct ``terms`` reaches the threshold (block-max WAND)."""
        lists = [(self.items[a:b], self.weight[a:b]) for a, b in
                 ((int(self.start[t]), int(self.start[t + 1])) for t in terms)]
        tops = [[float(w[k:k + BLOCK].max()) for k in range(0, len(w), BLOCK)] for _, w in lists]
        largest = [float(self.largest[t]) for t in terms]
        at, found, least = [0] * len(lists), [], self.threshold - 1e-9
        live = [j for j in range(len(lists)) if len(lists[j][0])]
        while live:
            live.sort(key=lambda j: lists[j][0][at[j]])
            bound, pivot = 0.0, -1
            for k, j in enumerate(live):
                bound += largest[j]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[live[pivot]][0][at[live[pivot]]]
            while pivot + 1 < len(live) and lists[live[pivot + 1]][0][at[live[pivot + 1]]] == item:
                pivot += 1
            blocks = []
            for j in live[:pivot + 1]:  # the block where the item would be
                blocks.append(max(at[j] // BLOCK, (int(np.searchsorted(lists[j][0], item))) // BLOCK))
            reach = sum(tops[j][b] for j, b in zip(live, blocks) if b < len(tops[j]))
            if reach >= least:
                score = 0.0
                for j in live[:pivot + 1]:
                    k = int(np.searchsorted(lists[j][0], item))
                    if k < len(lists[j][0]) and lists[j][0][k] == item:
                        score += float(lists[j][1][k])
                if score >= least:
                    found.append((int(item), score))
                target = item + 1
            else:  # nothing before the next block border or next list can reach the threshold
                ends = [int(lists[j][0][min((b + 1) * BLOCK, len(lists[j][0])) - 1]) + 1
                        for j, b in zip(live, blocks) if b < len(tops[j])]
                after = [int(lists[live[pivot + 1]][0][at[live[pivot + 1]]])] if pivot + 1 < len(live) else []
                target = max(item + 1, min(ends + after))
            for j in live[:pivot + 1]:
                at[j] = max(at[j], int(np.searchsorted(lists[j][0], target)))
            live = [j for j in live if at[j] < len(lists[j][0])]
        return found


def _confirm(index: Index, item: int, passage: np.ndarray) -> tuple[float, float]:
    """Shares of the item's question and answer trigrams (words, where shorter) that the passage holds."""
    grams, shares = np.unique(window_hashes(passage, GRAM)), []
    for part, short in zip((index.question[item], index.answer[item]), index.short[item]):
        own = int(np.isin(part, grams).sum())
        if not own and len(part):
            own = int(np.isin(part, passage).sum())
        share = own / len(part) if len(part) else 1.0
        shares.append(share if short is None else max(share, _nearby(short, passage)))
    return shares[0], shares[1]


def _nearby(part: np.ndarray, passage: np.ndarray) -> float:
    """Largest share of the part's distinct words in a stretch of the passage one word longer than the part."""
    words = np.unique(part)
    found = np.cumsum(np.pad(passage[None, :] == words[:, None], ((0, 0), (1, 0))), axis=1)
    begin = np.arange(len(passage))
    end = np.minimum(begin + len(part) + 1, len(passage))
    return float(((found[:, end] - found[:, begin]) > 0).sum(axis=0).max(initial=0) / len(words))


def _held(index: Index, item: int, question: float, answer: float) -> bool:
    part = index.answer_part[item]
    return (question >= QUESTION and answer >= ANSWER) or question * (1 - part) + answer * part >= WHOLE


def scan_column(index: Index, column: pa.Array) -> Iterator[tuple[int, int, int, float, float, float]]:
    """(document, item, first word of the passage, score, question share, answer share) of confirmed hits."""
    size = max(MIN_PASSAGE, 2 * index.longest)
    step = size // 2
    data, offsets = utf8_buffer(column)
    i, n = 0, len(offsets) - 1
    while i < n and index.ids:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + GROUP_BYTES, side="right")) - 1)
        words, first = _words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        term = index.lookup(words)
        count = np.diff(first)
        passages = np.where(count > 0, np.maximum(1, -(-(count - step) // step)), 0)
        doc = np.repeat(np.arange(j - i), passages)
        begin = first[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(passages) - passages, passages)) * step
        end = np.minimum(begin + size, first[1:][doc])
        for p in _possible(index, term, begin, end):
            own = term[begin[p]:end[p]]
            distinct = np.unique(own[own >= 0])
            for item, score in index.search(distinct):
                q, a = _confirm(index, item, words[begin[p]:end[p]])
                if _held(index, item, q, a):
                    yield i + int(doc[p]), item, int(begin[p] - first[doc[p]]), score, q, a
        i = j


def _possible(index: Index, term: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Passages some item might reach the threshold in.

    The bound for an item is its weights of the passage's rare terms plus, for the
    common terms, their largest weights in the item's block of a few items of like length.
    """
    n, least = len(index.ids), index.threshold - 1e-9
    width = end - begin
    passage = np.repeat(np.arange(len(begin)), width)
    t = ragged_take(term, begin, width)
    passage, t = passage[t >= 0], t[t >= 0]
    pair = np.unique(passage * max(1, len(index.terms)) + t)
    passage, t = pair // max(1, len(index.terms)), pair % max(1, len(index.terms))
    often = index.common[t]
    present = np.zeros((len(begin), len(index.common_bound)), np.float32)
    present[passage[often], index.common_row[t[often]]] = 1
    rest = present @ index.common_bound + np.float32(1e-5)
    passage, t = passage[~often], t[~often]
    size = index.start[t + 1] - index.start[t]
    at = ragged_take(np.arange(len(index.items)), index.start[t], size)
    key, inverse = np.unique(np.repeat(passage, size) * max(1, n) + index.items[at], return_inverse=True)
    bound = np.bincount(inverse, index.weight[at], minlength=len(key)) + rest[key // max(1, n), key % max(1, n) // BOUND_ITEMS]
    return np.union1d(key[bound >= least] // max(1, n), np.flatnonzero((rest >= least).any(axis=1)))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, term, length) of each distinct word of each item; the item's length is on one of its rows."""
    for batch in batches:
        words, first = _words(*utf8_buffer(batch.column("text")))
        size = np.diff(first)
        item = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((words, item))
        words, item = words[order], item[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (item[1:] != item[:-1])
        words, item = words[new], item[new]
        length = np.where(np.diff(item, prepend=-1) != 0, size[item], 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("shard").take(pa.array(item)), pa.array(words.view(np.int64)), pa.array(length, pa.int64())],
            ["shard", "term", "length"])


def _indexes(items: DataFrame, threshold: float) -> Iterator[Index]:
    """One index per shard of the items; shards are bounded in rows and bytes."""
    rows = items.filter("text IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"),
                                                   F.col("text").cast("string").alias("text"))
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = max(1, -(-n // (SHARD_ITEMS // 2)), -(-size // (SHARD_BYTES // 2)))
    if shards == 1:
        yield Index([(r.item_id, r.text) for r in rows.collect()], threshold)
        return
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))
    terms = stage(rows.mapInArrow(_item_terms, "shard int, term bigint, length bigint"), "item_terms")
    whole = terms.agg(F.count(F.when(F.col("length") > 0, 1)), F.coalesce(F.sum("length"), F.lit(0)),
                      F.coalesce(F.max("length"), F.lit(0))).first()
    held = terms.groupBy("shard", "term").agg(F.count(F.lit(1)).alias("n"))
    df = held.groupBy("term").agg(F.sum("n").alias("df"))
    counted = stage(held.join(df, "term").select("shard", "term", "df").repartition("shard"), "item_df")
    for s in range(shards):
        mine = counted.filter(F.col("shard") == s).select("term", "df").toPandas()  # a shard's distinct words
        key = mine["term"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(key)
        overall = Overall(*map(int, whole), key[order], mine["df"].to_numpy(np.int64)[order])
        part = rows.filter(F.col("shard") == s).select("item_id", "text")
        yield Index([(r.item_id, r.text) for r in part.collect()], threshold, overall)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_passages, first_word, score, question_share, answer_share of each confirmed pair."""
    share_package(docs.sparkSession)
    schema = "doc_id bigint, item_id bigint, first_word int, score double, question_share double, answer_share double"
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = None
    for index in _indexes(items, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                got = list(scan_column(index, batch.column("text")))
                cols = list(zip(*got)) if got else [[]] * 6
                keys = batch.column("doc_id").take(pa.array(cols[0], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array([index.ids[i] for i in cols[1]], pa.int64()), pa.array(cols[2], pa.int32()),
                     *(pa.array(c, pa.float64()) for c in cols[3:])],
                    ["doc_id", "item_id", "first_word", "score", "question_share", "answer_share"])

        part = texts.mapInArrow(run, schema)
        hits = part if hits is None else hits.unionByName(part)
    return (hits.groupBy("doc_id", "item_id")
            .agg(F.count(F.lit(1)).alias("n_passages"), F.min("first_word").alias("first_word"),
                 F.max("score").alias("score"), F.max("question_share").alias("question_share"),
                 F.max("answer_share").alias("answer_share")))


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold a test item."""
    share_package(docs.sparkSession)
    out = docs.withColumn("text", F.col("text").cast("string"))
    schema = out.schema
    for index in _indexes(items, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[hit[0] for hit in scan_column(shared.value, batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, schema)
    return out
