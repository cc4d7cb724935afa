"""Phrase collocations by level-wise counting with broadcast double-array tries.

Texts are lower-cased (A-Z), cut at ``. , ; : ! ?`` and line ends into pieces, and those at
spaces and tabs into words.  Everything is counted per language.  A phrase of two to
``longest`` words can only reach ``least`` occurrences if its first and its last part, one
word shorter, do (Apriori); so each level starts from the frequent phrases one word shorter.

The frequent words get numbers, symbols, one for each language and word.  One pass writes the
texts as symbols: 0 for all other words and between pieces, which no frequent phrase crosses.
Then each level is one pass over the symbols, however many phrases there are: the frequent
phrases, dealt by a hash of all words but the last into shards of about ``SHARD`` (more only
where one beginning has more ends), are double-array tries over symbols, built in tasks and
broadcast one by one.  A task deals the positions of a batch in the same way and numpy advances
the states of a shard's positions together, one symbol a step; so a position is looked up in one
trie.  Where a frequent phrase and another one a word later start, there is a candidate, named
by the first phrase and the last symbol.  A task adds up its candidates and Spark adds the
counts of all tasks: counts are exact.  A task keeps at most ``KEPT`` shards and reads the
others again for each batch, so what it holds does not grow with the number of phrases.

Scores are exact: whole-number division of decimals.  A candidate's words lie in a longer
candidate if they are consecutive words of it.

A null text counts as empty, a null language as ``und``.  Repeated rows count as often as
they occur.  Long texts are cut at piece borders into stretches of about ``STRETCH`` bytes.
An empty table gives no rows.  Only the columns ``text`` and ``lang`` are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.llm.stage import share_package, small_batches, stage
from ledgerlight.llm.text_arrays import mix, span_hashes, utf8_buffer

LEAST, LONGEST, TOP = 30, 4, 2000
SHARD = 250_000            # words or phrases of a broadcast
KEPT = 16                  # broadcasts of a level that a task keeps
ROOM = 1                   # a trie has a place for each node and one more for this many, as far as wide nodes fit in
STRETCH = 4 << 20          # bytes of text whose positions advance together
ROW = 1 << 9               # symbols of a written row, and on to the end of a run
SHARES = 16                # first-phase shares of a language's ranking
HELD = 1 << 20             # rows of word counts that a task holds to add them up
HELD_KEYS = 1 << 20        # candidates that a task holds to add them up
ROWS_OUT = 1 << 16         # rows of a batch that a task gives back

_SPLIT = np.zeros(256, bool)
_SPLIT[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_SOLID = ~_SPLIT
_SOLID[[0x20, 0x09]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Stretch:
    """Words of a stretch of text: number in a dictionary, language and whether the next word follows in the same piece."""

    def __init__(self, words: pa.Array, ids: np.ndarray, lang: np.ndarray, follows: np.ndarray) -> None:
        self.words, self.ids, self.lang, self.follows = words, ids, lang, follows


def stretches(texts: pa.Array, langs: np.ndarray) -> Iterator[Stretch]:
    """The words of a batch of texts, ``langs`` being a number per text."""
    data, offsets = utf8_buffer(texts)
    if not len(data):
        return
    cut = _SPLIT[data]
    at = 0
    while at < len(data):
        stop = min(len(data), at + STRETCH)
        while stop < len(data):  # on to the end of the piece (or of the text)
            look = cut[stop:stop + STRETCH]
            piece = stop + int(look.argmax()) if look.any() else len(data) if stop + STRETCH >= len(data) else 0
            text = int(offsets[np.searchsorted(offsets, stop)])
            if not piece and text > stop + STRETCH:
                stop += STRETCH
                continue
            stop = min(piece or text, text)
            break
        found = _words(data[at:stop], cut[at:stop], offsets - at, langs)
        if found is not None:
            yield found
        at = stop


def _words(data: np.ndarray, cut: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> Stretch | None:
    n = len(data)
    solid = _SOLID[data]
    offsets = np.clip(offsets, 0, n)
    inner = offsets[offsets < n]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[inner] = solid[inner]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return None
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    behind = inner[inner > 0] - 1
    stops[behind] = solid[behind]
    kept = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(np.flatnonzero(stops) + 1 - starts, out=kept[1:])
    body = _LOWER[data[solid]]
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(kept), pa.py_buffer(body)])
    words = words.dictionary_encode()
    follows = np.ones(len(starts) + 1, bool)  # of the word before each word, and of the last
    follows[np.searchsorted(starts, np.flatnonzero(cut))] = False
    follows[np.searchsorted(starts, inner)] = False
    follows[-1] = False
    lang = np.repeat(langs, np.diff(np.searchsorted(starts, offsets)))
    return Stretch(words.dictionary, words.indices.to_numpy().astype(np.int64), lang, follows[1:])


class DoubleArray:
    """A trie over whole-number symbols in two arrays: state ``s`` goes to ``base[s] + c`` on ``c`` if that place's check is ``s``.

    All keys are equally long, so a last state goes nowhere and its base is the key's value.
    """

    def __init__(self, base: np.ndarray, check: np.ndarray) -> None:
        self.base, self.check = base, check

    @property
    def value(self) -> np.ndarray:
        return self.base

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray | None = None) -> "DoubleArray":
        """``keys``: distinct sequences of equal length as sorted rows of symbols from 1 on; the value is the row number or that of ``values``."""
        depth = keys.shape[1]
        first_new = np.ones(len(keys), np.int64)  # the first symbol that a row doesn't share with the row before
        first_new[1:] = (keys[1:] != keys[:-1]).argmax(axis=1)
        first_new[:1] = 0
        nodes = int((depth - first_new).sum())
        size = nodes + nodes // ROOM + int(keys.max(initial=0)) + 1024
        base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        taken = np.zeros(size, bool)
        taken[0] = True  # the root's own place
        top, rng = 0, np.random.default_rng(1)
        states, low = np.zeros(1, np.int64), np.zeros(1, np.int64)
        for d in range(depth):
            column = keys[:, d]
            new = np.zeros(len(keys), bool)  # rows where a child begins
            new[1:] = column[1:] != column[:-1]
            new[low] = True
            heads = np.flatnonzero(new)
            first = np.searchsorted(heads, low)
            width = np.append(first[1:], len(heads)) - first
            place = np.empty(len(heads), np.int64)
            for i in np.argsort(-width, kind="stable")[:int((width > 1).sum())]:  # wide nodes are hardest to place
                mine = slice(first[i], first[i] + width[i])
                symbols = column[heads[mine]]
                b = cls._room(taken, symbols, rng)
                if b is None:  # behind everything taken so far
                    b = top + 1 - int(symbols[0])
                    more = max(0, b + int(symbols[-1]) + 1024 - len(taken))
                    base, check, taken = cls._grown(more, base, check, taken)
                place[mine] = b + symbols
                taken[place[mine]] = True
                top = max(top, b + int(symbols[-1]))
            single = first[width == 1]  # these fit anywhere
            free = np.flatnonzero(~taken)[:len(single)]
            if len(free) < len(single):
                base, check, taken = cls._grown(len(single) - len(free) + 1024, base, check, taken)
                free = np.flatnonzero(~taken)[:len(single)]
            place[single] = free
            taken[free] = True
            top = max(top, int(free.max(initial=0)))
            check[place] = np.repeat(states, width)
            base[states] = place[first] - column[heads[first]]
            states, low = place, heads
        base[states] = low if values is None else values[low]
        used = int(np.flatnonzero(taken)[-1]) + 1
        base, check = base[:used], check[:used]
        small = max(used + int(keys.max(initial=0)), int(base.max())) < 1 << 31
        return cls(base.astype(np.int32), check.astype(np.int32)) if small else cls(base.copy(), check.copy())

    @staticmethod
    def _grown(more: int, base: np.ndarray, check: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (np.concatenate([base, np.zeros(more, np.int64)]), np.concatenate([check, np.full(more, -1, np.int64)]),
                np.concatenate([taken, np.zeros(more, bool)]))

    @staticmethod
    def _room(taken: np.ndarray, symbols: np.ndarray, rng: np.random.Generator, batch: int = 64, batches: int = 16) -> int | None:
        """A base at which all ``symbols`` find free places, from some places tried for the first of them."""
        away = symbols - symbols[0]
        last = len(taken) - 1 - int(away[-1])
        if last < 1:
            return None
        some = away[np.linspace(0, len(away) - 1, min(len(away), 64)).astype(np.int64)]
        for _ in range(batches):
            at = rng.integers(1, last + 1, batch)
            for b in at[~taken[at[:, None] + some].any(axis=1)].tolist():
                if not taken[b + away].any():
                    return b - int(symbols[0])
        return None

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none (or was none, or the symbol is 0)."""
        place = self.base[states] + symbols
        known = (states >= 0) & (symbols > 0) & (place > 0) & (place < len(self.check))
        place = np.where(known, place, 0)
        return np.where(known & (self.check[place] == states), place, -1)


    def find(self, symbols: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of ``at`` where a key of ``length`` symbols starts, and its value."""
        state = np.zeros(len(at), np.int64)
        for step in range(length):  # all places together, those without a state drop out
            state = self.step(state, symbols[at + step])
            at, state = at[state >= 0], state[state >= 0]
        return at, self.value[state]


class Shards:
    """Broadcast parts of a level by number; a task keeps ``KEPT`` of them and reads the others again."""

    def __init__(self, parts: dict[int, Broadcast], many: int) -> None:
        self.parts, self.many = parts, many

    def __getitem__(self, number: int) -> "Words | DoubleArray | None":
        part = self.parts.get(number)
        if part is None:
            return None
        value = part.value
        if number >= KEPT and getattr(part, "_path", None):
            vars(part).pop("_value", None)  # the next use reads it again, from the worker's file
        return value

    def dealt(self, shard: np.ndarray) -> Iterator[tuple["Words | DoubleArray", np.ndarray]]:
        """Each part with the places of its number in ``shard``, ascending."""
        if self.many == 1:
            order, ends = np.arange(len(shard)), np.array([len(shard)])
        else:
            order = np.argsort(shard.astype(np.uint16) if self.many < 1 << 16 else shard, kind="stable")
            ends = np.searchsorted(shard[order], np.arange(self.many), side="right")
        for number in range(self.many):
            some = order[ends[number - 1] if number else 0:ends[number]]
            if len(some) and (part := self[number]) is not None:
                yield part, some

    def unpersist(self) -> None:
        for part in self.parts.values():
            part.unpersist()


def _word_hashes(words: pa.Array) -> np.ndarray:
    data, offsets = utf8_buffer(words)
    return span_hashes(data, offsets[:-1], offsets[1:])


def _hashes(langs: pa.Array, lang: np.ndarray, words: pa.Array, word: np.ndarray) -> np.ndarray:
    """A hash per pair of a language and a word, given as numbers in ``langs`` and ``words``."""
    return mix(mix(_word_hashes(langs))[lang] ^ _word_hashes(words)[word])


def _shard_of(hashes: np.ndarray, many: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(many)).astype(np.int64)


def _symbol_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """A hash per phrase from the symbols of its words but the last (it only deals phrases out; a trie is dense where siblings are together)."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


class Words:
    """Frequent words of a shard with their symbols, found by hash and then compared."""

    def __init__(self, table: pa.Table) -> None:
        langs, words, symbols = (table[c].combine_chunks() for c in ("lang", "phrase", "id"))
        langs = langs.dictionary_encode()
        hashes = _hashes(langs.dictionary, langs.indices.to_numpy(), words, np.arange(len(words)))
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.symbols = hashes[order], symbols.to_numpy()[order].astype(np.int32)
        self.names, self.langs = langs.dictionary.cast(pa.string()), langs.indices.to_numpy()[order]
        self.words = words.cast(pa.large_string()).take(pa.array(order))

    def find(self, hashes: np.ndarray, langs: pa.Array, lang: np.ndarray, words: pa.Array, word: np.ndarray) -> np.ndarray:
        """The symbols of pairs of a language and a word, 0 where a pair is not frequent."""
        out = np.zeros(len(hashes), np.int32)
        known = pc.fill_null(pc.index_in(langs.cast(pa.string()), value_set=self.names), -1).to_numpy()
        at = np.arange(len(hashes))
        place = np.searchsorted(self.hashes, hashes)
        while True:  # more than once only for words that share a hash
            same = place < len(self.hashes)
            same[same] = self.hashes[place[same]] == hashes[at[same]]
            at, place = at[same], place[same]
            if not len(at):
                return out
            equal = pc.equal(self.words.take(pa.array(place)), words.take(pa.array(word[at])).cast(pa.large_string()))
            equal = equal.to_numpy(zero_copy_only=False) & (self.langs[place] == known[lang[at]])
            out[at[equal]] = self.symbols[place[equal]]
            at, place = at[~equal], place[~equal] + 1


def _encoded(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    langs = batch.column("lang").dictionary_encode()
    return langs.dictionary, langs.indices.to_numpy().astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, word, count) of a task, counts of a word added up over stretches and batches."""
    held, rows = [], 0
    for counted in _stretch_words(batches):
        held.append(counted)
        rows += counted.num_rows
        if rows >= HELD:
            held = _added(held)
            rows = sum(x.num_rows for x in held)
            if 2 * rows > HELD:  # mostly different words
                yield from held
                held, rows = [], 0
    if held:
        yield from _added(held)


def _added(counts: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """One row per language and word."""
    table = pa.Table.from_batches(counts).group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")])
    return table.rename_columns({"f_sum": "f"}).select(["lang", "phrase", "f"]).combine_chunks().to_batches(max_chunksize=ROWS_OUT)


def _stretch_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, lang = _encoded(batch)
        for part in stretches(batch.column("text"), lang):
            key = part.lang * len(part.words) + part.ids
            count = np.bincount(key, minlength=len(names) * len(part.words))
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(some // len(part.words))), part.words.take(pa.array(some % len(part.words))).cast(pa.string()),
                 pa.array(count[some])], ["lang", "phrase", "f"])


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _write_symbols(words: Shards) -> Task:
    """The texts as rows of 32-bit symbols that end behind a 0; runs of 0 are one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lang = _encoded(batch)
            for part in stretches(batch.column("text"), lang):
                symbols = _symbols(part, names, words)
                ends = np.flatnonzero(symbols == 0)
                rows = ends[np.minimum(np.searchsorted(ends, np.arange(ROW - 1, len(symbols) + ROW, ROW)), len(ends) - 1)]
                borders = np.append(0, np.unique(rows) + 1) * 4
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, [
                    None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(symbols)]).cast(pa.binary())], ["symbols"])
    return run


def _symbols(part: Stretch, names: pa.Array, words: Shards) -> np.ndarray:
    """The symbols of a stretch, a 0 behind each piece and at its end."""
    key = part.lang * len(part.words) + part.ids
    symbol_of = np.zeros(len(names) * len(part.words), np.int32)
    symbol_of[key] = 1
    pairs = np.flatnonzero(symbol_of)
    lang, word = pairs // len(part.words), pairs % len(part.words)
    hashes = _hashes(names, lang, part.words, word)
    found = np.zeros(len(pairs), np.int32)
    for shard, some in words.dealt(_shard_of(hashes, words.many)):
        found[some] = shard.find(hashes[some], names, lang[some], part.words, word[some])
    symbol_of[pairs] = found
    apart = ~part.follows  # a 0 follows the word
    spread = np.zeros(len(key) + int(apart.sum()), np.int32)
    spread[np.arange(len(key)) + np.cumsum(apart) - apart] = symbol_of[key]
    kept = np.ones(len(spread), bool)
    kept[1:] = (spread[1:] != 0) | (spread[:-1] != 0)
    return spread[kept]


def _count_candidates(tries: Shards | None, length: int, span: int) -> Task:
    """(phrase * span + last symbol, count) of the candidates whose first and last ``length`` words are frequent phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            data, _ = utf8_buffer(batch.column("symbols"))
            symbols = np.concatenate([np.frombuffer(data.tobytes(), np.int32), np.zeros(length + 1, np.int32)])
            first = symbols.astype(np.int64) if tries is None else _phrases_at(symbols, tries, length)
            at = np.flatnonzero((first[:-1] > 0) & (first[1:] > 0))
            held.append(_keys_added([(first[at] * span + symbols[at + length], np.ones(len(at), np.int64))]))
            rows += len(held[-1][0])
            if rows >= HELD_KEYS:
                held = [_keys_added(held)]
                rows = len(held[0][0])
                if 2 * rows > HELD_KEYS:  # mostly different candidates
                    yield from _key_batches(held[0])
                    held, rows = [], 0
        if held:
            yield from _key_batches(_keys_added(held))
    return run


def _phrases_at(symbols: np.ndarray, tries: Shards, length: int) -> np.ndarray:
    """For each place the id of the phrase of ``length`` words that starts there, or 0."""
    whole = symbols[:len(symbols) - length] != 0
    for j in range(1, length):
        whole &= symbols[j:len(symbols) - length + j] != 0
    at = np.flatnonzero(whole)
    out = np.zeros(len(symbols), np.int64)
    shard = _shard_of(_symbol_hashes([symbols[at + j] for j in range(length - 1)]), tries.many) if tries.many > 1 else at
    for trie, some in tries.dealt(shard):
        place, value = trie.find(symbols, at[some], length)
        out[place] = value
    return out


def _keys_added(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One count per key, by key."""
    keys, f = (np.concatenate(c) for c in zip(*counts))
    if not len(keys):
        return keys, f
    order = np.argsort(keys)
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[heads], np.add.reduceat(f[order], heads)


def _key_batches(counts: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(counts[0]), ROWS_OUT):
        yield pa.RecordBatch.from_arrays([pa.array(c[i:i + ROWS_OUT]) for c in counts], ["key", "f"])


def _names(length: int) -> list[str]:
    return [f"s{i + 1}" for i in range(length)]


def _deal_words(many: int) -> Task:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lang = _encoded(batch)
            shard = _shard_of(_hashes(names, lang, batch.column("phrase"), np.arange(len(lang))), many)
            yield batch.append_column("shard", pa.array(shard.astype(np.int32)))
    return run


def _deal_phrases(length: int, many: int) -> Task:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = _shard_of(_symbol_hashes([batch.column(c).to_numpy() for c in _names(length - 1)]), many)
            yield batch.append_column("shard", pa.array(shard.astype(np.int32)))
    return run


def _number(order: list[tuple[str, str]], many: int) -> Callable[[pa.Table], pa.Table]:
    """The rows of a shard in this order with ids that are unique in all shards, from 1 on and nearly without gaps."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        return table.append_column("id", pa.array(np.arange(table.num_rows) * many + table["shard"][0].as_py() + 1))
    return run


def _dealt_out(phrases: DataFrame, deal: Task, order: list[tuple[str, str]], many: int) -> DataFrame:
    """``phrases`` with a shard number and an id."""
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in phrases.schema) + ", shard int"
    return stage(phrases.mapInArrow(deal, kind).repartition(many, "shard").groupBy("shard")
                 .applyInArrow(_number(order, many), kind + ", id bigint"), "phrases")


def _numbered_words(words: DataFrame, shard: int) -> tuple[DataFrame, Shards]:
    """The frequent words, their ids as symbols (small ones for frequent words, for dense tries), and all of them broadcast."""
    many = max(1, -(-words.count() // shard))
    numbered = _dealt_out(words, _deal_words(many), [("f", "descending"), ("lang", "ascending"), ("phrase", "ascending")], many)
    parts = {}
    for s in range(many):
        table = numbered.filter(F.col("shard") == s).select("lang", "phrase", "id").toArrow()  # about SHARD words
        if table.num_rows:
            parts[s] = words.sparkSession.sparkContext.broadcast(Words(table))
    return numbered.withColumn("s1", F.col("id").cast("int")), Shards(parts, many)


def _build_trie(length: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")  # by symbols
        keys = np.stack([table[c].to_numpy().astype(np.int64) for c in _names(length)], axis=1)
        trie = DoubleArray.build(keys, table["id"].to_numpy())
        return pa.table({"shard": table["shard"][:1], "trie": pa.array([pickle.dumps(trie, protocol=5)])})
    return run


def _numbered_phrases(phrases: DataFrame, length: int, shard: int) -> tuple[DataFrame, Shards]:
    """The frequent phrases of ``length`` words with ids, and their tries, built in tasks and broadcast one by one."""
    many = max(1, -(-phrases.count() // shard))
    numbered = _dealt_out(phrases, _deal_phrases(length, many), [(c, "ascending") for c in _names(length)], many)
    tries = stage(numbered.select(*_names(length), "shard", "id").repartition(many, "shard").groupBy("shard")
                  .applyInArrow(_build_trie(length), "shard int, trie binary"), "tries")
    parts = {}
    for s in range(many):
        for row in tries.filter(F.col("shard") == s).select("trie").collect():
            parts[s] = phrases.sparkSession.sparkContext.broadcast(pickle.loads(row.trie))
    return numbered, Shards(parts, many)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``longest`` words with ``f >= least``, and (lang, n) of all words."""
    with small_batches(docs.sparkSession):
        return _frequent_phrases(docs, least, longest, shard)


def _frequent_phrases(docs: DataFrame, least: int, longest: int, shard: int) -> tuple[DataFrame, DataFrame]:
    share_package(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = stage(texts.mapInArrow(_count_words, "lang string, phrase string, f bigint")
                  .groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "words")
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    phrases, shards = _numbered_words(words.filter(F.col("f") >= least), shard)
    out = phrases.select("lang", "phrase", "f", F.lit(1).alias("words"))
    if not shards.parts:
        return stage(out, "frequent"), total
    symbols = stage(texts.mapInArrow(_write_symbols(shards), "symbols binary"), "symbols")
    shards.unpersist()
    last = phrases.select(F.col("id").alias("word"), F.col("phrase").alias("last"))
    span = phrases.agg(F.max("id")).first()[0] + 1
    tries = None
    for length in range(2, longest + 1):
        counted = (symbols.mapInArrow(_count_candidates(tries, length - 1, span), "key bigint, f bigint")
                   .groupBy("key").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
                   .select(F.expr(f"key DIV {span}L").alias("id"), F.expr(f"key % {span}L").alias("word"), "f"))
        level = stage(counted.join(phrases.drop("f", "shard"), "id").join(last, "word").select(
            "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "f", *_names(length - 1),
            F.col("word").cast("int").alias(f"s{length}")), "level")
        if tries is not None:
            tries.unpersist()
        out = out.unionByName(level.select("lang", "phrase", "f", F.lit(length).alias("words")))
        if length < longest:
            phrases, tries = _numbered_phrases(level, length, shard)
            if not tries.parts:
                break
    return stage(out, "frequent"), total


def _joined(words: Column, start: int, count: int) -> Column:
    return F.array_join(F.slice(words, start, count), " ")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` best phrases not held by a longer one as frequent."""
    known, total = frequent_phrases(docs, least, longest, shard)
    candidates = known.filter("words >= 2").withColumn("w", F.split("phrase", " ", -1))
    # every way to cut a candidate in two
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.col("w"), 1, F.col("k")).alias("head"),
                       F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("tail"))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", F.expr(
        "CAST(CAST(a AS DECIMAL(20,0)) * 2000000 DIV (CAST(l AS DECIMAL(20,0)) + r) AS BIGINT)"))
    best = (scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
            .select("lang", "phrase", "cut.*").drop("k"))
    # what a longer candidate holds: its runs of two words or more
    runs = candidates.filter("words >= 3").select("lang", "f", F.explode(F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )).alias("phrase"))
    held = runs.groupBy("lang", "phrase").agg(F.max("f").alias("inside"))
    free = (best.join(held, ["lang", "phrase"], "left")
            .filter(F.col("inside").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("inside") < F.lit(80).cast("decimal(20,0)") * F.col("a"))))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each share first: a language with most phrases is not one task's
    shared = Window.partitionBy("lang", "share").orderBy(*order)
    some = (free.drop("inside").withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)).cast("int"))
            .withColumn("place", F.row_number().over(shared)).filter(F.col("place") <= top).drop("place", "share"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return (ranked.filter(F.col("rank") <= top).join(total, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
