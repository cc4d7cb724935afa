"""Exact top-k, vector codes and collocations against brute force."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import sys
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import __spark_entry__ as entry  # noqa: E402
from ledgerlight.llm import collocations, exact_topk, vector_codes  # noqa: E402

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<double>, label int, cell string, block int, id int, part string, score double"


def vectors(n=400, d=8, seed=3):
    rng = np.random.default_rng(seed)
    rows = [[int(i), [float(v) for v in x]] for i, x in enumerate(rng.normal(size=(n, d)).round(2))]
    for i in range(0, n, 3):  # one vector of a third of the rows
        rows[i][1] = [0.5] * d
    rows += [[5, [0.5] * d], [50, [0.25] * d], [50, [0.25] * d], [n + 1, None], [n + 2, [1.0, None] + [0.0] * (d - 2)],
             [n + 3, [float("nan")] * d], [n + 4, [float("inf")] * d], [None, [1.0] * d], [n + 5, [0.0] * d],
             [n + 6, [3.0]], [n + 7, []]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, x, None if i is None or i % 7 == 0 else i % 3, "c", 1, 2, "p", 0.5) for i, x in rows], VECTORS)


def usable(rows, scale, with_null_ids):
    out = [(i, [math.floor(scale * v) for v in x]) for i, x in rows
           if x is not None and all(v is not None and math.isfinite(v) for v in x) and (with_null_ids or i is not None)]
    width = max((len(x) for _, x in out), default=0)
    return [(i, tuple(x + [0] * (width - len(x)))) for i, x in out]


@pytest.mark.parametrize("every, k, block", [(50, 5, 1024), (7, 3, 16), (1, 1, 64)])
def test_exact_topk(spark, every, k, block):
    rows = vectors()
    found = defaultdict(list)
    for r in exact_topk.search(frame(spark, rows), every=every, k=k, block=block).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    kept = sorted(set(usable(rows, 256, False)))
    want = defaultdict(list)
    for q, x in kept:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), c) for c, y in kept if c != q)[:k]
            want[q] += [(n + 1, c, -s) for n, (s, c) in enumerate(best)]
    assert {q: sorted(v) for q, v in found.items()} == {q: sorted(v) for q, v in want.items()}


def test_exact_topk_edges(spark):
    assert exact_topk.search(frame(spark, [])).count() == 0
    assert exact_topk.search(frame(spark, [[0, [1.0]]])).count() == 0  # no candidates
    assert [tuple(r) for r in exact_topk.search(frame(spark, [[0, [1.0]], [3, [-0.001]], [2, [-0.001]]])).collect()] == [
        (0, 1, 2, -256), (0, 2, 3, -256)]
    with pytest.raises(Exception):
        exact_topk.search(frame(spark, [[0, [1e30]], [1, [1e30]]])).collect()
    big = exact_topk.search(frame(spark, [[0, [1e6, 3.0]], [1, [1e6, -1.0]]])).collect()  # beyond 2**53
    assert big[0].score == 256_000_000**2 - 3 * 256 * 256


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-300, 300, (500, 6)).astype(float), rng.integers(-300, 300, (40, 6)).astype(float)
    centres = exact_topk.pivots(x.astype(int), 9)
    cell = exact_topk.nearest(x, centres)
    along, rest = exact_topk.split(x, centres)
    summary = np.full((9, 4), -np.inf)
    for c in set(cell.tolist()):
        w = cell == c
        summary[c] = np.linalg.norm(x[w] - centres[c], axis=1).max(), along[w, c].min(), along[w, c].max(), rest[w, c].max()
    bound = exact_topk.upper_bounds(q, centres, summary)
    for c in set(cell.tolist()):
        assert (q @ x[cell == c].T <= bound[:, c][:, None]).all()


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = usable(rows, 1024, True)
    if not kept:
        return []
    width = len(kept[0][1])
    each = max(1, -(-width // parts))
    x = np.array([list(v) + [0] * (each * parts - width) for _, v in kept], np.int64)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [x[order, p * each:(p + 1) * each].copy() for p in range(parts)]

    def near(p):
        return ((x[:, None, p * each:(p + 1) * each] - books[p][None]) ** 2).sum(-1)

    for _ in range(rounds):
        for p in range(parts):
            code = near(p).argmin(1)
            for e in range(len(books[p])):
                mine = x[code == e, p * each:(p + 1) * each]
                if len(mine):
                    books[p][e] = mine.sum(0) // len(mine)
    codes, errors = [near(p).argmin(1) for p in range(parts)], sum(near(p).min(1) for p in range(parts))
    text = ",".join(str(v) for b in books for v in b.ravel().tolist())
    return [(kept[i][0], "".join(f"{c[i]:02x}" for c in codes), int(errors[i])) for i in range(len(kept))], hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("n, d", [(900, 8), (40, 6), (1500, 16)])
def test_vector_codes(spark, n, d):
    rows = vectors(n, d)
    want, digest = brute_codes(rows)
    got = vector_codes.report(frame(spark, rows).repartition(3)).collect()
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=str) == sorted(want, key=str)
    assert {r.codebooks_sha256 for r in got} == {digest}
    label = lambda i: None if i is None or i % 7 == 0 else i % 3
    sums = Counter()
    for i, _, e in want:
        sums[label(i)] += e
    assert all(r.label_error == sums[label(r.vec_id)] for r in got)


def test_vector_codes_edges(spark):
    assert vector_codes.report(frame(spark, [])).count() == 0
    assert vector_codes.report(frame(spark, [[1, None]])).count() == 0
    one = vector_codes.report(frame(spark, [[1, []]]).drop("label")).collect()
    assert [(r.code, r.error, r.label_error) for r in one] == [("00000000", 0, 0)]


def test_cover_tree_is_exact():
    rng = np.random.default_rng(7)
    for n, d, spread in ((1, 3, 5), (300, 4, 3), (1000, 16, 1000), (700, 2, 100)):
        x = rng.integers(-spread, spread, (n, d))
        tree = vector_codes.CoverTree.load(vector_codes.CoverTree.build(x).dump())
        book = rng.integers(-spread, spread, (20, d))
        book[5] = book[3]  # ties go to the lower index
        found = tree.assign(book)
        want = ((tree.points[:, None] - book[None]) ** 2).sum(-1).argmin(1)
        assert (found.codes == want).all() and (x[tree.order] == tree.points).all()
        total, count = tree.sums(found, 20)
        assert (count == np.bincount(want, minlength=20)).all()
        assert all((total[e] == tree.points[want == e].sum(0)).all() for e in range(20))


def brute_phrases(rows, least, top):
    words, counts = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for m in range(1, 5):
                counts[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in cand.items():
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            inside = any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= 80 * a
                         for q, b in cand.items())
            if not inside:
                best.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, n + 1, p.decode(), -a, left, right, words[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(best)[:top])]
    return out


def texts(n=60, seed=5):
    rng = random.Random(seed)
    vocab = ["the", "Of", "é", "ß", "x", "Über", "a-b", "\x01", "日本", "y"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts += rng.choice([[rng.choice(vocab)], ["New", "York", "City"], ["New", "York", "City", "Hall"]])
            parts.append(rng.choice([" ", " ", "  ", "\t", ". ", "\n", ","]))
        rows.append((rng.choice(["en", "de", None]), " ".join(parts)))
    return rows + [("en", None), ("en", ""), ("fr", " .,"), (None, "new york city " * 200)]


@pytest.mark.parametrize("shard, stretch", [(200_000, 4 << 20), (5, 300)])
def test_collocations(spark, monkeypatch, shard, stretch):
    monkeypatch.setattr(collocations, "STRETCH", stretch)
    rows = texts()
    docs = spark.createDataFrame([(*r, "p", 1, "w") for r in rows], "lang string, text string, phrase string, id int, f string")
    got = sorted(tuple(r) for r in collocations.mine(docs, least=8, top=15, shard=shard).collect())
    assert got == sorted(brute_phrases(rows, 8, 15)) and len(got) > 20


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.mine(docs).count() == 0
    assert collocations.mine(spark.createDataFrame([("en", "a b c")], "lang string, text string")).count() == 0


def test_stretches_cut_at_pieces():
    import pyarrow as pa
    text = "a b, c d. " * 50 + "long" * 400 + " e f"
    old, collocations.STRETCH = collocations.STRETCH, 64
    try:
        parts = list(collocations.stretches(pa.array([text, "", None, "g h"]), np.array([0, 0, 0, 1])))
    finally:
        collocations.STRETCH = old
    words = [w for p in parts for w in np.array(p.words.to_pylist())[p.ids]]
    assert words == re.findall("[^ .,]+", text) + ["g", "h"] and len(parts) > 5
    assert [lang for p in parts for lang in p.lang][-3:] == [0, 1, 1]


@pytest.mark.parametrize("held", [1 << 20, 100])
def test_a_task_adds_its_word_counts_up(monkeypatch, held):
    """A word leaves a task once, not once per stretch; with little room it may come out again."""
    import pyarrow as pa
    from collections import Counter
    monkeypatch.setattr(collocations, "STRETCH", 64)
    monkeypatch.setattr(collocations, "HELD", held, raising=False)
    rows = [(lang or "und", text) for lang, text in texts()] + [("en", f"the word{i}. The word{i}, the end") for i in range(500)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + 50])], ["lang", "text"]) for i in range(0, len(rows), 50)]
    got = [r for b in collocations._count_words(iter(batches)) for r in zip(*b.to_pydict().values())]
    want, total = Counter(), Counter()
    for lang, text in rows:
        want.update((lang, w) for w in re.findall("[^ \t\n,.]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
    for lang, word, f in got:
        total[lang, word] += f
    assert total == want
    assert len(got) == len(want) if held > len(got) else len(got) < 3 * len(want)


def test_phrases_are_counted_in_small_batches(spark, monkeypatch):
    from ledgerlight.llm import stage as stages
    seen, stage = [], collocations.stage
    before = spark.conf.get(stages.BATCH_ROWS)
    monkeypatch.setattr(collocations, "stage", lambda df, label: seen.append(int(spark.conf.get(stages.BATCH_ROWS))) or stage(df, label))
    docs = spark.createDataFrame([("en", "new york city " * 10)], "lang string, text string")
    known, total = collocations.frequent_phrases(docs, least=8)
    assert len(known.collect()) == 3 + 3 + 3 + 3 and total.collect()[0].n == 30 and set(seen) == {1000}
    assert spark.conf.get(stages.BATCH_ROWS) == before


def test_word_hashes_tell_words_apart_and_fit_the_bitmap():
    """Hashes of the words of a stretch equal those of the phrases in the bitmap, whatever the array's type and place."""
    import pyarrow as pa
    words = [f"w{i}" for i in range(5000)] + ["", "é", "日本", "x" * 1000, "x" * 1001]
    small, large = pa.array(words), pa.array(["other", *words], pa.large_string()).slice(1)
    assert len(set(collocations._word_hashes(small).tolist())) == len(words)
    assert (collocations._word_hashes(small) == collocations._word_hashes(large)).all()


@pytest.mark.parametrize("shard", [1, 3])
def test_a_level_is_one_pass_however_many_shards(spark, monkeypatch, shard):
    """The texts are read twice and their symbols once a level; with a phrase a shard a task also reads tries again."""
    labels, reads = [], []
    stage, kind = collocations.stage, type(spark.range(0))
    monkeypatch.setattr(collocations, "stage", lambda df, label: labels.append(label) or stage(df, label))
    as_arrow = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: reads.append({"text", "symbols"} & {*self.columns}) or as_arrow(self, *a, **b))
    rows = texts()
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in collocations.mine(docs, least=8, top=15, shard=shard).collect())
    assert got == sorted(brute_phrases(rows, 8, 15))
    assert labels.count("level") == 3
    assert reads.count({"text"}) == 2 and reads.count({"symbols"}) == 3


def test_frequent_words_are_compared_not_only_hashed(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(collocations, "_hashes", lambda langs, lang, words, word: np.full(len(word), 7, np.uint64))
    table = pa.table({"lang": ["en", "de", "en"], "phrase": ["a", "a", "b"], "id": [1, 2, 3]})
    langs, words = pa.array(["fr", "de", "en"]), pa.array(["b", "c", "a"], pa.large_string())
    lang, word = np.repeat(np.arange(3), 3), np.tile(np.arange(3), 3)
    found = collocations.Words(table).find(np.full(9, 7, np.uint64), langs, lang, words, word)
    assert found.tolist() == [0, 0, 0, 0, 0, 2, 3, 0, 1]


@pytest.mark.parametrize("row", [1, 4, 1000])
@pytest.mark.parametrize("held", [1 << 20, 3])
def test_symbols_are_whole_runs_and_candidates_added_up(monkeypatch, row, held):
    import pyarrow as pa
    from collections import Counter
    monkeypatch.setattr(collocations, "ROW", row)
    monkeypatch.setattr(collocations, "HELD_KEYS", held)
    table = pa.table({"lang": ["en"] * 3 + ["de"], "phrase": ["a", "b", "c", "a"], "id": [1, 2, 3, 4]})

    class Here:
        def __init__(self, value):
            self.value = value

    words = collocations.Shards({0: Here(collocations.Words(table))}, 1)
    docs = pa.RecordBatch.from_arrays([pa.array(["en", "de", "en", "en"]), pa.array(["A b a b. x a b  c x x, ,", "a a b", None, "c a b"])], ["lang", "text"])
    written = list(collocations._write_symbols(words)(iter([docs])))
    rows = [np.frombuffer(x, np.int32).tolist() for b in written for x in b.column("symbols").to_pylist()]
    assert all(r[-1] == 0 for r in rows) and (len(rows) == 1 if row == 1000 else len(rows) > 1)
    assert sum(rows, []) == [1, 2, 1, 2, 0, 1, 2, 3, 0, 4, 4, 0, 3, 1, 2, 0]
    pairs = Counter()
    for b in collocations._count_candidates(None, 1, 10)(iter(written)):
        for key, f in zip(*b.to_pydict().values()):
            pairs[key] += f
    assert pairs == {12: 4, 21: 1, 23: 1, 44: 1, 31: 1}
    # pairs 12 and 31 frequent, in shards of their own
    shard_of = {tuple(k): int(collocations._shard_of(collocations._symbol_hashes([np.array([c]) for c in k[:-1]]), 2)[0]) for k in ((1, 2), (3, 1), (2, 1), (2, 3))}
    parts = {}
    for number in (0, 1):
        mine = sorted(k for k, s in shard_of.items() if s == number and k != (2, 3))
        if mine:
            parts[number] = Here(collocations.DoubleArray.build(np.array(mine), np.array([10 * a + b for a, b in mine])))
    got = Counter()
    for b in collocations._count_candidates(collocations.Shards(parts, 2), 2, 10)(iter(written)):
        for key, f in zip(*b.to_pydict().values()):
            got[key] += f
    assert got == {121: 1, 212: 1, 312: 1}  # not 123, whose last part is not frequent


def test_double_array():
    rng = np.random.default_rng(2)
    for n, v, depth in ((1, 1, 1), (300, 6, 3), (4000, 900, 2)):
        keys = np.unique(rng.integers(1, v + 1, (n, depth)), axis=0)
        trie = collocations.DoubleArray.build(keys)
        some = rng.integers(0, v + 2, (2000, depth))
        state = np.zeros(len(some), np.int64)
        for i in range(depth):
            state = trie.step(state, some[:, i])
        want = {tuple(k): i for i, k in enumerate(keys.tolist())}
        assert [trie.value[s] if s >= 0 else None for s in state] == [want.get(tuple(s)) for s in some.tolist()]


@pytest.mark.parametrize("name", ["op11_exact_topk", "op12_collocations"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(cur.fetchall())
