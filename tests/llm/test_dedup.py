"""Substring, line and near-duplicate removal, and components, against brute force."""

from __future__ import annotations

import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from brute import near_groups, repeated_windows, run_lines  # noqa: E402

from ledgerlight.llm import line_dedup, minhash_dedup, substring_dedup, text_arrays
from ledgerlight.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, chunk string, bucket int, n_removed string, minima binary"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, "y", b"z") for i, t in texts], SCHEMA)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocab) for _ in range(80)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 120))) for _ in range(n)]
    for _ in range(20):  # shared passages, near copies, copies, periodic texts
        cut = rng.randint(0, 30)
        texts.append(" ".join([rng.choice(vocab), *passage[cut:cut + rng.randint(30, 50)], rng.choice(vocab)]))
        w = rng.choice(texts[:n]).split(" ")
        if w:
            w[rng.randrange(len(w))] = "Changed"
        texts.append(" ".join(w).upper() if rng.random() < 0.2 else "\t".join(w))
    texts += [texts[3]] * 5 + ["a b c " * 40, "z " * 90, "", None, "one", "One", "two words", " \n\t ", "é ü 日本 " * 20]
    return list(enumerate(texts))


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 700])
def test_substring_dedup(spark, chunk_bytes):
    texts = corpus()
    got = substring_dedup.remove_repeats(frame(spark, texts), chunk_bytes=chunk_bytes, keep_text=True).collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(repeated_windows(texts, 35))
    assert all(r.n_words - r.n_removed == len(r.kept.split()) for r in got)
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_substring_dedup_of_repeated_rows(spark):
    long = " ".join(f"v{i}" for i in range(50))
    got = substring_dedup.remove_repeats(frame(spark, [(1, long), (1, long), (None, "a b")])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 50), (1, 50)]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, k, percent):
    texts = corpus(2)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    for n in range(40):  # a group whose members are near the base, some not near each other
        w = list(base)
        for p in rng.sample(range(120), n % 6):
            w[p] = f"e{n}-{p}"
        texts.append((1000 + n, " ".join(w)))
    want = near_groups(texts, k, percent)
    got = minhash_dedup.near_duplicates(frame(spark, texts), k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_edges(spark):
    rows = minhash_dedup.near_duplicates(frame(spark, [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (9, "A b C d")]), 3, 85)
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in rows.collect())
    assert got == [(-1, None, True), (4, 4, True), (4, 4, True), (9, 4, False)]
    assert minhash_dedup.near_duplicates(frame(spark, []), 3, 85).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(500, 500), (700 - 1, 700)]
    edges += [(300 + i, 301 + i) for i in range(40)]  # a chain
    up = {}
    for a, b in edges:
        up.setdefault(a, a), up.setdefault(b, b)
    for _ in range(300):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    got = connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r.id: r.component for r in got} == {a: c for a, c in up.items() if a != c}


def lines(tag, n):
    return "\n".join(f"{tag} line {i} of text" for i in range(n))


def test_line_chunks_cover_the_text_and_survive_shifts(spark):
    body = lines("body", 40)
    texts = [(1, body), (2, "new\nopening\nlines\n" + body + "\nend"), (3, "short"), (4, "a\nb"), (5, ""), (6, None),
             (7, "\n\n\n"), (8, "B\nLx\nBy\nL\n\nB" * 3)]
    rows = {r.doc_id: r for r in line_dedup.chunk_columns(frame(spark, texts)).collect()}
    for i, t in texts:
        assert "\n".join(c.text for c in rows[i]._chunks) == (t or "")
        assert sum(c.lines for c in rows[i]._chunks) == (t or "").count("\n") + 1
        assert all(c.lines >= 2 for c in rows[i]._chunks) or (t or "").count("\n") < 1
    shared = {c.text for c in rows[1]._chunks} & {c.text for c in rows[2]._chunks}
    assert len(shared) >= len(rows[1]._chunks) - 2


def test_line_dedup(spark):
    body, other = lines("body", 30), lines("other", 12)
    texts = [(5, body), (3, "x\n" + body), (9, body), (9, body), (7, other + "\n" + other), (None, body), (None, None), (2, "a\nb"),
             (1, "\n \n")]
    out = line_dedup.dedup_lines(frame(spark, texts))
    assert set(out.columns) == {"doc_id", "text", "chunk", "bucket", "minima", "n_lines", "n_removed", "n_chunks", "n_chunks_removed"}
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[3][0].n_removed == 0 and got[3][0].text == "x\n" + body
    assert got[5][0].n_removed > 20 and got[9][0].text == "" == got[9][1].text
    assert got[7][0].n_removed > 0 and got[2][0].text == "a\nb" and got[1][0].n_removed == 0
    assert body in [r.text for r in got[None]]
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_line_dedup_runs_without_python(spark):
    plan = line_dedup.dedup_lines(frame(spark, [(1, "a")]).select("doc_id", "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def run_corpus(seed=7):
    """Short passages repeated at the start, in the middle and at the end of otherwise different texts."""
    rng = random.Random(seed)
    passages = [lines(f"passage {p}", 2 + p % 5) for p in range(10)]
    texts = []
    for i in range(60):
        own = [f"own {i} line {n}" for n in range(rng.randint(0, 12))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            own.insert(rng.randint(0, len(own)), p)
        for _ in range(rng.randint(0, 2)):
            own.insert(rng.randint(0, len(own)), rng.choice(["", "  ", "common line"]))
        texts.append((i, "\n".join(own)))
    return texts + [(100, texts[3][1]), (101, "x\nx\nx\nx"), (102, "\n\na\n\nb\n\n"), (103, "a\nb"), (104, None), (105, "\n"),
                    (106, "a"), (107, "common line")]


def test_line_runs_against_brute_force(spark):
    texts = run_corpus()
    want = run_lines(texts)
    rows = {r.doc_id: r for r in line_dedup.dedup_runs(frame(spark, texts)).collect()}
    assert sum(map(len, want.values())) > 100
    for i, t in texts:
        whole = (t or "").split("\n")
        kept = [x for n, x in enumerate(whole) if n not in want[i] and x.strip(" ")]
        assert [x for x in rows[i].text.split("\n") if x.strip(" ")] == kept
        assert rows[i].n_lines == len(whole) and rows[i].n_left == len(kept)
        if not want[i]:
            assert rows[i].text == (t or "") and rows[i].n_removed == 0


def test_pipeline_removes_repeated_runs_inside_texts(spark):
    import corpus_pipeline
    run = "first shared line\nsecond shared line"
    texts = [(n, f"{lines(f'top {n}', 5)}\n{run}\n{lines(f'end {n}', 5)}") for n in range(1, 9)] + [(20, run)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_deduplication(spark, docs, "").collect()}
    assert got == {n: f"{lines(f'top {n}', 5)}\n{run + chr(10) if n == 1 else ''}{lines(f'end {n}', 5)}" for n in range(1, 9)}


def test_pipeline_removes_repeated_chunks_and_then_runs(spark, monkeypatch):
    """The pipeline's line stage takes the chunks of ``dedup_lines`` out, whole, and the repeated pairs of lines outside them."""
    import corpus_pipeline
    body = [x for n in range(40) for x in (f"body line {n} of text", "")]  # blank lines at the heads of chunks
    texts = run_corpus() + [(200, "\n".join(body)), (201, "own first\n" + "\n".join(body) + "\nown last")]
    docs = frame(spark, texts).select("doc_id", "text")
    chunks = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    runs = {r.doc_id: r for r in line_dedup.dedup_runs(docs).collect()}
    both = {r.doc_id: r for r in line_dedup.dedup_chunks_and_runs(docs).collect()}
    assert sum(r.n_chunks_removed for r in chunks.values()) > 3
    want = run_lines(texts)
    for i, t in texts:
        whole = (t or "").split("\n")
        kept = both[i].text.split("\n")
        assert [x for x in kept if x.strip(" ")] == [x for n, x in enumerate(whole) if n not in want[i] and x.strip(" ")]
        assert both[i].n_lines == len(whole) and both[i].n_left == runs[i].n_left
        if both[i].n_left:
            assert both[i].n_removed == len(whole) - len(kept) >= max(chunks[i].n_removed, runs[i].n_removed)
        if not want[i]:
            assert both[i].text == (t or "") and both[i].n_removed == 0
    calls, chunked = [], line_dedup.chunk_columns
    monkeypatch.setattr(line_dedup, "chunk_columns", lambda *args: calls.append(1) or chunked(*args))
    got = {r.doc_id: r.text for r in corpus_pipeline.line_deduplication(spark, docs, "").collect()}
    assert calls and got == {i: r.text for i, r in both.items() if not r.n_removed or r.n_left}
    plan = line_dedup.dedup_chunks_and_runs(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert line_dedup.dedup_chunks_and_runs(frame(spark, [])).count() == 0


def test_line_stage_writes_no_texts_of_its_own(spark, monkeypatch):
    """Only hashes are written on the way; the filter reads the counts and does not compute the lines once more."""
    import corpus_pipeline
    labels = []
    for module in (corpus_pipeline, line_dedup):
        monkeypatch.setattr(module, "stage", lambda df, label, real=module.stage: labels.append(label) or real(df, label))
    docs = frame(spark, run_corpus()).select("doc_id", "text")
    out = corpus_pipeline.line_deduplication(spark, docs, "")
    assert labels == ["piece-hashes"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Filter \(\(_row#\d+L >= 0\) AND \(\(n_removed#\d+L = 0\) OR \(n_left#\d+L > 0\)\)\)", plan)
    both = line_dedup.dedup_chunks_and_runs(docs).collect()
    assert sorted(out.collect()) == sorted((r.doc_id, r.text) for r in both if not r.n_removed or r.n_left)


def test_line_runs_edges(spark):
    a, b = lines("a", 4), lines("b", 3)
    docs = frame(spark, [(9, a), (9, b), (5, a + "\n" + b), (None, a), (None, a), (None, b + "\n" + b)])
    got = {}
    for r in line_dedup.dedup_runs(docs).collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[9] == ["", ""] and got[5] == [a + "\n" + b] and sorted(got[None]) == [a, a, b]
    assert line_dedup.dedup_runs(frame(spark, [])).count() == 0
    plan = line_dedup.dedup_runs(docs.select("doc_id", "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_near_duplicates_run_in_small_batches(spark, monkeypatch):
    from ledgerlight.llm import stage as stages
    seen, stage = [], minhash_dedup.stage
    before = spark.conf.get(stages.BATCH_ROWS)
    monkeypatch.setattr(minhash_dedup, "stage", lambda df, label: seen.append(int(spark.conf.get(stages.BATCH_ROWS))) or stage(df, label))
    texts = [(i, f"one two three four five six seven eight nine w{i % 3}") for i in range(6)]
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(frame(spark, texts), 3, 85).collect()}
    assert got == {i: i % 3 for i in range(6)} and set(seen) == {1000}
    assert spark.conf.get(stages.BATCH_ROWS) == before


def thue_morse(n):
    word, other = "a", "b"
    for _ in range(n):
        word, other = word + other, other + word
    return word, other


def test_words_that_collide_under_polynomials(spark):
    a, b = thue_morse(10)
    column = pa.array([a, b, a.upper()])
    data, offsets = text_arrays.utf8_buffer(column)
    for base in (text_arrays.BASE_A, text_arrays.BASE_B):
        h = text_arrays.span_hashes(data, offsets[:-1], offsets[1:], base, lower=True)
        assert h[0] != h[1] and h[0] == h[2]
    # near duplicates of one word
    got = minhash_dedup.near_duplicates(frame(spark, [(1, a), (2, b), (3, a)]), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1}
    # windows that differ in that word alone
    rest = " ".join(f"w{i}" for i in range(34))
    gone = substring_dedup.remove_repeats(frame(spark, [(1, f"{a} {rest}"), (2, f"{b} {rest}")])).collect()
    assert [r.n_removed for r in gone] == [0, 0]
    # tokens
    from ledgerlight.llm import tokens
    ids, offs = tokens.encode_column(pa.array([a, b]), tokens.default_tokenizer())
    tok = tokens._load(tokens.default_tokenizer())[0]
    assert [ids[offs[i]:offs[i + 1]].tolist() for i in (0, 1)] == [tok.encode(t, add_special_tokens=False).ids for t in (a, b)]


def test_span_hashes_see_every_byte():
    rng = np.random.default_rng(2)
    seen = set()
    texts = [b"", b"\0", b"\0\0", b"\0" * 8, b"\0" * 9] + [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in range(1, 40)]
    for t in list(texts):
        for i in range(len(t)):
            texts.append(t[:i] + bytes([t[i] ^ 1]) + t[i + 1:])
    texts = sorted(set(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    h = text_arrays.span_hashes(data, ends - [len(t) for t in texts], ends)
    seen.update(h.tolist())
    assert len(seen) == len(texts)


def test_repeated_ids_with_different_texts(spark):
    a, b, c = ("alpha beta gamma delta", "one two three four five", "red green blue white")
    rows = [(1, a), (9, a), (9, b), (12, b), (20, c), (20, ""), (30, ""), (40, c), (None, a)]
    got = minhash_dedup.near_duplicates(frame(spark, rows), 3, 85).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (9, 1), (12, 1), (20, 20), (30, 30), (40, 20), (None, None)}
    assert len(got) == len(rows)
    import corpus_pipeline
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, th string")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_deduplication(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (9, b), (20, c), (20, ""), (30, ""), (None, a)], key=str)


def test_clashing_names_in_line_stages(spark):
    names = ["_id", "_lines", "_units", "_pair", "_pairs", "_keys", "_repeated", "_places", "_chunks", "_hash", "_texts", "_gone",
             "n_left", "n_lines", "n_removed", "others", "th", "score", "quality_score", "h1", "wanted", "first"]
    text = "one line here\nand another\nthird one"
    docs = spark.createDataFrame([(1, text, *names), (2, text + "\nown end", *names)],
                                 "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    import corpus_pipeline
    from ledgerlight.llm import line_dedup
    for step in (corpus_pipeline.line_deduplication, corpus_pipeline.near_deduplication):
        out = step(spark, docs, "")
        assert out.columns == docs.columns
        assert all([r[n] for n in names] == names for r in out.collect()) and out.count()
    out = line_dedup.dedup_lines(docs)
    left = [n for n in names if n not in ("n_lines", "n_removed")]
    assert all([r[n] for n in left] == left for r in out.collect())


def test_sample_takes_one_row_of_an_id(spark):
    from ledgerlight.llm import quality
    docs = spark.createDataFrame([(3, f"text {i}") for i in range(3000)] + [(i, "other text") for i in range(4, 30)],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3, 30)], "doc_id bigint, quality int")
    chunks, known = quality.training_sample(docs, labels, per_label=50)
    assert len(known) <= 27
