"""Decontamination, vector search, licence scan, quality network, chat format and the pipeline."""

from __future__ import annotations

import hashlib
import os
import random
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from brute import near_groups  # noqa: E402
from ledgerlight.llm import ann, chat_format, decontaminate, license_scan, quality  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op1_chat_format", "op6_line_dedup"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(cur.fetchall())


def test_chat_windows(spark):
    rng = random.Random(4)
    rows = []
    for c in range(12):
        for t in range(rng.randint(1, 30)):
            role = "system" if t == 0 and c % 2 else rng.choice(["user", "assistant", "tool/é\n"])
            text = "".join(rng.choice(["<|im_end|>", "\\", "</s>", "<", "[INST]", "word ", "é", "\n"]) for _ in range(rng.randint(0, 60)))
            rows.append((c, t, role, text, "x"))
    rows += [(50, 0, None, None, "x"), (51, None, "user", "same", "x"), (51, None, "user", "same", "x"),
             (52, 0, "system", "alone", "x"), (None, 0, "user", "no id", "x")]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, span string")
    windows = chat_format.format_windows(frame, budget=100, history_tokens=30)
    want = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=key):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    for r in chat_format.digest(windows).collect():
        turns = want.pop(r.conv_id)
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert not want
    for w in windows.filter("conv_id < 12").collect():
        n = w.text.count(chat_format.END)
        assert w.text.startswith(chat_format.START) and w.n_repeated < n
    assert chat_format.digest(chat_format.format_windows(frame.limit(0))).count() == 0
    assert "Python" not in windows._jdf.queryExecution().toString()


ITEMS = [(1, "Which river runs past the old mill near Tarn? The slow green river Olm runs past it."),
         (2, "Name the third moon of Varda as listed by sailors. They called the third moon Ishka."), (3, None), (4, "")]


def test_decontamination(spark):
    rng = random.Random(2)
    noise = [" ".join(rng.choice(["river", "the", "moon", "of", "stone", "old", "walks", "green"]) for _ in range(300)) for _ in range(20)]
    texts = [(i, t) for i, t in enumerate(noise)]
    texts += [(100, noise[0] + " " + ITEMS[0][1].upper() + " " + noise[1]), (101, ITEMS[1][1].replace(".", " !!")),
              (102, noise[2] + " Which river runs past the old mill near Tarn? " + noise[3]), (103, None), (104, "")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(100, 1), (101, 2)}
    kept = {r.doc_id for r in decontaminate.clean(docs, items).collect()}
    assert kept == {i for i, _ in texts} - {100, 101}
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def test_decontamination_of_cut_and_edited_items(spark):
    question = "Long ago the keeper of the northern light wrote down every ship that passed the stony cape in winter."
    item = [(1, question + " Seven. Yes."), (2, "Count all grey herons between both weirs before sunrise every spring morning. Nearly forty herons nest there."),
            (3, "Which baker sold warm rye loaves beside the chapel gate on market days? Old Marten did.")]
    words = [t.split() for _, t in item]
    texts = {(100 + n): (n, " ".join(w[:cut])) for n, w, cut in ((1, words[0], -1), (2, words[1], -5), (3, words[2], -3))}
    for n, w in enumerate(words, 1):
        for p in range(len(w)):
            texts[1000 * n + p] = (n, " ".join([*w[:p], "changedword", *w[p + 1:]]))
    rest = " ".join(f"filler{i}" for i in range(90))
    docs = spark.createDataFrame([(i, f"{rest} {t} {rest}") for i, (_, t) in texts.items()] + [(1, rest), (2, f"{rest} Seven. Yes. {rest}")],
                                 "doc_id bigint, text string")
    items = spark.createDataFrame(item, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(i, n) for i, (n, _) in texts.items()}


def test_block_max_wand_finds_all_above_threshold():
    rng = random.Random(8)
    vocab = [f"t{i}" for i in range(60)]
    index = decontaminate.Index([(i, " ".join(rng.choices(vocab, k=rng.randint(3, 20)))) for i in range(150)], 0.3)
    for _ in range(60):
        terms = np.unique([rng.randrange(len(index.terms)) for _ in range(rng.randint(1, 25))])
        score = np.zeros(len(index.ids))
        for t in terms:
            a, b = index.start[t], index.start[t + 1]
            score[index.items[a:b]] += index.weight[a:b]
        assert sorted(i for i, _ in index.search(terms)) == np.flatnonzero(score >= 0.3 - 1e-9).tolist()


def test_vector_search(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    x = centres[rng.integers(0, 30, 4000)] + 0.4 * rng.normal(size=(4000, 16))
    x[1000:1900] = x[40]  # a third of copies
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    rows += [(5000, None, 0), (5020, [0.0] * 16, 0), (5040, [float("nan")] * 16, 0), (5060, [1.0] * 3, 0), (5080, [None] * 16, 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, part int")
    got = {}
    for r in ann.search(frame, every=20, k=20).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 4000, 20))
    hit = 0
    for q, found in got.items():
        score = (x * x[q]).sum(axis=1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(4000), -score))[:20]
        hit += len(set(best.tolist()) & {v for v, _ in found.values()})
        assert sorted(found) == list(range(1, 21))
        assert all(np.isclose(s, score[v]) for v, s in found.values())
    assert hit / (20 * len(got)) >= 0.9
    assert found and ann.search(frame.limit(0)).count() == 0
    few = ann.search(frame.filter("vec_id < 3")).collect()
    assert sorted((r["rank"]) for r in few) == [1, 2]


def _best(ids, x, q, k):
    """The ``k`` best other ids of id ``q`` at the vector ``x[q's first row]``, each at its best row."""
    score = (x * x[ids.index(q)]).sum(axis=1)
    best = {}
    for i, s in zip(ids, score):
        if i != q:
            best[i] = max(best.get(i, -np.inf), s)
    return sorted(best, key=lambda i: (-best[i], i))[:k]


@pytest.mark.parametrize("n", [1, 2, 21, 79, 100, 500, 2000])
def test_router_at_any_size(n):
    x = np.random.default_rng(n).normal(size=(n, 8))
    router, probes = ann.fit_router(x, n)
    assert router.parts == max(1, min(16, n // 40)) and 1 <= probes <= router.parts
    graph, ranked = ann.neighbour_graph(x, 20), router.ranked(x)
    found = (ranked[:, None, :probes] == ranked[:, 0][graph][:, :, None]).any(axis=2)
    assert found.size == 0 or found.mean() >= 0.9


def test_vector_search_in_small_tables(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 7)  # several blocks of vectors and of queries in each part
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 16))[rng.integers(0, 12, 600)] + 0.3 * rng.normal(size=(600, 16))
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id bigint, embedding array<double>")
    hits = {}
    for r in ann.search(frame, every=5, k=20).collect():
        hits.setdefault(r.query_id, []).append(r.vec_id)
    assert set(hits) == set(range(0, 600, 5)) and {len(set(v)) for v in hits.values()} == {20}
    true = {q: set(_best(list(range(600)), x, q, 20)) for q in hits}
    assert sum(len(true[q] & set(v)) for q, v in hits.items()) >= 0.9 * 20 * len(hits)


@pytest.mark.parametrize("block", [4096, 8])
def test_repeated_ids_hide_no_answers(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, 4)).round(1)
    ids = list(range(30)) + [20] * 50 + [0] * 40 + [7] * 30  # copies of a row, and rows of one id that differ
    x = np.vstack([x, np.repeat(x[20:21], 50, axis=0), np.repeat(x[:1], 40, axis=0), rng.normal(size=(30, 4)).round(1)])
    # fewer than 80 distinct vectors make one part, so the search is exact
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in zip(ids, x)], "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.search(frame, every=20, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: _best(ids, x, q, 20) for q in (0, 20)}


def test_license_scan(spark):
    texts = [(1, "intro text here\nReleased under the MIT License.\nmore words"), (2, "All rights reserved."), (3, None), (4, ""),
             (5, "the general public may visit the library under the old bridge"), (6, "a\nLicensed under CC BY-NC 4.0!\n\nend")]
    texts += [(10 + i, "plain words number %d without any notice at all" % i) for i in range(50)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id bigint, text string, family string")
    got = {(r.doc_id, r.paragraph, r.family) for r in license_scan.scan(docs).collect()}
    assert got == {(1, 0, "mit"), (2, 0, "proprietary"), (6, 0, "cc-by-nc")}
    assert license_scan.scan(docs.limit(0)).count() == 0


def _license_model(n=600, seed=6):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 8))) for _ in range(800)]
    vocabulary += "the of under a to and is version general public software work copy license library terms for".split()
    plain = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    return license_scan.fit([plain(rng.randint(4, 64)) for _ in range(n)]), plain


def _found(model, texts):
    return sorted((d, p, f) for d, p, f, _, _ in license_scan.scan_column(model, pa.array(texts, pa.string())))


def test_wrapped_commented_and_inline_notices():
    model, plain = _license_model()
    gpl = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public "
           "License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.")
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
           "documentation files, to deal\nin the Software without restriction")
    mark = lambda text, sign: "\n".join(f"{sign} {line}" for line in text.split("\n"))
    texts = [gpl, mit, mark(gpl, "#"), mark(mit, " *"), plain(60) + " Released under the MIT License. " + plain(60),
             "x\n \t\n" + plain(30) + "\n\n\n" + mark(gpl, "//") + "\n#\n" + plain(20), None, "", " \n\n ",
             plain(25) + "\nLicensed under the Apache\nLicense, Version 2.0.\n" + plain(9) + "\nLicensed under CC BY-SA 4.0.\n" + plain(25),
             plain(5000), plain(3000) + " All rights reserved. " + plain(3000)]
    got = _found(model, texts)
    assert got == [(0, 0, "gpl-3.0"), (1, 0, "mit"), (2, 0, "gpl-3.0"), (3, 0, "mit"), (4, 0, "mit"), (5, 2, "gpl-3.0"),
                   (9, 0, "apache-2.0"), (9, 0, "cc-by-sa"), (11, 0, "proprietary")]


def test_every_notice_at_any_place_in_a_text():
    model, plain = _license_model()
    rng = random.Random(8)
    texts, want = [], []
    for family, notices in license_scan.TEMPLATES.items():
        for notice in notices:
            for _ in range(4):
                lines = plain(rng.randint(0, 90)).split() + notice.split() + plain(rng.randint(0, 90)).split()
                texts.append("".join(w + rng.choice("      \n") for w in lines))
                want.append(family)
    clean = [plain(rng.randint(1, 200)) for _ in range(200)]
    got = _found(model, texts + clean)
    assert not [g for g in got if g[0] >= len(texts)]
    families = {d: f for d, _, f in got}
    assert sum(families.get(d) == f for d, f in enumerate(want)) >= 0.97 * len(want)


def test_short_notices_between_other_lines():
    model, plain = _license_model()
    rng = random.Random(9)
    texts = ["\n".join([plain(rng.randint(1, 12)), "All rights reserved.", plain(rng.randint(1, 12))]) for _ in range(200)]
    assert _found(model, texts) == [(d, 0, "proprietary") for d in range(200)]


def test_window_scores_equal_brute_force(monkeypatch):
    model, plain = _license_model(100)
    monkeypatch.setattr(license_scan, "SPAN", 37)
    text = plain(150) + "\n\n" + plain(3) + "\n\nword\n\n" + plain(49)
    data = np.frombuffer(text.encode(), np.uint8)
    heads, doc, number = license_scan.paragraphs(data, np.array([0, len(data)]))
    assert number.tolist() == [0, 1, 2, 3] and set(doc) == {0}
    words, first = license_scan._words(data, np.append(heads, len(data)))
    starts, ends, owner = license_scan.windows(first)
    z = license_scan.logits(model, words, starts, ends)
    tokens = text.split()
    for k, (s, e) in enumerate(zip(starts, ends)):
        part = np.frombuffer(" ".join(tokens[s:e]).encode(), np.uint8)
        feats, offs = license_scan.features(part, np.array([0, len(part)]))
        want = model["weights"][feats].astype(float).sum(0) / np.sqrt(len(feats)) + model["bias"]
        assert np.allclose(z[k], want, atol=1e-3)
    for b in range(4):  # every word is covered at every scale, and short paragraphs are one window a scale
        for scale in license_scan.SCALES:
            size = first[b + 1] - first[b]
            mine = [(s, e) for s, e, o in zip(starts, ends, owner) if o == b and e - s == min(scale, size)]
            assert (first[b], first[b] + min(scale, size)) in mine


@pytest.fixture(scope="module")
def scored(spark):
    return entry.queries()["op10_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()


def test_quality_on_held_out_rows(spark, scored):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().merge(scored, on="doc_id")
    held = labels[labels.held_out]
    assert len(scored) == 1000 and scored.score.between(0, 1).all()
    assert (held.quality == held.predicted).mean() >= 0.93


def test_quality_reads_whole_texts_and_edges(spark):
    assert quality.chunk_starts(0).tolist() == [0] and quality.chunk_starts(401).tolist() == [0, 384]
    good = ["The plain old words of this calm text go on. " * n for n in range(1, 40)]
    bad = ["!!## @@ %% " * n for n in range(8, 47)]

    def cut(text):
        starts = quality.chunk_starts(len(text))
        stops = np.full(len(starts), len(text))
        return [c.tobytes() for c in quality.chunk_matrix(np.frombuffer(text.encode(), np.uint8), starts, stops)]

    chunks = [cut(t) for t in good + bad]
    model = quality.fit(chunks, [1] * len(good) + [0] * len(bad), epochs=4)
    score = quality.score_column(model, pa.array([good[20], bad[20], None, "", good[3] * 200 + bad[5]]))
    assert score[0] > 0.5 > score[1] and score[2] == score[3]
    assert quality.fit([[b"\0" * quality.CHUNK]], [1]) is None
    docs = spark.createDataFrame([(None, None, 1.0)], "doc_id bigint, text string, score double")
    assert quality.score_documents(docs, None).first().score == 0.5


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        after = step(spark, docs, SF)
        assert after.columns == columns
        rows = {r.doc_id: r for r in after.collect()}
        assert set(rows) <= set(before)
        if name == "minhash_near_dedup":
            groups = near_groups([(i, r.text) for i, r in before.items()], 5, 80)
            assert set(rows) == {i for i, (_, top) in groups.items() if i == top}
        if name != "line_dedup":
            assert all(rows[i] == before[i] for i in rows)
        docs = spark.createDataFrame(list(rows.values()), docs.schema)
    pieces = corpus_pipeline.run(spark, SF).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("offset")).collect()
    assert pieces and max(r.n for r in pieces) <= 1024


def test_pipeline_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = empty
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        assert docs.count() == 0
        docs = empty


def test_scores_do_not_depend_on_shards(spark, monkeypatch):
    rng = random.Random(12)
    vocabulary = ["w%d" % i for i in range(120)]
    some = lambda k: " ".join(rng.choices(vocabulary, range(120, 0, -1), k=k))
    tests = [(i, some(rng.randint(6, 50)) + ". " + some(rng.randint(1, 12))) for i in range(60)]
    tests += [(60, None), (61, ""), (None, some(20)), (5, some(30)), (62, some(300))]
    rows = [(i, some(rng.randint(0, 90)) + " " + (rng.choice(tests)[1] or "") + " " + some(rng.randint(0, 90)), "x") for i in range(150)]
    items = spark.createDataFrame(tests, "item_id bigint, text string")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string")

    def found():
        got = decontaminate.contaminated(docs, items).collect()
        kept = sorted(r.doc_id for r in decontaminate.clean(docs, items).collect())
        return {(r.doc_id, r.item_id, r.n_passages, r.first_word): (r.score, r.question_share, r.answer_share) for r in got}, kept

    whole, kept = found()
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 20)
    assert len(list(decontaminate._indexes(items, 0.5))) > 4
    parts, kept_by_parts = found()
    assert len(whole) > 100 and set(whole) == set(parts) and kept == kept_by_parts
    assert all(np.allclose(whole[k], parts[k], atol=1e-9) for k in whole)
