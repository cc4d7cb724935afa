"""Licence notices in paragraphs: a trained classifier, confirmed by comparison with templates.

Paragraphs are blocks of lines between blank lines, their lines joined, so a notice may be
wrapped, commented out or lie inside a long line.  Words are normalised (ASCII case and
punctuation dropped, so comment marks vanish).  Each paragraph is cut into overlapping word
windows of every length in ``SCALES``, one every quarter of the length; a paragraph shorter
than that is one window.  A notice of up to three quarters of the longest length lies whole in some window.
Features are the hashed word one- and two-grams of a window.  A softmax
regression over these sparse features tells licence families from an unknown class; as it is
linear, running sums of the weights give the scores of all windows.  It is
trained on variants of the templates below (words dropped, changed or added) and on
a bounded sample of corpus paragraphs as unknown (``NEGATIVES`` distinct ones, those with the
smallest hashes, of each ``EXCERPT`` words at a place given by its hash, without ones like a
template).  A temperature, fitted on the held-out third of the training rows, calibrates the
probabilities.

A window counts when a family is most probable with at least ``LEAST`` and the
window holds at least ``CONFIRM`` of the word bigrams of a template of that family.  Where
windows of different families meet on the same words, the one most like its template counts.
A paragraph gives one row for each family found in it, with its best window's figures.
All windows of all paragraphs of all documents are scored.  Null or empty texts have no notices;
rows that share a doc_id are reported separately; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.decontaminate import _words
from ledgerlight.llm.stage import share_package, smallest_keys
from ledgerlight.llm.text_arrays import mix, utf8_buffer

# licence families and short notices; fixed values
TEMPLATES = {
    "mit": ["Released under the MIT License.", "Licensed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is distributed under the terms of the GNU Lesser General Public License"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "bsd": ["Released under the BSD 3-Clause License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "cc-by": ["Licensed under CC BY 4.0.", "Licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc0": ["Released into the public domain under CC0 1.0.", "CC0 1.0 Universal Public Domain Dedication"],
    "proprietary": ["All rights reserved.", "Copyright holder. All rights reserved. Reproduction prohibited without permission."],
}
FAMILIES = ["unknown", *TEMPLATES]
BITS = 15
NEGATIVES, VARIANTS = 3000, 40
EXCERPT = 64
LEAST, CONFIRM = 0.5, 0.7
PARTLY = 0.5  # sampled paragraphs that hold so much of a template are not used as unknown
SCALES = (4, 8, 16, 32, 48)
SPAN = 1 << 16  # words whose running sums are held at once
GROUP_BYTES = 1 << 20
_U = np.uint64


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def paragraphs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the paragraphs of all texts, and for each its document and number there.

    What lies between a paragraph's end and the next one's start is white space.
    """
    cuts = np.flatnonzero(data == 0x0A) + 1
    bounds = np.unique(np.concatenate([offsets, cuts]))
    ink = np.concatenate([[0], np.cumsum(~_SPACE[data])])
    filled = np.diff(ink[bounds]) > 0
    doc = np.searchsorted(offsets, bounds[:-1], side="right") - 1
    joined = np.zeros(len(filled), bool)
    joined[1:] = filled[:-1] & (doc[1:] == doc[:-1])
    heads = np.flatnonzero(filled & ~joined)
    doc = doc[heads]
    return bounds[:-1][heads], doc, np.arange(len(doc)) - np.searchsorted(doc, doc)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end word and paragraph of every window; ``first`` holds the first word of each paragraph."""
    size = np.diff(first)
    starts, ends, owners = [], [], []
    for scale in SCALES:
        step = scale // 4
        n = np.where(size > 0, 1 + np.maximum(0, -(-(size - scale) // step)), 0)
        owner = np.repeat(np.arange(len(size)), n)
        begin = first[owner] + step * (np.arange(len(owner)) - (np.cumsum(n) - n)[owner])
        starts.append(begin)
        ends.append(np.minimum(begin + scale, first[owner + 1]))
        owners.append(owner)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(owners)


def grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the words, and of each word with the next one."""
    mask = _U((1 << BITS) - 1)
    return (words & mask).astype(np.int64), (mix(words[:-1] * _U(3) + words[1:]) & mask).astype(np.int64)


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of consecutive texts, and offsets per text."""
    words, first = _words(data, bounds)
    one, two = grams(words)
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    pair = of[1:] == of[:-1]
    owner = np.concatenate([of, of[:-1][pair]])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([one, two[pair]])[order], np.searchsorted(owner[order], np.arange(len(bounds)))


def logits(model: dict, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Scores of the windows [start, end) of ``words``, from running sums over stretches of ``SPAN`` words."""
    out = np.empty((len(starts), len(FAMILIES)), np.float32)
    order = np.argsort(starts, kind="stable")
    at = np.searchsorted(starts[order], np.arange(0, len(words) + SPAN, SPAN))
    for k in range(len(at) - 1):
        mine = order[at[k]:at[k + 1]]
        if len(mine) == 0:
            continue
        low = k * SPAN
        one, two = grams(words[low:low + SPAN + max(SCALES)])
        sums = np.zeros((len(one) + 1, len(FAMILIES)))
        pairs = np.zeros((len(one), len(FAMILIES)), np.float32)
        pairs[:-1] = model["weights"][two]
        np.cumsum(model["weights"][one] + pairs, axis=0, dtype=np.float64, out=sums[1:])
        s, e = starts[mine] - low, ends[mine] - low
        out[mine] = (sums[e] - sums[s] - pairs[e - 1]) / np.sqrt(2 * (e - s) - 1)[:, None] + model["bias"]
    return out


def probabilities(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _bigrams(text: str) -> set:
    raw = np.frombuffer(text.encode(), np.uint8)
    words = _words(raw, np.array([0, len(raw)]))[0].tolist()
    return set(zip(words, words[1:]))


_TEMPLATE_GRAMS = {f: [_bigrams(t) for t in ts] for f, ts in TEMPLATES.items()}


def similarity(family: str, text: str) -> float:
    """Largest share of a template's word bigrams that the text holds."""
    own = _bigrams(text)
    return max((len(g & own) / len(g) for g in _TEMPLATE_GRAMS.get(family, []) if g), default=0.0)


def likeness(family: str, words: list) -> tuple[float, int, int]:
    """Largest share of a template's bigrams among ``words``, and the stretch of words that holds them."""
    best = (0.0, 0, 0)
    own = list(zip(words, words[1:]))
    for template in _TEMPLATE_GRAMS[family]:
        at = [i for i, gram in enumerate(own) if gram in template]
        share = len({own[i] for i in at}) / len(template)
        if share > best[0]:
            best = (share, at[0], at[-1] + 2)
    return best


def fit(negatives: list[str], seed: int = 3, steps: int = 300) -> dict:
    """Softmax regression by Adam; the temperature comes from rows not trained on."""
    rng = np.random.default_rng(seed)
    negatives = [t for t in negatives if max(similarity(f, t) for f in TEMPLATES) < PARTLY]
    filler = [w for t in negatives[:300] for w in t.split()] or ["text"]
    texts = [" ".join(t.split()[:rng.choice(SCALES)]) for t in negatives]
    labels = [0] * len(texts)
    for f, family in enumerate(TEMPLATES, 1):
        for template in TEMPLATES[family]:
            for v in range(VARIANTS):
                words = [w for w in template.split() if v == 0 or rng.random() > 0.06]
                if v % 2:
                    words = [*rng.choice(filler, rng.integers(0, 6)), *words, *rng.choice(filler, rng.integers(0, 6))]
                texts.append(" ".join(map(str, words)))
                labels.append(f)
    for _ in range(200):  # loose words of templates are no notice
        words = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
        texts.append(" ".join(map(str, [*rng.choice(words, 2), *rng.choice(filler, 12)])))
        labels.append(0)
    data, offsets = utf8_buffer(pa.array(texts, pa.string()))
    feats, offs = features(data, offsets)
    y = np.array(labels)
    held = rng.random(len(y)) < 1 / 3
    row = np.repeat(np.arange(len(y)), np.diff(offs))
    value = (1 / np.sqrt(np.maximum(np.diff(offs), 1)))[row]
    used, column = np.unique(feats, return_inverse=True)
    k = len(FAMILIES)
    w, b = np.zeros((len(used), k)), np.zeros(k)
    m, v = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    onehot = np.eye(k)[y]
    weight = np.where(held, 0, 1.0)
    for t in range(1, steps + 1):
        z = np.stack([np.bincount(row, value * w[column, j], len(y)) for j in range(k)], axis=1) + b
        d = (probabilities(z) - onehot) * weight[:, None] / weight.sum()
        g = np.stack([np.bincount(column, value * d[row, j], len(used)) for j in range(k)], axis=1) + 1e-6 * w
        for i, (a, grad) in enumerate(((w, g), (b, d.sum(0)))):
            m[i] += 0.1 * (grad - m[i])
            v[i] += 0.01 * (grad * grad - v[i])
            a -= 0.1 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
    z = np.stack([np.bincount(row, value * w[column, j], len(y)) for j in range(k)], axis=1) + b
    heats = np.geomspace(0.25, 4, 33)
    loss = [-np.log(probabilities(z[held] / t)[np.arange(held.sum()), y[held]] + 1e-12).mean() for t in heats]
    heat = float(heats[int(np.argmin(loss))]) if held.any() else 1.0
    weights = np.zeros((1 << BITS, k), np.float32)
    weights[used] = w / heat
    return {"weights": weights, "bias": (b / heat).astype(np.float32)}


def scan_column(model: dict, column: pa.Array) -> Iterator[tuple[int, int, str, float, float]]:
    """(document, paragraph, family, probability, similarity) of confirmed notices."""
    data, offsets = utf8_buffer(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + GROUP_BYTES, side="right")) - 1)
        part = data[offsets[i]:offsets[j]]
        heads, doc, number = paragraphs(part, offsets[i:j + 1] - offsets[i])
        if len(heads):
            words, first = _words(part, np.concatenate([[0], heads[1:], [len(part)]]))
            starts, ends, owner = windows(first)
            z = logits(model, words, starts, ends)
            likely = np.flatnonzero(z.argmax(axis=1) > 0)
            p = probabilities(z[likely])
            sure = p.max(axis=1) >= LEAST
            hits: dict[int, list] = {}
            for r, q in zip(likely[sure], p[sure]):
                family = FAMILIES[q.argmax()]
                share, a, b = likeness(family, words[starts[r]:ends[r]].tolist())
                if share >= CONFIRM:
                    a, b = int(starts[r]) + a, int(starts[r]) + b
                    hits.setdefault(int(owner[r]), []).append((-share, b - a, -float(q.max()), a, b, family))
            for block in sorted(hits):
                for family, share, probability in chosen(hits[block]):
                    yield i + int(doc[block]), int(number[block]), family, probability, share
        i = j


def chosen(hits: list) -> list[tuple[str, float, float]]:
    """The families of a paragraph's hits, where stretches of different families meet only the most alike one."""
    kept: dict[int, str] = {}  # word -> family that holds it
    out: dict[str, tuple[float, float]] = {}
    for share, _, probability, a, b, family in sorted(hits):
        if all(kept.get(w, family) == family for w in range(a, b)):
            kept.update(dict.fromkeys(range(a, b), family))
            out.setdefault(family, (-share, -probability))
    return [(family, *figures) for family, figures in sorted(out.items())]


def fit_licenses(docs: DataFrame, negatives: int = NEGATIVES) -> dict:
    """The model, with excerpts of a bounded sample of corpus paragraphs as unknown."""
    blocks = F.split("text", r"\n[ \t\r\f\x0B]*\n")
    count = docs.agg(F.sum(F.size(blocks)).alias("n")).first().n or 0
    rows = (docs.select(F.explode(blocks).alias("block")).filter(F.length(F.trim("block")) > 0)
            .select("block", F.xxhash64("block").alias("key")))
    words = F.split("block", r"\s+")
    at = F.pmod("key", F.greatest(F.size(words) - EXCERPT + 1, F.lit(1))) + 1
    text = F.array_join(F.slice(words, at.cast("int"), EXCERPT), " ")
    rows = rows.select("key", F.substring(text, 1, 2000).alias("excerpt"))  # a bound on words of any length
    rows = smallest_keys(rows, "key", count, negatives)
    return fit([r.excerpt for r in rows])


def scan(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, paragraph, family, probability, similarity of each licence notice in ``docs``."""
    share_package(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model or fit_licenses(texts))  # about 2 MB, fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = list(scan_column(shared.value, batch.column("text")))
            cols = list(zip(*got)) if got else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.float64())],
                ["doc_id", "paragraph", "family", "probability", "similarity"])

    return texts.mapInArrow(run, "doc_id bigint, paragraph int, family string, probability double, similarity double")
