"""Hard negatives, spelling variants and license scans against brute force on small tables with awkward rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewell.llm import hard_negatives, license_scan, queries, spelling_variants

DOCS = "doc_id bigint, text string, word string, key string, n int, label string, h bigint, score double"


def table(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


# -- hard negatives --------------------------------------------------------------------------
VECTORS = "vec_id bigint, embedding array<float>, label int, row bigint, v string, query int"


def vectors(n=400, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(9)]
    out = []
    for i in range(n):
        c = centres[rng.randrange(9)]
        v = [x + rng.gauss(0, 0.05 if i % 3 else 0.7) for x in c]
        out.append((i, v, rng.randrange(4) if i % 11 else None))
    out += [(n + i, out[50][1], 3) for i in range(60)]  # copies of an anchor
    out += [(n + 60 + i, out[50][1], 1) for i in range(40)]
    out += [(2000, None, 1), (2050, [1.0, None, 2.0, 0.0, 0.0, 0.0], 1), (2100, [float("nan")] * 6, 1), (2150, [float("inf")] * 6, 2)]
    out += [(2200, [], 1), (2250, [1.0, 2.0], 2), (2300, [0.0] * 6, 0), (2350, [0.5] * 9, 3), (None, [1.0] * 6, 1)]
    out += [out[100], out[100], out[57]]  # repeated rows
    return [(*r, 1, "v", 2) for r in out]


def brute_negatives(rows):
    import math

    sound = []
    for k, (i, v, label, *_) in enumerate(rows):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v32 = [float(np.float32(x)) for x in v]
        sound.append((k, i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v32]))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, i, label, v in sound:
        if i % 50:
            continue
        # Spark numbers equal rows as it reads them, so their order among themselves cannot be seen
        ranked = sorted(((-score(v, w), j, m, other) for m, j, other, w in sound if m != k), key=lambda t: t[:2])
        for p in [t for t in ranked if t[3] == label][:5]:
            ps = -p[0]
            fits = [t for t in ranked if t[3] != label and 50 * ps <= -100 * t[0] <= 95 * ps][:3]
            out += [(i, p[1], r + 1, t[1], ps, -t[0]) for r, t in enumerate(fits)]
    return sorted(out)


def test_hard_negatives_are_those_of_brute_force(spark, tmp_path, monkeypatch):
    rows = vectors()
    folder = table(spark, tmp_path, "embeddings", rows, VECTORS)
    for chunk, leaf, fanout in ((16_384, 256, 32), (64, 8, 3)):
        monkeypatch.setattr(hard_negatives, "CHUNK", chunk)
        monkeypatch.setattr(hard_negatives, "LEAF", leaf)
        monkeypatch.setattr(hard_negatives, "FANOUT", fanout)
        got = sorted(tuple(r) for r in queries.op11_hard_negatives(spark, folder).collect())
        assert got == brute_negatives(rows)
        assert len(got) > 50


def test_trees_bound_every_score_and_leave_out_far_nodes(monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    rng = np.random.default_rng(2)
    x = np.floor(256 * (np.repeat(rng.normal(size=(20, 8)), 40, axis=0) + 0.01 * rng.normal(size=(800, 8))))
    tree = hard_negatives.CoverTree(x)
    q = x[::37]
    top, bottom = tree.bounds(q, np.arange(len(tree.nodes)))
    for k, (first, last, _, _, _) in enumerate(tree.nodes):
        s = q @ x[tree.order[int(first) : int(last)]].T
        assert (s.max(axis=1) <= top[:, k]).all() and (s.min(axis=1) >= bottom[:, k]).all()
    low = np.sort(q @ x.T, axis=1)[:, -5].astype(float)
    query, _, _ = tree.reached(q, low, np.full(len(q), np.inf))
    leaves = (tree.nodes[:, 4] > 0).sum()
    assert len(query) < 0.5 * leaves * len(q)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [1e6] * 4, 1), (1, [1e6, 1e6, 1e6, 1e6 + 0.0625], 1), (2, [6e5, 6e5, 6e5, 6e5], 2), (3, [6e5, 6e5, 6e5, 6e5 + 0.0625], 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") == 0, scale=256).collect())
    v = {i: [int(256 * x) for x in e] for i, e, _ in rows}
    s = lambda a, b: sum(x * y for x, y in zip(v[a], v[b]))
    assert got == [(0, 1, 1, 3, s(0, 1), s(0, 3)), (0, 1, 2, 2, s(0, 1), s(0, 2))]


def test_mining_an_empty_table(spark):
    df = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(df, F.col("vec_id") % 50 == 0).collect() == []


# -- spelling variants -------------------------------------------------------------------------
def spelled():
    rng = random.Random(8)
    stems = ["because", "letters", "niño", "éàçêô", "variant", "anagram", "naagram", "corpora", "aaaaaa", "aaaaab", "abcde"]
    out = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = rng.choice(stems)
            if rng.random() < 0.25:
                k = rng.randrange(len(w) + 1)
                w = rng.choice([w[:k] + rng.choice("abzé") + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice("xyÀ") + w[k + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, rng.choice([" ", ", ", "\n", "9"]).join(words)))
    long = "q" * 3000
    out += [(1000, None), (1001, ""), (1002, "12 34"), (None, "because letters"), (1003, f"{long} {long} {long}x {long}x {long}x {long}"), out[5]]
    out += [(2000 + i, " ".join("".join(rng.choice("abc") for _ in range(6)) for _ in range(60))) for i in range(60)]
    return [(*r, "w", "k", 1, "l", 5, 0.5) for r in out]


def brute_variants(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    gaps = {}
    for w in words:
        for k in range(len(w)):
            gaps.setdefault(w[:k] + "\0" + w[k + 1 :], set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for k in range(len(w)):
            near[w] |= gaps[w[:k] + "\0" + w[k + 1 :]] - {w}
            shorter = w[:k] + w[k + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items()}


@pytest.mark.parametrize("cell_letters,leaf", [(400_000, 96), (900, 8)])
def test_variants_are_those_of_brute_force(spark, tmp_path, monkeypatch, cell_letters, leaf):
    monkeypatch.setattr(spelling_variants, "CELL_LETTERS", cell_letters)
    monkeypatch.setattr(spelling_variants, "LEAF", leaf)
    folder = table(spark, tmp_path, "documents", spelled(), DOCS)
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in queries.op12_spelling_variants(spark, folder).collect()}
    want = brute_variants(spelled())
    assert got == want
    assert sum(v[2] is not None for v in want.values()) > 20


def test_no_words(spark):
    assert spelling_variants.spelling_variants(spark.createDataFrame([], DOCS)).collect() == []


# -- license scans -------------------------------------------------------------------------------
def licensed():
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice("abcdelmnort") for _ in range(rng.randint(2, 8))) for _ in range(n))
    lines = [
        "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.", "Licensed by the GNU General Public License version 3",
        "Mozilla public terms", "under the mit licenses", "cc by nc cc by nc", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "you may not use this old file except in compliance with license", "UNDER THE MIT LICENSE",
    ]
    texts = [f"{prose(a)}{rng.choice([' ', chr(10), '... '])}{line}{rng.choice(['', '!', ' '])}{prose(b)}" for line in lines for a, b in ((0, 0), (0, 40), (37, 1), (500, 3))]
    texts += [None, "", "  ", "...", prose(3000) + " " + lines[0] + prose(2000), " ".join(lines), "mit license mit license under the"]
    rows = list(enumerate(texts))
    rows += [rows[0], (None, lines[3])]
    return [(*r, "w", "k", 1, "l", 5, 0.5) for r in rows]


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_licenses(text, step=16, percent=80):
    words = words_of(text)
    labels, score, places = set(), 0.0, []
    lead = 1 if text and re.match(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", text) else 0  # blocks count an empty first part
    for at in range(-lead, max(len(words), 1), step):
        block = set(words[max(at, 0) : max(at + 2 * step, 0)])
        for template, label in license_scan.TEMPLATES:
            t = set(template.split())
            share = len(block & t) / len(t)
            if 100 * len(block & t) >= percent * len(t):
                labels.add(label)
                score = max(score, share)
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        places += [(label, i) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(places), sorted(labels), 1.0 if places else score


def test_licenses_are_those_of_brute_force(spark):
    rows = licensed()
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = [
        (r["doc_id"], r["n_words"], [tuple(p) for p in r["places"]], r["template_labels"], r["score"]) for r in license_scan.scan_licenses(df).collect()
    ]
    want = [(i, *brute_licenses(t)) for i, t, *_ in rows]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert [(a, b, c, d, round(e, 9)) for a, b, c, d, e in sorted(got, key=key)] == [(a, b, c, d, round(e, 9)) for a, b, c, d, e in sorted(want, key=key)]
    assert {label for r in want for label in r[3]} >= {"mit", "apache-2", "cc-by-nc", "gpl-3"}


def test_licenses_with_hot_texts_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(license_scan, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, "Released under the MIT License.") for i in range(50)] + [(99, "nothing here"), (98, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["template_labels"], r["score"]) for r in license_scan.scan_licenses(df).collect()}
    assert got == {**{i: (["mit"], 1.0) for i in range(50)}, 99: ([], 0.0), 98: ([], 0.0)}


def test_licenses_of_nothing(spark):
    assert license_scan.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []
    df = spark.createDataFrame([(1, "cc by nc"), (2, "cc by")], "doc_id bigint, text string")
    got = {r["doc_id"]: (len(r["places"]), r["template_labels"], r["score"]) for r in license_scan.scan_licenses(df, templates=[]).collect()}
    assert got == {1: (1, [], 1.0), 2: (0, [], 0.0)}
