"""Filtering stages decide by row: repeated and missing ids lose no text and keep no contaminated one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import os

from framewell.llm import decontaminate, jaccard_join
from framewell.plans.settle import settle, shared_folder, working

SCHEMA = "doc_id bigint, text string, _key string, n int"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghik") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_keep_one_leaves_one_row_of_every_component(spark):
    rng = random.Random(1)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(5, a), (5, b), (3, b), (9, a + " z"), (None, c), (None, c), (None, "one two"), (7, None), (7, ""), (8, "one two"), (8, "one two")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA).repartition(3)
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(5, a), (3, b), (None, c), (7, None), (7, ""), (8, "one two")], key=repr)


def test_no_contaminated_row_stays_and_no_clean_one_goes(spark):
    rng = random.Random(2)
    item, clean = prose(rng, 30), prose(rng, 80)
    rows = [(1, clean), (1, f"x {item} y"), (None, item), (None, clean), (2, None), (3, item[:40])]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    items = spark.createDataFrame([("i", item)], "item_id string, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in decontaminate.clean_documents(df, items).collect()), key=repr)
    assert got == sorted([(1, clean), (None, clean), (2, None), (3, item[:40])], key=repr)


@pytest.mark.parametrize("size,extra", [(4, 1), (9, 2), (40, 8), (300, 60), (2000, 440)])
def test_sets_that_link_share_a_signature(size, extra):
    rng = np.random.default_rng(size)
    for trial in range(60):
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        drop = int(rng.integers(0, extra + 1))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, extra - drop, dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common) or common == len(a) == len(b):
            continue
        assert np.intersect1d(jaccard_join.signatures(a, 80), jaccard_join.signatures(b, 80)).size
        bits = int(np.bitwise_count((jaccard_join.sketch(a) ^ jaccard_join.sketch(b)).view(np.uint64)).sum())
        assert bits <= len(a) + len(b) - 2 * common


def test_a_scope_removes_what_is_not_kept(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with working() as scope:
        inner = settle(spark.range(5), "scratch")
        with working() as nested:
            settle(spark.range(3), "scratch")
            passed = nested.keep(inner.where("id > 1"), "passed")
        kept = scope.keep(passed.withColumn("x", F.lit(1)), "kept")
    left = set(os.listdir(folder)) - before
    assert [n.split("-")[0] for n in left] == ["kept"] and kept.count() == 3


def test_jaccard_leaves_only_its_result(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    rng = random.Random(4)
    base = prose(rng, 50)
    df = spark.createDataFrame([(i, f"{base} {i}" if i % 2 else prose(rng, 30)) for i in range(20)], "doc_id bigint, text string")
    jaccard_join.jaccard_classes(df).count()
    assert {n.split("-")[0] for n in set(os.listdir(folder)) - before} == {"jaccard"}


def test_pairs_travel_without_sketches(spark, monkeypatch):
    """Only pairs of a ``v`` whose sketch is not broadcast carry one through a shuffle; links are the same either way."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**62, 40)
    sets = [base] + [np.concatenate([base[: 40 - k % 9], rng.integers(0, 2**62, k % 9)]) for k in range(1, 40)]
    rows = [(i, len(s), jaccard_join.sketch(np.sort(s).astype(np.uint64)).tolist(), s.tolist()) for i, s in enumerate(sets)]
    table = spark.createDataFrame(rows, "node bigint, n_shingles bigint, sketch array<bigint>, elements array<bigint>")
    nodes, elements = table.select("node", "n_shingles", "sketch"), table.select("node", "elements")
    some = [(u, v) for v in (0, 1, 2) for u in range(3, 40)] + [(4, 3)]
    pairs = spark.createDataFrame(some, "u bigint, v bigint")
    links = lambda: sorted(tuple(r) for r in jaccard_join.verified(pairs, nodes, elements, 80).collect())
    want = sorted((u, v) for u, v in some if len(np.intersect1d(sets[u], sets[v])) * 100 >= 80 * len(np.union1d(sets[u], sets[v])))
    counts = spark.createDataFrame([(v, n) for v, n in ((0, 37), (1, 37), (2, 37), (3, 1))], "v bigint, n bigint")
    assert jaccard_join.broadcast_from(counts) == 1 and links() == want and 0 < len(want) < len(some)
    row = 8 * jaccard_join.SKETCH_WORDS + 64
    for room, least in ((3, 32), (2, 2**62)):
        monkeypatch.setattr(jaccard_join, "SKETCH_BYTES", room * row)
        assert jaccard_join.broadcast_from(counts) == least and links() == want
