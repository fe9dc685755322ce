"""Spans and later rows against plain Python."""

import random

import numpy as np
import pytest

from framewell.llm import sentence_spans
from framewell.llm.repeats import later_rows
from framewell.plans.settle import settle


@pytest.mark.parametrize("partitions", ["1", "23"])
def test_later_rows_are_all_but_those_of_the_first_document(spark, partitions):
    rng = random.Random(int(partitions))
    rows = [(rng.choice([1, 1, 1, 2, rng.randint(3, 60)]), 5, rng.choice([None, *range(40)]), rng.randint(0, 2), i) for i in range(3000)]
    table = spark.createDataFrame(rows, "h1 bigint, h2 int, doc_id bigint, _text bigint, a int")
    who = lambda r: (r[2] is None, r[2] or 0, r[3] if r[2] is None else 0)
    first = {}
    for r in rows:
        first[r[0]] = min(first.get(r[0], who(r)), who(r))
    want = sorted(r[4] for r in rows if who(r) != first[r[0]])
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], partitions)
        spark.conf.set(names[1], "false")
        got = sorted(r["a"] for r in later_rows(settle(table, "t"), ["h1", "h2"], ["a"]).collect())
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)
    assert got == want and len(got) > 1000


def test_spans_are_the_shortest_from_and_up_to_each_piece():
    rng = random.Random(2)
    for n in [0, 1, 2, 3, 5, 40]:
        sizes = [rng.randint(1, 16) for _ in range(n)]
        ok = lambda a, b: 0 <= a <= b < n and b - a + 1 >= 3 and sum(sizes[a : b + 1]) >= 24  # noqa: E731, B023
        want = sorted((a, b) for a in range(n) for b in range(n) if ok(a, b) and (not ok(a, b - 1) or not ok(a + 1, b)))
        a, b = sentence_spans.spans_of(np.array(sizes, np.int64), 3, 24)
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_hashes_of_runs_depend_on_their_content_alone():
    values = np.random.default_rng(1).integers(0, 2**63, 50, dtype=np.uint64)
    twice = np.concatenate([values, values[::-1], values])
    powers = sentence_spans.Powers(sentence_spans.BASES[0])
    one = powers.of_runs(twice, np.arange(0, 47), np.arange(3, 50))
    assert np.array_equal(one, powers.of_runs(twice, np.arange(100, 147), np.arange(103, 150)))
    assert len(set(one.tolist()) | set(powers.of_runs(twice, np.arange(50, 97), np.arange(53, 100)).tolist())) == 94


def test_passages_of_documents_without_id_are_found_and_extreme_tables_work(spark):
    rng = random.Random(8)
    said = lambda n: " ".join(f"w{rng.randint(0, 10**6)} x{rng.randint(0, 99)} y z." for _ in range(n))
    passage = said(15)
    texts = [(None, said(2) + " " + passage), (None, passage + " " + said(2)), (None, None), (4, ""), (5, said(4000)), (4, "")]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id bigint, text string, begins string, a int")
    got = sentence_spans.remove_repeated(table).collect()
    assert len(got) == 6
    assert sorted(r["n_removed"] for r in got) == [0, 0, 0, 0, 0, 15]
    assert [r["text"] for r in got if r["doc_id"] == 5] == [texts[4][1]]
    nothing = sentence_spans.remove_repeated(table.where("doc_id = 4"))
    assert [tuple(r)[1:] for r in nothing.collect()] == [(0, 0, 0, "")] * 2
