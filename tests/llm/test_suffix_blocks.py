"""Repeats of passages that begin and end anywhere, and how many runs are sorted for them."""

import random

from framewell.llm import suffix_dedup
from tests.llm.test_operators import prose


def brute(out):
    seen, want = {}, {}
    for doc, text in out:
        words = text.encode().split()
        runs = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
        covered = set()
        for i, run in enumerate(runs):
            if run in seen:
                covered.update(range(i, i + 50))
            seen.setdefault(run, doc)
        want[doc] = len(covered)
    return want


def test_short_passages_are_found_whole_between_any_neighbours(spark):
    rng, out = random.Random(41), []
    for k in range(60):
        passage = prose(rng, rng.randint(50, 58))
        out += [(10 * k + j, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for j in range(2)]
    table = spark.createDataFrame(out, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeated(table).collect()}
    want = brute(out)
    assert got == want and sum(map(bool, want.values())) == 60


def test_only_runs_at_the_ends_of_passages_are_sorted_one_by_one(spark, monkeypatch):
    rng, seen = random.Random(42), []
    passage = prose(rng, 400)
    out = [(i, f"{prose(rng, 60)} {passage} {prose(rng, 60)}") for i in range(30)] + [(100 + i, passage) for i in range(5)]
    later = suffix_dedup.later_places
    monkeypatch.setattr(suffix_dedup, "later_places", lambda windows, kind: seen.append(windows.count()) or later(windows, kind))
    table = spark.createDataFrame(out, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeated(table).collect()}
    assert got == brute(out)
    assert 0 < sum(seen) < 3000, seen  # every run around a shared seed: more than 10,000
