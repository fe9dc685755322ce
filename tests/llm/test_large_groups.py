"""Members of large groups that cannot link are not compared with all others."""

import random

from framewell.llm import jaccard_join
from tests.llm.test_operators import brute_components, prose


def test_copies_with_too_many_changes_leave_large_groups(spark, monkeypatch):
    rng, data = random.Random(31), []
    base = prose(rng, 150).split()
    for i in range(160):  # a third near the base, the others with more changes than any link allows
        words = list(base)
        for at in rng.sample(range(150), rng.choice([0, 1, 2, 8, 9, 10])):
            words[at] = f"own{i}x{at}"
        data.append((i, " ".join(words)))
    seen = []
    monkeypatch.setattr(jaccard_join, "LARGE_GROUP", 2, raising=False)
    verified = jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    table = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    want = brute_components(data)
    assert sorted((tuple(r) for r in jaccard_join.jaccard_classes(table).collect()), key=repr) == want
    assert len({r[2] for r in want}) > 60
    assert 0 < sum(seen) < 400, seen  # all pairs: 12,720
