"""Members that a hub left open are compared only where their differences from it can meet."""

import random

from framewell.llm import jaccard_join
from tests.llm.test_operators import brute_components, prose


def test_copies_with_changes_of_their_own_are_not_compared_with_each_other(spark, monkeypatch):
    rng, data = random.Random(41), []
    base = prose(rng, 90).split()
    for i in range(150):  # one change links with the base; two changes, made in other copies too, do not link
        words = list(base)
        for at in rng.sample(range(5, 85), 0 if i == 0 else 1 if i < 20 else 2):
            words[at] = f"own{i}x{at}"
        data.append((i, " ".join(words)))
    for i in range(10):  # these share both changes with another
        words = data[100 + i][1].split()
        words[2] = f"more{i}"
        data.append((500 + i, " ".join(words)))
    seen = []
    monkeypatch.setattr(jaccard_join, "CROWD", 2, raising=False)
    verified = jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    table = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    want = brute_components(data)
    assert sorted((tuple(r) for r in jaccard_join.jaccard_classes(table).collect()), key=repr) == want
    components = [r[2] for r in want]
    assert len(set(components)) > 60 and sum(components.count(c) == 2 for c in set(components)) >= 5
    assert 0 < sum(seen) < 1500, seen  # all pairs: 12,720
