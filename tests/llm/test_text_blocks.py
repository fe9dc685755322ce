"""Texts are hashed in blocks, with the sets and signatures of single texts."""

import random

import numpy as np

from framewell.llm import jaccard_join
from tests.llm.test_operators import prose


def test_sets_of_blocks_are_those_of_single_texts():
    rng = random.Random(3)
    texts = ["", "  \t", "a", "A b", "x" * 70 + " y Z\x0bq r s " + "x" * 70, "\x00 \x00\x00 a\x00 a", "É é   ñ\x85 k", "w " * 300, "a" * 8 + " " + "a" * 16 + " q w e"]
    texts += [prose(rng, rng.randrange(12)) for _ in range(200)] + ["ab " * 7 + "x" * 64, "AB " * 7 + "x" * 64, "ab " * 7 + "x" * 65]
    texts += [f"one two three four {word}" for word in ("a" * 63, "a" * 64, "a" * 65, "a" * 64 + "b", "a" * 64 + "c", "a\x00", "a")]
    data = [t.encode() for t in texts]
    plain = []
    for t in data:
        words = t.lower().split()
        size = min(5, len(words))
        plain.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    for sets in (jaccard_join.shingle_sets(data, 5), [jaccard_join.shingle_sets([t], 5)[0] for t in data]):
        assert [len(s) for s in sets] == [len(p) for p in plain]
        for i in range(len(data)):
            for j in range(i):
                assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])
    sent, sizes = jaccard_join.signatures_of(sets, 80)
    alone = [jaccard_join.signatures(s, 80) for s in sets]
    assert list(sizes) == [len(a) for a in alone] and np.array_equal(sent, np.concatenate(alone))
