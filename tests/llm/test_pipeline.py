"""The whole pipeline against plain Python, and the mixture of the packed stream."""

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from framewell.llm import packing


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def near(a, b):
    a, b = shingles(a), shingles(b)
    return 100 * len(a & b) >= 80 * len(a | b)


def test_pipeline_keeps_what_plain_python_keeps(spark, tmp_path):
    rng = random.Random(31)
    words = {k: ["".join(rng.choice(s) for _ in range(rng.randint(3, 8))) for _ in range(300)] for k, s in (("aa", "abcdefgh"), ("bb", "pqrstuvw"))}
    prose = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    item = prose("aa", 15)
    rows = [(i, prose("ab"[i % 2] * 2, 70), "ab"[i % 2] * 2, f"s{i % 3}") for i in range(80)]
    rows += [(100 + i, rows[i][1], rows[i][2], "s0") for i in range(5)]  # copies
    rows += [(200 + i, rows[i][1] + " " + words[rows[i][2]][i], rows[i][2], "s1") for i in range(3, 9)]  # near copies
    rows += [(300, prose("aa", 40) + " " + item + " " + prose("aa", 40), "aa", "s2"), (301, item, "aa", None)]  # benchmark passages
    rows += [(400, "12345 67890 " * 20, "aa", "s0"), (401, None, None, "s0")]  # in no language
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([("i1", item)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, docs, folder).collect()}
    assert not known & {400, 401} and len(known) >= 0.9 * len(rows)
    left = []  # by id: the least of each class of near copies, which are pairs or triples here
    for doc, text, *_ in sorted(rows, key=lambda r: r[0]):
        if doc in known and not any(near(text, other) for _, other in left):
            left.append((doc, text))
    windows = {tuple(item.split()[k : k + 10]) for k in range(6)}
    want = {d for d, t in left if not any(tuple(t.split()[k : k + 10]) in windows for k in range(len(t.split()) - 9))}

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "jaccard_join", "decontamination", "packing"]
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {p["doc_id"] for p in pieces} == want
    lengths = Counter()
    for p in pieces:
        lengths[p["doc_id"]] += p["length"]
    assert all(lengths[p["doc_id"]] == p["doc_tokens"] for p in pieces)


def test_every_prefix_of_the_stream_has_the_mixture(spark):
    rng, chunk, window = random.Random(8), 32, 2000
    rows = [(i, i, f"s{min(int(rng.expovariate(0.6)), 6)}", rng.choice((1, 5, 40, 130, 700))) for i in range(900)]
    counts = spark.createDataFrame(rows, "row bigint, doc_id bigint, source string, n bigint").repartition(5)
    served = packing.serve(counts, window=window, chunk=chunk).orderBy("end").collect()
    whole, total = Counter(), sum(r[3] for r in rows)
    for r in rows:
        whole[r[2]] += r[3]
    assert [r["end"] for r in served][-1] == total
    sent, done = Counter(), 0
    for r in served:
        assert r["end"] - r["size"] == done  # no gaps
        done, sent[r["source"]] = r["end"], sent[r["source"]] + r["size"]
        # a source is less than a chunk behind its moment, so all together less than a chunk for each source
        for s, n in whole.items():
            assert -chunk <= sent[s] - done * n / total <= chunk * len(whole) * n / total


def test_chunks_that_other_sources_part_are_pieces_of_their_own(spark, tmp_path):
    import public_tokenizers

    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(("one", "two", "three")) for _ in range(3000 if i < 4 else 50)), f"s{i % 2}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    pieces = packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), length=512, chunk=128)
    pieces = pieces.withColumn("n", F.octet_length("ids") / 4).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert p["n"] == p["length"]
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for of in by_doc.values():
        at = 0
        for p in sorted(of, key=lambda p: p["start"]):
            assert p["start"] == at
            at += p["length"]
        assert at == of[0]["doc_tokens"]
    for k, of in by_sequence.items():
        at = 0
        for p in sorted(of, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == 512 or k == max(by_sequence)
