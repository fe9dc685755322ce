"""Dropping contaminated documents needs exact occurrences only."""

from framewell.llm import decontaminate


def test_clean_documents_looks_for_no_proximity(spark, monkeypatch):
    slops = []
    intersect = decontaminate.intersect
    monkeypatch.setattr(decontaminate, "intersect", lambda index, picked, slop=0: slops.append(slop) or intersect(index, picked, slop))
    words = [f"w{i}" for i in range(14)]
    gapped = [*words[:5], "x", *words[5:10], "x", *words[10:]]
    rows = [(1, " ".join(["a", *words, "b"])), (2, " ".join(gapped)), (3, None), (None, " ".join(words)), (None, "w1 w2"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(words))], "item_id bigint, text string")
    left = decontaminate.clean_documents(docs, items).collect()
    assert sorted(map(repr, left)) == sorted(repr(r) for r in docs.collect() if r["text"] in (" ".join(gapped), None, "w1 w2", ""))
    assert slops == [0]
    near = {r["doc_id"]: r["near_items"] for r in decontaminate.decontaminate(docs.where("doc_id is not null"), items).collect()}
    assert near == {1: 1, 2: 1, 3: 0, 4: 0}
