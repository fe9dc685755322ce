"""Substring deduplication with a sparse suffix array.

Of each text only the suffixes at content-selected positions are kept: minimisers, the
smallest hash of ``gram`` words in every window of ``window`` such grams.  Every run of
``least_words`` words belongs to the minimiser of the window it begins with, which lies
inside it with its first ``seed`` words (``window + seed <= least_words + 1``): so a run
belongs to the same suffix wherever it stands.

Consecutive runs of one suffix are a block, a block is told by 128 bits over its words.
Blocks are brought together by their seed, told by 64 bits, and sorted: one that follows
another place of the same block repeats it whole.  Of blocks that share a seed and differ
(where a passage begins or ends) the first place of each is cut into its runs, told by
128 bits.  These are sorted (one range-partitioned sort by run, document and place, which
also spreads a run that very many documents share) and compared with their neighbours: an
entry that follows another place of the same run is a repeat of ``least_words`` words from
one earlier place.  Partition ends are compared in a second step, from two rows each.  A
run that a later place of a block repeats is in the first place too, so nothing is missed.

A word goes exactly when a run around it repeats an earlier one: overlapping repeats
are merged, and nothing else is removed.  The first occurrence (smallest id, then first
place) stays.

Words are compared in lower case (A-Z) with ASCII white space between them.  Defined
cases: null texts stay null and empty ones empty; documents without an id come last;
rows that repeat an id and a text are one document given twice and treated alike;
rows that repeat an id with different texts are ordered by a hash of the text; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.llm.common import join_sized, pick
from framewell.llm.jaccard_join import WordHashes, mixed
from framewell.llm.sentence_spans import BASES, Powers
from framewell.plans.settle import release, settle, working

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BATCH_BYTES = 4_000_000


def word_hashes(text: str | None, hashes: WordHashes) -> np.ndarray:
    words = (text or "").encode("utf-8").lower().split()
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def blocks_of(at: np.ndarray, gram: int, window: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix, first and last start of all blocks of runs, in a text given as hashes of its words."""
    runs = len(at) - length + 1
    if runs < 1:
        return (np.empty(0, np.int64),) * 3
    grams = np.zeros(len(at) - gram + 1, np.uint64)
    for i in range(gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + at[i : i + len(grams)]
    views = np.lib.stride_tricks.sliding_window_view(mixed(grams, 1), window)[:runs]
    kept = views.argmin(axis=1) + np.arange(runs)
    first = np.flatnonzero(np.concatenate([[True], kept[1:] != kept[:-1]]))
    return kept[first], first, np.concatenate([first[1:], [runs]]) - 1


class Runs:
    """128 bits for every run of words of a text, the same wherever it stands."""

    def __init__(self) -> None:
        self.powers = tuple(Powers(base) for base in BASES)

    def told(self, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        size = (last - first).astype(np.uint64)
        values = (mixed(at, 21), mixed(at, 22))
        return [mixed(p.of_runs(v, first, last) + size, 23).view(np.int64) for p, v in zip(self.powers, values, strict=True)]


REPEAT, OPEN = 0, 1


def compared_blocks(blocks: DataFrame, kind: str) -> DataFrame:
    """``what, doc_id, _text, a, b`` of the blocks that repeat an earlier place and, as ``OPEN``, of first places that share a seed with others."""
    names = ["doc_id", "_text", "a", "b"]
    order = ["seed", "h1", "h2", "late", "doc_id", "_text", "a"]
    place = F.xxhash64("late", F.coalesce("doc_id", F.lit(0).cast(kind)), "_text", "a")
    late = blocks.withColumn("late", F.col("doc_id").isNull())
    # a document sends a block once, so the most frequent seed has few rows of the many of a document
    array = late.repartition("seed").sortWithinPartitions(*order).withColumn("place", place)

    def neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(batch: pa.RecordBatch, what: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, what, np.int32)), *[batch.column(c) for c in names]], names=["what", *names])

        last = lead = pending = None  # the row before; the place of its block's first row; the only block of its seed so far
        held = 0  # blocks of that seed so far
        for batch in batches:
            again = batch.column("again").to_numpy(zero_copy_only=False)
            if again.any():
                yield told(batch.filter(pa.array(again)), REPEAT)
                batch = batch.filter(pa.array(~again))
            n = batch.num_rows
            if not n:
                continue
            seed, h1, h2, where = (batch.column(c).to_numpy() for c in ("seed", "h1", "h2", "place"))
            goes_on = last is not None and last[0] == seed[0]
            new_seed = np.concatenate([[not goes_on], seed[1:] != seed[:-1]])
            new = np.concatenate([[not goes_on or last[1:] != (h1[0], h2[0])], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]) | new_seed
            leader = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            first_place = np.where(leader >= 0, where[np.maximum(leader, 0)], where[0] if lead is None else lead)
            repeat = ~new & (where != first_place)
            if repeat.any():
                yield told(batch.filter(pa.array(repeat)), REPEAT)
            which = np.cumsum(new_seed) - int(new_seed[0])
            count = np.bincount(which[new], minlength=which[-1] + 1)
            count[0] += held if goes_on else 0
            if pending is not None and goes_on and count[0] > 1:
                yield told(pending, OPEN)
            several = new & (count[which] > 1)
            if several.any():
                yield told(batch.filter(pa.array(several)), OPEN)
            held = int(count[-1])
            mine = np.flatnonzero(new & (which == which[-1]))
            if held > 1:
                pending = None
            elif len(mine):
                pending = batch.slice(int(mine[0]), 1)
            last, lead = (seed[-1], h1[-1], h2[-1]), first_place[-1]

    shape = f"what int, doc_id {kind}, _text bigint, a int, b int"
    return settle(array.mapInArrow(neighbours, shape), "blocks")


def later_places(windows: DataFrame, kind: str) -> DataFrame:
    """``doc_id, _text, start`` of all entries ``h1, h2, late, doc_id, _text, start`` that follow another place of the same run."""
    spark = windows.sparkSession
    order = ["h1", "h2", "late", "doc_id", "_text", "start"]
    placed = windows.withColumn("place", F.xxhash64("late", F.coalesce("doc_id", F.lit(0).cast(kind)), "_text", "start"))
    array = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    names = ["part", "what", "h1", "h2", "place", "doc_id", "_text", "start"]

    def neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The repeats in this partition, its first entry, and the leading one of its last run."""
        lead: tuple | None = None
        last: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, place = (batch.column(c).to_numpy() for c in ("h1", "h2", "place"))
            what = np.full(len(h1), "", dtype=object)
            if lead is None:
                what[0] = "first"
                lead = (h1[0], h2[0], place[0])
                last = batch.slice(0, 1)
            new = np.concatenate([[(h1[0], h2[0]) != lead[:2]], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            leader = np.maximum.accumulate(np.where(new, np.arange(len(h1)), -1))
            first_place = np.where(leader >= 0, place[np.maximum(leader, 0)], lead[2])
            what[place != first_place] = "repeat"
            if leader[-1] >= 0:
                lead = (h1[leader[-1]], h2[leader[-1]], place[leader[-1]])
                last = batch.slice(int(leader[-1]), 1)
            chosen = np.flatnonzero(what != "")
            out = batch.take(pa.array(chosen))
            columns = [out.column("part"), pa.array(what[chosen].tolist(), pa.string()), *[out.column(c) for c in names[2:]]]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if last is not None:
            columns = [last.column("part"), pa.array(["last"], pa.string()), *[last.column(c) for c in names[2:]]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    shape = f"part int, what string, h1 bigint, h2 bigint, place bigint, doc_id {kind}, _text bigint, start int"
    compared = settle(array.mapInArrow(neighbours, shape), "compared")
    # two rows for each partition of the sort: where a run that began in one before goes on
    ends = sorted(compared.where("what IN ('first', 'last')").collect(), key=lambda r: (r["part"], r["what"] == "last"))
    run = lambda r: (r["h1"], r["h2"])
    joints, begun = [], None
    for first, last in zip(ends[::2], ends[1::2], strict=True):
        goes_on = begun is not None and run(begun) == run(first)
        if goes_on and begun["place"] != first["place"]:
            joints.append((first["doc_id"], first["_text"], first["start"]))
        if not (goes_on and run(last) == run(first)):
            begun = last
    places = f"doc_id {kind}, _text bigint, start int"
    # further entries at the first entry's own place are one document given twice: decided by place, below
    return compared.where("what = 'repeat'").select("doc_id", "_text", "start").unionAll(spark.createDataFrame(joints, places))


def remove_repeated(
    docs: DataFrame,
    *,
    least_words: int = 50,
    gram: int = 8,
    window: int = 25,
    seed: int = 26,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id_col, n_words, n_removed, removed`` (word ranges) and ``text`` (what is left)."""
    if window + seed > least_words + 1 or gram > seed or window > seed:
        raise ValueError("gram and window must not exceed seed, and window + seed not least_words + 1")
    docs = pick(docs, doc_id=id_col, text=text_col).withColumn("_text", F.xxhash64("text"))
    kind = {f.name: f.dataType for f in docs.schema}["doc_id"].simpleString()
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_same"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All blocks; of those that a text has several times, all but the first as such."""
        hashes, runs = WordHashes(), Runs()
        for batch in batches:
            rows, found, weight = [], [], 0
            for i, text in enumerate(batch.column("text")):
                words = word_hashes(text.as_py(), hashes)
                kept, a, b = blocks_of(words, gram, window, least_words)
                if len(a):
                    (h1, h2), (seeds, _) = runs.told(words, a, b + least_words - 1), runs.told(words, kept, kept + seed - 1)
                    sort = np.lexsort((a, h2, h1))
                    again = np.zeros(len(a), bool)
                    again[sort[1:]] = (h1[sort[1:]] == h1[sort[:-1]]) & (h2[sort[1:]] == h2[sort[:-1]])
                    seeds = np.where(again, mixed(a.astype(np.uint64), 24).view(np.int64), seeds)  # decided here: dealt evenly
                    rows += [i] * len(a)
                    found.append((seeds, h1, h2, a.astype(np.int32), b.astype(np.int32), again))
                    weight += 64 * len(a)
                if rows and (weight > BATCH_BYTES or i + 1 == batch.num_rows):
                    chosen = pa.array(rows, pa.int64())
                    arrays = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                    names = ["seed", "h1", "h2", "a", "b", "again", "doc_id", "_text"]
                    yield pa.RecordBatch.from_arrays([*arrays, batch.column("doc_id").take(chosen), batch.column("_text").take(chosen)], names=names)
                    rows, found, weight = [], [], 0

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs of open blocks."""
        hashes, runs = WordHashes(), Runs()
        for batch in batches:
            for i in range(batch.num_rows):
                words = word_hashes(batch.column("text")[i].as_py(), hashes)
                starts = np.concatenate([np.arange(r["a"], r["b"] + 1) for r in batch.column("places")[i].as_py()])
                for begin in range(0, len(starts), 50_000):
                    some = starts[begin : begin + 50_000]
                    chosen = pa.array(np.full(len(some), i))
                    ids = batch.column("doc_id").take(chosen)
                    arrays = [*map(pa.array, runs.told(words, some, some + least_words - 1)), ids.is_null(), ids, batch.column("_text").take(chosen), pa.array(some.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["h1", "h2", "late", "doc_id", "_text", "start"])

    def by_document(places: DataFrame, name: str) -> DataFrame:
        listed = places.groupBy("doc_id", "_text").agg(F.collect_set(F.struct("a", "b")).alias(name))
        return listed.select(F.col("doc_id").alias("_doc"), F.col("_text").alias("_same"), name)

    with working() as scope:
        shape = f"seed bigint, h1 bigint, h2 bigint, a int, b int, again boolean, doc_id {kind}, _text bigint"
        compared = compared_blocks(docs.mapInArrow(cut, shape), kind)
        places = by_document(compared.where(F.col("what") == OPEN), "places")
        met = join_sized(docs, places, same, F.lit(32) + 8 * F.size("places"), "places", "inner").select("doc_id", "_text", "text", "places")
        windows = settle(met.mapInArrow(extend, f"h1 bigint, h2 bigint, late boolean, doc_id {kind}, _text bigint, start int"), "runs")
        single = later_places(windows, kind).select("doc_id", "_text", F.col("start").alias("a"), F.col("start").alias("b"))
        release(windows)
        whole = compared.where(F.col("what") == REPEAT).select("doc_id", "_text", "a", "b")
        ranges = scope.keep(by_document(whole.unionByName(single), "ranges"), "repeats")
    joined = join_sized(docs, ranges, same, F.lit(32) + 8 * F.size("ranges"), "ranges").select("doc_id", "text", "ranges")

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        for batch in batches:
            begin, rows, weight = 0, [], 0
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                data = (text or "").encode("utf-8")
                merged: list[list[int]] = []
                for a, b in sorted((r["a"], r["b"]) for r in batch.column("ranges")[i].as_py() or []):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b + least_words)
                    else:
                        merged.append([a, b + least_words])
                n_words, left, at = len(data.split()), [], 0
                if merged:
                    spots = [m.span() for m in WORD.finditer(data)]
                    for a, b in merged:
                        left.append(data[at : spots[a][0]])
                        at = spots[b][0] if b < len(spots) else len(data)
                kept = None if text is None else b"".join([*left, data[at:]]).decode("utf-8")
                rows.append((n_words, sum(b - a for a, b in merged), [{"from": a, "to": b} for a, b in merged], kept))
                weight += len(data)
                if weight > BATCH_BYTES or i + 1 == batch.num_rows:
                    a, b, c, d = zip(*rows, strict=True)
                    arrays = [batch.column("doc_id").slice(begin, i + 1 - begin), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pair), pa.array(d, pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "removed", "text"])
                    begin, rows, weight = i + 1, [], 0

    out = joined.mapInArrow(clean, f"doc_id {kind}, n_words bigint, n_removed bigint, removed array<struct<`from`:bigint,`to`:bigint>>, text string")
    return out.withColumnRenamed("doc_id", id_col)
