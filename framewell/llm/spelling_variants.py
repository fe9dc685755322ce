"""Spelling variants: words one edit apart, by k-d trees over letter-count vectors.

A word is a point: how often it has each letter (a-z, and one count for all others).  One
replaced letter moves the point by at most 2 in L1 distance and keeps the length, an
inserted or deleted one by at most 1 with the length off by one.  So the near words of
a word lie in a range around its point, among the words of its own length (radius 2)
and of the next length (radius 1).

*Trees.*  The words of one length are dealt to cells by a top tree of median splits.
Its splits are fitted on a bounded sample (``SAMPLE`` words, those of smallest hash);
every word is then placed, so nothing is lost, only balance depends on the sample.  A
query goes to every cell whose half-spaces its range reaches.  Within a cell a task
builds a k-d tree with boxes over all its words and searches it for a block of queries
at once: a box farther than the radius is left with all its words.  Cells that hold
more than ``CELL_LETTERS`` letters are cut into parts, and many queries of a cell into
blocks, so a task's memory is bounded whatever the words are.

*Leaves* compare counts, up to two of a letter, packed into 64 bits (never farther than
the true distance); what is left is compared letter by letter.

Tasks give one row a word: the number of near words and the best of them; these fold
into one.  Every pair of words is met once, as a word is in one part and a query once
in each.

Defined cases: null and empty texts have no words; a null id counts as an empty
string; rows that repeat count again; ties go to the word smaller in code points; an
empty table gives an empty result; texts and words of any length are read whole;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.llm.common import join_sized, pick
from framewell.plans.settle import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = r"[A-Za-zÀ-ÿ]+"
SAMPLE = 50_000
CELL_LETTERS = 400_000
LEAF = 96


# -- words -------------------------------------------------------------------------------
def marked_words(docs: DataFrame) -> DataFrame:
    """``word`` for every run of letters of ``doc_id, text``; of one in 97 by hash a letter is left out."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUNS), 0)).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return runs.select("run", h.alias("h")).select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, *, least_letters: int, least_n: int) -> DataFrame:
    """``word, n, letters`` of the words long and frequent enough."""
    long_enough = words.where(F.length("word") >= least_letters)
    counted = long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)
    return counted.withColumn("letters", F.length("word"))


# -- points ------------------------------------------------------------------------------
def code_points(words: list[str], letters: int) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), letters)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """27 counts a word: a to z, and all other letters together."""
    place = np.where((codes >= 97) & (codes <= 122), codes - 97, 26).astype(np.int64)
    flat = (np.arange(len(codes))[:, None] * 27 + place).ravel()
    return np.bincount(flat, minlength=27 * len(codes)).reshape(-1, 27).astype(np.int32)


def packed_counts(codes: np.ndarray) -> np.ndarray:
    """64 bits a word: for each of a-z and six classes of other letters one bit for the first and one for the second."""
    place = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % 6).astype(np.int64)
    flat = (np.arange(len(codes))[:, None] * 32 + place).ravel()
    counts = np.bincount(flat, minlength=32 * len(codes)).reshape(-1, 32)
    bits = np.uint64(1) << np.arange(32, dtype=np.uint64)
    once = ((counts > 0) * bits).sum(axis=1, dtype=np.uint64)
    twice = ((counts > 1) * bits).sum(axis=1, dtype=np.uint64)
    return once | (twice << np.uint64(32))


# -- the top tree ------------------------------------------------------------------------
class Splits:
    """Median splits of the points of one length: inner nodes test ``point[dim] <= value``, leaves are cells."""

    def __init__(self, points: np.ndarray, cells: int):
        self.nodes: list[tuple] = []
        self.cells = 0
        self._grow(points, cells)

    def _grow(self, points: np.ndarray, cells: int) -> int:
        me = len(self.nodes)
        self.nodes.append(())
        spread = points.max(axis=0) - points.min(axis=0) if len(points) else np.zeros(27)
        if cells > 1 and spread.max() > 0:
            dim = int(np.argmax(points.var(axis=0)))
            value = int(np.median(points[:, dim]))
            if value == points[:, dim].max():
                value -= 1
            low = points[:, dim] <= value
            left = self._grow(points[low], cells // 2)
            right = self._grow(points[~low], cells - cells // 2)
            self.nodes[me] = (dim, value, left, right)
        else:
            self.nodes[me] = (self.cells,)
            self.cells += 1
        return me

    def reach(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """``(point, cell)`` for every cell within ``radius`` of a point; radius 0 gives each point its own cell."""
        out: list[tuple[np.ndarray, int]] = []
        todo = [(0, np.arange(len(points)), np.zeros((len(points), 27), np.int32))]
        while todo:
            at, who, off = todo.pop()
            if not len(who):
                continue
            node = self.nodes[at]
            if len(node) == 1:
                out.append((who, node[0]))
                continue
            dim, value, left, right = node
            x = points[who, dim]
            for child, beyond in ((left, np.maximum(x - value, 0)), (right, np.maximum(value + 1 - x, 0))):
                moved = off.copy()
                moved[:, dim] = np.maximum(moved[:, dim], beyond)  # how far the range must move along each axis
                near = moved.sum(axis=1) <= radius
                todo.append((child, who[near], moved[near]))
        return np.concatenate([w for w, _ in out] or [np.empty(0, int)]), np.concatenate([np.full(len(w), c) for w, c in out] or [np.empty(0, int)])


def fit_splits(words: DataFrame) -> dict[int, Splits]:
    """The top tree of each length with more letters than one cell; lengths without a tree are one cell."""
    sizes = words.groupBy("letters").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") * F.col("letters") > CELL_LETTERS).collect()  # one row for each CELL_LETTERS letters at most
    if not large:
        return {}
    lengths = [r["letters"] for r in large]
    sample = words.where(F.col("letters").isin(lengths)).orderBy(F.xxhash64("word"), "word").limit(SAMPLE).select("word").collect()
    by_length: dict[int, list[str]] = {}
    for (word,) in sample:
        by_length.setdefault(len(word), []).append(word)
    trees = {}
    for r in large:
        some = by_length.get(r["letters"], [])
        if some:
            cells = min(-(-r["n"] * r["letters"] // CELL_LETTERS), max(1, len(some) // 16))
            trees[r["letters"]] = Splits(letter_counts(code_points(some, r["letters"])), cells)
    return trees


def routed(words: DataFrame, trees: dict[int, Splits], target: int | None) -> DataFrame:
    """``word, n, letters, cell``: each word in its own cell (``target`` None), or in all it asks, of its own length (0) or the next (1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("letters").to_numpy()
            for size in np.unique(letters):
                who = np.flatnonzero(letters == size)
                size = int(size)
                tree = trees.get(size + (target or 0))
                if tree is None:
                    cells = np.zeros(len(who), int)
                else:
                    points = letter_counts(code_points(batch.column("word").take(pa.array(who)).to_pylist(), size))
                    at, cells = tree.reach(points, 0 if target is None else 2 - target)
                    who = who[at]
                rows = batch.take(pa.array(who))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("word"), rows.column("n"), pa.array(np.full(len(who), size + (target or 0), np.int32)), pa.array(cells.astype(np.int32))],
                    names=["word", "n", "letters", "cell"],
                )

    return words.select("word", "n", "letters").mapInArrow(run, "word string, n bigint, letters int, cell int")


# -- search in a cell ----------------------------------------------------------------------
def near_pairs(points, packed, codes, q_points, q_packed, q_codes, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(queries, members)`` that are exactly one edit apart, by a k-d tree over the members."""
    todo = [(np.arange(len(points)), np.arange(len(q_points)))]
    while todo:
        own, asking = todo.pop()
        if not len(own) or not len(asking):
            continue
        box = points[own]
        low, high = box.min(axis=0), box.max(axis=0)
        q = q_points[asking]
        asking = asking[(np.maximum(low - q, 0) + np.maximum(q - high, 0)).sum(axis=1) <= radius]
        if not len(asking):
            continue
        spread = high - low
        if len(own) > LEAF and spread.max() > 0:
            dim = int(np.argmax(box.var(axis=0)))
            value = np.median(box[:, dim])
            left = box[:, dim] <= (value if value < high[dim] else value - 1)
            todo += [(own[left], asking), (own[~left], asking)]
            continue
        for start in range(0, len(own), 4 * LEAF):  # words of one point may be many
            some = own[start : start + 4 * LEAF]
            for q0 in range(0, len(asking), 4096):
                asked = asking[q0 : q0 + 4096]
                off = np.bitwise_count(q_packed[asked][:, None] ^ packed[some][None, :])
                i, j = np.nonzero(off <= radius)
                if len(i):
                    a, b = asked[i], some[j]
                    ok = one_edit(q_codes[a], codes[b])
                    yield a[ok], b[ok]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows differ by one replaced letter (equal widths) or one letter that only ``b`` has."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    front = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= n


def best_per_word(words: list[str], who: np.ndarray, other_words: list[str], other_n: np.ndarray, other: np.ndarray) -> list[tuple]:
    """``(word, number of near words, the best of them, its n)``; largest n first, then the smaller word."""
    out: dict[int, list] = {}
    for i, j in zip(who.tolist(), other.tolist(), strict=True):
        have = out.get(i)
        if have is None:
            out[i] = [1, int(other_n[j]), other_words[j]]
            continue
        have[0] += 1
        if other_n[j] > have[1] or (other_n[j] == have[1] and other_words[j] < have[2]):
            have[1], have[2] = int(other_n[j]), other_words[j]
    return [(words[i], near, form, form_n) for i, (near, form_n, form) in out.items()]


FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def search_cell(key, members: pa.Table, asking: pa.Table) -> pa.Table:
    """Near words of a block of queries among the words of one part of a cell."""
    letters, target = key[0].as_py(), key[1].as_py()
    words, asked = members.column("word").to_pylist(), asking.column("word").to_pylist()
    if not words or not asked:
        return FOUND.empty_table()
    n, asked_n = members.column("n").to_numpy(), asking.column("n").to_numpy()
    codes, q_codes = code_points(words, letters), code_points(asked, letters - target)
    radius = 2 - target
    pairs = list(near_pairs(letter_counts(codes), packed_counts(codes), codes, letter_counts(q_codes), packed_counts(q_codes), q_codes, radius))
    a = np.concatenate([p[0] for p in pairs] or [np.empty(0, int)])
    b = np.concatenate([p[1] for p in pairs] or [np.empty(0, int)])
    rows = best_per_word(asked, a, words, n, b)
    if target:  # words of one length find each other twice, those of two lengths once
        rows += best_per_word(words, b, asked, asked_n, a)
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.table({name: pa.array(values, kind) for name, kind, values in zip(FOUND.names, FOUND.types, columns, strict=True)})


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, near, near_n``: number and best of the near words, for words that have any."""
    trees = fit_splits(words)
    members = settle(routed(words, trees, None), "members")
    found = []
    for target in (0, 1):
        asking = settle(routed(words, trees, target), "asking")
        sizes = members.groupBy("letters", "cell").agg(F.count(F.lit(1)).alias("m"))
        asked = asking.groupBy("letters", "cell").agg(F.count(F.lit(1)).alias("q"))
        share = lambda c: F.ceil(F.col(c) * F.col("letters") / CELL_LETTERS).cast("int")
        grid = settle(sizes.join(asked, ["letters", "cell"]).select("letters", "cell", share("m").alias("parts"), share("q").alias("blocks")), "grid")
        dealt = lambda df, own, other: join_sized(
            df, grid, ["letters", "cell"], F.lit(16), "grid", "inner"
        ).select(
            "letters", F.lit(target).alias("target"), "cell", F.pmod(F.xxhash64("word"), F.col(own)).cast("int").alias(own[:-1]),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[:-1]), "word", "n",
        )
        left = dealt(members, "parts", "blocks").groupBy("letters", "target", "cell", "part", "block")
        right = dealt(asking, "blocks", "parts").groupBy("letters", "target", "cell", "part", "block")
        found.append(left.cogroup(right).applyInArrow(search_cell, "word string, n_near bigint, near string, near_n bigint"))
    best = F.min(F.struct((-F.col("near_n")).alias("k"), "near"))  # largest n first, then the smaller word
    folded = found[0].unionByName(found[1]).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return folded.select("word", "n_near", "b.near", (-F.col("b.k")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms of a word lead in the end; counts at least double at each step, so rounds are few."""
    now = settle(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = join_sized(now, ahead, "root", F.lit(32) + F.octet_length("root") + F.octet_length("_next"), "ahead")
        following = settle(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "steps")
        if not following.where("_moved").take(1):
            return following.select("word", "root")
        now = following.select("word", "root")


def spelling_variants(
    docs: DataFrame, *, least_letters: int = 5, least_n: int = 3, ratio: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word.

    ``form`` is the most frequent near word, if it is at least ``ratio`` times as frequent; ``root`` follows forms to the last.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    words = settle(vocabulary(marked_words(docs), least_letters=least_letters, least_n=least_n), "vocabulary")
    near = settle(near_words(words), "near")
    joined = words.select("word", "n").join(near, "word", "left")
    is_form = F.col("near_n") >= ratio * F.col("n")
    known = settle(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "known",
    )
    led = roots(known.where(F.col("form").isNotNull()))
    out = known.join(led, "word", "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
