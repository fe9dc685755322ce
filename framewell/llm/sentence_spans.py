"""Substring deduplication by sliding sentence spans.

A text is cut into sentences (after ``. ! ?`` and a blank, after the sentence ends of
other scripts, and at line ends).  A sentence of more than ``LONGEST_PIECE`` words is cut
again before words that their surroundings select: the word with the smallest hash of
any ``CUT_WINDOW`` consecutive words.  So no piece of it is longer than that, and two
copies of a passage are cut alike wherever they stand, save near their ends.  In scripts
without blanks every sign counts as a word.  A span is a run of at least ``sentences`` pieces and
``least_words`` words: the shortest one from each piece on, and the shortest one up to
each piece.  A span is told by 96 bits of two polynomials over its pieces' hashes (at 10
million million spans some 0.0006 pairs are expected to agree by chance); the first occurrence
of a span (smallest id, then first place) stays, and sentences covered by any other
occurrence of a repeated span are removed.  With the default limits every repeated
passage of 50 words or more that begins and ends with a sentence is found whole, and of
one inside a long sentence all but at most ``2 * CUT_WINDOW - 2`` words at either end.
Where a passage begins or ends inside a sentence that is long in one copy and short in
the other, its part of that sentence stays.

Every text is cut once.  All spans go through one range-partitioned sort by hash and
document, which also spreads a span that very many documents share, and are compared
with their neighbours (``repeats.py``); the pieces' places travel to the text with the
ranges to remove.  Python sees one batch at a time.

Words are compared in lower case, with white space collapsed.  Defined cases: null texts stay null
and empty ones empty; an empty table gives an empty result; very long texts are cut whole, one
at a time; documents without an id come last, each text of them a document of its own; rows that repeat an id and a
text are one document given twice and treated alike; rows that repeat an id with
different texts are one document, which does not lose what only its rows share;
texts shorter than a span are left alone; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.llm.common import join_sized, pick
from framewell.llm.repeats import later_rows
from framewell.plans.settle import release, settle, working

SENTENCE_END = re.compile(r"[.!?]+\s+|[\u3002\uff01\uff0e\uff1f\uff61\u0964\u0965\u061f\u06d4\u1362\u104b\u17d4]+\s*|\n+")
# Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han
SIGNS = "\u0e00-\u0e7f\u0e80-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
SIGN = re.compile(f"[{SIGNS}]")
WORD = re.compile(r"\S+")
SIGN_OR_WORD = re.compile(rf"[{SIGNS}]|[^\s{SIGNS}]+")
LONGEST_PIECE = 16
CUT_WINDOW = 7  # 50 words inside a long sentence share 24 or more between common cuts
BATCH_BYTES = 4_000_000
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)  # odd, so that powers have inverses modulo 2**64
SPAN = pa.struct([("h1", pa.int64()), ("h2", pa.int32()), ("a", pa.int32()), ("b", pa.int32())])
RANGE = pa.struct([("a", pa.int32()), ("b", pa.int32())])


def cuts_of(words: list[str]) -> list[int]:
    """Where to cut a long sentence: the first smallest of every ``CUT_WINDOW`` consecutive word hashes."""
    marks = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words]
    out, best = [0], -1
    for begin in range(len(marks) - CUT_WINDOW + 1):
        last = begin + CUT_WINDOW - 1
        if best < begin:
            part = marks[begin : last + 1]
            best = begin + part.index(min(part))
        elif marks[last] < marks[best]:
            best = last
        if best > out[-1]:
            out.append(best)
    return out


def pieces_of(text: str) -> list[tuple[int, int, int, bytes]]:
    """First and last character, number of words and hash of every sentence or piece of one."""
    out, begin = [], 0
    word = SIGN_OR_WORD if SIGN.search(text) else WORD
    ends = [m.end() for m in SENTENCE_END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    for end in ends:
        part = text[begin:end]
        words = part.lower().split() if word is WORD else word.findall(part.lower())
        if len(words) <= LONGEST_PIECE:
            if words:
                out.append((begin, end, len(words), hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()))
        else:
            at = [begin + m.start() for m in word.finditer(part)]
            at[0] = begin
            cuts = [*cuts_of(words), len(words)]
            for i, j in pairwise(cuts):
                held = " ".join(words[i:j]).encode("utf-8", "surrogatepass")
                out.append((at[i], at[j] if j < len(at) else end, j - i, hashlib.blake2b(held, digest_size=16).digest()))
        begin = end
    return out


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as the longest text so far needs."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> Powers:
        if len(self.up) < n:
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, by, np.uint64))]) for by in (self.base, self.inverse)
            )
        return self

    def of_runs(self, values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The polynomial over ``values[a .. b]`` of every run, the same wherever the run stands."""
        self.reach(len(values) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[: len(values)], dtype=np.uint64)])
        return (total[b + 1] - total[a]) * self.down[a]


def spans_of(sizes: np.ndarray, sentences: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last piece of all spans, in order, from the numbers of words of the pieces."""
    n = len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(n)
    ends = np.maximum(at + sentences, np.searchsorted(total, total[:-1] + least_words, "left"))  # the shortest from each piece on
    begins = np.minimum(at + 1 - sentences, np.searchsorted(total, total[1:] - least_words, "right") - 1)  # the shortest up to each
    from_each, up_to_each = ends <= n, begins >= 0
    first = np.concatenate([at[from_each], begins[up_to_each]])
    last = np.concatenate([ends[from_each] - 1, at[up_to_each]])
    return np.divmod(np.unique(first * n + last), n) if n else (first, last)


def first_spans(pieces: list[tuple[int, int, int, bytes]], sentences: int, least_words: int, powers: tuple[Powers, Powers]):
    """Hashes, first and last piece of each span's first place in a text, and the ranges of pieces at later places."""
    a, b = spans_of(np.array([p[2] for p in pieces], np.int64), sentences, least_words)
    values = np.frombuffer(b"".join(p[3] for p in pieces), "<u8").reshape(-1, 2)
    h1 = powers[0].of_runs(values[:, 0], a, b).view(np.int64)
    h2 = (powers[1].of_runs(values[:, 1], a, b) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    order = np.lexsort((h2, h1))  # stable: places of equal spans stay in order
    again = np.zeros(len(a), bool)
    again[order[1:]] = (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
    kept = ~again
    return h1[kept], h2[kept], a[kept], b[kept], list(zip(a[again].tolist(), b[again].tolist(), strict=True))


def covered(ranges: Iterable[tuple[int, int]]) -> list[list[int]]:
    """Overlapping ranges as one, in order."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _lists(parts: list[list], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    flat = np.concatenate([np.asarray(p) for p in parts]) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32), kind))


def remove_repeated(
    docs: DataFrame, *, sentences: int = 3, least_words: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id_col, n_sentences, n_removed, removed_chars, text`` (what is left)."""
    docs = pick(docs, doc_id=id_col, text=text_col).withColumn("_text", F.xxhash64("text"))
    kind = {f.name: f.dataType for f in docs.schema}["doc_id"].simpleString()

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = (Powers(BASES[0]), Powers(BASES[1]))
        for batch in batches:
            begin, begins, ends, spans, ranges, weight = 0, [], [], [], [], 0
            for i, text in enumerate(batch.column("text")):
                pieces = pieces_of(text.as_py() or "")
                *found, again = first_spans(pieces, sentences, least_words, powers)
                begins.append([p[0] for p in pieces])
                ends.append([p[1] for p in pieces])
                spans.append(found)
                ranges.append([{"a": a, "b": b} for a, b in covered(again)])
                weight += 32 * len(pieces)
                if weight > BATCH_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(begin, i + 1 - begin)
                    offsets = pa.array(np.concatenate([[0], np.cumsum([len(s[0]) for s in spans])]), pa.int32())
                    flat = [pa.array(np.concatenate(c), t.type) for c, t in zip(zip(*spans, strict=True), SPAN, strict=True)]
                    arrays = [
                        part.column("doc_id"), part.column("_text"), _lists(begins, pa.int32()), _lists(ends, pa.int32()),
                        pa.array(ranges, pa.list_(RANGE)), pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(flat, fields=list(SPAN))),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "_text", "begins", "ends", "ranges", "spans"])
                    begin, begins, ends, spans, ranges, weight = i + 1, [], [], [], [], 0

    places = "begins array<int>, ends array<int>, ranges array<struct<a:int,b:int>>"
    with working() as scope:
        made = settle(docs.mapInArrow(emit, f"doc_id {kind}, _text bigint, {places}, spans array<struct<h1:bigint,h2:int,a:int,b:int>>"), "spans")
        spans = made.select("doc_id", "_text", F.explode("spans").alias("s")).select("s.h1", "s.h2", "doc_id", "_text", "s.a", "s.b")
        later = later_rows(spans, ["h1", "h2"], ["a", "b"])
        one = later.select("doc_id", "_text", F.lit(None).cast("array<int>").alias("begins"), F.lit(None).cast("array<int>").alias("ends"), F.array(F.struct("a", "b")).alias("ranges"))
        ranges = made.drop("spans").unionByName(one).groupBy("doc_id", "_text").agg(
            F.first("begins", ignorenulls=True).alias("begins"), F.first("ends", ignorenulls=True).alias("ends"), F.flatten(F.collect_set("ranges")).alias("ranges")
        )
        kept = scope.keep(ranges.select(F.col("doc_id").alias("_doc"), F.col("_text").alias("_same"), "begins", "ends", "ranges"), "ranges")
        release(made)
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_same"))
    size = F.lit(64) + 8 * F.size("begins") + 16 * F.size("ranges")
    joined = join_sized(docs, kept, same, size, "ranges").select("doc_id", "text", "begins", "ends", "ranges")

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, rows, weight = 0, [], 0
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                places = batch.column("begins")[i]
                left, at, gone = [], 0, 0
                for a, b in covered((r["a"], r["b"]) for r in batch.column("ranges")[i].as_py()):
                    begins, ends = places.values, batch.column("ends")[i].values
                    gone += b - a + 1
                    for k in range(a, b + 1):
                        left.append(text[at : begins[k].as_py()])
                        at = ends[k].as_py()
                kept = None if text is None else "".join([*left, text[at:]])
                rows.append((len(places), gone, len(text or "") - len(kept or ""), kept))
                weight += len(text or "")
                if weight > BATCH_BYTES or i + 1 == batch.num_rows:
                    a, b, c, d = zip(*rows, strict=True)
                    arrays = [batch.column("doc_id").slice(begin, i + 1 - begin), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_sentences", "n_removed", "removed_chars", "text"])
                    begin, rows, weight = i + 1, [], 0

    out = joined.mapInArrow(clean, f"doc_id {kind}, n_sentences bigint, n_removed bigint, removed_chars bigint, text string")
    return out.withColumnRenamed("doc_id", id_col)
