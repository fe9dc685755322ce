"""Packing documents into token sequences whose mixture of sources is controlled.

A document is its token ids and an end id.  Every source is a queue of its
documents, cut into chunks.  Deficit round-robin serves the queues: in each
window a source earns credit for its share of the window's tokens and sends
chunks while its credit, with what earlier windows left over, covers them.  That
state has a closed form: a chunk that ends at the source's token ``c`` leaves in
the first window ``r`` with ``(r + 1) * credit >= c``, and inside it when the credit, earned
evenly, reaches ``c``.  So every part of the stream follows the proportions, but for less
than a chunk that each source may be behind, and deficits carry exactly
over windows and over partitions, and no task ever holds a queue.  Running token
counts come from range-partitioned tables and one small sum per partition.

The served stream is cut every ``length`` tokens; only the last sequence is short.

The texts are tokenised once; ids are written (two bytes each where the vocabulary
allows), the plan is made from counts alone, and ids meet their pieces in one join
by row number.

Defined cases: null and empty texts consist of the end id; a null source is a queue
of its own; rows that repeat an id are packed separately; an empty table gives no
pieces; very long texts are cut into chunks like others, their ids stay in one row until they are
dealt to pieces; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewell.llm.common import pick
from framewell.plans.settle import settle

CACHED_WORDS = 800_000
CACHED_BYTES = 64
BATCH_BYTES = 4_000_000


class WordIds(dict):
    """Ids of white-space separated words as little-endian bytes, remembered for short words.

    Right for tokenizers that drop white space and treat the words between it
    independently.  Plain words skip the text pipeline and go to the model at once.
    """

    plain = re.compile("[a-zà-öø-ÿ]+")

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.dtype = np.dtype(f"<u{width}")

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        lower = text.lower()
        if self.plain.fullmatch(lower):
            mapped = lower if lower.isascii() else "".join(t for t, _ in self.as_bytes.pre_tokenize_str(lower))
            ids = self.packed([t.id for t in self.model.tokenize(mapped)])
        elif len(word) > 1 and text[-1] in ".,;:!?" and self.plain.fullmatch(lower[:-1]):
            ids = self[word[:-1]] + self[word[-1:]]
        else:
            ids = self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(word) <= CACHED_BYTES:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def of_text(self, data: bytes) -> bytes:
        if b"<|" in data:  # may spell a special token, which lower-casing would change
            return self.packed(self.tokenizer.encode(data.decode("utf-8"), add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, data.lower().split()))


@lru_cache(maxsize=1)
def word_ids(path: str, width: int) -> WordIds:
    """One cache for each Python worker, kept from task to task."""
    return WordIds(path, width)


def id_width(path: str) -> int:
    """Bytes that hold every id of the vocabulary."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``row, doc_id, source, n, ids`` from ``doc_id, source, text``, written once."""
    width = id_width(tokenizer)
    fields = {f.name: f.dataType for f in docs.schema}

    def tokenise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer, width)
        end = words.packed([end_id])
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            begin, ids, size = 0, [], 0
            for i in range(batch.num_rows):
                ids.append(words.of_text(texts[i].as_py() or b"") + end)
                size += len(ids[-1])
                if size > BATCH_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(begin, i + 1 - begin)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id"),
                            part.column("source"),
                            pa.array([len(x) // width for x in ids], pa.int64()),
                            pa.array(ids, pa.binary()),
                        ],
                        names=["doc_id", "source", "n", "ids"],
                    )
                    begin, ids, size = i + 1, [], 0

    schema = f"doc_id {fields['doc_id'].simpleString()}, source string, n bigint, ids binary"
    made = docs.select("doc_id", "source", "text").mapInArrow(tokenise, schema)
    return settle(made.withColumn("row", F.monotonically_increasing_id()), "tokens")


def with_running_total(rows: DataFrame, order: list[str], size: str, within: list[str], name: str) -> DataFrame:
    """``rows`` with ``end``: the running total of ``size`` in ``order``, separately for each ``within``.

    ``within`` must lead ``order``, and ``order`` must be total.  Rows are range-partitioned; only one sum
    per partition (and ``within``) is added up across partitions.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = settle(ranged.withColumn("_part", F.spark_partition_id()), name)
    sums = ranged.groupBy("_part", *within).agg(F.sum(size).alias("_sum"))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", *within, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_inside", F.sum(size).over(inside))
    keys = summed["_part"] == starts["_part"]
    for c in within:
        keys = keys & summed[c].eqNullSafe(starts[c])
    joined = summed.join(starts.select("_part", *within, "_before"), keys)
    return joined.select(*[summed[c] for c in ranged.columns if c != "_part"], (F.col("_before") + F.col("_inside")).alias("end"))


def serve(counts: DataFrame, *, window: int, chunk: int, shares: dict[str, float] | None = None) -> DataFrame:
    """Chunks in the order deficit round-robin serves them.

    ``counts`` has ``row, doc_id, source, n``.  Adds ``first, size`` (the chunk), ``round`` (the window that
    sends it) and ``end`` (its end in the served stream).  Without ``shares`` every source gets its share of all
    tokens, so all queues drain together; otherwise sources with no share follow after the named ones.
    """
    chunks = counts.select(
        "row", "doc_id", "source", "n", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {chunk}"))).alias("k")
    ).select("row", "source", (F.col("k") * chunk).alias("first"), F.least(F.lit(chunk), F.col("n") - F.col("k") * chunk).alias("size"))
    queued = with_running_total(chunks, ["source", "row", "first"], "size", ["source"], "queues").withColumnRenamed("end", "c")
    if shares is None:
        totals = counts.groupBy("source").agg(F.sum("n").alias("_n"))
        whole = counts.agg(F.coalesce(F.sum("n"), F.lit(1)).alias("n")).first()["n"]
        weights = totals.select(F.col("source").alias("_source"), (F.col("_n") / F.lit(float(whole))).alias("share"))
        queued = queued.join(weights, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    else:
        total = sum(shares.values())
        if total <= 0 or min(shares.values()) < 0:
            raise ValueError("shares must be positive")
        given = [(s, v / total) for s, v in shares.items() if v > 0]
        weights = counts.sparkSession.createDataFrame(given, "_source string, share double")
        queued = queued.join(F.broadcast(weights), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    # in windows, when the source has sent as much: every prefix of the stream has the mixture, but for the chunks in turn
    rounds = queued.withColumn("moment", F.col("c") / (F.col("share") * window))
    rounds = rounds.withColumn("round", F.coalesce(F.ceil("moment") - 1, F.lit(2**62)))
    return with_running_total(rounds, ["round", "moment", "source", "c"], "size", [], "stream")


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    end_id: int = 2,
    length: int = 4096,
    window: int | None = None,
    chunk: int = 1024,
    shares: dict[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Pieces of documents: ``doc_id, source, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers.  ``window`` is the number of tokens
    over which the mixture is kept (16 sequences unless given).
    """
    if not 0 < chunk <= length:
        raise ValueError("a chunk must fit into a sequence")
    docs = pick(docs, doc_id=id_col, source=source_col, text=text_col).withColumn("source", F.col("source").cast("string"))
    tokens = token_table(docs, tokenizer, end_id)
    served = serve(tokens.select("row", "doc_id", "source", "n"), window=window or 16 * length, chunk=chunk, shares=shares)
    begin = F.col("end") - F.col("size")
    cut = served.withColumn("begin", begin).withColumn(
        "sequence_id", F.explode(F.sequence(F.expr(f"begin div {length}"), F.expr(f"(end - 1) div {length}")))
    )
    low = F.greatest(F.col("begin"), F.col("sequence_id") * length)
    high = F.least(F.col("end"), (F.col("sequence_id") + 1) * length)
    pieces = (
        cut.select(
            "row", "sequence_id",
            (F.col("begin") - F.col("first")).alias("shift"),  # the same for chunks that follow each other in the stream
            (F.col("first") + low - F.col("begin")).alias("start"),
            (high - low).alias("length"),
            (low - F.col("sequence_id") * length).alias("offset"),
        )
        .groupBy("row", "shift", "sequence_id")  # chunks of a document that stay together are one piece
        .agg(F.min("start").alias("start"), F.sum("length").alias("length"), F.min("offset").alias("offset"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    )
    width = id_width(tokenizer)
    kind = {f.name: f.dataType for f in tokens.schema}["doc_id"].simpleString()
    names = ["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("ids", "n", "pieces")]
            at, rest, size = [], [], 0
            for i in range(batch.num_rows):
                ids = np.frombuffer(columns[0][i].as_py(), dtype=f"<u{width}").astype("<u4")
                for p in columns[2][i].as_py():
                    part = ids[p["start"] : p["start"] + p["length"]].tobytes()
                    at.append(i)
                    rest.append((p["start"], p["length"], part, columns[1][i].as_py(), p["sequence_id"], p["offset"]))
                    size += len(part)
                if at and (size > BATCH_BYTES or i + 1 == batch.num_rows):
                    picked = pa.array(at, pa.int64())
                    made = [pa.array(v, pa.binary() if k == 2 else pa.int64()) for k, v in enumerate(zip(*rest, strict=True))]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(picked), batch.column("source").take(picked), *made], names=names)
                    at, rest, size = [], [], 0

    schema = f"doc_id {kind}, source string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return tokens.join(pieces, "row").select("doc_id", "source", "n", "ids", "pieces").mapInArrow(slices, schema)
