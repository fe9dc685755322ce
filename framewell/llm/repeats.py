"""Rows that repeat another document's key, found by one sort.

All rows are range-partitioned and sorted by key and document, so a key that very many
rows share is spread over as many partitions as it fills, and every row is compared with
the first of its key in the task.  Where a key goes on from one partition into the next,
two rows for each partition tell which document has it first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.plans.settle import settle


def _same(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Equality in which nulls are equal to each other."""
    equal = pc.fill_null(pc.equal(left, right), False).to_numpy(zero_copy_only=False)
    return equal | (left.is_null().to_numpy(zero_copy_only=False) & right.is_null().to_numpy(zero_copy_only=False))


def _same_document(left: pa.RecordBatch, right: pa.RecordBatch) -> np.ndarray:
    """Of one id; without an id, of one text."""
    ids = left.column("doc_id")
    texts = _same(left.column("_text"), right.column("_text"))
    return _same(ids, right.column("doc_id")) & (texts | ids.is_valid().to_numpy(zero_copy_only=False))


def later_rows(rows: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """``doc_id, _text`` and the carried columns of every row whose key an earlier document has.

    Documents are ordered by id, those without one come last, by text.  ``rows`` should be
    read from a settled table, as its ranges are sampled before it is sorted; the result reads
    one, which belongs to the scope around.  The integer ``keys`` must not be null.  Rows of the first document of a key are
    not returned, whatever their places.
    """
    schema = {f.name: f.dataType.simpleString() for f in rows.schema}
    order = [F.col(k) for k in keys] + [F.col("doc_id").asc_nulls_last(), F.col("_text")]
    arranged = rows.select(*keys, "doc_id", "_text", *carried).repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["part", "what", *keys, "doc_id", "_text", *carried]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def told(batch: pa.RecordBatch, what: str, with_keys: bool = False) -> pa.RecordBatch:
            n = batch.num_rows
            held = [batch.column(k) if with_keys else pa.nulls(n, batch.column(k).type) for k in keys]
            rest = [batch.column(c) for c in ("doc_id", "_text", *carried)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array([what] * n, pa.string()), *held, *rest], names=names)

        opening = lead = None  # the first row of the partition, and of the key at hand
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if opening is None:
                opening = lead = batch.slice(0, 1)
                yield told(opening, "first", True)
            values = [np.concatenate([lead.column(k).to_numpy(), batch.column(k).to_numpy()]) for k in keys]
            new = np.any([v[1:] != v[:-1] for v in values], axis=0)
            leader = np.maximum.accumulate(np.where(new, np.arange(1, n + 1), 0))
            both = pa.Table.from_batches([lead, batch]).combine_chunks().to_batches()[0]
            later = ~_same_document(batch, both.take(pa.array(leader)))
            if later.any():
                yield told(batch.filter(pa.array(later)), "later")
            head = np.all([v[1:] == opening.column(k)[0].as_py() for k, v in zip(keys, values, strict=True)], axis=0) & ~later
            if head.any():  # of the partition's first document: later ones where an earlier partition has the key
                yield told(batch.filter(pa.array(head)), "head")
            lead = both.slice(int(leader[-1]), 1)
        if lead is not None:
            yield told(lead, "last", True)

    shape = ", ".join(["part int", "what string", *[f"{c} {schema[c]}" for c in names[2:]]])
    compared = settle(arranged.mapInArrow(compare, shape), "compared")
    ends = compared.where("what IN ('first', 'last')").select("part", "what", *keys, "doc_id", "_text").collect()
    ends.sort(key=lambda r: (r["part"], r["what"] == "last"))
    key = lambda r: tuple(r[k] for k in keys)
    begun, going_on = None, []
    for first, last in zip(ends[::2], ends[1::2], strict=True):
        goes_on = begun is not None and key(begun) == key(first)
        if goes_on and (begun["doc_id"] != first["doc_id"] or (begun["doc_id"] is None and begun["_text"] != first["_text"])):
            going_on.append(first["part"])
        if not (goes_on and key(last) == key(first)):
            begun = last
    wanted = F.col("what") == "later"
    if going_on:
        wanted = wanted | ((F.col("what") == "head") & F.col("part").isin(going_on))
    return compared.where(wanted).select("doc_id", "_text", *carried)
