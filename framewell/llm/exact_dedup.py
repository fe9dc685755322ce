"""Exact deduplication by a 128-bit content hash, with the texts themselves compared.

Built-in functions only.  Documents are grouped by the hash *and* the normalised
text, so Spark's own byte comparison of grouping keys separates colliding texts;
copies fold into one row per task before the shuffle, so a group that holds a
third of the corpus stays small.  Rows then find their class by the hash alone.
Where two different texts share a hash (a collision), the rows of that hash are
joined by their text instead.

Defined cases: a null text counts as empty; empty texts are copies of each other;
a null id is never the one kept unless all ids of its class are null (then
``keep_id`` is null and nothing of the class is marked as kept); rows that repeat
an id and a text are all marked as kept by :func:`duplicate_classes`, and
:func:`deduplicate` returns one of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.llm.common import join_classes, join_sized, pick
from framewell.plans.settle import settle

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null as empty, every run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def duplicate_classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256, same`` (the class's hash)."""
    rows = pick(docs, id=id_col, text=text_col).select("id", normalised(F.col("text")).alias("norm"))
    hashed = rows.withColumn("same", digest(F.col("norm")))
    classes = settle(
        hashed.groupBy("same", "norm")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("same", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256")),
        "classes",
    )
    collided = settle(
        classes.groupBy("same").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("same"), "collided"
    )
    keys = settle(hashed.select("id", "same"), "hashes")
    if collided.isEmpty():
        found = join_classes(keys, classes, "same", "group_size")
    else:
        clean = join_classes(keys.join(collided, "same", "left_anti"), classes.join(collided, "same", "left_anti"), "same", "group_size")
        apart = hashed.join(collided, "same", "left_semi")
        again = apart.groupBy("same", "norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        texts = apart.join(again, ["same", "norm"]).withColumn("text_sha256", F.sha2("norm", 256)).drop("norm")
        found = clean.unionByName(texts)
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        "text_sha256",
        "same",
    )


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the copies: of equal texts the row with the smallest id, whole.

    Only ids and hashes travel to decide; the documents are then filtered by a
    join with the ids to drop, broadcast if small.  Rows without an id are told
    apart by their text.
    """
    classes = settle(duplicate_classes(docs, id_col=id_col, text_col=text_col), "kept")
    ids = classes.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(id_col).alias("ids"), F.count(id_col).alias("named")
    ).first()
    if ids["rows"] == ids["ids"]:
        gone = classes.where(~F.col("kept")).select(id_col)
        return join_sized(docs, gone, id_col, F.lit(16), "gone", "left_anti")
    # ids repeat or are missing: choose among whole rows of equal text, folded before the shuffle
    columns = docs.columns
    text = normalised(F.col(f"`{text_col}`"))
    rows = docs.select(text.alias("_norm"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
    order = F.struct(F.col(f"_row.`{id_col}`").isNull(), F.col(f"_row.`{id_col}`"))
    best = rows.groupBy("_norm").agg(F.min_by("_row", order).alias("_row"))
    return best.select(*[F.col(f"_row.`{c}`").alias(c) for c in columns])
