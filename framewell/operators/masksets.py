"""Pixel sets of many runs as stored bitmaps: union, intersection and difference of their masks.

A set is one row per run and bucket of 32,768 pixels, its bitmap built by Spark's bitmap
aggregates, so the masks of a thousand runs of a large detector are a few thousand small
rows and are combined without a row a pixel.  Only a result that is asked for as
coordinates is expanded again, and the detector bounds it.

Defined cases: a null flag is not bad; a pixel listed twice counts once; a run without bad
pixels has one row without a bitmap, so that it empties every intersection; an empty table
gives no sets, and combining none gives none; pixels outside the detector are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.geometry import Geometry

BUCKET = 32_768  # bits of one bitmap of Spark's bitmap functions, a fixed value


def pixel_sets(masks: DataFrame, geometry: Geometry, *, run: str = "run", flag: str = "is_bad") -> DataFrame:
    """``run, bucket, bits`` of the flagged pixels of ``run, y, x, flag``."""
    bad = F.coalesce(F.col(flag), F.lit(False))
    inside = F.col("y").between(0, geometry.height - 1) & F.col("x").between(0, geometry.width - 1)
    number = F.col("y").cast("bigint") * geometry.width + F.col("x") + 1
    checked = F.when(F.coalesce(inside, F.lit(False)), number).otherwise(F.raise_error(F.lit("a pixel outside the detector")).cast("bigint"))
    marked = masks.select(F.col(run).alias("run"), F.when(bad, checked).alias("number"))
    keyed = marked.select("run", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("at"))
    sets = keyed.where("bucket IS NOT NULL").groupBy("run", "bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    empty = keyed.groupBy("run").agg(F.count("bucket").alias("n")).where("n = 0")
    return sets.unionByName(empty.select("run", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bits")))


def union_of(sets: DataFrame) -> DataFrame:
    """``bucket, bits`` of the pixels in any run."""
    return sets.where("bits IS NOT NULL").groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def intersection_of(sets: DataFrame) -> DataFrame:
    """``bucket, bits`` of the pixels in every run; a run without a bucket has none of its pixels."""
    runs = sets.agg(F.count_distinct("run").alias("n")).select("n").scalar()
    each = sets.where("bits IS NOT NULL").groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
    return each.where(F.col("n") == runs).select("bucket", "bits")


def size_of(sets: DataFrame) -> DataFrame:
    """Number of pixels ``n_pixels`` of one set."""
    return sets.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("n_pixels"))


def coordinates(sets: DataFrame, geometry: Geometry) -> DataFrame:
    """``y, x`` of the pixels of one set."""
    hexed = sets.where("bits IS NOT NULL").select("bucket", F.hex("bits").alias("digits"))
    spread = hexed.select("bucket", "digits", F.explode(F.sequence(F.lit(0), F.lit(BUCKET - 1))).alias("at"))
    octet: Column = F.conv(F.substring("digits", F.expr("2 * (at div 8) + 1"), F.lit(2)), 16, 10).cast("int")
    held = spread.where(octet.bitwiseAND(F.expr("shiftleft(1, at % 8)")) != 0)
    number = (F.col("bucket") - 1) * BUCKET + F.col("at")
    width = geometry.width
    return held.select(number.alias("k")).select(F.expr(f"cast(k div {width} AS INT)").alias("y"), F.expr(f"cast(k % {width} AS INT)").alias("x"))


def difference(sets: DataFrame, other: DataFrame, geometry: Geometry) -> DataFrame:
    """``y, x`` of the pixels of one set that are not in the other."""
    return coordinates(sets, geometry).join(coordinates(other, geometry), ["y", "x"], "left_anti")
