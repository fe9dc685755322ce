"""Readout blocks of any place and width: an interval table, joined by cover buckets.

Blocks are rows ``asic, x0, x1`` (``x1`` exclusive); they may leave gaps and have unequal
widths, but must not overlap.  A pixel finds its block by a range condition.  That would
compare every pixel with every block, so both sides are dealt into buckets of columns:
a block is listed in each bucket that it covers, a pixel is in one, and the range is
tested among the few blocks of that bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.functions.columns import finite_or_null, int_div, is_finite, nan_if_null
from framewell.functions.row_median import irregular_medians
from framewell.geometry import Geometry
from framewell.operators.common_mode import with_line_arrays
from framewell.plans.joins import join_counted
from framewell.sources.frames import FRAME_KEY

Slices = Sequence[tuple[str, int, int]]
BUCKET = 16


def checked(slices: Slices, width: int) -> list[tuple[str, int, int]]:
    """The blocks by place; an empty, overlapping or protruding block, or a name given twice, is an error."""
    ordered = sorted(((str(n), int(a), int(b)) for n, a, b in slices), key=lambda s: s[1])
    names = [n for n, _, _ in ordered]
    if len(set(names)) < len(names):
        raise ValueError("block names must differ")
    end = 0
    for name, x0, x1 in ordered:
        if not end <= x0 < x1 <= width:
            raise ValueError(f"block {name} [{x0}, {x1}) is empty, outside the {width} columns or overlaps another")
        end = x1
    return ordered


def slice_table(spark: SparkSession, slices: Slices, width: int) -> DataFrame:
    """``asic, x0, x1, bucket``: a row for each bucket of columns that a block covers."""
    rows = spark.createDataFrame(checked(slices, width), "asic string, x0 int, x1 int")
    buckets = F.sequence(int_div("x0", BUCKET), int_div(F.col("x1") - 1, BUCKET))
    return rows.select("asic", "x0", "x1", F.explode(buckets).alias("bucket"))


def with_slice(pixels: DataFrame, slices: Slices, width: int) -> DataFrame:
    """``pixels`` with the ``asic`` of their column, null in gaps."""
    table = slice_table(pixels.sparkSession, slices, width).withColumnRenamed("bucket", "_bucket")
    keyed = pixels.withColumn("_bucket", int_div("x", BUCKET))
    mine = pixels.sparkSession.createDataFrame([(x,) for x in range(width)], "x int").withColumn("_bucket", int_div("x", BUCKET))
    # one row a column that lies in a block: the join with the pixels is then by equality alone
    inside = mine.join(table, "_bucket").where((F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1"))).select("x", "asic")
    return join_counted(keyed.drop("_bucket"), inside, ["x"], "left")


def irregular_cm_map(
    rows: DataFrame, offsets: DataFrame, geometry: Geometry, slices: Slices, *, offset: str = "offset", exclude_sentinels: bool = True
) -> DataFrame:
    """Common mode per line and block, ``file_id, frame_id, y, asic, cm``: the median of the block's residuals.

    One narrow pass over whole lines, as with equal blocks; NaN where a block has no usable pixel.
    """
    ordered = checked(slices, geometry.width)
    maps = offsets.select("y", "x", F.col(offset).cast("float").alias("offset"))
    medians = irregular_medians(
        geometry.width, [(a, b) for _, a, b in ordered], sentinels=(geometry.underflow, geometry.overflow) if exclude_sentinels else None,
        skip_nan=exclude_sentinels,
    )
    lines = with_line_arrays(rows, maps, geometry, ["offset"]).withColumn("cm", medians("pixels", "offset"))
    names = F.array(*[F.lit(n) for n, _, _ in ordered])
    cells = F.arrays_zip(names.alias("asic"), F.col("cm").alias("cm"))
    return lines.select(*FRAME_KEY, "y", F.explode(cells).alias("c")).select(*FRAME_KEY, "y", F.col("c.asic").alias("asic"), F.col("c.cm").alias("cm"))


def slice_statistics(values: DataFrame, slices: Slices, width: int, *, value: str = "value") -> DataFrame:
    """``asic, n, mean, std`` of the finite values in each block (``asic`` null: the gaps)."""
    v = finite_or_null(F.col(value).cast("double"))
    grouped = with_slice(values, slices, width).groupBy("asic")
    return grouped.agg(F.count_if(is_finite(value)).alias("n"), nan_if_null(F.avg(v)).alias("mean"), nan_if_null(F.stddev_pop(v)).alias("std"))
