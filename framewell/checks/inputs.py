"""Frames derived from the shared test tables.

``events`` holds one value per row and becomes frames in long form;
``embeddings`` holds one vector per row and becomes readout lines; ``lineitem``
gives many samples per pixel for the per-pixel statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.functions.columns import int_div
from framewell.geometry import Geometry
from framewell.sources.frames import complete_frames

EVENTS = Geometry(height=8, width=16, n_asics=2)
EMBEDDINGS = Geometry(height=10, width=64, n_asics=8)
LINEITEM = Geometry(height=16, width=64, n_asics=8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_event_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pixel per event, the last frame possibly incomplete."""
    within = F.col("event_id") % EVENTS.n_pixels
    adc = F.when(F.col("value") >= 250, F.lit(EVENTS.overflow)).otherwise(F.floor(F.col("value") * 10))
    return table(spark, sf_dir, "events").select(
        F.lit(0).alias("file_id"),
        F.call_function("div", F.col("event_id"), F.lit(EVENTS.n_pixels)).alias("frame_id"),
        int_div(within, EVENTS.width).alias("y"),
        (F.col("event_id") % EVENTS.width).cast("int").alias("x"),
        adc.cast("int").alias("adc"),
    )


def event_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_frames(all_event_pixels(spark, sf_dir), EVENTS, long_form=True)


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One readout line per vector, values scaled to whole numbers."""
    h = EMBEDDINGS.height
    return table(spark, sf_dir, "embeddings").select(
        F.lit(0).alias("file_id"),
        F.call_function("div", F.col("vec_id"), F.lit(h)).alias("frame_id"),
        (F.col("vec_id") % h).cast("int").alias("y"),
        F.transform("embedding", lambda e: F.floor(2000 + 200 * e.cast("double")).cast("int")).alias("pixels"),
    )


def lineitem_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several samples per pixel: only for per-pixel statistics."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % LINEITEM.height).cast("int").alias("y"),
        (F.col("l_partkey") % LINEITEM.width).cast("int").alias("x"),
        (F.col("l_quantity") * 100).cast("int").alias("adc"),
    )


def event_occupancy(pixels: DataFrame) -> DataFrame:
    """Hits per pixel and mean of the valid values."""
    valid = ~F.col("adc").isin(EVENTS.underflow, EVENTS.overflow)
    return (
        pixels.groupBy("y", "x")
        .agg(F.count_if(F.col("adc") > 1000).alias("hit_count"), F.avg(F.when(valid, F.col("adc"))).alias("mean_adu"))
    )
