"""Numbers used to judge a calibration run: summaries, histograms, limits, profiles.

Histogram functions read their input twice (range, then counts).  Pass settled
or stored tables when the input is expensive.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.functions.columns import NAN, as_col, finite_or_null, keep_where
from framewell.functions.quantiles import exact_quantile, exact_quantiles
from framewell.geometry import Geometry
from framewell.operators.offsets import PIXEL
from framewell.plans.settle import settle

# Bins, percentile ranges and fields of the standard diagnostics.
MAP_BINS, FRAME_BINS = 200, 100
RANGE_PERCENTILES = (0.005, 0.995)
PREFERRED_FIELDS = ("adu_seed", "adu_sum")


def _number(value: Column | str) -> Column:
    return finite_or_null(as_col(value).cast("double"))


def _not_nan(value: Column | str) -> Column:
    c = as_col(value).cast("double")
    return F.when(~F.isnan(c), c)


def pool(*columns: tuple[DataFrame, str]) -> DataFrame:
    """Values of several tables as one column ``value``."""
    parts = [df.select(F.col(c).cast("double").alias("value")) for df, c in columns]
    return reduce(DataFrame.unionAll, parts)


def summary(df: DataFrame, value: str, *, where: Column | None = None) -> DataFrame:
    """Mean, population spread and median of the finite values (per-pixel or smaller tables)."""
    v = _number(value) if where is None else F.when(where, _number(value))
    return df.agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
        F.percentile(v, F.lit(0.5)).alias("median"),
    )


# -- histograms -------------------------------------------------------------------------------
def histogram(df: DataFrame, value: Column | str, low: Column, high: Column, bins: int) -> DataFrame:
    """Counts in ``bins`` equal bins over ``[low, high]``: ``bin, lower, upper, n``.

    Values outside are dropped, the last bin includes its upper edge, empty bins
    are listed.  An empty range is widened by one half on both sides.  ``low`` and
    ``high`` are one-row scalars.
    """
    spark = df.sparkSession
    flat = high == low
    lo = F.when(flat, low - 0.5).otherwise(low)
    hi = F.when(flat, high + 0.5).otherwise(high)
    v = as_col(value).cast("double")
    inside = df.select(v.alias("v"), lo.alias("lo"), hi.alias("hi")).where(F.col("v").between(F.col("lo"), F.col("hi")))
    place = F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = inside.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"), lo.alias("lo"), hi.alias("hi"))
    step = (F.col("hi") - F.col("lo")) / bins
    return edges.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * step).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("upper"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def _span(df: DataFrame, low: Column, high: Column) -> tuple[Column, Column]:
    """Both ends of a range as scalars of one written row, found in one pass."""
    ends = settle(df.agg(low.alias("low"), high.alias("high")), "span")
    return ends.select("low").scalar(), ends.select("high").scalar()


def percentile_histogram(df: DataFrame, value: str, *, where: Column | None = None, bins: int = MAP_BINS) -> DataFrame:
    """Histogram of a per-pixel map over its central 99 percent."""
    v = _not_nan(value) if where is None else F.when(where, _not_nan(value))
    return histogram(df, v, *_span(df, *[F.percentile(v, F.lit(q)) for q in RANGE_PERCENTILES]), bins)


def noise_histogram(
    noise_map: DataFrame, geometry: Geometry, *, usable_only: bool = False, bins: int = MAP_BINS
) -> DataFrame:
    """Histogram of active noise from 0 to its 99.5th percentile.

    ``usable_only`` limits it to finite, positive noise.
    """
    v = F.when(geometry.is_active("x"), _number("noise") if usable_only else _not_nan("noise"))
    if usable_only:
        v = F.when(v > 0, v)
    return histogram(noise_map, v, *_span(noise_map, F.lit(0.0), F.percentile(v, F.lit(RANGE_PERCENTILES[1]))), bins)


def full_histogram(df: DataFrame, value: str, *, bins: int = FRAME_BINS) -> DataFrame:
    """Histogram of the finite values from their minimum to their maximum."""
    v = _number(value)
    return histogram(df, v, *_span(df, F.min(v), F.max(v)), bins)


def adjusted_edges(df: DataFrame, edges: Sequence[float], value: str | None = None) -> DataFrame:
    """As many bin edges as given, spread over the central 99 percent: ``i, edge``.

    Without ``value`` the first of ``adu_seed``, ``adu_sum`` or any numeric column
    is used.  Without finite values the edges stay as they are.
    """
    spark = df.sparkSession
    given = spark.createDataFrame([(i, float(e)) for i, e in enumerate(edges)], "i int, given double")
    if value is None:
        numeric = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("string", "array", "map", "struct")]
        value = next((c for c in PREFERRED_FIELDS if c in df.columns), numeric[0] if numeric else None)
    if value is None:
        return given.select("i", F.col("given").alias("edge"))
    numbers = df.select(F.lit("all").alias("of"), _number(value).alias("v"))
    found = settle(exact_quantiles(numbers, "v", RANGE_PERCENTILES, ["of"]), "edges")
    lo, hi = (found.where(F.col("i") == i).select("quantile").scalar() for i in (0, 1))
    last = max(len(edges) - 1, 1)
    spread = lo + (hi - lo) * F.col("i") / last
    return given.select("i", F.coalesce(F.nanvl(spread, "given"), "given").alias("edge"))


# -- display limits -----------------------------------------------------------------------------
def map_limits(values: DataFrame, probabilities: Sequence[float], *, nan_result: bool = True) -> DataFrame:
    """Percentiles of ``value`` over per-pixel maps as columns ``p<percent>``.

    One NaN makes them NaN, unless ``nan_result`` is False.
    """
    n_nan = F.count_if(F.isnan("value"))
    v = _not_nan("value")
    columns = []
    for p in probabilities:
        q = F.percentile(v, F.lit(p))
        if nan_result:
            q = F.when(n_nan > 0, F.lit(NAN)).otherwise(q)
        columns.append(q.alias(f"p{p * 100:g}".replace(".", "_")))
    return values.agg(*columns)


def cm_limits(cm: DataFrame, *, percentile: float = 0.99) -> DataFrame:
    """99th percentile of the absolute common mode, per block where there are blocks.

    Grows with the number of frames, so ranks are found by counting.
    """
    keys = [c for c in ("asic",) if c in cm.columns]
    if not keys:
        cm, keys = cm.withColumn("asic", F.lit("row")), ["asic"]
    sizes = cm.select(*keys, F.abs("cm").alias("size"))
    return exact_quantile(sizes, "size", percentile, keys).withColumnRenamed("quantile", "limit")


# -- maps and profiles ---------------------------------------------------------------------------
def offset_difference(pixels: DataFrame, geometry: Geometry) -> DataFrame:
    """Median minus clipped offset per pixel, NaN outside the active region."""
    diff = F.col("offset_median") - F.col("offset_sigclip")
    return pixels.select(*PIXEL, keep_where(geometry.is_active("x"), diff).alias("diff"))


def cm_frame_average(cm: DataFrame) -> DataFrame:
    """Average common mode of each frame (and block); NaN if any line has none."""
    keys = [c for c in ("file_id", "frame_id", "asic") if c in cm.columns]
    return cm.groupBy(*keys).agg(F.avg(F.col("cm").cast("double")).alias("avg_cm"))


def cm_noise_profile(cm_noise: DataFrame) -> DataFrame:
    """Common-mode noise along y, block by block."""
    return cm_noise.orderBy(*[c for c in ("asic", "y") if c in cm_noise.columns])


def clip_map_summary(pixels: DataFrame) -> DataFrame:
    """Average of the clip map and the upper end of its scale (at least 1)."""
    clipped = F.col("n_clipped")
    top = F.max(clipped).cast("bigint")
    return pixels.agg(F.avg(clipped.cast("double")).alias("avg_clipped"), F.greatest(top, F.lit(1)).alias("scale_max"))


def noise_without_bad(pixels: DataFrame) -> DataFrame:
    """Noise with bad pixels as NaN."""
    return pixels.select(*PIXEL, keep_where(~F.coalesce("is_bad", F.lit(False)), "noise").alias("noise"))


def mask_size(pixels: DataFrame) -> DataFrame:
    """Number of bad pixels."""
    return pixels.agg(F.count_if("is_bad").alias("n_bad"))


def stored_diagnostics(stored, geometry: Geometry) -> dict[str, DataFrame]:
    """All diagnostics that a loaded calibration set allows, nothing recomputed from frames."""
    pixels = stored.pixels
    out: dict[str, DataFrame] = {}
    present = [c for c in ("offset_median", "offset_sigclip") if c in pixels.columns]
    for name in present:
        out[f"{name}_histogram"] = full_histogram(pixels, name)
        out[f"{name}_summary"] = summary(pixels, name)
        values = pool((pixels, name))
        out[f"{name}_limits"] = map_limits(values, (0.01, 0.99), nan_result=False)
    if len(present) == 2:
        diff = offset_difference(pixels, geometry)
        out["difference_histogram"] = full_histogram(diff, "diff")
        absolute = diff.select(F.abs("diff").alias("value"))
        out["difference_limits"] = map_limits(absolute, (0.99,), nan_result=False)
    out["noise_histogram"] = full_histogram(pixels, "noise")
    out["noise_summary"] = summary(pixels, "noise")
    out["noise_limits"] = map_limits(pool((pixels, "noise")), (0.01, 0.99), nan_result=False)
    if "n_clipped" in pixels.columns:
        out["clip_summary"] = clip_map_summary(pixels)
        out["clip_limits"] = map_limits(pool((pixels, "n_clipped")), (0.95,), nan_result=False)
    if "is_bad" in pixels.columns:
        out["noise_without_bad"] = noise_without_bad(pixels)
        out["mask_size"] = mask_size(pixels)
    if stored.cm_map is not None:
        out["cm_frame_average"] = cm_frame_average(stored.cm_map)
        out["cm_limits"] = cm_limits(stored.cm_map)
    if stored.cm_noise is not None:
        out["cm_noise_profile"] = cm_noise_profile(stored.cm_noise)
    return out
