"""Per-pixel baselines from the value histogram of each pixel.

ADC values are whole numbers, so ``(y, x, adc, n)`` holds everything that the
median, the clipped mean and the raw noise need.  Building it is the only step
that touches the frames: one scan, partial counts in the tasks, one shuffle.
A pixel has at most ``2**n_bits`` distinct values, whatever the number of
frames, so all later groups are bounded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.functions.columns import INF, NAN, f32, is_valid_adc
from framewell.functions.value_counts import clip_rounds, weighted_median, weighted_spread
from framewell.geometry import Geometry
from framewell.plans.settle import settle

PIXEL = ["y", "x"]
# A mean that moved by less than this (squared) counts as settled.
MEAN_TOLERANCE = 1e-6


def pixel_histogram(pixels: DataFrame, geometry: Geometry) -> DataFrame:
    """``(y, x, adc, n)``: how often each pixel showed each valid ADC value."""
    return (
        pixels.where(is_valid_adc("adc", geometry))
        .groupBy(*PIXEL, "adc")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def on_grid(per_pixel: DataFrame, geometry: Geometry) -> DataFrame:
    """One row for every pixel of the detector, NULL where nothing was measured."""
    return geometry.grid(per_pixel.sparkSession).join(per_pixel, PIXEL, "left")


def pixel_values(histogram: DataFrame) -> DataFrame:
    """``(y, x, values)``: the counted values of each pixel as one list, ascending.

    At most ``2**n_bits`` entries per pixel and ``height * width`` rows in all.
    """
    counted = F.struct("adc", "n")
    return histogram.groupBy(*PIXEL).agg(F.sort_array(F.collect_list(counted)).alias("values"))


def _as_offset(value: Column | str, name: str) -> Column:
    return F.coalesce(f32(value), f32(F.lit(NAN))).alias(name)


def median_offset(histogram: DataFrame, geometry: Geometry) -> DataFrame:
    """Exact median of the valid values; NaN for a pixel that never had one."""
    medians = pixel_values(histogram).select(*PIXEL, weighted_median("values.adc", "values.n").alias("median"))
    return on_grid(medians, geometry).select(*PIXEL, _as_offset("median", "offset_median"))


def histogram_noise(histogram: DataFrame, geometry: Geometry) -> DataFrame:
    """Sample standard deviation of the valid values about their offset.

    Shifting by a constant does not change it, so the histogram suffices.
    NaN with fewer than two valid values.
    """
    spread = pixel_values(histogram).select(*PIXEL, weighted_spread("values.adc", "values.n").alias("noise"))
    return on_grid(spread, geometry).select(*PIXEL, _as_offset("noise", "noise"))


# -- iterative upper-tail clipping ---------------------------------------------------------
@dataclass(frozen=True)
class ClipResult:
    """``per_pixel(y, x, offset_sigclip, n_clipped, n_kept, keep_max)`` and
    ``trace(iteration, n_clipped, n_changed)``, one row per executed iteration.

    A value was kept exactly when it is valid and ``<= keep_max``.
    """

    per_pixel: DataFrame
    trace: DataFrame


def clip_states(histogram: DataFrame, n_sigma: float, max_iter: int) -> DataFrame:
    """Median and the state after each of ``max_iter`` clipping rounds, per pixel.

    Survivors can only shrink from above, so one number per pixel and round, the
    lowest limit so far, says who survives.  All rounds work on the pixel's list
    of counted values: one shuffle of the histogram, no rescan.
    """
    listed = pixel_values(histogram)
    value, n = F.col("values.adc"), F.col("values.n")
    return listed.select(
        *PIXEL,
        weighted_median(value, n).alias("median"),
        F.aggregate(n, F.lit(0).cast("bigint"), lambda total, k: total + k).alias("n_valid"),
        clip_rounds(n_sigma, max_iter)(value, n).alias("rounds"),
    ).select(
        *PIXEL,
        "median",
        "n_valid",
        "rounds.mu",
        "rounds.keep",
        "rounds.kept",
        F.transform("rounds.shift", lambda d: d * d > MEAN_TOLERANCE).alias("changed"),
    )


def sigma_clip(
    histogram: DataFrame, geometry: Geometry, *, n_sigma: float = 3.0, max_iter: int = 5
) -> ClipResult:
    """Mean of the values left after iterative upper-tail clipping.

    Starts from mean and population spread, continues with sample spread, and
    stops for all pixels together after the first round in which no pixel's
    mean moved.  A pixel without valid values gets offset 0 and keeps nothing.
    """
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    states = settle(clip_states(histogram, n_sigma, max_iter), "clip_states")
    return _finish_clip(states, geometry, max_iter)


def _finish_clip(states: DataFrame, geometry: Geometry, max_iter: int) -> ClipResult:
    totals = states.agg(
        F.array(*[F.count_if(F.element_at("changed", k)) for k in range(1, max_iter + 1)]).alias("n_changed"),
        F.array(
            *[
                F.coalesce(F.sum(F.col("n_valid") - F.element_at("kept", k)), F.lit(0).cast("bigint"))
                for k in range(1, max_iter + 1)
            ]
        ).alias("n_clipped"),
    )
    first_still = F.array_position("n_changed", F.lit(0).cast("bigint")).cast("int")
    totals = totals.withColumn("stop", F.when(first_still > 0, first_still).otherwise(F.lit(max_iter)))
    stop = totals.select("stop").scalar()

    at_stop = lambda c: F.element_at(F.col(c), F.col("stop"))
    chosen = states.withColumn("stop", stop).select(
        *PIXEL,
        at_stop("mu").alias("mu"),
        at_stop("keep").alias("keep_max"),
        at_stop("kept").alias("n_kept"),
        (F.col("n_valid") - at_stop("kept")).alias("n_clipped"),
    )
    per_pixel = on_grid(chosen, geometry).select(
        *PIXEL,
        f32(F.coalesce("mu", F.lit(0.0))).alias("offset_sigclip"),
        f32(F.coalesce("n_clipped", F.lit(0))).alias("n_clipped"),
        F.coalesce("n_kept", F.lit(0).cast("bigint")).alias("n_kept"),
        F.coalesce("keep_max", F.lit(-INF)).alias("keep_max"),
    )
    trace = totals.select(
        F.posexplode(F.slice(F.arrays_zip("n_clipped", "n_changed"), F.lit(1), F.col("stop"))).alias("i", "r")
    ).select((F.col("i") + 1).alias("iteration"), "r.n_clipped", "r.n_changed")
    return ClipResult(per_pixel, trace)


def both_offsets(
    histogram: DataFrame, geometry: Geometry, *, n_sigma: float = 3.0, max_iter: int = 5
) -> tuple[DataFrame, ClipResult]:
    """Median and clipped mean from one pass over the histogram."""
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    states = settle(clip_states(histogram, n_sigma, max_iter), "clip_states")
    medians = on_grid(states.select(*PIXEL, "median"), geometry).select(*PIXEL, _as_offset("median", "offset_median"))
    return medians, _finish_clip(states, geometry, max_iter)


def clip_summary(per_pixel: DataFrame, n_frames: int | Column) -> DataFrame:
    """Average and largest number of clipped frames per pixel, and the average in percent."""
    frames = F.lit(n_frames) if isinstance(n_frames, int) else n_frames
    mean = F.avg(F.col("n_clipped").cast("double"))
    return per_pixel.agg(
        mean.alias("avg_clipped"),
        (mean / F.greatest(frames, F.lit(1)) * 100.0).alias("avg_clipped_percent"),
        F.max("n_clipped").cast("bigint").alias("max_clipped"),
    )
