"""Per-pixel noise: spread of corrected values over frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.functions.columns import f32, is_valid_adc, nan_if_null
from framewell.geometry import Geometry
from framewell.operators.offsets import PIXEL, on_grid
from framewell.plans.joins import join_bounded
from framewell.sources.frames import frame_count


def noise_all_frames(corrected: DataFrame, geometry: Geometry) -> DataFrame:
    """Sample spread over all frames, sentinels included; NaN for a single frame."""
    spread = corrected.groupBy(*PIXEL).agg(F.stddev_samp("value").alias("noise"))
    return on_grid(spread, geometry).select(*PIXEL, nan_if_null("noise", "float").alias("noise"))


def noise_kept(corrected: DataFrame, geometry: Geometry, *, keep_max: str = "keep_max") -> DataFrame:
    """Spread over the values that survived clipping, plus how many there were.

    ``corrected`` carries ``adc`` and the pixel's ``keep_max``.  The count is
    floored at two before it divides, so one survivor of value ``d`` gives
    ``|d|/2`` and none gives 0.
    """
    kept = is_valid_adc("adc", geometry) & (F.col("adc") <= F.col(keep_max))
    value = F.when(kept, F.col("value").cast("double"))
    sums = corrected.groupBy(*PIXEL).agg(
        F.count(value).alias("n_kept"),
        F.stddev_samp(value).alias("spread"),
        F.sum(value).alias("total"),
    )
    noise = (
        F.when(F.col("n_kept") >= 2, F.col("spread"))
        .when(F.col("n_kept") == 1, F.abs("total") / 2)
        .otherwise(F.lit(0.0))
    )
    return on_grid(sums, geometry).select(
        *PIXEL,
        f32(F.coalesce(noise, F.lit(0.0))).alias("noise"),
        F.coalesce("n_kept", F.lit(0).cast("bigint")).alias("n_kept"),
    )


def kept_summary(noise: DataFrame, n_frames: int | Column) -> DataFrame:
    """Average number (and percent) of frames kept per pixel."""
    frames = F.lit(n_frames) if isinstance(n_frames, int) else n_frames
    mean = F.avg("n_kept")
    return noise.agg(
        mean.alias("avg_kept"), (mean / F.greatest(frames, F.lit(1)) * 100.0).alias("avg_kept_percent")
    )


def residual_noise(
    pixels: DataFrame, offsets: DataFrame, geometry: Geometry, *, offset: str = "offset_median", n_frames: int | None = None
) -> DataFrame:
    """Sample spread of ``adc - offset`` over valid values, no common mode removed.

    NaN with fewer than two valid values; fewer than two frames is an error.
    When the histogram exists already, ``histogram_noise`` gives the same.
    """
    if n_frames is None:
        n_frames = frame_count(pixels.where(F.col("x") == 0))
    if n_frames < 2:
        raise ValueError("at least two frames are needed for a noise estimate")
    valid = pixels.where(is_valid_adc("adc", geometry))
    side = offsets.select(*PIXEL, f32(offset).alias("_offset"))
    joined = join_bounded(valid, side, PIXEL, rows=geometry.n_pixels, row_bytes=48)
    spread = joined.groupBy(*PIXEL).agg(F.stddev_samp(f32("adc") - F.col("_offset")).alias("noise"))
    return on_grid(spread, geometry).select(*PIXEL, nan_if_null("noise", "float").alias("noise"))
