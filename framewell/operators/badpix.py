"""Bad-pixel classification.

All inputs are per-pixel tables (at most ``height * width`` rows).  Thresholds
come from a one-row summary of the same table, read as a scalar subquery, so
the table is settled first and never computed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.functions.columns import any_flag, exceeds, falls_below, f32, is_finite
from framewell.geometry import Geometry
from framewell.operators.offsets import PIXEL
from framewell.plans.joins import join_bounded
from framewell.plans.settle import settle

# Fixed values of the category map.
GOOD, HOT, COLD, NON_FINITE, OTHER = 0, 1, 2, 3, 4


def _active(geometry: Geometry, active: str | Column | None) -> Column:
    """Active flag of a pixel: given as a column, or from the masked blocks."""
    if active is None:
        return geometry.is_active("x")
    return F.coalesce(F.col(active) if isinstance(active, str) else active, F.lit(False))


def _median_noise(noise: DataFrame, condition: Column) -> Column:
    """Median of the noise where ``condition`` holds, as a scalar."""
    return noise.agg(F.percentile(F.when(condition, F.col("noise").cast("double")), F.lit(0.5))).scalar()


def _required(value: Column, message: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(message)).cast("double"))


def _usable(noise: Column) -> Column:
    return is_finite(noise) & (noise > 0)


def classify_pixels(
    noise_map: DataFrame,
    geometry: Geometry,
    *,
    n_dark_frames: int = 0,
    hot_rms_multiple: float = 5.0,
    cold_rms_fraction: float = 0.1,
    max_clip_fraction: float | None = 0.5,
    active: str | Column | None = None,
) -> DataFrame:
    """One flag per rule and ``is_bad`` for ``noise_map(y, x, noise [, n_clipped])``.

    Bad are pixels outside the active region, with non-finite noise, active with
    noise <= 0, above ``hot_rms_multiple`` or below ``cold_rms_fraction`` times
    the median noise of active usable pixels, or clipped in more than
    ``max_clip_fraction`` of the frames (only with ``n_clipped`` and a positive
    ``n_dark_frames``).  No usable pixel at all raises.
    """
    noise_map = settle(noise_map, "noise_map")
    on = _active(geometry, active)
    noise = F.col("noise")
    median = _required(_median_noise(noise_map, on & _usable(noise)), "no usable pixels for a reference noise")

    flagged = (
        noise_map.withColumn("median_noise", median)
        .withColumn("is_active", on)
        .withColumn("non_finite", ~is_finite(noise))
        .withColumn("non_positive", F.col("is_active") & F.coalesce(noise <= 0, F.lit(False)))
        .withColumn("hot", F.col("is_active") & exceeds(noise, F.col("median_noise") * hot_rms_multiple))
        .withColumn(
            "cold",
            F.col("is_active") & is_finite(noise) & falls_below(noise, F.col("median_noise") * cold_rms_fraction),
        )
    )
    if "n_clipped" in noise_map.columns and n_dark_frames > 0 and max_clip_fraction is not None:
        fraction = F.col("n_clipped").cast("double") / float(n_dark_frames)
        unstable = F.col("is_active") & exceeds(fraction, F.lit(max_clip_fraction))
    else:
        unstable = F.lit(False)
    return flagged.withColumn("unstable", unstable).withColumn(
        "is_bad", any_flag(~F.col("is_active"), "non_finite", "non_positive", "hot", "cold", "unstable")
    )


def class_counts(flags: DataFrame) -> DataFrame:
    """Counts per rule and the share of bad pixels in the active region."""
    counts = flags.agg(
        F.first("median_noise").alias("median_noise"),
        F.count_if("hot").alias("n_hot"),
        F.count_if("cold").alias("n_cold"),
        F.count_if(F.col("non_finite") & F.col("is_active")).alias("n_non_finite"),
        F.count_if("unstable").alias("n_unstable"),
        F.count_if(F.col("is_bad") & F.col("is_active")).alias("n_bad_active"),
        F.count_if("is_active").alias("n_active"),
    )
    share = F.col("n_bad_active") * 100.0 / F.greatest("n_active", F.lit(1))
    return counts.withColumn("bad_percent", share)


def simple_mask(
    noise_map: DataFrame, *, hot_multiple: float = 5.0, cold_fraction: float = 0.1
) -> DataFrame:
    """``y, x, noise, is_bad`` from noise alone: unusable, hot or cold pixels."""
    noise_map = settle(noise_map, "noise_map")
    noise = F.col("noise")
    usable = _usable(noise)
    median = _required(_median_noise(noise_map, usable), "no finite, positive noise values")
    bad = any_flag(~usable, exceeds(noise, median * hot_multiple), usable & falls_below(noise, median * cold_fraction))
    return noise_map.withColumn("is_bad", bad)


# -- rules on corrected frames -------------------------------------------------------------------
def _with_noise(corrected: DataFrame, noise_map: DataFrame, geometry: Geometry) -> DataFrame:
    if "noise" in corrected.columns:  # carried through the explode already
        return corrected
    side = noise_map.select(*PIXEL, f32("noise").alias("noise"))
    return join_bounded(corrected, side, PIXEL, rows=geometry.n_pixels, row_bytes=48)


def bright_and_empty(
    corrected: DataFrame,
    noise_map: DataFrame,
    geometry: Geometry,
    *,
    bright_sigma: float = 5.0,
    bright_fraction: float = 0.5,
    empty_sigma: float = 3.0,
    empty_fraction: float = 0.8,
) -> DataFrame:
    """Both frame-wise rules in one aggregation: counts and flags per pixel."""
    value, noise = F.col("value"), F.col("noise")
    counts = _with_noise(corrected, noise_map, geometry).groupBy(*PIXEL).agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.count_if(exceeds(value, noise * bright_sigma)).alias("n_above"),
        F.count_if(falls_below(value, noise * -empty_sigma)).alias("n_below"),
    )
    return counts.select(
        *PIXEL,
        "n_above",
        "n_below",
        (F.col("n_above") >= F.col("n_frames") * bright_fraction).alias("bright"),
        (F.col("n_below") >= F.col("n_frames") * empty_fraction).alias("empty"),
    )


def bright_pixels(
    corrected: DataFrame, noise_map: DataFrame, geometry: Geometry, *, threshold_sigma: float = 5.0, min_fraction: float = 0.5
) -> DataFrame:
    """Pixels above ``threshold_sigma`` times their noise in enough frames."""
    found = bright_and_empty(corrected, noise_map, geometry, bright_sigma=threshold_sigma, bright_fraction=min_fraction)
    return found.select(*PIXEL, "n_above", "bright")


def empty_pixels(
    corrected: DataFrame, noise_map: DataFrame, geometry: Geometry, *, threshold_sigma: float = 3.0, min_fraction: float = 0.8
) -> DataFrame:
    """Pixels below minus ``threshold_sigma`` times their noise in enough frames."""
    found = bright_and_empty(corrected, noise_map, geometry, empty_sigma=threshold_sigma, empty_fraction=min_fraction)
    return found.select(*PIXEL, "n_below", "empty")


def hot_by_occupancy(
    occupancy: DataFrame, *, hit_multiple: float = 3.0, adu_multiple: float = 5.0
) -> DataFrame:
    """``occupancy(y, x, hit_count, mean_adu)`` with flag ``hot_occupancy``.

    A pixel is hot above ``hit_multiple`` times the median positive hit count or
    ``adu_multiple`` times the median positive mean; nothing is hot when either
    median does not exist.
    """
    occupancy = settle(occupancy, "occupancy")
    hits, adu = F.col("hit_count").cast("double"), F.col("mean_adu").cast("double")
    middle = lambda c: F.percentile(F.when(~F.isnan(c) & (c > 0), c), F.lit(0.5))
    medians = occupancy.agg(F.struct(middle(hits).alias("hits"), middle(adu).alias("adu"))).scalar()
    return (
        occupancy.withColumn("_m", medians)
        .withColumn(
            "hot_occupancy",
            F.coalesce(F.col("_m.hits").isNotNull() & F.col("_m.adu").isNotNull(), F.lit(False))
            & any_flag(
                exceeds(hits, F.col("_m.hits") * hit_multiple), exceeds(adu, F.col("_m.adu") * adu_multiple)
            ),
        )
        .drop("_m")
    )


def comprehensive_mask(
    noise_map: DataFrame,
    geometry: Geometry,
    *,
    n_dark_frames: int = 0,
    corrected: DataFrame | None = None,
    occupancy: DataFrame | None = None,
    active: str | Column | None = None,
    hot_rms_multiple: float = 5.0,
    cold_rms_fraction: float = 0.1,
    max_clip_fraction: float = 0.5,
    bright_sigma: float = 5.0,
    bright_fraction: float = 0.5,
    empty_sigma: float = 3.0,
    empty_fraction: float = 0.8,
    hit_multiple: float = 3.0,
    adu_multiple: float = 5.0,
    strict_nan_median: bool = True,
) -> DataFrame:
    """OR of every rule, each kept as a column.

    Unlike :func:`classify_pixels` the reference median takes the active pixels
    unfiltered: one NaN among them (with ``strict_nan_median``) switches the noisy
    and cold rules off.  Those rules are not limited to active pixels, and
    non-finite noise is no rule of its own.
    """
    noise_map = settle(noise_map, "noise_map")
    on = _active(geometry, active)
    noise = F.col("noise").cast("double")
    middle = F.percentile(F.when(on & ~F.isnan(noise), noise), F.lit(0.5))
    if strict_nan_median:
        middle = F.when(F.count_if(on & F.isnan(noise)) == 0, middle)
    median = noise_map.agg(middle).scalar()

    out = (
        noise_map.withColumn("_median", median)
        .withColumn("outside", ~on)
        .withColumn("noisy", exceeds(noise, F.col("_median") * hot_rms_multiple))
        .withColumn("cold", F.coalesce(falls_below(noise, F.col("_median") * cold_rms_fraction), F.lit(False)))
        .drop("_median")
    )
    rules = ["outside", "noisy", "cold"]
    if "n_clipped" in noise_map.columns and n_dark_frames > 0:
        fraction = F.col("n_clipped").cast("double") / float(n_dark_frames)
        out = out.withColumn("overclipped", exceeds(fraction, F.lit(max_clip_fraction)))
        rules.append("overclipped")
    if corrected is not None:
        found = bright_and_empty(
            corrected,
            noise_map,
            geometry,
            bright_sigma=bright_sigma,
            bright_fraction=bright_fraction,
            empty_sigma=empty_sigma,
            empty_fraction=empty_fraction,
        )
        out = out.join(found.select(*PIXEL, "bright", "empty"), PIXEL, "left")
        rules += ["bright", "empty"]
    if occupancy is not None:
        hot = hot_by_occupancy(occupancy, hit_multiple=hit_multiple, adu_multiple=adu_multiple)
        out = out.join(hot.select(*PIXEL, "hot_occupancy"), PIXEL, "left")
        rules.append("hot_occupancy")
    out = out.select(*noise_map.columns, *[F.coalesce(r, F.lit(False)).alias(r) for r in rules])
    return out.withColumn("is_bad", any_flag(*rules))


# -- reports on a finished mask ----------------------------------------------------------------------
def categories(
    mask: DataFrame,
    geometry: Geometry,
    *,
    hot_rms_multiple: float = 5.0,
    cold_rms_fraction: float = 0.1,
    active: str | Column | None = None,
) -> DataFrame:
    """Category of each pixel of ``mask(y, x, noise, is_bad)``.

    Hot and cold are judged again from the noise; the strongest claim wins in
    the order other bad, non-finite, cold, hot.
    """
    mask = settle(mask, "mask")
    on = _active(geometry, active)
    noise = F.col("noise")
    median = F.coalesce(_median_noise(mask, on & _usable(noise)), F.lit(1.0))
    labelled = (
        mask.withColumn("_median", median)
        .withColumn("is_active", on)
        .withColumn("_hot", F.col("is_active") & exceeds(noise, F.col("_median") * hot_rms_multiple))
        .withColumn(
            "_cold", F.col("is_active") & is_finite(noise) & falls_below(noise, F.col("_median") * cold_rms_fraction)
        )
    )
    category = (
        F.when(~is_finite(noise), F.lit(NON_FINITE))
        .when(F.col("_cold"), F.lit(COLD))
        .when(F.col("_hot"), F.lit(HOT))
        .when(F.col("is_bad"), F.lit(OTHER))
        .otherwise(F.lit(GOOD))
    )
    return labelled.select(*PIXEL, "noise", "is_bad", "is_active", category.alias("category"))


def category_counts(labelled: DataFrame) -> DataFrame:
    """Pixels per category; good pixels count only inside the active region."""
    hot, cold = F.count_if(F.col("category") == HOT), F.count_if(F.col("category") == COLD)
    broken = F.count_if((F.col("category") == NON_FINITE) & F.col("is_active"))
    return labelled.agg(
        F.count_if(~F.col("is_bad") & F.col("is_active")).alias("n_good"),
        hot.alias("n_hot"),
        cold.alias("n_cold"),
        broken.alias("n_non_finite"),
        (F.count_if("is_bad") - hot - cold - broken).alias("n_other"),
    )


def bad_per_asic(mask: DataFrame, geometry: Geometry) -> DataFrame:
    """Bad pixels of each readout block, blocks without any included."""
    counts = mask.groupBy(geometry.asic_name("x").alias("asic")).agg(F.count_if("is_bad").alias("n_bad"))
    blocks = geometry.asic_dim(mask.sparkSession).select("asic")
    return blocks.join(counts, "asic", "left").select("asic", F.coalesce("n_bad", F.lit(0).cast("bigint")).alias("n_bad"))


def mask_total(mask: DataFrame, geometry: Geometry, *, active: str | Column | None = None) -> DataFrame:
    """All bad pixels against the number of active ones."""
    totals = mask.agg(
        F.count_if("is_bad").alias("n_bad"), F.count_if(_active(geometry, active)).alias("n_active")
    )
    return totals.withColumn("bad_percent", F.col("n_bad") * 100.0 / F.greatest("n_active", F.lit(1)))


def bad_coordinates(mask: DataFrame) -> DataFrame:
    """Coordinates of the flagged pixels."""
    return mask.where("is_bad").select(*PIXEL)
