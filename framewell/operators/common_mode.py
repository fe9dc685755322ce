"""Common mode: the shift shared by all pixels of one readout line (or block of it).

Lines stay arrays.  The offset map is folded into one array per detector line
(512 rows) and broadcast, so subtracting it, taking the medians and subtracting
those again never shuffles a frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewell.functions.columns import NAN, any_flag, f32, finite_or_null, int_div, is_finite, is_valid_adc, nan_if_null
from framewell.functions.row_median import slice_medians
from framewell.geometry import Geometry
from framewell.operators.offsets import PIXEL, on_grid
from framewell.plans.joins import join_bounded
from framewell.sources.frames import FRAME_KEY


# -- per-pixel maps as one array per detector line ------------------------------------------
def line_arrays(per_pixel: DataFrame, geometry: Geometry, columns: list[str]) -> DataFrame:
    """Fold per-pixel columns into arrays over x: one row per ``y``, ``width`` entries.

    Pixels missing from the map become NULL entries; a pixel given twice is an error.
    """
    cells = on_grid(per_pixel.select(*PIXEL, *columns), geometry)
    lines = cells.groupBy("y").agg(F.sort_array(F.collect_list(F.struct("x", *columns))).alias("cells"))
    whole = F.size("cells") == geometry.width
    checked = F.when(whole, F.col("cells")).otherwise(F.raise_error(F.lit("pixel map holds a pixel twice")))
    return lines.select("y", checked.alias("cells")).select("y", *[F.col(f"cells.{c}").alias(c) for c in columns])


def with_line_arrays(
    rows: DataFrame, per_pixel: DataFrame, geometry: Geometry, columns: list[str]
) -> DataFrame:
    """Add per-pixel maps to readout lines as array columns."""
    lines = line_arrays(per_pixel, geometry, columns)
    return join_bounded(rows, lines, ["y"], rows=geometry.height, row_bytes=8 * geometry.width * len(columns))


# -- medians ----------------------------------------------------------------------------------
def common_mode(
    rows: DataFrame,
    offsets: DataFrame,
    geometry: Geometry,
    *,
    offset: str = "offset",
    per_asic: bool = True,
    split_even_odd: bool = False,
    exclude_sentinels: bool = True,
    bad_pixels: DataFrame | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """Lines with their common-mode medians.

    Adds ``offset ARRAY<FLOAT>`` and ``cm ARRAY<FLOAT>`` (one entry per block, two
    with ``split_even_odd``: even columns first).  ``exclude_sentinels`` leaves
    under- and overflowing pixels out of the medians, ``bad_pixels(y, x, is_bad)``
    leaves out flagged ones.  With nothing excluded a NaN residual makes the
    median NaN; otherwise NaN is skipped.  ``carry`` names further columns of
    ``offsets`` to keep as arrays.
    """
    carry = carry or []
    maps = offsets.select(*PIXEL, f32(offset).alias("offset"), *[c for c in carry])
    columns = ["offset", *carry]
    reference = "offset"
    if bad_pixels is not None:
        flag = any_flag("is_bad")
        maps = maps.join(bad_pixels.select(*PIXEL, "is_bad"), PIXEL, "left").withColumn(
            "median_offset", F.when(~flag, F.col("offset")).otherwise(f32(F.lit(NAN)))
        )
        columns, reference = [*columns, "median_offset"], "median_offset"
    n, width = (geometry.n_asics, geometry.asic_width) if per_asic else (1, geometry.width)
    medians = slice_medians(
        geometry.width,
        n,
        width,
        split_parity=split_even_odd,
        sentinels=(geometry.underflow, geometry.overflow) if exclude_sentinels else None,
        skip_nan=exclude_sentinels or bad_pixels is not None,
    )
    lines = with_line_arrays(rows, maps.select(*PIXEL, *columns), geometry, columns)
    return lines.withColumn("cm", medians("pixels", reference)).drop("median_offset")


def _slice_of(x: Column, geometry: Geometry, per_asic: bool, split: bool) -> Column:
    """Place of a pixel's median in the ``cm`` array; NULL outside every block."""
    width = geometry.asic_width if per_asic else geometry.width
    pos = int_div(x, width)
    place = pos * 2 + (x % width) % 2 if split else pos
    return F.when(pos < (geometry.n_asics if per_asic else 1), place)


def corrected_pixels(
    lines: DataFrame,
    geometry: Geometry,
    *,
    per_asic: bool = True,
    split_even_odd: bool = False,
    carry: list[str] | None = None,
) -> DataFrame:
    """Long form of corrected values: ``file_id, frame_id, y, x, adc, value [, carried]``.

    Every pixel loses its offset and its block's median, excluded pixels too; a
    median that is not finite subtracts 0.
    """
    carry = carry or []
    cells = F.arrays_zip(F.col("pixels").alias("adc"), "offset", *carry)
    exploded = lines.select(*FRAME_KEY, "y", "cm", F.posexplode(cells).alias("x", "cell"))
    shift = F.get("cm", _slice_of(F.col("x"), geometry, per_asic, split_even_odd))
    shift = F.when(is_finite(shift), shift).otherwise(f32(F.lit(0.0)))
    value = f32("cell.adc") - F.col("cell.offset") - shift
    return exploded.select(
        *FRAME_KEY, "y", "x", F.col("cell.adc").alias("adc"), value.alias("value"), *[f"cell.{c}" for c in carry]
    )


def cm_map(
    lines: DataFrame, geometry: Geometry, *, per_asic: bool = True, split_even_odd: bool = False
) -> DataFrame:
    """Stored common-mode values: ``file_id, frame_id, y, [asic,] cm``.

    With even/odd medians the stored value is their mean, or the finite one.
    """
    n = geometry.n_asics if per_asic else 1
    slices = lines.select(*FRAME_KEY, "y", "cm", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("pos"))
    if split_even_odd:
        even, odd = F.get("cm", F.col("pos") * 2), F.get("cm", F.col("pos") * 2 + 1)
        both = (even + odd) * f32(F.lit(0.5))
        value = F.when(is_finite(even) & is_finite(odd), both).when(is_finite(even), even).otherwise(odd)
    else:
        value = F.get("cm", F.col("pos"))
    asic = [geometry.asic_name_of(F.col("pos")).alias("asic")] if per_asic else []
    return slices.select(*FRAME_KEY, "y", *asic, f32(value).alias("cm"))


def cm_noise(cm: DataFrame) -> DataFrame:
    """Sample spread over frames of the common mode of each line (and block)."""
    keys = [c for c in ("asic", "y") if c in cm.columns]
    spread = F.stddev_samp(F.col("cm").cast("double"))
    return cm.groupBy(*keys).agg(nan_if_null(spread, "float").alias("cm_noise"))


# -- long form: plain window medians ---------------------------------------------------------------
def common_mode_by_window(
    pixels: DataFrame, geometry: Geometry, *, per_asic: bool = True, split_even_odd: bool = False
) -> DataFrame:
    """Residuals in long form with the median of their own group given back to each.

    Takes ``file_id, frame_id, y, x, adc, residual``; sentinels and non-finite
    residuals are left out of the median.  Needs a shuffle by line, so prefer
    :func:`common_mode` when lines are stored whole.  Groups hold at most
    ``width`` pixels.
    """
    width = geometry.asic_width if per_asic else geometry.width
    pos = int_div("x", width)
    keyed = pixels.withColumn("pos", F.when(pos < (geometry.n_asics if per_asic else 1), pos))
    keys = [*FRAME_KEY, "y", "pos"]
    if split_even_odd:
        keyed = keyed.withColumn("parity", (F.col("x") % width) % 2)
        keys.append("parity")
    usable = F.when(is_valid_adc("adc", geometry), finite_or_null("residual"))
    median = F.when(F.col("pos").isNotNull(), F.median(usable).over(Window.partitionBy(*keys)))
    return (
        keyed.withColumn("cm", nan_if_null(median, "float"))
        .withColumn("value", f32("residual") - F.when(F.isnan("cm"), f32(F.lit(0.0))).otherwise(F.col("cm")))
        .drop("pos", "parity")
    )
