"""Applying a finished calibration to frames, and reporting on the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.functions.columns import NAN, f32, finite_or_null, int_div, is_finite, is_valid_adc, nan_if_null
from framewell.functions.row_median import corrected_lines, slice_medians
from framewell.geometry import Geometry
from framewell.operators.common_mode import with_line_arrays
from framewell.operators.offsets import PIXEL
from framewell.sources.frames import FRAME_KEY
from framewell.sources.raw import FRAME_MARKER, LINE_MARKER


def slice_width(geometry: Geometry, mode: str, asic_width: int | None = None) -> int:
    """Columns that share one common-mode value in ``row`` or ``asic`` mode."""
    if mode == "row":
        return geometry.width
    if mode != "asic":
        raise ValueError(f"unknown common-mode mode {mode!r}; use 'row' or 'asic'")
    width = geometry.asic_width if asic_width is None else asic_width
    if width < 1 or geometry.width % width:
        raise ValueError("the ASIC width must divide the frame width")
    return width


def apply_calibration(
    rows: DataFrame,
    calibration: DataFrame,
    geometry: Geometry,
    *,
    mode: str = "asic",
    asic_width: int | None = None,
    with_corrected: bool = False,
) -> DataFrame:
    """Lines with the common mode left after subtracting a stored calibration.

    ``calibration(y, x, offset, is_bad)``.  Bad pixels, sentinels and pixels with
    a non-finite offset are left out of the medians and become NaN; a slice
    without usable pixels has a NaN median and stays NaN.  Adds ``reference``
    (offset, NaN where unusable), ``cm`` and, on request, ``corrected``, one
    array each.  No shuffle, no state: it also runs on a stream of lines.
    """
    width = slice_width(geometry, mode, asic_width)
    usable = is_finite("offset") & ~F.coalesce("is_bad", F.lit(False))
    maps = calibration.select(*PIXEL, F.when(usable, f32("offset")).otherwise(f32(F.lit(NAN))).alias("reference"))
    sentinels = (geometry.underflow, geometry.overflow)
    medians = slice_medians(
        geometry.width, geometry.width // width, width, split_parity=False, sentinels=sentinels, skip_nan=True
    )
    lines = with_line_arrays(rows, maps, geometry, ["reference"]).withColumn("cm", medians("pixels", "reference"))
    if with_corrected:
        corrected = corrected_lines(geometry.width, width, sentinels=sentinels)
        lines = lines.withColumn("corrected", corrected("pixels", "reference", "cm"))
    return lines


def applied_pixels(
    lines: DataFrame, geometry: Geometry, *, mode: str = "asic", asic_width: int | None = None
) -> DataFrame:
    """Corrected values in long form, NaN where the pixel is unusable."""
    width = slice_width(geometry, mode, asic_width)
    cells = F.arrays_zip(F.col("pixels").alias("adc"), "reference")
    exploded = lines.select(*FRAME_KEY, "y", "cm", F.posexplode(cells).alias("x", "cell"))
    value = f32("cell.adc") - F.col("cell.reference") - F.get("cm", int_div("x", width))
    valid = is_valid_adc("cell.adc", geometry)
    return exploded.select(
        *FRAME_KEY, "y", "x", F.when(valid, value).otherwise(f32(F.lit(NAN))).alias("value")
    )


def applied_cm(
    lines: DataFrame, geometry: Geometry, *, mode: str = "asic"
) -> DataFrame:
    """Common-mode values of applied lines: ``file_id, frame_id, y, [slice,] cm``."""
    exploded = lines.select(*FRAME_KEY, "y", F.posexplode("cm").alias("slice", "cm"))
    return exploded.drop("slice") if mode == "row" else exploded


# -- integrity and per-frame report ---------------------------------------------------------------------
def _wrong_marker() -> Column:
    expected = F.when(F.col("y") == 0, FRAME_MARKER).otherwise(LINE_MARKER)
    return F.coalesce(F.col("marker") != expected, F.lit(True))


def marker_status(rows: DataFrame) -> DataFrame:
    """Per frame: number of lines with an unexpected marker, and whether there are none."""
    return (
        rows.groupBy(*FRAME_KEY)
        .agg(F.count_if(_wrong_marker()).alias("n_bad_markers"))
        .withColumn("markers_ok", F.col("n_bad_markers") == 0)
    )


def frame_report(
    lines: DataFrame, calibration: DataFrame, geometry: Geometry, *, mode: str = "asic", asic_width: int | None = None
) -> DataFrame:
    """One row per applied frame: masked pixels, statistics of values and common mode.

    All columns come from one pass: each slice's median is counted at its first
    pixel and each line's marker at pixel 0.  Every aggregate is mergeable, so a
    task sends one row per frame.
    """
    width = slice_width(geometry, mode, asic_width)
    marked = "marker" in lines.columns
    carried = ["cm", "marker"] if marked else ["cm"]
    cells = F.arrays_zip(F.col("pixels").alias("adc"), "reference")
    pixels = lines.select(*FRAME_KEY, "y", *carried, F.posexplode(cells).alias("x", "cell"))

    slice_cm = F.get("cm", int_div("x", width))
    value = f32("cell.adc") - F.col("cell.reference") - slice_cm
    value = finite_or_null(F.when(is_valid_adc("cell.adc", geometry), value).cast("double"))
    cm = F.when(F.col("x") % width == 0, finite_or_null(slice_cm.cast("double")))
    report = [
        F.count_if(value.isNull()).alias("n_masked"),
        nan_if_null(F.min(value)).alias("min_value"),
        nan_if_null(F.max(value)).alias("max_value"),
        nan_if_null(F.avg(value)).alias("mean_value"),
        nan_if_null(F.stddev_pop(value)).alias("std_value"),
        F.count(cm).alias("cm_entries"),
        nan_if_null(F.avg(cm)).alias("cm_mean"),
        nan_if_null(F.stddev_pop(cm)).alias("cm_std"),
    ]
    if marked:
        report.append(F.count_if((F.col("x") == 0) & _wrong_marker()).alias("n_bad_markers"))
    n_bad = calibration.agg(F.count_if("is_bad")).scalar()
    return pixels.groupBy(*FRAME_KEY).agg(*report).withColumn("n_bad_pixels", n_bad)


def frame_limits(
    lines: DataFrame, geometry: Geometry, *, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Display range of each applied frame (lines with ``corrected``).

    Without limits: the 1st and 99th percentile of the finite values, widened by
    one if they coincide.  With one limit given, the other is the minimum or
    maximum.  A frame without finite values gets (0, 1).  A frame's lines are
    brought together as arrays (``height * width`` floats, fixed by the detector).
    """
    frames = lines.groupBy(*FRAME_KEY).agg(F.sort_array(F.flatten(F.collect_list("corrected"))).alias("v"))
    # NaN ranks last; corrected values are otherwise finite
    first_nan = F.array_position("v", f32(F.lit(NAN)))
    n = F.when(first_nan > 0, first_nan - 1).otherwise(F.size("v")).cast("int")
    frames = frames.select(*FRAME_KEY, "v", n.alias("n"))

    def quantile(q: float):
        at = (F.col("n") - 1) * F.lit(q)
        below = F.floor(at).cast("int")
        lower, upper = F.get("v", below).cast("double"), F.get("v", F.ceil(at).cast("int")).cast("double")
        return lower + (upper - lower) * (at - below)

    if low is None and high is None:
        frames = frames.select(*FRAME_KEY, "n", quantile(0.01).alias("lo"), quantile(0.99).alias("hi"))
        hi = F.when(F.col("lo") == F.col("hi"), F.col("lo") + 1.0).otherwise(F.col("hi"))
    else:
        lowest = F.get("v", F.lit(0)).cast("double") if low is None else F.lit(float(low))
        highest = F.get("v", F.col("n") - 1).cast("double") if high is None else F.lit(float(high))
        frames = frames.select(*FRAME_KEY, "n", lowest.alias("lo"), highest.alias("hi"))
        hi = F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("lo") + 1.0)
    some = F.col("n") > 0
    return frames.select(
        *FRAME_KEY,
        F.when(some, F.col("lo")).otherwise(F.lit(0.0)).alias("lo"),
        F.when(some, hi).otherwise(F.lit(1.0)).alias("hi"),
    )
