"""Frames as tables.

Storage form, one row per readout line::

    file_id INT, frame_id BIGINT, y INT, [marker INT, adc_counter BIGINT,] pixels ARRAY<INT>

Long form, one row per pixel: ``file_id, frame_id, y, x, adc``.  ``frame_id`` is
the position of the frame inside its file.  Lines stay whole wherever possible:
a 512-pixel array is far cheaper to move than 512 rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewell.functions.columns import int_div
from framewell.geometry import Geometry
from framewell.plans.joins import drop_keys, join_bounded
from framewell.plans.settle import settle

FRAME_KEY = ["file_id", "frame_id"]


# -- shape changes -------------------------------------------------------------------
def to_pixels(rows: DataFrame, *, transpose: bool = False) -> DataFrame:
    """Lines to pixels.  ``transpose`` swaps x and y (line-major displays)."""
    y, x = ("x", "y") if transpose else ("y", "x")
    exploded = rows.select(*FRAME_KEY, F.col("y").alias(y), F.posexplode("pixels").alias(x, "adc"))
    return exploded.select(*FRAME_KEY, "y", "x", "adc")


def to_rows(pixels: DataFrame, geometry: Geometry) -> DataFrame:
    """Pixels to lines; lines that miss a pixel, repeat one or have one outside the width are left out.

    Groups hold at most ``width`` pixels, so the collected arrays are bounded.
    """
    line = F.sort_array(F.collect_list(F.struct("x", "adc")))
    every_x = F.sequence(F.lit(0), F.lit(geometry.width - 1))
    return (
        pixels.groupBy(*FRAME_KEY, "y")
        .agg(line.alias("line"))
        .where(F.transform("line", lambda p: p["x"].cast("int")) == every_x)
        .select(*FRAME_KEY, "y", F.col("line.adc").alias("pixels"))
    )


def concat_frames(*stacks: DataFrame) -> DataFrame:
    """All frames of several stacks, duplicates kept; files are renumbered in order.

    Each stack becomes one ``file_id``, so frames of different stacks never mix.
    """
    out = None
    for i, stack in enumerate(stacks):
        numbered = stack.withColumn("file_id", F.lit(i))
        out = numbered if out is None else out.unionByName(numbered)
    if out is None:
        raise ValueError("no frames to concatenate")
    return out


# -- completeness ----------------------------------------------------------------------
def frame_sizes(records: DataFrame, geometry: Geometry, *, long_form: bool = False) -> DataFrame:
    """Per frame: ``n_records``, and ``n_places``, the different lines (or pixels) inside the geometry.

    Only key columns are read; places are counted in bitmaps, which merge before the shuffle.
    """
    place, inside = F.col("y").cast("long"), F.col("y").between(0, geometry.height - 1)
    if long_form:
        place, inside = place * geometry.width + F.col("x"), inside & F.col("x").between(0, geometry.width - 1)
    placed = records.select(*FRAME_KEY, F.when(inside, place).alias("place"))
    parts = placed.groupBy(*FRAME_KEY, F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("place"))).alias("places")
    )
    return parts.groupBy(*FRAME_KEY).agg(F.sum("n").alias("n_records"), F.sum("places").alias("n_places"))


def _whole(geometry: Geometry, long_form: bool):
    expected = geometry.n_pixels if long_form else geometry.height
    return (F.col("n_records") == expected) & (F.col("n_places") == expected)


def complete_frames(records: DataFrame, geometry: Geometry, *, long_form: bool = False) -> DataFrame:
    """Drop every frame that lacks lines (or pixels, in long form) or has some twice.

    Incomplete frames are the exception, so their keys are what gets joined:
    the frames themselves are not shuffled.
    """
    sizes = frame_sizes(records, geometry, long_form=long_form)
    return drop_keys(records, sizes.where(~_whole(geometry, long_form)).select(*FRAME_KEY), FRAME_KEY)


def frame_inventory(records: DataFrame, geometry: Geometry, *, long_form: bool = False) -> DataFrame:
    """Per file: complete frames, records left over in incomplete ones, last complete frame."""
    whole = _whole(geometry, long_form)
    return (
        frame_sizes(records, geometry, long_form=long_form)
        .groupBy("file_id")
        .agg(
            F.count_if(whole).alias("n_frames"),
            F.coalesce(F.sum(F.when(~whole, F.col("n_records"))), F.lit(0)).alias("orphan_records"),
            F.max(F.when(whole, F.col("frame_id"))).alias("last_frame"),
        )
    )


def frame_count(rows: DataFrame) -> int:
    """Number of frames in a stack of complete frames: every frame has one line 0."""
    return rows.where(F.col("y") == 0).count()


# -- selection --------------------------------------------------------------------------
def select_frames(
    rows: DataFrame,
    geometry: Geometry,
    *,
    skip: int = 0,
    max_frames: int | None = None,
    long_form: bool = False,
    incomplete: bool = False,
) -> DataFrame:
    """The frames of :func:`selection` without their number."""
    return selection(rows, geometry, skip=skip, max_frames=max_frames, long_form=long_form, incomplete=incomplete)[0]


def selection(
    rows: DataFrame,
    geometry: Geometry,
    *,
    skip: int = 0,
    max_frames: int | None = None,
    long_form: bool = False,
    incomplete: bool = False,
) -> tuple[DataFrame, int]:
    """Complete frames ``skip .. skip + max_frames`` counted across files.

    ``skip`` drops leading frames of the first file and must leave some of them;
    ``max_frames`` caps the running total over all files.  Adds ``frame_seq``, the
    frame number over all files.  Only per-file counts are joined to the frames.
    Also returns how many frames were selected.  With ``incomplete`` frames that lack lines
    count and stay too.
    """
    if skip < 0:
        raise ValueError("skip must not be negative")
    if max_frames is not None and max_frames <= 0:
        raise ValueError("max_frames must be positive")
    if incomplete:
        started = frame_sizes(rows, geometry, long_form=long_form).groupBy("file_id")
        files = started.agg(F.count(F.lit(1)).alias("n_frames"), F.max("frame_id").alias("last_frame"))
    else:
        files = frame_inventory(rows, geometry, long_form=long_form)
    files = settle(files, "files")
    known = files.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("n_frames"), F.lit(0)).alias("n_frames"),
        F.coalesce(F.min_by("n_frames", "file_id"), F.lit(0)).alias("in_first"),
        F.count_if(F.col("last_frame") + 1 != F.col("n_frames")).alias("n_gaps"),
    ).first()
    if known["in_first"] == 0:
        raise ValueError("no complete frames")
    if 0 < skip >= known["in_first"]:
        raise ValueError(f"skip={skip} leaves nothing of the first file ({known['in_first']} frames)")
    if known["n_gaps"]:
        but = "" if incomplete else " with only the last one incomplete"
        raise ValueError(f"frames of a file must be numbered 0, 1, 2 ...{but}")

    before = Window.orderBy("file_id").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(
        "file_id", "n_frames", F.coalesce(F.sum("n_frames").over(before), F.lit(0)).alias("first_seq")
    )
    end = None if max_frames is None else skip + max_frames
    if end is not None:
        rows = rows.where(F.col("frame_id") < end)  # necessary in every file, so it reaches the scan
    numbered = (
        join_bounded(rows, starts, ["file_id"], rows=known["n_files"], row_bytes=32)
        .where(F.col("frame_id") < F.col("n_frames"))
        .withColumn("frame_seq", F.col("first_seq") + F.col("frame_id"))
        .drop("n_frames", "first_seq")
        .where(F.col("frame_seq") >= skip)
    )
    available = known["n_frames"] - skip
    if end is None:
        return numbered, available
    return numbered.where(F.col("frame_seq") < end), min(available, max_frames)


def read_frames_at(rows: DataFrame, frame_ids: Sequence[int], *, n_frames: int | None = None) -> DataFrame:
    """The frames at the given positions of one file, repeats allowed.

    ``pos`` is the place in the request; sort by it (and ``y``) to get request
    order.  Asking for a frame outside ``0 .. n_frames-1`` raises IndexError, and so do rows of several
    files ValueError.  With ``n_frames`` the caller answers for both, and the rows are not looked through.
    """
    wanted = [int(i) for i in frame_ids]
    if n_frames is None:
        found = rows.agg(
            F.coalesce(F.max("frame_id") + 1, F.lit(0)).alias("n"), F.min("file_id").alias("first"), F.max("file_id").alias("last")
        ).first()
        if found["first"] != found["last"]:
            raise ValueError("frames are read from one file; choose it first")
        n_frames = found["n"]
    outside = [i for i in wanted if not 0 <= i < n_frames]
    if outside:
        raise IndexError(f"frames {outside} outside 0..{n_frames - 1}")
    spark = rows.sparkSession
    request = spark.createDataFrame(list(enumerate(wanted)), "pos int, frame_id bigint")
    hits = rows.where(F.col("frame_id").isin(sorted(set(wanted))))  # prunes the scan
    return hits.join(F.broadcast(request), "frame_id")  # as long as the caller's own list


# -- sinks --------------------------------------------------------------------------------
def write_rows(
    rows: DataFrame,
    path: str,
    geometry: Geometry,
    *,
    lines_per_band: int | None = None,
    files_per_band: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write lines as Parquet, optionally in folders of ``lines_per_band`` lines.

    Bands keep the many frames of few lines together, which makes the map-side
    part of every per-pixel aggregate far more effective.  Read raw frames with
    the same ``lines_per_partition`` and each task writes exactly one band, with
    no shuffle.  Frames stored in frame order need one: give ``files_per_band``,
    over which the frames of a band are spread evenly.
    """
    if lines_per_band is None:
        rows.write.mode(mode).parquet(path)
        return
    banded = rows.withColumn("band", int_div("y", lines_per_band))
    if files_per_band is not None:
        n_bands = -(-geometry.height // lines_per_band)
        banded = banded.repartition(n_bands * files_per_band, "band", F.col("frame_id") % files_per_band)
    banded.write.mode(mode).partitionBy("band").parquet(path)


def extract_frames(
    rows: DataFrame,
    path: str,
    geometry: Geometry,
    *,
    start: int = 0,
    n_frames: int = 2000,
    overwrite: bool = False,
    lines_per_band: int | None = None,
) -> int:
    """Copy frames ``start .. start+n_frames-1`` of one file to a new table.

    Returns the number of frames written: fewer than asked for when the file
    ends earlier.  The written table is counted again afterwards.
    """
    if start < 0:
        raise ValueError("start must not be negative")
    if n_frames <= 0:
        raise ValueError("n_frames must be positive")
    found = frame_inventory(rows, geometry).agg(
        F.coalesce(F.sum("n_frames"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("files")
    ).first()
    if found["files"] > 1:
        raise ValueError(f"frames are extracted from one file, the rows hold {found['files']}; choose one first")
    available = found["n"]
    if start >= available:
        raise ValueError(f"start={start} is outside the file ({available} complete frames)")
    if n_frames > available - start:
        warnings.warn(f"only {available - start} of {n_frames} frames follow frame {start}", stacklevel=2)
        n_frames = available - start
    chosen = rows.where(F.col("frame_id").between(start, start + n_frames - 1))
    write_rows(chosen, path, geometry, lines_per_band=lines_per_band, mode="overwrite" if overwrite else "errorifexists")
    written = rows.sparkSession.read.parquet(path).count()
    if written != n_frames * geometry.height:
        raise RuntimeError(f"{path}: {written} lines written, expected {n_frames * geometry.height}")
    return n_frames
