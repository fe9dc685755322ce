"""The jobs users run: full and quick calibration of dark frames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.functions.columns import NAN, f32
from framewell.functions.value_counts import weighted_median, weighted_spread
from framewell.geometry import Geometry
from framewell.operators import badpix, common_mode, noise, offsets
from framewell.operators.offsets import PIXEL
from framewell.plans.settle import settle
from framewell.sources.frames import frame_count, selection, to_pixels
from framewell.sources.raw import frame_range, inspect_files, read_raw, resolve_paths
from framewell.sources.store import save_calibration

METHODS = {"both": ("median", "sigclip"), "median": ("median",), "sigclip": ("sigclip",)}


@dataclass(frozen=True)
class CalibrationOptions:
    """Settings of :func:`calibrate` with their defaults."""

    method: str = "both"
    skip_frames: int = 0
    max_frames: int | None = None
    n_sigma: float = 3.0
    max_iter: int = 5
    split_even_odd: bool = True
    exclude_sentinels: bool = True
    mask_bad_pixels: bool = True
    hot_rms_multiple: float = 5.0
    cold_rms_fraction: float = 0.1
    max_clip_fraction: float = 0.5

    @property
    def methods(self) -> tuple[str, ...]:
        return offset_methods(self.method)


def offset_methods(choice: str) -> tuple[str, ...]:
    """Offset methods behind a choice; case and surrounding blanks do not matter."""
    key = choice.strip().lower()
    if key not in METHODS:
        raise ValueError(f"unknown offset method {choice!r}; use one of {sorted(METHODS)}")
    return METHODS[key]


@dataclass(frozen=True)
class Calibration:
    """Products of a calibration run; all lazy tables, the per-pixel ones settled."""

    n_frames: int
    pixels: DataFrame
    cm_map: DataFrame
    cm_noise: DataFrame
    offset_type: str
    clip_trace: DataFrame | None = None
    mask: DataFrame | None = None
    geometry: Geometry = field(default_factory=Geometry)

    def save(self, path: str, mode: str = "overwrite") -> None:
        """Write the set.  The common-mode spread is computed from the written map."""
        self.cm_map.write.mode(mode).parquet(f"{path}/cm_map")
        written = self.cm_map.sparkSession.read.parquet(f"{path}/cm_map")
        save_calibration(path, self.pixels, cm_noise=common_mode.cm_noise(written), mode=mode)


def calibrate(
    rows: DataFrame,
    geometry: Geometry,
    options: CalibrationOptions = CalibrationOptions(),
    *,
    n_frames: int | None = None,
) -> Calibration:
    """Offsets, common mode, noise and bad pixels from dark frames.

    With ``n_frames`` the rows are taken as that many complete, selected frames;
    without it they are selected and counted first (from the key columns).

    Two scans of the frames: one for the pixel histograms (both offsets), one for
    the noise after common-mode subtraction; the common-mode map is a third,
    narrow one when it is used.  Per-pixel tables between them are settled.  The
    clipped offset is the reference if it was asked for, else the median; with
    one ASIC the common mode runs over whole lines.
    """
    methods = options.methods
    if n_frames is None:
        rows, n_frames = selection(rows, geometry, skip=options.skip_frames, max_frames=options.max_frames)
    histogram = offsets.pixel_histogram(to_pixels(rows), geometry)
    per_asic = geometry.n_asics > 1
    trace = None
    if "sigclip" in methods:
        if "median" in methods:
            medians, clip = offsets.both_offsets(
                histogram, geometry, n_sigma=options.n_sigma, max_iter=options.max_iter
            )
            maps = medians.join(clip.per_pixel, PIXEL)
        else:
            clip = offsets.sigma_clip(histogram, geometry, n_sigma=options.n_sigma, max_iter=options.max_iter)
            maps = clip.per_pixel
        trace = clip.trace
    else:
        maps = offsets.median_offset(histogram, geometry)
    maps = settle(maps, "offsets")

    reference = "sigclip" if "sigclip" in methods else "median"
    clipped = "sigclip" in methods
    lines = common_mode.common_mode(
        rows,
        maps,
        geometry,
        offset=f"offset_{reference}",
        per_asic=per_asic,
        split_even_odd=options.split_even_odd,
        exclude_sentinels=options.exclude_sentinels,
        carry=["keep_max"] if clipped else [],
    )
    corrected = common_mode.corrected_pixels(
        lines, geometry, per_asic=per_asic, split_even_odd=options.split_even_odd, carry=["keep_max"] if clipped else []
    )
    spread = noise.noise_kept(corrected, geometry) if clipped else noise.noise_all_frames(corrected, geometry)
    pixels = settle(maps.drop("n_kept").join(spread.select(*PIXEL, "noise"), PIXEL), "pixels")

    mask = None
    if options.mask_bad_pixels:
        mask = badpix.classify_pixels(
            pixels,
            geometry,
            n_dark_frames=n_frames if clipped else 0,
            hot_rms_multiple=options.hot_rms_multiple,
            cold_rms_fraction=options.cold_rms_fraction,
            max_clip_fraction=options.max_clip_fraction,
        )
        pixels = mask.select(*pixels.columns, "is_bad")
    cm = common_mode.cm_map(lines, geometry, per_asic=per_asic, split_even_odd=options.split_even_odd)
    return Calibration(
        n_frames=n_frames,
        pixels=pixels,
        cm_map=cm,
        cm_noise=common_mode.cm_noise(cm),
        offset_type=reference,
        clip_trace=trace,
        mask=mask,
        geometry=geometry,
    )


def calibrate_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    geometry: Geometry = Geometry(),
    options: CalibrationOptions = CalibrationOptions(),
    *,
    frames_per_partition: int | None = None,
    lines_per_partition: int | None = None,
) -> Calibration:
    """:func:`calibrate` straight from raw files.

    Selection and counting are arithmetic on file sizes: each needed file is looked
    at once, and read only for the calibration itself.
    """
    needed = None if options.max_frames is None else options.skip_frames + options.max_frames
    files = inspect_files(resolve_paths(paths), geometry.height, geometry.width, needed)
    counts = [f.n_frames for f in files]
    ranges = frame_range(counts, options.skip_frames, options.max_frames)
    rows = read_raw(
        spark,
        paths,
        geometry,
        skip=options.skip_frames,
        max_frames=options.max_frames,
        frames_per_partition=frames_per_partition,
        lines_per_partition=lines_per_partition,
        with_header=False,
        frame_counts=counts,
    )
    return calibrate(rows, geometry, options, n_frames=sum(stop - start for start, stop in ranges))


def quick_calibrate(
    pixels: DataFrame,
    geometry: Geometry,
    *,
    hot_multiple: float = 5.0,
    cold_fraction: float = 0.1,
    n_frames: int | None = None,
) -> DataFrame:
    """Median offset, raw noise and simple mask: ``y, x, offset, noise, is_bad``.

    Takes complete frames in long form.  One scan: offset and noise both come
    from one grouping of the pixel histogram.  Fewer than two frames is an error; pass
    ``n_frames`` where it is known already.
    """
    if n_frames is None:
        n_frames = frame_count(pixels.where(F.col("x") == 0))
    if n_frames < 2:
        raise ValueError("at least two frames are needed for a noise estimate")
    histogram = offsets.pixel_histogram(pixels, geometry)
    counted = ("values.adc", "values.n")
    found = offsets.pixel_values(histogram).select(
        *PIXEL, weighted_median(*counted).alias("median"), weighted_spread(*counted).alias("spread")
    )
    nan = f32(F.lit(NAN))
    maps = offsets.on_grid(found, geometry).select(
        *PIXEL, F.coalesce(f32("median"), nan).alias("offset"), F.coalesce(f32("spread"), nan).alias("noise")
    )
    maps = settle(maps, "quick")
    return badpix.simple_mask(maps, hot_multiple=hot_multiple, cold_fraction=cold_fraction)
