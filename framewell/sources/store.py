"""Calibration sets as Parquet tables under one folder.

``pixel_calibration`` holds one row per pixel, ``cm_map`` and ``cm_noise`` the
common mode; ``n_clipped`` and ``is_bad`` are columns that may be absent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from framewell.geometry import Geometry

# Fixed column names and types of the stored pixel table.
PIXEL_COLUMNS = {
    "y": "int",
    "x": "int",
    "offset_median": "float",
    "offset_sigclip": "float",
    "noise": "float",
    "n_clipped": "float",
    "is_bad": "boolean",
}


@dataclass(frozen=True)
class StoredCalibration:
    """A loaded set.  ``pixels`` has the chosen offset as ``offset``."""

    pixels: DataFrame
    offset_type: str
    cm_map: DataFrame | None = None
    cm_noise: DataFrame | None = None


def save_calibration(
    path: str,
    pixels: DataFrame,
    *,
    cm_map: DataFrame | None = None,
    cm_noise: DataFrame | None = None,
    mode: str = "overwrite",
) -> None:
    """Write the products that exist, with their fixed types."""
    known = [F.col(c).cast(t).alias(c) for c, t in PIXEL_COLUMNS.items() if c in pixels.columns]
    others = [
        F.col(c).cast("float").alias(c)
        for c in pixels.columns
        if c.startswith("offset_") and c not in PIXEL_COLUMNS
    ]
    pixels.select(*known, *others).write.mode(mode).parquet(f"{path}/pixel_calibration")
    if cm_map is not None:
        cm_map.write.mode(mode).parquet(f"{path}/cm_map")
    if cm_noise is not None:
        cm_noise.write.mode(mode).parquet(f"{path}/cm_noise")


def _read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def choose_offset(columns: list[str], prefer: str = "sigclip") -> str:
    """Offset method to use: the preferred one, the other one, then any."""
    methods = sorted(c.removeprefix("offset_") for c in columns if c.startswith("offset_"))
    alternative = "median" if prefer == "sigclip" else "sigclip"
    for method in (prefer, alternative, *methods):
        if method in methods:
            return method
    raise RuntimeError("the calibration holds no offset")


def load_calibration(spark: SparkSession, path: str, *, prefer: str = "sigclip") -> StoredCalibration:
    """Load a set; the offset and the noise are required, everything else optional."""
    pixels = _read_if_present(spark, f"{path}/pixel_calibration")
    if pixels is None:
        raise RuntimeError(f"no calibration under {path}")
    method = choose_offset(pixels.columns, prefer)
    if "noise" not in pixels.columns:
        raise RuntimeError(f"the calibration under {path} holds no noise")
    return StoredCalibration(
        pixels.withColumn("offset", F.col(f"offset_{method}")),
        method,
        _read_if_present(spark, f"{path}/cm_map"),
        _read_if_present(spark, f"{path}/cm_noise"),
    )


def map_shape(per_pixel: DataFrame, geometry: Geometry) -> DataFrame:
    """One row: how many pixels a map holds, how many differ, how many lie outside."""
    inside = F.col("y").between(0, geometry.height - 1) & F.col("x").between(0, geometry.width - 1)
    return per_pixel.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("y", "x").alias("n_pixels"),
        F.count_if(~inside).alias("n_outside"),
    )


def check_map_shape(per_pixel: DataFrame, geometry: Geometry) -> None:
    """Raise unless the map covers every pixel of the detector exactly once."""
    found = map_shape(per_pixel, geometry).first()
    if (found["n_rows"], found["n_pixels"], found["n_outside"]) != (geometry.n_pixels, geometry.n_pixels, 0):
        raise ValueError(
            f"map has {found['n_rows']} rows, {found['n_pixels']} pixels, {found['n_outside']} outside; "
            f"expected {geometry.height} x {geometry.width}"
        )
