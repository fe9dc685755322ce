"""Calibrating frames as they are written.

Applying a calibration needs no state: every line is corrected on its own
against a static table.  The same plan therefore runs on a stream of line files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewell.geometry import Geometry
from framewell.operators.apply import apply_calibration

LINE_SCHEMA = "file_id INT, frame_id BIGINT, y INT, pixels ARRAY<INT>"


def stream_rows(spark: SparkSession, path: str, *, schema: str = LINE_SCHEMA, files_per_trigger: int | None = None) -> DataFrame:
    """Lines from Parquet files appearing under ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_calibrated(
    rows: DataFrame, calibration: DataFrame, geometry: Geometry, *, mode: str = "asic", asic_width: int | None = None
) -> DataFrame:
    """Stream of lines with ``cm`` and ``corrected`` arrays, ready for ``writeStream``."""
    lines = apply_calibration(rows, calibration, geometry, mode=mode, asic_width=asic_width, with_corrected=True)
    return lines.drop("reference")
