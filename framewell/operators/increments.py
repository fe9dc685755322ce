"""Counts of pixel values kept between runs, so that offsets need no rescan of old frames.

The value histogram of each pixel is all that median, clipped mean and raw noise need,
and histograms add up.  A batch of frames is stored once as a delta under its own name,
in folders of ``lines_per_band`` lines; reading sums all deltas, one shuffle of counts
that is bounded by pixels and distinct values, however many frames they stand for.
``compact`` folds deltas into one.

A store is a folder of deltas and one manifest a change.  A manifest is a small table that
names the batches it holds and the delta of each; it is written last, under the next
number, so a failed or repeated write leaves the store as it was, and a batch given
twice counts once.  One writer at a time: two that take the same number meet an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.functions.columns import int_div
from framewell.geometry import Geometry
from framewell.operators.offsets import PIXEL, pixel_histogram
from framewell.sources.frames import to_pixels
from framewell.sources.manifests import version_folder, written_versions

MANIFEST = "batch string, delta string"


class HistogramStore:
    def __init__(self, spark: SparkSession, path: str, geometry: Geometry, *, lines_per_band: int = 64):
        self.spark, self.path, self.geometry, self.lines_per_band = spark, path.rstrip("/"), geometry, lines_per_band

    # -- manifests ---------------------------------------------------------------------------
    def versions(self) -> list[int]:
        """Numbers of the manifests that were written to the end."""
        return written_versions(self.spark, f"{self.path}/manifests")

    def batches(self, version: int | None = None) -> dict[str, str]:
        """The batches of a version (the last one) and the folder each is counted in."""
        versions = self.versions()
        if version is None:
            version = versions[-1] if versions else None
        if version is None:
            return {}
        if version not in versions:
            raise ValueError(f"{self.path} has no version {version}")
        rows = self.spark.read.schema(MANIFEST).parquet(version_folder(f"{self.path}/manifests", version)).collect()  # a row a batch
        return {r["batch"]: r["delta"] for r in rows}

    def _publish(self, batches: dict[str, str]) -> int:
        versions = self.versions()
        number = versions[-1] + 1 if versions else 0
        table = self.spark.createDataFrame(sorted(batches.items()), MANIFEST)
        table.coalesce(1).write.mode("errorifexists").parquet(version_folder(f"{self.path}/manifests", number))
        return number

    def _write(self, counts: DataFrame) -> str:
        name = f"delta-{uuid.uuid4().hex}"
        banded = counts.withColumn("band", int_div("y", self.lines_per_band))
        banded.write.partitionBy("band").parquet(f"{self.path}/{name}")
        return name

    # -- changes -----------------------------------------------------------------------------
    def add(self, batch: str, rows: DataFrame) -> bool:
        """Count the lines of a batch of complete frames.  False, and nothing is read, if the batch was counted before."""
        known = self.batches()
        if batch in known:
            return False
        delta = self._write(pixel_histogram(to_pixels(rows), self.geometry))
        self._publish({**known, batch: delta})
        return True

    def compact(self) -> int:
        """Fold all deltas into one; older versions stay readable."""
        known = self.batches()
        if not known:
            raise ValueError(f"{self.path} holds nothing")
        delta = self._write(self.histogram())
        return self._publish(dict.fromkeys(known, delta))

    # -- reading -----------------------------------------------------------------------------
    def histogram(self, *, version: int | None = None, lines: Iterable[int] | None = None) -> DataFrame:
        """``y, x, adc, n`` over all batches, as :func:`pixel_histogram` gives it for all their frames.

        ``lines`` reads the bands of these lines only.
        """
        deltas = sorted(set(self.batches(version).values()))
        schema = "y int, x int, adc int, n bigint, band int"
        if not deltas:
            return self.spark.createDataFrame([], schema).select(*PIXEL, "adc", "n")
        found = None
        for name in deltas:
            part = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
            found = part if found is None else found.unionByName(part)
        if lines is not None:
            wanted = sorted({int(y) for y in lines})
            found = found.where(F.col("band").isin(sorted({y // self.lines_per_band for y in wanted})) & F.col("y").isin(wanted))
        return found.groupBy(*PIXEL, "adc").agg(F.sum("n").alias("n"))
