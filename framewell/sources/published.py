"""Calibration sets published in versions.

``save_calibration`` overwrites its tables one after another, so a reader or a failure in
between meets a mix.  Here every set goes to a folder of its own, and a manifest with one
row a table is written last, under the next number: it is the switch.  Until then readers
load the version before, and a failed save leaves nothing but a folder that no manifest
names.  A reader names a version or takes the last one; published tables never change.
Works on every file system that Spark writes to, as nothing is renamed or replaced here.
One writer at a time: two that take the same number meet an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from framewell.sources.manifests import version_folder, written_versions
from framewell.sources.store import StoredCalibration, load_calibration, save_calibration

MANIFEST = "set string, product string, label string"


class CalibrationSets:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.manifests = f"{self.path}/manifests"

    def versions(self) -> list[int]:
        return written_versions(self.spark, self.manifests)

    def _rows(self, version: int) -> list:
        return self.spark.read.schema(MANIFEST).parquet(version_folder(self.manifests, version)).collect()  # a row a product

    def labels(self) -> dict[int, str | None]:
        """What each version was said to be when it was published."""
        return {v: self._rows(v)[0]["label"] for v in self.versions()}

    def publish(
        self, pixels: DataFrame, *, cm_map: DataFrame | None = None, cm_noise: DataFrame | None = None, label: str | None = None
    ) -> int:
        """Write a set and make it the last version; returns its number."""
        name = f"set-{uuid.uuid4().hex}"
        save_calibration(f"{self.path}/{name}", pixels, cm_map=cm_map, cm_noise=cm_noise, mode="errorifexists")
        products = ["pixel_calibration", *(p for p, df in (("cm_map", cm_map), ("cm_noise", cm_noise)) if df is not None)]
        versions = self.versions()
        number = versions[-1] + 1 if versions else 0
        rows = self.spark.createDataFrame([(name, p, label) for p in products], MANIFEST)
        rows.coalesce(1).write.mode("errorifexists").parquet(version_folder(self.manifests, number))
        return number

    def load(self, version: int | None = None, *, prefer: str = "sigclip") -> StoredCalibration:
        """A version, the last one by default, as :func:`load_calibration` gives it."""
        versions = self.versions()
        if not versions:
            raise RuntimeError(f"no calibration was published under {self.path}")
        version = versions[-1] if version is None else version
        if version not in versions:
            raise ValueError(f"{self.path} has no version {version}")
        return load_calibration(self.spark, f"{self.path}/{self._rows(version)[0]['set']}", prefer=prefer)
