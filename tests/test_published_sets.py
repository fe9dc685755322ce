"""Published versions: a failed save leaves the last one in place, earlier ones stay as they were."""

import pytest
from pyspark.sql import functions as F

from framewell.sources.published import CalibrationSets


def maps(spark, offset):
    return spark.range(6).select(
        (F.col("id") / 3).cast("int").alias("y"), (F.col("id") % 3).cast("int").alias("x"),
        F.lit(float(offset)).alias("offset_median"), F.lit(2.0).alias("noise"), (F.col("id") == 4).alias("is_bad"),
    )


def offsets(stored):
    return {r["offset"] for r in stored.pixels.collect()}


def test_versions_stay_and_a_failed_save_changes_nothing(spark, tmp_path):
    sets = CalibrationSets(spark, str(tmp_path / "sets"))
    assert sets.versions() == [] and sets.labels() == {}
    with pytest.raises(RuntimeError, match="no calibration"):
        sets.load()
    noise = spark.createDataFrame([("A", 0, 1.5)], "asic string, y int, cm_noise double")
    assert sets.publish(maps(spark, 10), cm_noise=noise, label="run 1") == 0
    broken = spark.createDataFrame([("A", 0)], "asic string, y int").withColumn("cm_noise", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):  # after its pixel table was written
        sets.publish(maps(spark, 99), cm_noise=broken, label="broken")
    assert sets.versions() == [0] and offsets(sets.load()) == {10.0} and sets.load().cm_noise.count() == 1
    held = sets.load()
    assert sets.publish(maps(spark, 20), label="run 2") == 1
    assert offsets(sets.load()) == {20.0} and sets.load().cm_noise is None
    assert offsets(sets.load(0)) == offsets(held) == {10.0}
    assert sets.labels() == {0: "run 1", 1: "run 2"}
    with pytest.raises(ValueError, match="no version 7"):
        sets.load(7)


def test_a_manifest_cut_off_is_no_version(spark, tmp_path):
    sets = CalibrationSets(spark, (tmp_path / "sets").as_uri())
    sets.publish(maps(spark, 10))
    (tmp_path / "sets" / "manifests" / "v00000001").mkdir()  # no _SUCCESS
    assert sets.versions() == [0] and offsets(sets.load()) == {10.0}
