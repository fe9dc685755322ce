import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewell import Calibration, CalibrationOptions, Geometry, calibrate, calibrate_raw, load_calibration, quick_calibrate, save_calibration
from framewell.operators import apply as ap
from framewell.operators import badpix
from framewell.operators.diagnostics import stored_diagnostics
from framewell.plans.calibrate import offset_methods
from framewell.plans.settle import settle, shared_folder
from framewell.sources.frames import to_pixels
from framewell.sources.store import check_map_shape, choose_offset
from framewell.streaming.apply import stream_calibrated, stream_rows
from tests.fixtures import SMALL, as_map, brute_clip, brute_common_mode, brute_median, make_frames, map_frame, rows_frame, spread, valid, write_raw


@pytest.fixture(scope="module")
def frames():
    return make_frames(n_frames=30)


def brute_full(frames, split, n_sigma=3.0, exclude=True):
    """Noise and common mode of a full calibration with clipped offsets."""
    offsets, clipped, kept, _ = brute_clip(frames, n_sigma)
    n, h, w = frames.shape
    values, cms = np.zeros(frames.shape), {}
    for f in range(n):
        for y in range(h):
            line = frames[f, y].tolist()
            skip = [not valid(v) for v in line] if exclude else None
            medians, values[f, y] = brute_common_mode(line, offsets[y].tolist(), SMALL, split=split, skip=skip)
            cms[f, y] = medians
    noise = np.zeros((h, w))
    for y in range(h):
        for x in range(w):
            left = list(kept[y, x])
            used = [values[f, y, x] for f in range(n) if frames[f, y, x] in left]
            noise[y, x] = spread(used, 1) if len(used) > 1 else (abs(used[0]) / 2 if used else 0.0)
    return offsets, clipped, noise, cms


@pytest.fixture(scope="module")
def full(spark, frames) -> Calibration:
    return calibrate(rows_frame(spark, frames), SMALL)


def test_full_calibration(full, frames):
    offsets, clipped, noise, cms = brute_full(frames, split=True)
    assert full.n_frames == 30 and full.offset_type == "sigclip"
    np.testing.assert_allclose(as_map(full.pixels, "offset_sigclip"), offsets, rtol=1e-6)
    np.testing.assert_array_equal(as_map(full.pixels, "offset_median"), brute_median(frames))
    np.testing.assert_array_equal(as_map(full.pixels, "n_clipped"), clipped)
    np.testing.assert_allclose(as_map(full.pixels, "noise"), noise, rtol=1e-3, atol=1e-3)
    usable = noise[(noise > 0) & np.isfinite(noise)]
    median = float(np.sort(usable)[[(len(usable) - 1) // 2, len(usable) // 2]].mean())
    bad = (noise <= 0) | (noise > 5 * median) | (noise < 0.1 * median) | (clipped / 30 > 0.5)
    np.testing.assert_array_equal(as_map(full.pixels, "is_bad"), bad)
    assert bad[1, 5] and bad[0, 1]  # never valid; far too noisy
    stored = {(r["frame_id"], r["y"], r["asic"]): r["cm"] for r in full.cm_map.collect()}
    for (f, y), medians in cms.items():
        for i in range(4):
            even, odd = medians[2 * i], medians[2 * i + 1]
            want = (even + odd) / 2 if math.isfinite(even) and math.isfinite(odd) else (even if math.isfinite(even) else odd)
            assert stored[f, y, f"C{3 - i}"] == pytest.approx(want, abs=1e-2, nan_ok=True)
    per_line = {(r["asic"], r["y"]): r["cm_noise"] for r in full.cm_noise.collect()}
    want = spread([stored[f, 2, "C1"] for f in range(30)], 1)
    assert per_line["C1", 2] == pytest.approx(want, rel=1e-4, nan_ok=True)


def test_sentinels_can_be_left_in_the_common_mode(spark, frames):
    found = calibrate(rows_frame(spark, frames), SMALL, CalibrationOptions(exclude_sentinels=False, split_even_odd=False))
    _, _, noise, _ = brute_full(frames, split=False, exclude=False)
    np.testing.assert_allclose(as_map(found.pixels, "noise"), noise, rtol=1e-3, atol=1e-3)


def test_median_method_and_selection(spark, frames):
    options = CalibrationOptions(method=" MEDIAN ", skip_frames=5, max_frames=12, split_even_odd=False, mask_bad_pixels=False)
    one_block = Geometry(height=6, width=16, n_asics=1)
    found = calibrate(rows_frame(spark, frames), one_block, options)
    part = frames[5:17]
    offsets = brute_median(part)
    np.testing.assert_array_equal(as_map(found.pixels, "offset_median"), offsets)
    assert found.n_frames == 12 and found.mask is None and found.clip_trace is None
    assert "asic" not in found.cm_map.columns and "n_clipped" not in found.pixels.columns
    values = np.array(
        [[brute_common_mode(part[f, y].tolist(), offsets[y].tolist(), one_block, skip=[not valid(v) for v in part[f, y].tolist()])[1] for y in range(6)] for f in range(12)]
    )
    noise = as_map(found.pixels, "noise")
    for y, x in ((0, 3), (3, 7), (5, 15)):
        assert noise[y, x] == pytest.approx(spread(values[:, y, x].tolist(), 1), rel=1e-4)
    assert math.isnan(noise[1, 5])


def test_calibration_from_raw_files_is_the_same(spark, frames, full, tmp_path):
    write_raw(tmp_path / "d1.raw", frames[:11], extra_lines=2)
    write_raw(tmp_path / "d2.raw", frames[11:])
    found = calibrate_raw(spark, str(tmp_path / "d*.raw"), SMALL, frames_per_partition=8, lines_per_partition=3)
    assert found.n_frames == 30
    assert found.pixels.exceptAll(full.pixels.select(*found.pixels.columns)).count() == 0
    part = calibrate_raw(spark, str(tmp_path / "d*.raw"), SMALL, CalibrationOptions(method="median", skip_frames=3, max_frames=20))
    np.testing.assert_array_equal(as_map(part.pixels, "offset_median"), brute_median(frames[3:23]))


def test_method_names():
    assert offset_methods("Both ") == ("median", "sigclip")
    assert offset_methods("sigclip") == ("sigclip",)
    with pytest.raises(ValueError):
        offset_methods("mean")
    defaults = CalibrationOptions()
    assert (defaults.n_sigma, defaults.max_iter, defaults.split_even_odd, defaults.max_clip_fraction) == (3.0, 5, True, 0.5)


def test_quick_calibration(spark, frames):
    found = quick_calibrate(to_pixels(rows_frame(spark, frames)), SMALL).cache()
    np.testing.assert_array_equal(as_map(found, "offset"), brute_median(frames))
    noise = np.array([[spread([v for v in frames[:, y, x].tolist() if valid(v)], 1) for x in range(16)] for y in range(6)])
    np.testing.assert_allclose(as_map(found, "noise"), noise, rtol=1e-5)
    bad = as_map(found, "is_bad")
    assert bad[0, 0] and bad[1, 5]  # stuck, never valid
    with pytest.raises(ValueError, match="two frames"):
        quick_calibrate(to_pixels(rows_frame(spark, frames[:1])), SMALL)


# -- stored sets ---------------------------------------------------------------------------------
def test_save_and_load(spark, full, tmp_path):
    path = str(tmp_path / "set")
    full.save(path)
    stored = load_calibration(spark, path)
    assert stored.offset_type == "sigclip"
    assert stored.pixels.schema["noise"].dataType.simpleString() == "float"
    np.testing.assert_array_equal(as_map(stored.pixels, "offset"), as_map(full.pixels, "offset_sigclip"))
    assert load_calibration(spark, path, prefer="median").offset_type == "median"
    assert stored.cm_map.count() == 30 * 6 * 4 and stored.cm_noise.count() == 24
    check_map_shape(stored.pixels, SMALL)
    with pytest.raises(ValueError):
        check_map_shape(stored.pixels.where("y > 0"), SMALL)
    found = stored_diagnostics(stored, SMALL)
    assert found["noise_histogram"].agg(F.sum("n")).first()[0] == 96
    assert found["mask_size"].first()[0] == full.pixels.where("is_bad").count()
    assert {"difference_limits", "clip_summary", "cm_limits", "cm_noise_profile"} <= set(found)


def test_load_falls_back_and_requires_noise(spark, tmp_path):
    maps = map_frame(spark, offset_trimmed=np.ones((6, 16)), noise=np.ones((6, 16)))
    save_calibration(str(tmp_path / "odd"), maps)
    stored = load_calibration(spark, str(tmp_path / "odd"))
    assert stored.offset_type == "trimmed" and stored.cm_map is None
    save_calibration(str(tmp_path / "bare"), maps.drop("noise"))
    with pytest.raises(RuntimeError, match="noise"):
        load_calibration(spark, str(tmp_path / "bare"))
    with pytest.raises(RuntimeError):
        load_calibration(spark, str(tmp_path / "missing"))
    with pytest.raises(RuntimeError):
        choose_offset(["noise"])
    assert choose_offset(["offset_median", "offset_a"]) == "median"


# -- applying ----------------------------------------------------------------------------------------
def brute_apply(frame, offset, bad, width):
    """Corrected frame (NaN where unusable) and medians, by the definition."""
    h, w = frame.shape
    out, medians = np.full((h, w), np.nan), np.full((h, w // width), np.nan)
    for y in range(h):
        for s in range(w // width):
            used = [x for x in range(s * width, (s + 1) * width) if not bad[y, x] and valid(int(frame[y, x])) and math.isfinite(offset[y, x])]
            if not used:
                continue
            residual = sorted(float(frame[y, x]) - offset[y, x] for x in used)
            medians[y, s] = (residual[(len(used) - 1) // 2] + residual[len(used) // 2]) / 2
            for x in used:
                out[y, x] = float(frame[y, x]) - offset[y, x] - medians[y, s]
    return out, medians


@pytest.fixture(scope="module")
def calibration(spark, frames):
    offset = brute_median(frames)
    bad = np.zeros((6, 16), dtype=bool)
    bad[2, 4:8] = True
    bad[0, 1] = True
    offset[3, 3] = np.inf
    return offset, bad, map_frame(spark, offset=offset, is_bad=bad)


@pytest.mark.parametrize("mode,asic_width,width", [("row", None, 16), ("asic", None, 4), ("asic", 8, 8)])
def test_apply_matches_the_definition(spark, frames, calibration, mode, asic_width, width):
    offset, bad, table = calibration
    lines = ap.apply_calibration(rows_frame(spark, frames), table, SMALL, mode=mode, asic_width=asic_width, with_corrected=True).cache()
    arrays = {(r["frame_id"], r["y"]): (r["corrected"], r["cm"]) for r in lines.collect()}
    long = {(r["frame_id"], r["y"], r["x"]): r["value"] for r in ap.applied_pixels(lines, SMALL, mode=mode, asic_width=asic_width).collect()}
    report = {r["frame_id"]: r for r in ap.frame_report(lines, table, SMALL, mode=mode, asic_width=asic_width).collect()}
    limits = {r["frame_id"]: (r["lo"], r["hi"]) for r in ap.frame_limits(lines, SMALL).collect()}
    for f in range(len(frames)):
        want, medians = brute_apply(frames[f], offset, bad, width)
        for y in range(6):
            np.testing.assert_allclose(arrays[f, y][0], want[y], atol=1e-3)
            np.testing.assert_allclose(arrays[f, y][1], medians[y], atol=1e-3)
            np.testing.assert_allclose([long[f, y, x] for x in range(16)], want[y], atol=1e-3)
        values, cm = want[np.isfinite(want)], medians[np.isfinite(medians)]
        row = report[f]
        assert (row["n_masked"], row["cm_entries"], row["n_bad_pixels"]) == (96 - values.size, cm.size, 5)
        got = [row[c] for c in ("min_value", "max_value", "mean_value", "std_value", "cm_mean", "cm_std")]
        np.testing.assert_allclose(got, [values.min(), values.max(), values.mean(), values.std(), cm.mean(), cm.std()], atol=1e-3)
        np.testing.assert_allclose(limits[f], np.percentile(values, (1, 99)), atol=1e-3)


def test_apply_refuses_wrong_modes(spark, frames, calibration):
    for settings in (dict(mode="frame"), dict(mode="asic", asic_width=5)):
        with pytest.raises(ValueError):
            ap.apply_calibration(rows_frame(spark, frames), calibration[2], SMALL, **settings)


def test_limits_of_flat_and_empty_frames(spark):
    flat = np.full((2, 6, 16), 100)
    flat[1] = 0
    table = map_frame(spark, offset=np.full((6, 16), 90.0), is_bad=np.zeros((6, 16), dtype=bool))
    lines = ap.apply_calibration(rows_frame(spark, flat), table, SMALL, mode="row", with_corrected=True).cache()
    found = {r["frame_id"]: (r["lo"], r["hi"]) for r in ap.frame_limits(lines, SMALL).collect()}
    assert found == {0: (0.0, 1.0), 1: (0.0, 1.0)}
    given = {r["frame_id"]: (r["lo"], r["hi"]) for r in ap.frame_limits(lines, SMALL, low=-5.0).collect()}
    assert given == {0: (-5.0, 0.0), 1: (0.0, 1.0)}
    report = {r["frame_id"]: r for r in ap.frame_report(lines, table, SMALL, mode="row").collect()}
    assert report[1]["n_masked"] == 96 and math.isnan(report[1]["mean_value"]) and report[1]["cm_entries"] == 0


def test_apply_on_a_stream(spark, frames, calibration, tmp_path):
    table = calibration[2]
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows_frame(spark, frames[:10]).write.parquet(source)

    def run():
        calibrated = stream_calibrated(stream_rows(spark, source, files_per_trigger=1), table, SMALL)
        query = (
            calibrated.writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    run()
    rows_frame(spark, frames[10:]).withColumn("frame_id", F.col("frame_id") + 10).write.mode("append").parquet(source)
    run()
    batch = ap.apply_calibration(rows_frame(spark, frames), table, SMALL, with_corrected=True)
    columns = ["frame_id", "y", F.col("cm").cast("string"), F.col("corrected").cast("string")]
    found = spark.read.parquet(sink)
    assert found.count() == 180
    assert found.select(*columns).exceptAll(batch.select(*columns)).count() == 0


# -- settling -------------------------------------------------------------------------------------------
def test_settle_writes_once_into_the_shared_folder(spark):
    first = settle(spark.range(3).toDF("v"))
    assert settle(first) is first
    assert all(spark.conf.get("spark.checkpoint.dir") + "/table-" in f for f in first.inputFiles())
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_classification_reads_the_frames_once(spark, frames):
    """Thresholds and flags read the settled table, not the frames again."""
    quick = quick_calibrate(to_pixels(rows_frame(spark, frames)), SMALL)
    plan = quick._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "Generate" not in plan and "parquet" in plan
    assert badpix.mask_total(quick, SMALL).first()["n_active"] == 96
