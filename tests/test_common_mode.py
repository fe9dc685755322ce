import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewell.geometry import Geometry
from framewell.operators import common_mode as cm
from framewell.operators import noise
from framewell.operators.offsets import pixel_histogram, sigma_clip
from framewell.sources.frames import to_pixels
from tests.fixtures import SMALL, as_map, brute_clip, brute_common_mode, brute_median, make_frames, map_frame, rows_frame, spread, valid

# the trailing column belongs to no block
UNEVEN = Geometry(height=6, width=16, n_asics=3)


@pytest.fixture(scope="module")
def frames():
    return make_frames(n_frames=12)


def collect_values(df, column="value"):
    return {(r["frame_id"], r["y"], r["x"]): r[column] for r in df.select("frame_id", "y", "x", column).collect()}


def lines_of(spark, frames, geometry, offsets, **settings):
    return cm.common_mode(rows_frame(spark, frames), map_frame(spark, offset=offsets), geometry, **settings)


@pytest.mark.parametrize("per_asic", [True, False])
@pytest.mark.parametrize("split", [True, False])
@pytest.mark.parametrize("exclude", [True, False])
@pytest.mark.parametrize("geometry", [SMALL, UNEVEN])
def test_medians_and_corrected_frames(spark, frames, per_asic, split, exclude, geometry):
    offsets = brute_median(frames)  # NaN for the pixel without values
    lines = lines_of(spark, frames, geometry, offsets, per_asic=per_asic, split_even_odd=split, exclude_sentinels=exclude).cache()
    medians = {(r["frame_id"], r["y"]): r["cm"] for r in lines.select("frame_id", "y", "cm").collect()}
    values = collect_values(cm.corrected_pixels(lines, geometry, per_asic=per_asic, split_even_odd=split))
    assert len(values) == frames.size
    for f in range(len(frames)):
        for y in range(geometry.height):
            line = frames[f, y].tolist()
            skip = [not valid(v) for v in line] if exclude else None
            want, corrected = brute_common_mode(
                line, offsets[y].tolist(), geometry, per_asic=per_asic, split=split, skip=skip, propagate=not exclude
            )
            np.testing.assert_allclose(medians[f, y], want, atol=1e-3)
            np.testing.assert_allclose([values[f, y, x] for x in range(geometry.width)], corrected, atol=1e-3)


def test_bad_pixels_leave_the_median_but_are_corrected(spark, frames):
    offsets = np.nan_to_num(brute_median(frames), nan=6000.0)
    bad = np.zeros((6, 16), dtype=bool)
    bad[:, 3] = bad[2, 8:12] = True  # one block of line 2 is entirely bad
    lines = lines_of(spark, frames, SMALL, offsets, bad_pixels=map_frame(spark, is_bad=bad), exclude_sentinels=False).cache()
    values = collect_values(cm.corrected_pixels(lines, SMALL))
    stored = {(r["frame_id"], r["y"], r["asic"]): r["cm"] for r in cm.cm_map(lines, SMALL).collect()}
    for f in range(len(frames)):
        for y in range(6):
            want, corrected = brute_common_mode(frames[f, y].tolist(), offsets[y].tolist(), SMALL, skip=bad[y].tolist())
            np.testing.assert_allclose([values[f, y, x] for x in range(16)], corrected, atol=1e-3)
            np.testing.assert_allclose([stored[f, y, f"C{3 - i}"] for i in range(4)], want, atol=1e-3)
    assert all(math.isnan(stored[f, 2, "C1"]) for f in range(len(frames)))


def test_even_odd_map_stores_the_mean_or_the_finite_one(spark):
    geometry = Geometry(height=1, width=4, n_asics=1)
    frames = np.array([[[10, 20, 12, 22]], [[10, 0, 12, 65535]], [[0, 0, 0, 0]]])
    lines = lines_of(spark, frames, geometry, np.zeros((1, 4)), split_even_odd=True)
    stored = {r["frame_id"]: r["cm"] for r in cm.cm_map(lines, geometry, split_even_odd=True).collect()}
    assert stored[0] == 16.0 and stored[1] == 11.0 and math.isnan(stored[2])


def test_window_form_gives_the_same_values(spark, frames):
    offsets = brute_median(frames)
    lines = lines_of(spark, frames, SMALL, offsets, split_even_odd=True)
    want = collect_values(cm.corrected_pixels(lines, SMALL, split_even_odd=True))
    maps = map_frame(spark, offset=offsets)
    residual = to_pixels(rows_frame(spark, frames)).join(maps, ["y", "x"]).withColumn(
        "residual", F.col("adc").cast("float") - F.col("offset").cast("float")
    )
    found = collect_values(cm.common_mode_by_window(residual, SMALL, split_even_odd=True))
    assert found.keys() == want.keys()
    for key, value in found.items():
        assert value == pytest.approx(want[key], abs=1e-3, nan_ok=True)


def test_common_mode_needs_no_shuffle_of_the_frames(spark, frames):
    lines = lines_of(spark, frames, SMALL, brute_median(frames))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    frame_side = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in frame_side


def test_a_map_given_twice_is_an_error(spark, frames):
    maps = map_frame(spark, offset=np.zeros((6, 16)))
    with pytest.raises(Exception, match="twice"):
        cm.common_mode(rows_frame(spark, frames), maps.unionAll(maps), SMALL).select("cm").collect()


def test_cm_noise_is_nan_when_a_value_is_missing(spark):
    rows = [(0, 0, "C0", 1.0), (1, 0, "C0", 3.0), (0, 1, "C0", 1.0), (1, 1, "C0", math.nan), (0, 2, "C0", 5.0)]
    stored = spark.createDataFrame(rows, "frame_id bigint, y int, asic string, cm float")
    found = {r["y"]: r["cm_noise"] for r in cm.cm_noise(stored).collect()}
    assert found[0] == pytest.approx(math.sqrt(2)) and math.isnan(found[1]) and math.isnan(found[2])


def test_noise_of_all_and_of_kept_values(spark, frames):
    clip = sigma_clip(pixel_histogram(to_pixels(rows_frame(spark, frames)), SMALL), SMALL)
    offsets, _, kept, _ = brute_clip(frames)
    lines = cm.common_mode(
        rows_frame(spark, frames), clip.per_pixel, SMALL, offset="offset_sigclip", split_even_odd=True, carry=["keep_max"]
    )
    corrected = cm.corrected_pixels(lines, SMALL, split_even_odd=True, carry=["keep_max"]).cache()
    values = collect_values(corrected)
    limits = as_map(clip.per_pixel, "keep_max")
    found = noise.noise_kept(corrected, SMALL).cache()
    noise_map, n_kept = as_map(found, "noise"), as_map(found, "n_kept")
    all_noise = as_map(noise.noise_all_frames(corrected, SMALL), "noise")
    for y in range(6):
        for x in range(16):
            used = [values[f, y, x] for f in range(len(frames)) if valid(frames[f, y, x]) and frames[f, y, x] <= limits[y, x]]
            assert n_kept[y, x] == len(used) == len(kept[y, x])
            want = spread(used, 1) if len(used) > 1 else (abs(used[0]) / 2 if used else 0.0)
            assert noise_map[y, x] == pytest.approx(want, rel=1e-4, abs=1e-4)
            assert all_noise[y, x] == pytest.approx(spread([values[f, y, x] for f in range(len(frames))], 1), rel=1e-4)
    assert noise_map[1, 5] == 0.0  # never a valid value


def test_noise_of_a_single_kept_value_is_half_of_it(spark):
    one = Geometry(height=1, width=2, n_asics=1)
    rows = [(0, 0, 0, 0, 50, -6.0, 60.0), (0, 1, 0, 0, 70, 9.0, 60.0), (0, 0, 0, 1, 0, 1.0, 60.0), (0, 1, 0, 1, 65535, 2.0, 60.0)]
    corrected = spark.createDataFrame(rows, "file_id int, frame_id bigint, y int, x int, adc int, value float, keep_max double")
    assert as_map(noise.noise_kept(corrected, one), "noise", one).tolist() == [[3.0, 0.0]]
    summary = noise.kept_summary(noise.noise_kept(corrected, one), 2).first()
    assert (summary["avg_kept"], summary["avg_kept_percent"]) == (0.5, 25.0)


def test_single_frame_noise(spark):
    frames = make_frames(n_frames=1)
    offsets = map_frame(spark, offset=np.zeros((6, 16)))
    corrected = cm.corrected_pixels(cm.common_mode(rows_frame(spark, frames), offsets, SMALL), SMALL)
    assert np.isnan(as_map(noise.noise_all_frames(corrected, SMALL), "noise")).all()
    with pytest.raises(ValueError, match="two frames"):
        noise.residual_noise(to_pixels(rows_frame(spark, frames)), offsets, SMALL, offset="offset")


def test_lines_of_another_width_are_refused(spark):
    rows = spark.createDataFrame([(0, 0, 0, [1, 2, 3])], "file_id int, frame_id bigint, y int, pixels array<int>")
    with pytest.raises(Exception, match="exactly 16 pixels"):
        cm.common_mode(rows, map_frame(spark, offset=np.zeros((6, 16))), SMALL).select("cm").collect()
