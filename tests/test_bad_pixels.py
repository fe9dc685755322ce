import math

import numpy as np
import pytest

from framewell.geometry import Geometry
from framewell.operators import badpix
from tests.fixtures import as_map, map_frame

SQUARE = Geometry(height=16, width=16, n_asics=2)


def flagged(df) -> set[tuple[int, int]]:
    return {(r["y"], r["x"]) for r in badpix.bad_coordinates(df).collect()}


def test_every_category_is_flagged(spark):
    noise = np.full((16, 16), 4.0)
    noise[2, 2], noise[5, 5], noise[7, 7], noise[9, 9], noise[11, 11] = 100.0, 0.0, 0.05, math.nan, math.inf
    flags = badpix.classify_pixels(map_frame(spark, noise=noise), SQUARE).cache()
    assert flagged(flags) == {(2, 2), (5, 5), (7, 7), (9, 9), (11, 11)}
    counts = badpix.class_counts(flags).first()
    assert (counts["median_noise"], counts["n_hot"], counts["n_cold"], counts["n_non_finite"]) == (4.0, 2, 2, 2)
    assert counts["n_bad_active"] == 5 and counts["n_active"] == 256
    assert counts["bad_percent"] == pytest.approx(500 / 256)


def test_outside_the_active_region_is_bad(spark):
    active = np.zeros((16, 16), dtype=bool)
    active[4:12, 4:12] = True
    maps = map_frame(spark, noise=np.full((16, 16), 4.0), active=active)
    flags = badpix.classify_pixels(maps, SQUARE, active="active")
    assert flagged(flags) == {(y, x) for y in range(16) for x in range(16) if not active[y, x]}


def test_padding_noise_does_not_move_the_reference(spark):
    noise = np.full((16, 16), 4.0)
    noise[:, 8:] = 4000.0
    masked = Geometry(height=16, width=16, n_asics=2, masked=(1,))
    flags = badpix.classify_pixels(map_frame(spark, noise=noise), masked)
    assert flagged(flags) == {(y, x) for y in range(16) for x in range(8, 16)}


def test_clip_fraction(spark):
    clipped = np.zeros((8, 8))
    clipped[1, 1], clipped[2, 2] = 60, 40
    maps = map_frame(spark, noise=np.full((8, 8), 4.0), n_clipped=clipped)
    small = Geometry(height=8, width=8, n_asics=1)
    settings = dict(hot_rms_multiple=10.0, cold_rms_fraction=0.0, max_clip_fraction=0.5)
    assert flagged(badpix.classify_pixels(maps, small, n_dark_frames=100, **settings)) == {(1, 1)}
    assert flagged(badpix.classify_pixels(maps, small, n_dark_frames=0, **settings)) == set()


def test_no_usable_pixel_raises(spark):
    maps = map_frame(spark, noise=np.full((16, 16), math.nan))
    with pytest.raises(Exception, match="no usable pixels"):
        badpix.classify_pixels(maps, SQUARE).collect()
    with pytest.raises(Exception, match="no finite, positive"):
        badpix.simple_mask(maps).collect()


def test_simple_mask(spark):
    noise = np.full((16, 16), 4.0)
    noise[0, 0], noise[0, 1], noise[0, 2], noise[0, 3], noise[0, 4] = math.nan, math.inf, 0.0, 21.0, 0.3
    assert flagged(badpix.simple_mask(map_frame(spark, noise=noise))) == {(0, x) for x in range(5)}


def corrected_frame(spark, stack: np.ndarray):
    rows = [
        (0, f, y, x, float(stack[f, y, x])) for f in range(stack.shape[0]) for y in range(stack.shape[1]) for x in range(stack.shape[2])
    ]
    return spark.createDataFrame(rows, "file_id int, frame_id bigint, y int, x int, value float")


def test_bright_and_empty_pixels(spark):
    stack = np.zeros((10, 2, 2))
    stack[:5, 0, 0] = 21.0  # exactly half above 5 * 4
    stack[:4, 0, 1] = 21.0
    stack[:8, 1, 0] = -13.0
    stack[:, 1, 1] = math.nan
    small = Geometry(height=2, width=2, n_asics=1)
    noise = map_frame(spark, noise=np.full((2, 2), 4.0))
    corrected = corrected_frame(spark, stack)
    assert as_map(badpix.bright_pixels(corrected, noise, small), "bright", small).tolist() == [[True, False], [False, False]]
    assert as_map(badpix.empty_pixels(corrected, noise, small), "empty", small).tolist() == [[False, False], [True, False]]
    # a NaN threshold is never exceeded
    unknown = map_frame(spark, noise=np.full((2, 2), math.nan))
    both = badpix.bright_and_empty(corrected, unknown, small).collect()
    assert all(r["n_above"] == r["n_below"] == 0 for r in both)


def test_hot_by_occupancy(spark):
    hits, adu = np.full((4, 4), 10), np.full((4, 4), 100.0)
    hits[0, 0], adu[1, 1], hits[2, 2], adu[3, 3] = 31, 501.0, 0, math.nan
    found = badpix.hot_by_occupancy(map_frame(spark, hit_count=hits, mean_adu=adu))
    assert {(r["y"], r["x"]) for r in found.where("hot_occupancy").collect()} == {(0, 0), (1, 1)}
    nothing = badpix.hot_by_occupancy(map_frame(spark, hit_count=hits * 0, mean_adu=adu))
    assert nothing.where("hot_occupancy").count() == 0


def test_comprehensive_mask_follows_its_own_rules(spark):
    noise = np.full((4, 4), 4.0)
    noise[0, 0], noise[0, 1] = 100.0, 0.1
    small = Geometry(height=4, width=4, n_asics=2, masked=(1,))
    found = badpix.comprehensive_mask(map_frame(spark, noise=noise), small).cache()
    assert flagged(found) == {(0, 0), (0, 1)} | {(y, x) for y in range(4) for x in (2, 3)}
    # one NaN among the active pixels switches the noise rules off and is itself not bad
    noise[3, 0] = math.nan
    strict = badpix.comprehensive_mask(map_frame(spark, noise=noise), small)
    assert flagged(strict) == {(y, x) for y in range(4) for x in (2, 3)}
    lenient = badpix.comprehensive_mask(map_frame(spark, noise=noise), small, strict_nan_median=False)
    assert {(0, 0), (0, 1)} <= flagged(lenient) and (3, 0) not in flagged(lenient)


def test_comprehensive_mask_joins_all_sources(spark):
    small = Geometry(height=2, width=2, n_asics=1)
    stack = np.zeros((4, 2, 2))
    stack[:, 0, 1] = 100.0
    hits = np.array([[1, 1], [9, 1]])
    found = badpix.comprehensive_mask(
        map_frame(spark, noise=np.full((2, 2), 4.0), n_clipped=np.array([[0.0, 0.0], [0.0, 3.0]])),
        small,
        n_dark_frames=4,
        corrected=corrected_frame(spark, stack),
        occupancy=map_frame(spark, hit_count=hits, mean_adu=np.ones((2, 2))),
    )
    assert as_map(found, "bright", small).tolist() == [[False, True], [False, False]]
    assert as_map(found, "hot_occupancy", small).tolist() == [[False, False], [True, False]]
    assert as_map(found, "overclipped", small).tolist() == [[False, False], [False, True]]
    assert as_map(found, "is_bad", small).tolist() == [[False, True], [True, True]]


def test_categories_and_reports(spark):
    noise = np.full((4, 4), 4.0)
    noise[0, 0], noise[0, 1], noise[0, 2], noise[0, 3] = 100.0, 0.1, math.nan, 4.0
    bad = np.zeros((4, 4), dtype=bool)
    bad[0] = True
    small = Geometry(height=4, width=4, n_asics=2)
    mask = map_frame(spark, noise=noise, is_bad=bad)
    labelled = badpix.categories(mask, small).cache()
    assert as_map(labelled, "category", small)[0].tolist() == [1, 2, 3, 4]
    counts = badpix.category_counts(labelled).first().asDict()
    assert counts == {"n_good": 12, "n_hot": 1, "n_cold": 1, "n_non_finite": 1, "n_other": 1}
    per_asic = {r["asic"]: r["n_bad"] for r in badpix.bad_per_asic(mask, small).collect()}
    assert per_asic == {"C1": 2, "C0": 2}
    total = badpix.mask_total(mask, Geometry(height=4, width=4, n_asics=2, masked=(0,))).first()
    assert (total["n_bad"], total["n_active"], total["bad_percent"]) == (4, 8, 50.0)


def test_infinite_noise_counts_as_non_finite_not_hot(spark):
    noise = np.full((2, 2), 4.0)
    noise[0, 0] = math.inf
    small = Geometry(height=2, width=2, n_asics=1)
    labelled = badpix.categories(map_frame(spark, noise=noise, is_bad=~np.isfinite(noise)), small)
    assert as_map(labelled, "category", small)[0, 0] == badpix.NON_FINITE
