import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewell.geometry import Geometry
from framewell.operators import offsets
from framewell.sources.frames import to_pixels
from tests.fixtures import SMALL, as_map, brute_clip, brute_median, make_frames, rows_frame, spread, valid


@pytest.fixture(scope="module")
def frames():
    return make_frames()


@pytest.fixture(scope="module")
def histogram(spark, frames):
    return offsets.pixel_histogram(to_pixels(rows_frame(spark, frames)), SMALL).cache()


def test_histogram_counts_every_valid_value(histogram, frames):
    assert histogram.agg(F.sum("n")).first()[0] == sum(valid(v) for v in frames.ravel().tolist())


def test_median_skips_sentinels_and_is_nan_without_values(histogram, frames):
    found = as_map(offsets.median_offset(histogram, SMALL), "offset_median")
    np.testing.assert_array_equal(found, brute_median(frames))
    assert math.isnan(found[1, 5])


@pytest.mark.parametrize("n_sigma,max_iter", [(3.0, 5), (4.5, 5), (1.5, 2), (2.0, 9)])
def test_sigma_clip_matches_brute_force(histogram, frames, n_sigma, max_iter):
    result = offsets.sigma_clip(histogram, SMALL, n_sigma=n_sigma, max_iter=max_iter)
    offset, clipped, kept, trace = brute_clip(frames, n_sigma, max_iter)
    np.testing.assert_allclose(as_map(result.per_pixel, "offset_sigclip"), offset, rtol=1e-6)
    np.testing.assert_array_equal(as_map(result.per_pixel, "n_clipped"), clipped)
    found = [(r["n_clipped"], r["n_changed"]) for r in result.trace.orderBy("iteration").collect()]
    assert found == trace
    limits = as_map(result.per_pixel, "keep_max")
    for (y, x), values in kept.items():
        survivors = [v for v in frames[:, y, x].tolist() if valid(v) and v <= limits[y, x]]
        assert sorted(survivors) == sorted(values)


def test_clip_of_a_pixel_without_values_is_zero_and_keeps_nothing(histogram):
    row = offsets.sigma_clip(histogram, SMALL).per_pixel.where("y = 1 and x = 5").first()
    assert (row["offset_sigclip"], row["n_clipped"], row["n_kept"]) == (0.0, 0.0, 0)
    assert row["keep_max"] == -math.inf


def test_both_offsets_agree_with_the_single_ones(histogram):
    medians, clip = offsets.both_offsets(histogram, SMALL)
    assert medians.exceptAll(offsets.median_offset(histogram, SMALL)).count() == 0
    assert clip.per_pixel.exceptAll(offsets.sigma_clip(histogram, SMALL).per_pixel).count() == 0


def test_histogram_noise_is_the_sample_spread(histogram, frames):
    found = as_map(offsets.histogram_noise(histogram, SMALL), "noise")
    for y in range(SMALL.height):
        for x in range(SMALL.width):
            expected = spread([v for v in frames[:, y, x].tolist() if valid(v)], 1)
            assert found[y, x] == pytest.approx(expected, rel=1e-6, nan_ok=True)


def test_clip_summary(histogram, frames):
    per_pixel = offsets.sigma_clip(histogram, SMALL).per_pixel
    _, clipped, _, _ = brute_clip(frames)
    row = offsets.clip_summary(per_pixel, len(frames)).first()
    assert row["avg_clipped"] == pytest.approx(clipped.mean())
    assert row["avg_clipped_percent"] == pytest.approx(clipped.mean() / len(frames) * 100)
    assert row["max_clipped"] == clipped.max()


def test_other_bit_depth_moves_the_overflow(spark):
    twelve = Geometry(height=1, width=2, n_asics=1, n_bits=12)
    frames = np.array([[[4095, 65535]], [[10, 20]], [[12, 22]]])
    found = as_map(offsets.median_offset(offsets.pixel_histogram(to_pixels(rows_frame(spark, frames)), twelve), twelve), "offset_median", twelve)
    assert found.tolist() == [[11.0, 22.0]]


def test_a_single_hot_pixel_value_is_counted_not_collected(spark):
    """One value of one pixel holding most rows collapses before the shuffle."""
    rows = spark.range(20000).select(F.lit(0).alias("y"), F.lit(0).alias("x"), F.when(F.col("id") % 3 == 0, 9).otherwise(7).alias("adc"))
    one = Geometry(height=1, width=1, n_asics=1)
    histogram = offsets.pixel_histogram(rows, one)
    assert {(r["adc"], r["n"]) for r in histogram.collect()} == {(9, 6667), (7, 13333)}
    assert as_map(offsets.median_offset(histogram, one), "offset_median", one)[0, 0] == 7.0


def test_max_iter_must_be_positive(histogram):
    with pytest.raises(ValueError):
        offsets.sigma_clip(histogram, SMALL, max_iter=0)
