"""Sets of pixels as bitmaps against Python sets."""

import random

import pytest

from framewell.geometry import Geometry
from framewell.operators import masksets

BIG = Geometry(width=256, height=300, n_asics=8)  # three buckets, the last not full


def found(df):
    return {tuple(r) for r in df.select("y", "x").collect()}


def test_sets_of_runs_match_python_sets(spark):
    rng = random.Random(3)
    pixels = [(y, x) for y in range(BIG.height) for x in (0, 1, 127, 128, 255)]
    runs = {r: {p for p in pixels if rng.random() < 0.7} for r in ("a", "b", "c")}
    rows = [(r, y, x, (y, x) in s) for r, s in runs.items() for y, x in pixels] + [("a", 5, 5, None)]
    rows += rows[:40]  # pixels given twice
    sets = masksets.pixel_sets(spark.createDataFrame(rows, "run string, y int, x int, is_bad boolean"), BIG).cache()
    a, b, c = (runs[r] for r in "abc")
    assert found(masksets.coordinates(masksets.union_of(sets), BIG)) == a | b | c
    assert found(masksets.coordinates(masksets.intersection_of(sets), BIG)) == a & b & c
    assert found(masksets.difference(sets.where("run = 'a'"), sets.where("run = 'b'"), BIG)) == a - b
    assert masksets.size_of(masksets.union_of(sets)).first()[0] == len(a | b | c)


def test_runs_without_bad_pixels_and_empty_tables(spark):
    schema = "run string, y int, x int, is_bad boolean"
    sets = masksets.pixel_sets(spark.createDataFrame([("a", 0, 0, True), ("b", 0, 0, False), ("b", 1, 1, None)], schema), BIG)
    assert found(masksets.coordinates(masksets.intersection_of(sets), BIG)) == set()
    assert found(masksets.coordinates(masksets.union_of(sets), BIG)) == {(0, 0)}
    none = masksets.pixel_sets(spark.createDataFrame([], schema), BIG)
    assert masksets.union_of(none).count() == masksets.intersection_of(none).count() == 0
    assert masksets.size_of(none).first()[0] == 0
    outside = spark.createDataFrame([("a", 300, 0, True)], schema)
    with pytest.raises(Exception, match="outside the detector"):
        masksets.pixel_sets(outside, BIG).collect()
