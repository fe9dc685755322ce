"""Stored counts that grow by batches, and blocks of any place and width."""

import os
import shutil

import numpy as np
import pytest

from framewell.geometry import Geometry
from framewell.operators.increments import HistogramStore
from framewell.operators.offsets import pixel_histogram
from framewell.operators.slices import irregular_cm_map, slice_table, with_slice
from framewell.sources.frames import to_pixels

G = Geometry(height=4, width=40, n_asics=2)


def lines(spark, rng, first, n):
    rows = [(0, f, y, [int(v) for v in rng.integers(0, 9, 40)]) for f in range(first, first + n) for y in range(4)]
    return spark.createDataFrame(rows, "file_id int, frame_id bigint, y int, pixels array<int>")


def counted(df):
    return sorted(tuple(r) for r in df.select("y", "x", "adc", "n").collect())


def test_batches_add_up_to_one_count(spark, tmp_path):
    rng = np.random.default_rng(4)
    parts = [lines(spark, rng, 10 * k, 3 + k) for k in range(3)]
    store = HistogramStore(spark, str(tmp_path / "store"), G, lines_per_band=3)
    assert store.histogram().count() == 0 and store.batches() == {}
    assert [store.add(f"b{k}", p) for k, p in enumerate(parts)] == [True] * 3
    assert store.add("b1", parts[1]) is False
    whole = counted(pixel_histogram(to_pixels(parts[0].union(parts[1]).union(parts[2])), G))
    assert counted(store.histogram()) == whole
    assert counted(store.histogram(version=0)) == counted(pixel_histogram(to_pixels(parts[0]), G))
    store.compact()
    assert len(set(store.batches().values())) == 1 and len(store.batches()) == 3
    assert counted(store.histogram()) == whole and store.add("b2", parts[2]) is False
    assert counted(store.histogram(lines=[1])) == [r for r in whole if r[0] == 1]
    with pytest.raises(ValueError, match="no version"):
        store.histogram(version=99)


def test_a_failed_batch_leaves_the_counts_as_they_were(spark, tmp_path):
    rng = np.random.default_rng(5)
    store = HistogramStore(spark, str(tmp_path / "store"), G)
    store.add("good", lines(spark, rng, 0, 2))
    before = counted(store.histogram())
    broken = lines(spark, rng, 9, 1).selectExpr("file_id", "frame_id", "y", "transform(pixels, p -> p + raise_error('lost')) AS pixels")
    with pytest.raises(Exception, match="lost"):
        store.add("bad", broken)
    shutil.copytree(tmp_path / "store/manifests/v00000000", tmp_path / "store/manifests/v00000001")
    os.remove(tmp_path / "store/manifests/v00000001/_SUCCESS")  # a manifest whose write was cut short
    assert store.versions() == [0] and counted(store.histogram()) == before


def test_blocks_with_gaps_and_unequal_widths(spark):
    blocks = [("wide", 18, 39), ("narrow", 2, 3), ("odd", 3, 16)]
    rng = np.random.default_rng(6)
    rows = lines(spark, rng, 0, 5)
    offsets = spark.createDataFrame([(y, x, float(x % 3)) for y in range(4) for x in range(40)], "y int, x int, offset float")
    got = {(r["frame_id"], r["y"], r["asic"]): r["cm"] for r in irregular_cm_map(rows, offsets, G, blocks).collect()}
    for r in rows.collect():
        v = np.array(r["pixels"], float)
        residual = np.where(v == 0, np.nan, v - np.arange(40) % 3)
        for name, a, b in blocks:
            usable = residual[a:b][~np.isnan(residual[a:b])]
            cm = got[r["frame_id"], r["y"], name]
            assert cm == pytest.approx(np.median(usable)) if len(usable) else np.isnan(cm)
    pixels = to_pixels(rows)
    found = {r["x"]: r["asic"] for r in with_slice(pixels, blocks, 40).select("x", "asic").distinct().collect()}
    assert found == {x: next((n for n, a, b in blocks if a <= x < b), None) for x in range(40)}
    assert {(r["asic"], r["bucket"]) for r in slice_table(spark, blocks, 40).collect()} == {("narrow", 0), ("odd", 0), ("wide", 1), ("wide", 2)}


@pytest.mark.parametrize("wrong", [[("a", 0, 5), ("b", 4, 9)], [("a", 3, 3)], [("a", 30, 41)], [("a", 0, 2), ("a", 2, 4)], [("a", -1, 2)]])
def test_wrong_blocks_are_refused(spark, wrong):
    with pytest.raises(ValueError):
        slice_table(spark, wrong, 40)
