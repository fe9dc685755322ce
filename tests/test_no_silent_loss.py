"""Nothing is lost, wrapped or passed off as whole without a word."""

import json
import math

import numpy as np
import pytest

from framewell import Geometry
from framewell.operators.offsets import histogram_noise, sigma_clip
from framewell.sources import raw
from framewell.sources.frames import complete_frames, extract_frames, frame_inventory, to_rows
from framewell.sources.raw import DetectorRawSource, read_raw

G = Geometry(height=2, width=4, n_asics=2)
ROWS = "file_id int, frame_id bigint, y int, pixels array<int>"


def frames(spark, n, first=0):
    return spark.createDataFrame([(0, f, y, [first + f, 1, 2, 3]) for f in range(n) for y in range(2)], ROWS).coalesce(1)


def write(spark, df, path, mode):
    spark.dataSource.register(DetectorRawSource)
    df.write.format("detector_raw").option("height", 2).option("width", 4).mode(mode).save(path)


def read(spark, path):
    return read_raw(spark, f"{path}/*.raw", G)


def test_append_keeps_what_is_there_and_overwrite_replaces_it(spark, tmp_path):
    path = str(tmp_path / "run")
    write(spark, frames(spark, 3), path, "append")
    write(spark, frames(spark, 2, first=100), path, "append")
    values = lambda: sorted(r["pixels"][0] for r in read(spark, path).where("y = 0").collect())
    assert values() == [0, 1, 2, 100, 101]
    write(spark, frames(spark, 1, first=7), path, "overwrite")
    assert values() == [7]


def test_values_beyond_the_pixel_type_stop_the_job(spark, tmp_path):
    with pytest.raises(Exception, match="do not fit"):
        write(spark, frames(spark, 1, first=70000), str(tmp_path / "run"), "append")


def test_a_pixel_twice_is_not_a_whole_line(spark):
    pixels = [(0, 0, 0, x, 10 * x) for x in (0, 0, 2, 3)] + [(0, 0, 1, x, x) for x in range(4)]
    table = spark.createDataFrame(pixels, "file_id int, frame_id bigint, y int, x int, adc int")
    assert [r["y"] for r in to_rows(table, G).collect()] == [1]
    assert complete_frames(table, G, long_form=True).count() == 0


def test_a_line_twice_is_not_a_whole_frame(spark):
    rows = [(0, 0, 0, [1] * 4), (0, 0, 0, [2] * 4), (0, 1, 0, [1] * 4), (0, 1, 1, [1] * 4), (0, 2, 0, [1] * 4), (0, 2, 5, [1] * 4)]
    table = spark.createDataFrame(rows, ROWS)
    assert {r["frame_id"] for r in complete_frames(table, G).collect()} == {1}
    assert frame_inventory(table, G).first()["orphan_records"] == 4


def test_a_short_extract_warns(spark, tmp_path):
    with pytest.warns(UserWarning, match="only 3 of 10"):
        assert extract_frames(frames(spark, 4), str(tmp_path / "out"), G, start=1, n_frames=10) == 3


def test_wide_values_keep_exact_sums(spark):
    geometry = Geometry(height=1, width=2, n_asics=1, n_bits=26)
    counted = [(0, 0, 60_000_000, 3000), (0, 0, 60_000_002, 3000), (0, 1, 3, 1 << 33), (0, 1, 5, 1 << 33)]
    histogram = spark.createDataFrame(counted, "y int, x int, adc int, n bigint")
    clipped = {r["x"]: r for r in sigma_clip(histogram, geometry).per_pixel.collect()}
    assert clipped[0]["offset_sigclip"] == np.float32(60_000_001) and clipped[0]["n_kept"] == 6000  # maps are 32-bit floats
    assert clipped[1]["offset_sigclip"] == 4 and clipped[1]["n_kept"] == 1 << 34
    noise = {r["x"]: r["noise"] for r in histogram_noise(histogram, geometry).collect()}
    assert noise[0] == pytest.approx(math.sqrt(6000 / 5999)) and noise[1] == pytest.approx(1.0)


def test_each_needed_file_is_looked_at_once(tmp_path, monkeypatch):
    looked = []
    known = raw.RawFile("", 4, 0)
    monkeypatch.setattr(raw, "inspect_file", lambda path, height, width: looked.append(path) or known)
    assert len(raw.inspect_files(["a", "b", "c"], 2, 2, needed=5)) == 2 and looked == ["a", "b"]
    looked.clear()
    assert len(raw.inspect_files(["a", "b", "c"], 2, 2)) == 3 and sorted(looked) == ["a", "b", "c"]
    looked.clear()
    for name in ("a", "b", "c"):
        (tmp_path / name).touch()
    paths = json.dumps([str(tmp_path / name) for name in ("a", "b", "c")])
    reader = raw.DetectorRawReader({"paths": paths, "height": "2", "width": "2", "frameCounts": "[4, 4]", "maxFrames": "5"})
    assert sum(n for p in reader.partitions() for _, n in p.runs) == 5 and not looked
