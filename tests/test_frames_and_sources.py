import os
import warnings

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framewell.geometry import Geometry
from framewell.operators import chunks
from framewell.operators.apply import marker_status
from framewell.sources import frames as fr
from framewell.sources import raw
from tests.fixtures import SMALL, make_frames, rows_frame, write_raw


@pytest.fixture(scope="module")
def frames():
    return make_frames(n_frames=9)


def stack(df, geometry=SMALL) -> dict[tuple[int, int, int], list[int]]:
    return {(r["file_id"], r["frame_id"], r["y"]): list(r["pixels"]) for r in df.collect()}


def expected(frames, file_id=0, only=None):
    return {
        (file_id, f, y): frames[f, y].tolist()
        for f in range(len(frames))
        for y in range(frames.shape[1])
        if only is None or f in only
    }


# -- geometry ------------------------------------------------------------------------------
def test_geometry_names_and_masks(spark):
    g = Geometry(height=2, width=10, n_asics=3, masked=(0,))
    found = {
        r["x"]: (r["name"], r["on"])
        for r in spark.range(10).select(F.col("id").cast("int").alias("x")).select("x", g.asic_name("x").alias("name"), g.is_active("x").alias("on")).collect()
    }
    assert found[0] == ("C2", False) and found[3] == ("C1", True) and found[8] == ("C0", True)
    assert found[9] == (None, True)  # beyond the last whole block
    assert g.with_masked_names(["C0"]).masked == (2,)
    with pytest.raises(ValueError):
        g.with_masked_names(["C9"])
    dim = [tuple(r) for r in g.asic_dim(spark).orderBy("asic_pos").collect()]
    assert dim == [(0, "C2", 0, 3), (1, "C1", 3, 6), (2, "C0", 6, 9)]
    assert g.grid(spark).distinct().count() == 20
    with pytest.raises(ValueError):
        Geometry(height=0)


# -- tables of frames ------------------------------------------------------------------------
def test_rows_to_pixels_and_back(spark, frames):
    rows = rows_frame(spark, frames)
    assert stack(fr.to_rows(fr.to_pixels(rows), SMALL)) == expected(frames)
    turned = {(r["y"], r["x"]): r["adc"] for r in fr.to_pixels(rows, transpose=True).where("frame_id = 2").collect()}
    assert turned[11, 4] == frames[2, 4, 11]


def test_incomplete_frames_are_dropped_and_counted(spark, frames):
    rows = rows_frame(spark, frames).where("not (frame_id = 8 and y > 3)")
    assert stack(fr.complete_frames(rows, SMALL)) == expected(frames[:8])
    inventory = fr.frame_inventory(rows, SMALL).first()
    assert (inventory["n_frames"], inventory["orphan_records"]) == (8, 4)
    assert stack(fr.complete_frames(rows_frame(spark, frames), SMALL)) == expected(frames)


def test_selection_over_files(spark, frames):
    two = fr.concat_frames(rows_frame(spark, frames[:5]), rows_frame(spark, frames[5:]))
    chosen, n = fr.selection(two, SMALL, skip=2, max_frames=5)
    assert n == 5
    keys = {(r["file_id"], r["frame_id"], r["frame_seq"]) for r in chosen.collect()}
    assert keys == {(0, 2, 2), (0, 3, 3), (0, 4, 4), (1, 0, 5), (1, 1, 6)}
    assert fr.selection(two, SMALL, skip=2)[1] == 7
    assert fr.selection(two, SMALL, max_frames=100)[1] == 9
    with pytest.raises(ValueError, match="leaves nothing"):
        fr.select_frames(two, SMALL, skip=5)  # more than the first file has, though not more than both
    for wrong in (dict(max_frames=0), dict(skip=-1)):
        with pytest.raises(ValueError):
            fr.select_frames(two, SMALL, **wrong)
    with pytest.raises(ValueError, match="numbered"):
        fr.select_frames(two.where("not (file_id = 0 and frame_id = 1 and y = 0)"), SMALL)
    with pytest.raises(ValueError, match="no complete"):
        fr.select_frames(two.where("y < 3"), SMALL)


def test_point_read_keeps_the_requested_order(spark, frames):
    rows = rows_frame(spark, frames)
    found = fr.read_frames_at(rows, [6, 1, 6]).where("y = 0").orderBy("pos").collect()
    assert [(r["pos"], r["frame_id"]) for r in found] == [(0, 6), (1, 1), (2, 6)]
    assert found[1]["pixels"] == frames[1, 0].tolist()
    with pytest.raises(IndexError):
        fr.read_frames_at(rows, [9])


def test_extract(spark, frames, tmp_path):
    rows = rows_frame(spark, frames)
    path = str(tmp_path / "part")
    assert fr.extract_frames(rows, path, SMALL, start=3, n_frames=4) == 4
    assert stack(spark.read.parquet(path)) == expected(frames, only=range(3, 7))
    with pytest.raises(Exception, match="(?i)exist"):
        fr.extract_frames(rows, path, SMALL)
    assert fr.extract_frames(rows, path, SMALL, start=7, n_frames=100, overwrite=True, lines_per_band=2) == 2
    banded = spark.read.parquet(path)
    assert {r["band"] for r in banded.select("band").distinct().collect()} == {0, 1, 2}
    gathered = str(tmp_path / "gathered")
    fr.write_rows(rows, gathered, SMALL, lines_per_band=4, files_per_band=2)
    assert stack(spark.read.parquet(gathered)) == expected(frames)
    assert sorted(d for d in os.listdir(gathered) if d.startswith("band=")) == ["band=0", "band=1"]
    for wrong in (dict(start=-1), dict(n_frames=0), dict(start=9)):
        with pytest.raises(ValueError):
            fr.extract_frames(rows, str(tmp_path / "no"), SMALL, **wrong)


# -- raw files ----------------------------------------------------------------------------------
@pytest.mark.parametrize("frames_per_partition,lines_per_partition", [(None, None), (4, None), (2, 4), (100, 1)])
def test_raw_scan(spark, frames, tmp_path, frames_per_partition, lines_per_partition):
    path = write_raw(tmp_path / "a.raw", frames)
    df = raw.read_raw(spark, path, SMALL, frames_per_partition=frames_per_partition, lines_per_partition=lines_per_partition)
    assert stack(df) == expected(frames)
    first = df.orderBy("adc_counter").select("marker", "adc_counter").head(2)
    assert [tuple(r) for r in first] == [(0xFFFF, 0), (0xFFFE, 1)]
    assert "marker" not in raw.read_raw(spark, path, SMALL, with_header=False).columns


def test_raw_partitions_are_byte_ranges(frames, tmp_path):
    path = write_raw(tmp_path / "a.raw", frames)
    options = {"path": path, "height": "6", "width": "16", "framesPerPartition": "4", "linesPerPartition": "3"}
    parts = raw.DetectorRawReader(options).partitions()
    assert [(*p.runs[0], p.y0, p.y1) for p in parts] == [
        (0, 4, 0, 3), (0, 4, 3, 6), (4, 4, 0, 3), (4, 4, 3, 6), (8, 1, 0, 3), (8, 1, 3, 6),
    ]


def test_raw_selection_over_globbed_files(spark, frames, tmp_path):
    write_raw(tmp_path / "run_b.raw", frames[4:])
    write_raw(tmp_path / "run_a.raw", frames[:4])
    pattern = str(tmp_path / "run_*.raw")
    chosen = raw.read_raw(spark, pattern, SMALL, skip=1, max_frames=5)
    assert stack(chosen) == expected(frames[:4], 0, range(1, 4)) | expected(frames[4:], 1, range(2))
    twice = raw.read_raw(spark, [str(tmp_path / "run_b.raw"), pattern], SMALL)
    assert twice.select("file_id").distinct().count() == 3  # overlaps are kept
    with pytest.raises(FileNotFoundError):
        raw.resolve_paths([pattern, str(tmp_path / "none_*.raw")])
    inventory = [(r["file_id"], r["n_frames"]) for r in raw.raw_inventory(spark, pattern, SMALL).orderBy("file_id").collect()]
    assert inventory == [(0, 4), (1, 5)]


def test_frame_ranges():
    assert raw.frame_range([5, 5, 5], 2, 7) == [(2, 5), (0, 4), (0, 0)]
    assert raw.frame_range([5, 5], 0, None) == [(0, 5), (0, 5)]
    for wrong in (([5, 5], 5, None), ([5], -1, None), ([5], 0, 0)):
        with pytest.raises(ValueError):
            raw.frame_range(*wrong)


def test_partial_last_frame_is_ignored_with_a_warning(spark, frames, tmp_path):
    path = write_raw(tmp_path / "a.raw", frames, extra_lines=4)
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        found = raw.inspect_file(path, 6, 16)
    assert (found.n_frames, found.orphan_lines) == (9, 4) and "4 lines" in str(caught[0].message)
    assert stack(raw.read_raw(spark, path, SMALL)) == expected(frames)


def test_bad_header_and_empty_files_are_refused(spark, frames, tmp_path):
    wrong = write_raw(tmp_path / "wrong.raw", frames, header=b"NOTARAW0")
    with pytest.raises(ValueError, match="header"):
        raw.inspect_file(wrong, 6, 16)
    with pytest.raises(Exception, match="header"):
        raw.read_raw(spark, wrong, SMALL).count()
    short = write_raw(tmp_path / "short.raw", frames[:0], header=b"16BU0000")
    with pytest.raises(ValueError, match="no complete"):
        raw.inspect_file(short, 6, 16)


def test_raw_point_read(spark, frames, tmp_path):
    path = write_raw(tmp_path / "a.raw", frames)
    df = raw.read_raw(spark, path, SMALL, frames=[7, 2, 3])
    assert stack(df) == expected(frames, only=(2, 3, 7))
    ordered = fr.read_frames_at(df, [7, 2, 3], n_frames=9).where("y = 0").orderBy("pos").collect()
    assert [r["frame_id"] for r in ordered] == [7, 2, 3]
    with pytest.raises(Exception, match="outside"):
        raw.read_raw(spark, path, SMALL, frames=[9]).count()


def test_marker_status(spark, frames, tmp_path):
    path = write_raw(tmp_path / "a.raw", frames, bad_markers=(0, 8, 9))
    found = {r["frame_id"]: (r["n_bad_markers"], r["markers_ok"]) for r in marker_status(raw.read_raw(spark, path, SMALL)).collect()}
    assert found[0] == (1, False) and found[1] == (2, False) and found[2] == (0, True)


def test_raw_round_trip_through_the_writer(spark, frames, tmp_path):
    folder = str(tmp_path / "out")
    raw.write_raw(rows_frame(spark, frames), folder, SMALL, n_files=3)
    files = sorted(os.listdir(folder))
    assert len(files) == 3 and all(f.endswith(".raw") for f in files)
    back = fr.select_frames(raw.read_raw(spark, f"{folder}/*.raw", SMALL), SMALL)
    found = {(r["frame_seq"], r["y"]): list(r["pixels"]) for r in back.collect()}
    assert found == {(f, y): frames[f, y].tolist() for f in range(9) for y in range(6)}
    assert marker_status(back).where("not markers_ok").count() == 0
    with pytest.raises(FileExistsError):
        raw.write_raw(rows_frame(spark, frames), folder, SMALL, n_files=1)
    raw.write_raw(rows_frame(spark, frames), folder, SMALL, n_files=1, overwrite=True)
    assert os.listdir(folder) == ["part-000000.raw"]
    with pytest.raises(Exception, match="whole frames"):
        raw.write_raw(rows_frame(spark, frames).where("y <> 2"), str(tmp_path / "bad"), SMALL, n_files=1)


# -- chunks -----------------------------------------------------------------------------------------
def frame_sums(chunk: pa.Table) -> pa.Table:
    ids = chunk["frame_id"].to_pylist()
    sums = [sum(p) for p in chunk["pixels"].to_pylist()]
    assert ids == sorted(ids)
    total = {i: 0 for i in ids}
    for i, s in zip(ids, sums):
        total[i] += s
    return pa.table({"frame_id": pa.array(list(total), pa.int64()), "total": pa.array(list(total.values()), pa.int64()), "in_chunk": pa.array([len(total)] * len(total), pa.int32())})


def test_map_chunks(spark, frames, tmp_path):
    schema = "frame_id bigint, total bigint, in_chunk int"
    found = {r["frame_id"]: (r["total"], r["in_chunk"]) for r in chunks.map_chunks(rows_frame(spark, frames), frame_sums, schema, chunk_size=4).collect()}
    assert found == {f: (int(frames[f].sum()), 4 if f < 8 else 1) for f in range(9)}
    raw_rows = raw.read_raw(spark, write_raw(tmp_path / "a.raw", frames), SMALL, frames_per_partition=4)
    direct = {r["frame_id"]: (r["total"], r["in_chunk"]) for r in chunks.map_partition_chunks(raw_rows, frame_sums, schema).collect()}
    assert direct == found
    with pytest.raises(ValueError):
        chunks.map_chunks(raw_rows, frame_sums, schema, chunk_size=0)
