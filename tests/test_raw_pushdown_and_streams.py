"""Conditions that choose bytes of raw files, streams of growing files, and frames gathered over batches."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNotNull, LessThan

from framewell.geometry import Geometry
from framewell.operators.apply import apply_calibration, frame_report
from framewell.operators.chunks import map_partition_chunks
from framewell.sources import raw
from framewell.streaming.reports import REPORT, stream_frame_report
from tests.fixtures import write_raw

G = Geometry(height=6, width=16, n_asics=2)


@pytest.fixture()
def files(tmp_path):
    rng = np.random.default_rng(1)
    stacks = [rng.integers(1, 9000, (n, 6, 16)).astype(np.uint16) for n in (9, 5, 7)]
    return [write_raw(tmp_path / f"run-{i}.raw", s) for i, s in enumerate(stacks)], stacks, str(tmp_path / "run-*.raw")


def reader(path, *conditions, **options):
    out = raw.PushedRawReader({"path": path, "height": "6", "width": "16", **options})
    left = list(out.pushFilters(list(conditions)))
    return out, left


def bytes_of(parts):
    return sum(n * (p.y1 - p.y0) * raw.record_dtype(16).itemsize for p in parts for _, n in p.runs)


def test_conditions_become_byte_ranges(files):
    _, _, glob = files
    everything, _ = reader(glob)
    assert bytes_of(everything.partitions()) == 21 * 6 * 38
    null = IsNotNull(("frame_id",))
    chosen, left = reader(glob, null, In(("frame_id",), (7, 2, 3)), EqualTo(("file_id",), 0), GreaterThanOrEqual(("y",), 2), LessThan(("y",), 4))
    assert left == [null]
    parts = chosen.partitions()
    assert [(p.file_id, p.runs, p.y0, p.y1) for p in parts] == [(0, [(2, 2), (7, 1)], 2, 4)]
    assert bytes_of(parts) == 3 * 2 * 38
    nothing, _ = reader(glob, EqualTo(("file_id",), 1), EqualTo(("frame_id",), 5))
    assert nothing.partitions() == []
    other, left = reader(glob, EqualTo(("marker",), 0))
    assert len(left) == 1 and bytes_of(other.partitions()) == 21 * 6 * 38


def test_other_files_are_not_opened(files, tmp_path):
    paths, _, glob = files
    with open(paths[1], "r+b") as f:
        f.write(b"BROKEN!!")
    good, _ = reader(glob, EqualTo(("file_id",), 2))
    assert {p.path for p in good.partitions()} == {paths[2]}
    with pytest.raises(ValueError, match="header"):
        reader(glob)[0].partitions()


def test_pushed_and_optional_limits_give_the_same_rows(spark, files):
    _, stacks, glob = files
    want = {(i, f, y): stacks[i][f, y].tolist() for i in (0, 2) for f in (1, 3, 6) for y in range(1, 5) if not (i == 0 and f < 2)}
    whole = raw.read_raw(spark, glob, G, skip=2, frames_per_partition=4)
    chosen = (F.col("frame_id").isin(1, 3, 6)) & (F.col("file_id") != 1) & F.col("y").between(1, 4)
    only = {"frame_id": [1, 3, 6], "file_id": [0, 2], "y": range(1, 5)}
    limited = raw.read_raw(spark, glob, G, skip=2, frames_per_partition=4, only=only)
    pushed = raw.read_raw(spark, glob, G, skip=2, frames_per_partition=4, push_filters=True).where(chosen)
    for some in (limited, pushed, whole.where(chosen)):
        assert {(r["file_id"], r["frame_id"], r["y"]): r["pixels"] for r in some.collect()} == want
    assert max(d.rdd.getNumPartitions() for d in (limited, pushed)) < whole.rdd.getNumPartitions()
    assert whole.count() == (7 + 5 + 7) * 6  # a query without pushdown is not narrowed by one before
    with pytest.raises(ValueError, match="limited"):
        raw.read_raw(spark, glob, G, only={"marker": [1]})


def test_all_files_beyond_known_counts_are_read(spark, files):
    _, _, glob = files
    assert raw.read_raw(spark, glob, G, frame_counts=[9]).count() == 21 * 6
    assert raw.read_raw(spark, glob, G, frame_counts=[9], max_frames=11).count() == 11 * 6


def test_point_read_of_one_file_only(spark, files):
    paths, stacks, glob = files
    got = raw.read_raw_frames(spark, paths[2], [6, 0, 6], G).where("y = 5").orderBy("pos").collect()
    assert [r["pixels"] for r in got] == [stacks[2][f, 5].tolist() for f in (6, 0, 6)]
    with pytest.raises(ValueError, match="one file"):
        raw.read_raw_frames(spark, glob, [0], G)
    with pytest.raises(IndexError):
        raw.read_raw_frames(spark, paths[1], [5], G)


@pytest.mark.parametrize("frames_per_partition", [3, 5, 64])
def test_chunks_do_not_follow_partitions(spark, files, frames_per_partition):
    import pyarrow as pa

    _, stacks, glob = files

    def count(table):
        first = table.column("frame_id")[0].as_py()
        return pa.table({"file_id": [table.column("file_id")[0].as_py()], "chunk": [first // 3], "n": [table.num_rows]})

    rows = raw.read_raw(spark, glob, G, frames_per_partition=frames_per_partition * 3)
    got = {(r[0], r[1]): r[2] for r in map_partition_chunks(rows, count, "file_id bigint, chunk bigint, n bigint", chunk_size=3).collect()}
    want = {}
    for i, s in enumerate(stacks):
        for f in range(len(s)):
            want[i, f // 3] = want.get((i, f // 3), 0) + 6
    assert got == want


# -- streams ---------------------------------------------------------------------------------
def run_stream(frame, sink, checkpoint):
    query = frame.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def test_a_stream_follows_growing_and_new_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    stack = rng.integers(1, 9000, (8, 6, 16)).astype(np.uint16)
    whole = write_raw(tmp_path / "whole", stack)
    data = open(whole, "rb").read()
    frame = 6 * 38
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.raw").write_bytes(data[: 8 + 3 * frame + 100])  # three frames and a part of the fourth
    (folder / "b.raw").write_bytes(data[:5])  # not even a header
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "checkpoint")
    lines = lambda: raw.stream_raw(spark, str(folder / "*.raw"), G)
    run_stream(lines(), sink, checkpoint)
    assert spark.read.parquet(sink).count() == 3 * 6
    run_stream(lines(), sink, checkpoint)  # nothing new, nothing twice
    assert spark.read.parquet(sink).count() == 3 * 6
    (folder / "a.raw").write_bytes(data[: 8 + 5 * frame])
    (folder / "b.raw").write_bytes(data[: 8 + 2 * frame + 1])
    (folder / "c.raw").write_bytes(data)
    run_stream(lines(), sink, checkpoint)
    got = {(r["file_id"], r["frame_id"], r["y"]): r["pixels"] for r in spark.read.parquet(sink).collect()}
    want = {(i, f, y): stack[f, y].tolist() for i, n in enumerate((5, 2, 8)) for f in range(n) for y in range(6)}
    assert got == want and spark.read.parquet(sink).count() == len(want)
    (folder / "aa.raw").write_bytes(data)
    with pytest.raises(Exception, match="sorts before"):
        run_stream(lines(), sink, checkpoint)


def test_frames_are_reported_when_whole(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(0, f, y, 0xFFFF if y == 0 else 0xFFFE, rng.integers(0, 9000, 16).tolist()) for f in range(4) for y in range(6)]
    schema = "file_id int, frame_id bigint, y int, marker int, pixels array<int>"
    table = spark.createDataFrame(rows, schema)
    calibration = spark.createDataFrame([(y, x, 5000.0, (y, x) == (2, 3)) for y in range(6) for x in range(16)], "y int, x int, offset float, is_bad boolean")
    want = {r["frame_id"]: r for r in frame_report(apply_calibration(table, calibration, G), calibration, G).collect()}

    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    arrive = lambda some: spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(source)
    arrive(rows[:10] + rows[2:4])  # frame 0 with repeated lines, a part of frame 1
    lines = apply_calibration(spark.readStream.schema(schema).parquet(source), calibration, G, with_corrected=True)
    report = stream_frame_report(lines, G, wait_ms=8_000, keep_ms=60_000)
    query = report.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(processingTime="1 second").start()

    def seen():
        return spark.read.schema(REPORT).parquet(sink).collect() if os.path.isdir(f"{sink}/_spark_metadata") else []

    def wait(condition, seconds=60):
        until = time.time() + seconds
        while time.time() < until and not condition():
            assert query.exception() is None
            time.sleep(0.3)
        assert condition(), seen()

    try:
        wait(lambda: any(r["frame_id"] == 0 for r in seen()))
        arrive(rows[10:15])  # the rest of frame 1, half of frame 2
        wait(lambda: any(r["frame_id"] == 1 for r in seen()))
        wait(lambda: any(r["status"] == "incomplete" for r in seen()))  # frame 2 after the timeout
        arrive(rows[15:])
        wait(lambda: any(r["frame_id"] == 3 for r in seen()) and any(r["status"] == "late" for r in seen()))
    finally:
        query.stop()
    got = sorted((r["frame_id"], r["status"], r["n_lines"]) for r in seen())
    assert got == [(0, "whole", 6), (1, "whole", 6), (2, "incomplete", 3), (2, "late", 3), (3, "whole", 6)]
    for r in seen():
        if r["status"] == "whole":
            w = want[r["frame_id"]]
            for c in ("n_masked", "cm_entries", "n_bad_markers"):
                assert r[c] == w[c]
            for c in ("min_value", "max_value", "mean_value", "std_value", "cm_mean", "cm_std"):
                assert r[c] == pytest.approx(w[c], abs=1e-6)
