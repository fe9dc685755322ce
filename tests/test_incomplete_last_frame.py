"""Registered queries against their SQL on tables whose last frame lacks lines, and files with such lines."""

import glob
import math

import duckdb
import pytest

from framewell.checks.oracle import ORACLES
from framewell.checks.queries import QUERIES
from framewell.geometry import Geometry
from framewell.sources.raw import read_raw, stream_raw, write_raw

G = Geometry(height=4, width=6, n_asics=2)
NAMES = ["a1_a5_raw_round_trip", "a4_raw_limits", "a8_raw_point_read", "j_stream_raw", "k1_raw_chunks", "l1_median_calibration"]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """426 vectors: 42 frames of ten lines, and six lines of one more."""
    folder = tmp_path_factory.mktemp("tables")
    sql = "SELECT i AS vec_id, [CAST(sin(i * 64 + j) AS FLOAT) FOR j IN range(64)] AS embedding, CAST(i % 10 AS INT) AS label FROM range(426) t(i)"
    duckdb.sql(f"COPY ({sql}) TO '{folder}/embeddings.parquet' (FORMAT parquet)")
    return str(folder)


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_queries_keep_the_lines_of_an_incomplete_frame(spark, tables, name):
    found = QUERIES[name](spark, tables)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tables}/embeddings.parquet')")
    wanted = con.execute(ORACLES[name])
    assert plain(found.columns, found.collect()) == plain([d[0] for d in wanted.description], wanted.fetchall())


def lines(spark, n):
    rows = [(0, i // 4, i % 4, [i * 6 + x for x in range(6)]) for i in range(n)]
    return spark.createDataFrame(rows, "file_id int, frame_id bigint, y int, pixels array<int>")


def first_pixels(df):
    return sorted((r["frame_id"], r["y"], r["pixels"][0]) for r in df.collect())


def test_lines_after_the_last_frame_are_read_on_demand(spark, tmp_path):
    folder = str(tmp_path / "raw")
    with pytest.raises(Exception, match="whole frames"):
        write_raw(lines(spark, 15), folder, G, n_files=1)
    write_raw(lines(spark, 15), folder, G, n_files=1, append=True, orphans=True)
    path = f"{folder}/part-*.raw"
    want = [(i // 4, i % 4, i * 6) for i in range(15)]
    for some in ({}, {"frames_per_partition": 2}, {"lines_per_partition": 3}, {"frame_counts": [3]}):
        assert first_pixels(read_raw(spark, path, G, orphans=True, **some)) == want
    assert first_pixels(read_raw(spark, path, G)) == want[:12]
    assert first_pixels(read_raw(spark, path, G, orphans=True, skip=1, max_frames=2)) == want[4:12]
    assert first_pixels(read_raw(spark, path, G, orphans=True, only={"y": range(2, 4)})) == [w for w in want if w[1] >= 2]
    assert first_pixels(read_raw(spark, path, G, orphans=True, frames=[3, 0])) == want[:4] + want[12:]


def test_a_stream_of_lines_goes_on_inside_a_frame(spark, tmp_path):
    write_raw(lines(spark, 24), str(tmp_path / "raw"), G, n_files=1)
    data = open(glob.glob(f"{tmp_path}/raw/part-*.raw")[0], "rb").read()
    record = (len(data) - 8) // 24
    growing = str(tmp_path / "growing.raw")
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "check")
    for n in (2, 3, 13, 24):
        with open(growing, "wb") as out:
            out.write(data[: 8 + n * record + 5])
        stream = stream_raw(spark, growing, G, frames_per_partition=2, orphans=True).writeStream.format("parquet")
        stream.option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        assert first_pixels(spark.read.parquet(sink)) == [(i // 4, i % 4, i * 6) for i in range(n)]
    with pytest.raises(Exception, match="another setting"):
        stream = stream_raw(spark, growing, G).writeStream.format("parquet")
        stream.option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
