"""Running a user's function over chunks of frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from framewell.functions.columns import int_div
from framewell.sources.frames import FRAME_KEY


def map_chunks(
    rows: DataFrame,
    worker: Callable[[pa.Table], pa.Table],
    schema: str,
    *,
    chunk_size: int = 64,
) -> DataFrame:
    """Apply ``worker`` to every chunk of ``chunk_size`` consecutive frames of a file.

    The worker gets one Arrow table per chunk, its lines in frame order, with the
    keys and ``chunk_id`` as columns, so no result depends on arrival order.
    Chunks have a fixed size, whatever the data: ``chunk_size`` frames at most.
    """
    if chunk_size < 1:
        raise ValueError("chunk_size must be positive")
    chunked = rows.withColumn("chunk_id", int_div("frame_id", chunk_size))
    ordered = [(c, "ascending") for c in (*FRAME_KEY, "y")]

    def run(table: pa.Table) -> pa.Table:
        return worker(table.sort_by(ordered))

    return chunked.groupBy("file_id", "chunk_id").applyInArrow(run, schema)


def map_partition_chunks(
    rows: DataFrame, worker: Callable[[pa.Table], pa.Table], schema: str, *, chunk_size: int = 64
) -> DataFrame:
    """As :func:`map_chunks` without a shuffle, for frames read straight from raw files.

    The lines of a partition must come in frame order, as the raw reader gives them.  They are cut at multiples of
    ``chunk_size`` frames of a file, whatever a partition holds, and one chunk is in memory at a time.  Read with
    ``frames_per_partition`` a multiple of ``chunk_size`` (the default is), and every chunk is whole.
    """
    if chunk_size < 1:
        raise ValueError("chunk_size must be positive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        open_chunk: tuple[int, int] | None = None
        for batch in batches:
            chunk = pc.floor(pc.divide(batch.column("frame_id").cast(pa.float64()), chunk_size)).cast(pa.int64()).to_numpy()
            file_id = batch.column("file_id").to_numpy()
            edges = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(file_id) != 0)) + 1
            for first, last in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if first == last:
                    continue
                here = (int(file_id[first]), int(chunk[first]))
                if open_chunk is not None and here != open_chunk:
                    yield from worker(pa.Table.from_batches(held)).to_batches()
                    held = []
                open_chunk = here
                held.append(batch.slice(first, last - first))
        if held:
            yield from worker(pa.Table.from_batches(held)).to_batches()

    return rows.mapInArrow(run, schema)
