"""Reports of frames whose lines arrive over several batches.

A frame is known to be whole only when all its lines have come, in whatever batch and
order.  Each line is folded into a few sums on its own (a narrow step); keyed state
holds these sums and the lines seen, for blocks of consecutive frames.  A frame is reported when
its last line comes.  A timer reports what has not become whole in time as
incomplete, with the number of its lines, and forgets reported frames later; lines
that come after the report are counted and named late.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framewell.functions.columns import finite_or_null
from framewell.geometry import Geometry
from framewell.operators.apply import _wrong_marker
from framewell.sources.frames import FRAME_KEY

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SUMS = ["n_masked", "n", "total", "squares", "cm_entries", "cm_total", "cm_squares", "n_bad_markers"]
GATHERED = ["low", "high", *SUMS]
NOTHING = np.array([np.nan, np.nan, *[0.0] * len(SUMS)])
# Frames that share a state: a call of Python and its trips to the state store serve all of them.
BLOCK = 64
OPEN, DONE = 1, 2
STATE = "status binary, due binary, seen binary, sums binary, timer bigint"
REPORT = (
    "file_id int, frame_id bigint, status string, n_lines bigint, n_masked bigint, min_value double, max_value double, "
    "mean_value double, std_value double, cm_entries bigint, cm_mean double, cm_std double, n_bad_markers bigint"
)


def line_sums(lines: DataFrame) -> DataFrame:
    """One small row a line: ``file_id, frame_id, y``, extremes, and sums of the finite corrected values and medians."""
    values = F.filter(F.col("corrected"), lambda v: finite_or_null(v).isNotNull())
    medians = F.filter(F.col("cm"), lambda v: finite_or_null(v).isNotNull())

    def total(values: Column, square: bool) -> Column:
        step = lambda s, v: s + (v.cast("double") * v.cast("double") if square else v.cast("double"))
        return F.aggregate(values, F.lit(0.0), step)

    kept = lines.select(*FRAME_KEY, "y", values.alias("v"), medians.alias("m"), F.size("corrected").alias("width"), _wrong_marker().alias("wrong"))
    return kept.select(
        *FRAME_KEY, "y", F.array_min("v").cast("double").alias("low"), F.array_max("v").cast("double").alias("high"),
        (F.col("width") - F.size("v")).cast("double").alias("n_masked"), F.size("v").cast("double").alias("n"),
        total(F.col("v"), False).alias("total"), total(F.col("v"), True).alias("squares"),
        F.size("m").cast("double").alias("cm_entries"), total(F.col("m"), False).alias("cm_total"),
        total(F.col("m"), True).alias("cm_squares"), F.col("wrong").cast("double").alias("n_bad_markers"),
    )


def _spread(n: float, total: float, squares: float) -> tuple[float, float]:
    if n == 0:
        return float("nan"), float("nan")
    mean = total / n
    return mean, float(np.sqrt(max(squares / n - mean * mean, 0.0)))


class GatheredFrames(StatefulProcessor):
    """Lines of a block of ``BLOCK`` frames, gathered at once; the block has one timer, for the frame that is due first."""

    def __init__(self, height: int, wait_ms: int, keep_ms: int):
        self.height, self.wait_ms, self.keep_ms = height, wait_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("frames", STATE)

    def _load(self) -> bool:
        """The block as arrays with one row a frame; False if nothing is known of it."""
        known = self.state.exists()
        if known:
            status, due, seen, sums, self.timer = self.state.get()
            self.status = np.frombuffer(bytes(status), np.int8).copy()
            self.due = np.frombuffer(bytes(due), np.int64).copy()
            self.seen = np.unpackbits(np.frombuffer(bytes(seen), np.uint8), count=BLOCK * self.height).astype(bool)
            self.sums = np.frombuffer(bytes(sums), np.float64).reshape(BLOCK, -1).copy()
        else:
            self.status, self.due, self.timer = np.zeros(BLOCK, np.int8), np.zeros(BLOCK, np.int64), None
            self.seen, self.sums = np.zeros(BLOCK * self.height, bool), np.tile(NOTHING, (BLOCK, 1))
        return known

    def _store(self) -> None:
        first = int(self.due[self.status > 0].min())
        if self.timer is None or first < self.timer:
            self.handle.registerTimer(first)
            self.timer = first
        self.state.update((self.status.tobytes(), self.due.tobytes(), np.packbits(self.seen).tobytes(), self.sums.tobytes(), self.timer))

    def _rows(self, key, status: str, at: np.ndarray, n_lines: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
        rows = []
        for frame, n, found in zip(at.tolist(), n_lines.tolist(), sums.tolist(), strict=True):
            s = dict(zip(GATHERED, found, strict=True))
            mean, std = _spread(s["n"], s["total"], s["squares"])
            cm_mean, cm_std = _spread(s["cm_entries"], s["cm_total"], s["cm_squares"])
            rows.append((
                key[0], None if pd.isna(key[1]) else key[1] * BLOCK + frame, status, n, int(s["n_masked"]), s["low"], s["high"], mean, std,
                int(s["cm_entries"]), cm_mean, cm_std, int(s["n_bad_markers"]),
            ))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in REPORT.split(", ")])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._load()
        now = timerValues.getCurrentProcessingTimeInMs()
        done, late = self.status == DONE, np.zeros(BLOCK, np.int64)
        for batch in rows:
            frame = (batch["frame_id"].fillna(0).to_numpy() % BLOCK).astype(np.int64)
            y = batch["y"].to_numpy()
            late += np.bincount(frame[done[frame]], minlength=BLOCK)
            started = np.unique(frame[self.status[frame] == 0])
            self.status[started], self.due[started] = OPEN, now + self.wait_ms
            inside = np.flatnonzero(~done[frame] & (y >= 0) & (y < self.height))
            place, first = np.unique(frame[inside] * self.height + y[inside].astype(np.int64), return_index=True)  # a repeated line counts once
            fresh = ~self.seen[place]
            self.seen[place[fresh]] = True
            at = inside[first[fresh]]
            lines, owner = batch[GATHERED].to_numpy(np.float64)[at], frame[at]
            np.add.at(self.sums[:, 2:], owner, lines[:, 2:])
            np.fmin.at(self.sums[:, 0], owner, lines[:, 0])
            np.fmax.at(self.sums[:, 1], owner, lines[:, 1])
        whole = np.flatnonzero((self.status == OPEN) & self.seen.reshape(BLOCK, -1).all(axis=1))
        if len(whole):
            self.status[whole], self.due[whole] = DONE, now + self.keep_ms
            yield self._rows(key, "whole", whole, np.full(len(whole), self.height), self.sums[whole])
        if late.any():
            at = np.flatnonzero(late)
            yield self._rows(key, "late", at, late[at], np.tile(NOTHING, (len(at), 1)))
        self._store()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self._load():
            return
        now = max(timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs())
        over = self.due <= now
        forgotten, missed = over & (self.status == DONE), np.flatnonzero(over & (self.status == OPEN))
        self.status[forgotten] = 0
        self.seen.reshape(BLOCK, -1)[forgotten] = False
        self.sums[forgotten] = NOTHING
        if len(missed):
            self.status[missed], self.due[missed] = DONE, now + self.keep_ms
            n_lines = self.seen.reshape(BLOCK, -1).sum(axis=1)
            yield self._rows(key, "incomplete", missed, n_lines[missed], self.sums[missed])
        self.timer = None
        if (self.status > 0).any():
            self._store()
        else:
            self.state.clear()

    def close(self) -> None:
        """The handle holds nothing to free."""


def stream_frame_report(
    lines: DataFrame, geometry: Geometry, *, wait_ms: int = 60_000, keep_ms: int = 600_000
) -> DataFrame:
    """One row a frame of a stream of applied lines (with ``corrected``, ``cm`` and ``marker``), as soon as it is whole.

    ``status`` is ``whole``; ``incomplete`` after ``wait_ms`` without the missing lines; ``late`` for lines that come
    within ``keep_ms`` after either.  State is kept in RocksDB, which the session is set to here.
    """
    lines.sparkSession.conf.set(PROVIDER, ROCKS)
    if "marker" not in lines.columns:
        lines = lines.withColumn("marker", F.lit(None).cast("int"))
    block = F.floor(F.col("frame_id") / BLOCK).cast("bigint")
    return line_sums(lines).withColumn("block", block).groupBy("file_id", "block").transformWithStateInPandas(
        GatheredFrames(geometry.height, wait_ms, keep_ms), REPORT, "append", "ProcessingTime"
    )
