"""Batch reader and writer for raw detector files, ``format("detector_raw")``.

A file is an 8-byte header followed by fixed-size line records; ``height`` records
make a frame.  Positions follow from the sizes alone, so a partition is a byte
range: some frames, or with ``linesPerPartition`` a band of lines of many frames.
Bands let a task see many frames of few pixels, so that its partial per-pixel
counts shrink much further before they are shuffled.  The option ``only`` limits ``file_id``,
``frame_id`` and ``y`` to some numbers: other files are not opened, other frames and lines
not read.  Spark can push conditions on these columns down to the same end
(``PushedRawReader``), but Spark 4.1 then keeps the narrowed partitions with the loaded
table: a second query on it sees no other rows.  So that is off unless asked for, for
tables that are loaded anew for each query.

``readStream`` follows growing files and new ones (``DetectorRawStream``): an offset says
how many complete frames of each file were there.

A file may end in lines of an incomplete frame.  They are left out with a warning, unless ``orphans``
is set: then they are that frame's first lines, it counts as a frame, and the writer writes such lines too.

Files are opened with Python's ``open``: every executor must see the paths.
"""

from __future__ import annotations

import glob
import json
import os
import uuid
import warnings
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from framewell.geometry import Geometry
from framewell.sources.frames import read_frames_at

# Fixed values of the file format: header, then marker, counter, pixels per record;
# markers of the first and of every other line of a frame.
RAW_HEADER = b"16BU0000"
FRAME_MARKER, LINE_MARKER = 0xFFFF, 0xFFFE
MARKER_TYPE, COUNTER_TYPE, PIXEL_TYPE = "<u2", "<u4", "<u2"

BATCH_BYTES = 8 * 1024 * 1024
DEFAULT_FRAMES_PER_PARTITION = 64
OPENED_AT_ONCE = 32
# Beyond this many partitions the default frame count per partition grows, in whole multiples.
MAX_DEFAULT_PARTITIONS = 50_000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def record_dtype(width: int) -> np.dtype:
    return np.dtype([("marker", MARKER_TYPE), ("counter", COUNTER_TYPE), ("pixels", PIXEL_TYPE, (width,))])


def resolve_paths(spec: str | os.PathLike | Sequence[str | os.PathLike]) -> list[str]:
    """Files of one path, glob or list of them: sorted per entry, entries in order.

    Overlapping entries are kept twice.  An entry without files raises.
    """
    entries = [spec] if isinstance(spec, (str, os.PathLike)) else list(spec)
    found: list[str] = []
    for entry in map(os.fspath, entries):
        matched = sorted(glob.glob(entry)) or ([entry] if os.path.exists(entry) else [])
        if not matched:
            raise FileNotFoundError(f"no files match {entry!r}")
        found += matched
    if not found:
        raise FileNotFoundError("no files given")
    return found


@dataclass(frozen=True)
class RawFile:
    """What the header and the size of one file say."""

    path: str
    n_frames: int
    orphan_lines: int

    @property
    def n_started(self) -> int:
        """Frames with the incomplete one at the end."""
        return self.n_frames + (self.orphan_lines > 0)


def inspect_file(path: str, height: int, width: int, orphans_count: bool = False) -> RawFile:
    """Look at one file; with ``orphans_count`` a file of an incomplete frame alone is no error, nor are such lines worth a warning."""
    with open(path, "rb") as stream:
        header = stream.read(len(RAW_HEADER))
    if header != RAW_HEADER:
        raise ValueError(f"{path}: header {header!r} is not {RAW_HEADER!r}")
    records = (os.path.getsize(path) - len(RAW_HEADER)) // record_dtype(width).itemsize
    n_frames, orphans = divmod(records, height)
    if n_frames == 0 and not (orphans_count and orphans):
        raise ValueError(f"{path}: no complete frames")
    if orphans and not orphans_count:
        warnings.warn(f"{path}: {orphans} lines after {n_frames} complete frames are ignored", stacklevel=2)
    return RawFile(path, n_frames, orphans)


def inspect_files(paths: Sequence[str], height: int, width: int, needed: int | None = None) -> list[RawFile]:
    """Look at each file once, several at a time; with ``needed`` only at the first files that hold so many frames."""
    if needed is None:
        with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
            return list(pool.map(lambda path: inspect_file(path, height, width), paths))
    found: list[RawFile] = []
    for path in paths:
        if found and sum(f.n_frames for f in found) >= needed:
            break
        found.append(inspect_file(path, height, width))
    return found


def frame_range(n_frames: Sequence[int], skip: int, max_frames: int | None) -> list[tuple[int, int]]:
    """Per file the half-open frame range left by skip (first file) and a running maximum."""
    if skip < 0:
        raise ValueError("skip must not be negative")
    if skip and skip >= n_frames[0]:
        raise ValueError(f"skip={skip} leaves nothing of the first file ({n_frames[0]} frames)")
    if max_frames is not None and max_frames <= 0:
        raise ValueError("max_frames must be positive")
    left, ranges = max_frames, []
    for i, n in enumerate(n_frames):
        start = skip if i == 0 else 0
        stop = n if left is None else min(n, start + left)
        ranges.append((start, stop))
        if left is not None:
            left -= stop - start
    return ranges


class Wanted:
    """The whole numbers that all conditions on one column allow: an interval, and a set where one was given."""

    def __init__(self) -> None:
        self.low: int | None = None
        self.high: int | None = None
        self.values: set[int] | None = None

    def limit(self, given: dict) -> None:
        """Limits as an option gives them: ``low`` and ``high``, or ``values``."""
        if "values" in given:
            self.values = set(given["values"])
        else:
            self.low, self.high = given["low"], given["high"]

    def add(self, condition: Filter) -> bool:
        """Take a condition into account; False if it is of another kind."""
        if isinstance(condition, In):
            given = {v for v in condition.value if v is not None}
        elif isinstance(condition, (EqualTo, EqualNullSafe)):
            given = {condition.value}
        elif isinstance(condition, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            given = None
        else:
            return False
        if not all(type(v) is int for v in (given if given is not None else [condition.value])):
            return False
        if given is not None:
            self.values = given if self.values is None else self.values & given
        elif isinstance(condition, (GreaterThan, GreaterThanOrEqual)):
            least = condition.value + isinstance(condition, GreaterThan)
            self.low = least if self.low is None else max(self.low, least)
        else:
            most = condition.value - isinstance(condition, LessThan)
            self.high = most if self.high is None else min(self.high, most)
        return True

    def runs(self, start: int, stop: int) -> list[tuple[int, int]]:
        """What is allowed of ``[start, stop)``, as half-open runs in order."""
        start = start if self.low is None else max(start, self.low)
        stop = stop if self.high is None else min(stop, self.high + 1)
        if self.values is None:
            return [(start, stop)] if start < stop else []
        out: list[tuple[int, int]] = []
        for v in sorted(self.values):
            if not start <= v < stop:
                continue
            if out and out[-1][1] == v:
                out[-1] = (out[-1][0], v + 1)
            else:
                out.append((v, v + 1))
        return out


@dataclass
class ByteRange(InputPartition):
    """Lines ``[y0, y1)`` of some runs ``(first frame, number)`` of one file; frame ``last`` has its first ``last_lines`` only."""

    path: str
    file_id: int
    runs: list[tuple[int, int]]
    y0: int
    y1: int
    last: int | None = None
    last_lines: int = 0


def packed(runs: list[tuple[int, int]], step: int) -> Iterator[list[tuple[int, int]]]:
    """Runs ``[start, stop)`` of frames dealt into lists of up to ``step`` frames; frames between multiples of ``step`` stay together."""
    blocks: dict[int, list[tuple[int, int]]] = {}
    for start, stop in runs:
        while start < stop:
            end = min(stop, (start // step + 1) * step)
            blocks.setdefault(start // step, []).append((start, end - start))
            start = end
    held: list[tuple[int, int]] = []
    for some in blocks.values():
        if held and sum(n for _, n in held) + sum(n for _, n in some) > step:
            yield held
            held = []
        held = held + some
    if held:
        yield held


class DetectorRawReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        get = lambda name, default: int(options.get(name, default))
        self.height, self.width = get("height", 512), get("width", 512)
        paths = json.loads(options["paths"]) if "paths" in options else options.get("path")
        if not paths:
            raise ValueError("give a path")
        self.spec = paths
        self.skip = get("skipFrames", 0)
        self.max_frames = int(options["maxFrames"]) if "maxFrames" in options else None
        self.frames = json.loads(options["frames"]) if "frames" in options else None
        self.frame_counts = json.loads(options["frameCounts"]) if "frameCounts" in options else None
        self.frames_per_partition = get("framesPerPartition", 0)
        self.lines_per_partition = get("linesPerPartition", self.height)
        self.with_header = options.get("withHeader", "true").lower() == "true"
        self.orphans = options.get("orphans", "false").lower() == "true"
        self.wanted = {"file_id": Wanted(), "frame_id": Wanted(), "y": Wanted()}
        for column, limits in json.loads(options.get("only", "{}")).items():
            self.wanted[column].limit(limits)

    def partitions(self) -> list[InputPartition]:
        runs = self._runs()
        lines = [
            (y0, y1)
            for y in range(0, self.height, self.lines_per_partition)
            for y0, y1 in self.wanted["y"].runs(y, min(y + self.lines_per_partition, self.height))
        ]
        step = self.frames_per_partition
        if step < 1:
            total = sum(stop - start for _, _, some in runs for start, stop in some) * len(lines)
            step = DEFAULT_FRAMES_PER_PARTITION * max(1, -(-total // (MAX_DEFAULT_PARTITIONS * DEFAULT_FRAMES_PER_PARTITION)))
        return [
            ByteRange(file.path, file_id, some, y0, y1, *((file.n_frames, file.orphan_lines) if self.orphans else ()))
            for file_id, file, wanted in runs
            for some in packed(wanted, step)
            for y0, y1 in lines
        ]

    def _inspect(self, paths: list[str], needed: int | None = None) -> list[RawFile]:
        if not self.orphans:
            return inspect_files(paths, self.height, self.width, needed)
        with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
            return list(pool.map(lambda path: inspect_file(path, self.height, self.width, True), paths))

    def _count(self, file: RawFile) -> int:
        return file.n_started if self.orphans else file.n_frames

    def _runs(self) -> list[tuple[int, RawFile, list[tuple[int, int]]]]:
        """Per file its id, itself and the runs of frames to read.  Files that no condition allows are not opened."""
        paths = resolve_paths(self.spec)
        if self.frames is not None:
            return self._requested(paths)
        allowed = self.wanted["file_id"]
        chosen = [i for first, last in allowed.runs(0, len(paths)) for i in range(first, last)]
        counts_given = [] if self.orphans else self.frame_counts or []  # they do not tell orphan lines
        known = [RawFile(p, n, 0) for p, n in zip(paths, counts_given, strict=False)]
        if self.max_frames is None:
            if self.skip and 0 not in chosen and len(known) < 1:
                known = self._inspect(paths[:1])  # the skip must leave something of it
            missing = [i for i in chosen if i >= len(known)]
            files = {**dict(enumerate(known)), **dict(zip(missing, self._inspect([paths[i] for i in missing]), strict=True))}
            if self.skip:
                frame_range([self._count(files[0])], self.skip, None)
            ranges = {i: (self.skip if i == 0 else 0, self._count(files[i])) for i in chosen}
        else:  # a running maximum needs the files before, as far as it reaches
            needed = self.skip + self.max_frames - sum(map(self._count, known))
            if needed > 0 and len(known) < len(paths):
                known += self._inspect(paths[len(known) :], needed)
            spans = frame_range([self._count(f) for f in known], self.skip, self.max_frames)
            files = dict(enumerate(known))
            ranges = {i: spans[i] for i in chosen if i < len(spans)}
        return [(i, files[i], self.wanted["frame_id"].runs(*span)) for i, span in ranges.items()]

    def _requested(self, paths: list[str]) -> list[tuple[int, RawFile, list[tuple[int, int]]]]:
        """The explicitly requested frames of a single file."""
        if len(paths) != 1:
            raise ValueError("frames can be requested from a single file only")
        file = self._inspect(paths)[0]
        outside = [f for f in self.frames if not 0 <= f < self._count(file)]
        if outside:
            raise IndexError(f"frames {outside} outside 0..{self._count(file) - 1}")
        asked = Wanted()
        asked.values = set(self.frames)
        runs = [r for start, stop in asked.runs(0, self._count(file)) for r in self.wanted["frame_id"].runs(start, stop)]
        return [(0, file, runs)] if self.wanted["file_id"].runs(0, 1) else []

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        dtype = record_dtype(self.width)
        n_lines = partition.y1 - partition.y0
        frame_bytes = self.height * dtype.itemsize
        band_bytes = n_lines * dtype.itemsize
        block = max(1, BATCH_BYTES // (2 * band_bytes))
        with open(partition.path, "rb") as stream:
            for start, n_frames in partition.runs:
                stop = start + n_frames if partition.last is None else min(start + n_frames, partition.last)
                for first in range(start, stop, block):
                    frames = np.arange(first, min(first + block, stop))
                    if n_lines == self.height:
                        stream.seek(len(RAW_HEADER) + first * frame_bytes)
                        data = stream.read(len(frames) * frame_bytes)
                    else:
                        parts = []
                        for f in frames:
                            stream.seek(len(RAW_HEADER) + int(f) * frame_bytes + partition.y0 * dtype.itemsize)
                            parts.append(stream.read(band_bytes))
                        data = b"".join(parts)
                    yield self._batch(partition, frames, np.frombuffer(data, dtype), partition.y1)
                y1 = min(partition.y1, partition.last_lines)
                if stop < start + n_frames and partition.y0 < y1:
                    stream.seek(len(RAW_HEADER) + stop * frame_bytes + partition.y0 * dtype.itemsize)
                    data = stream.read((y1 - partition.y0) * dtype.itemsize)
                    yield self._batch(partition, np.array([stop]), np.frombuffer(data, dtype), y1)

    def _batch(self, partition: ByteRange, frames: np.ndarray, records: np.ndarray, y1: int) -> pa.RecordBatch:
        n_lines = y1 - partition.y0
        n = len(records)
        ends = np.arange(0, (n + 1) * self.width, self.width, dtype=np.int32)[: n + 1]
        pixels = pa.ListArray.from_arrays(pa.array(ends), pa.array(records["pixels"].reshape(-1).astype(np.int32)))
        columns = {
            "file_id": pa.array(np.full(n, partition.file_id, np.int32)),
            "frame_id": pa.array(np.repeat(frames.astype(np.int64), n_lines)),
            "y": pa.array(np.tile(np.arange(partition.y0, y1, dtype=np.int32), len(frames))),
        }
        if self.with_header:
            columns["marker"] = pa.array(records["marker"].astype(np.int32))
            columns["adc_counter"] = pa.array(records["counter"].astype(np.int64))
        return pa.RecordBatch.from_pydict(columns | {"pixels": pixels})


class PushedRawReader(DetectorRawReader):
    """The reader for sessions with filter pushdown: conditions on whole-number keys choose files, frames and lines."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            column = getattr(condition, "attribute", ())
            wanted = self.wanted.get(column[0].lower()) if len(column) == 1 else None
            if wanted is None or not wanted.add(condition):
                yield condition


class DetectorRawStream(DataSourceStreamReader):
    """Complete frames as they appear, in files that grow and in new ones.

    An offset lists the files in name order with their complete frames, so a restarted stream goes on
    where its checkpoint ends.  File ids are places in that order: a new file must sort after those known (as
    numbered or dated names do), and a file must not shrink or vanish; otherwise the stream stops.
    With ``orphans`` offsets count whole lines: those of a frame that is being written come as well, its others later.
    """

    def __init__(self, options: dict[str, str]):
        self.reader = DetectorRawReader(options)
        self.counted = "lines" if self.reader.orphans else "files"

    def initialOffset(self) -> dict:
        return {self.counted: []}

    def latestOffset(self) -> dict:
        height, width = self.reader.height, self.reader.width
        try:
            paths = resolve_paths(self.reader.spec)
        except FileNotFoundError:
            return self.initialOffset()
        unit = 1 if self.reader.orphans else height
        with ThreadPoolExecutor(OPENED_AT_ONCE) as pool:
            return {self.counted: list(pool.map(lambda path: [path, whole_frames(path, unit, width)], paths))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.counted not in start or self.counted not in end:
            raise ValueError("the checkpoint was written with another setting of orphans")
        before, now = start[self.counted], end[self.counted]
        if [p for p, _ in before] != [p for p, _ in now[: len(before)]]:
            raise ValueError("files read before are gone, or a new file sorts before them")
        step = self.reader.frames_per_partition or DEFAULT_FRAMES_PER_PARTITION
        out = []
        for file_id, (path, n) in enumerate(now):
            done = before[file_id][1] if file_id < len(before) else 0
            if n < done:
                raise ValueError(f"{path} has shrunk from {done} to {n} {'lines' if self.reader.orphans else 'frames'}")
            out += self._lines(path, file_id, done, n, step) if self.reader.orphans else self._frames(path, file_id, done, n, step)
        return out

    def _frames(self, path: str, file_id: int, start: int, stop: int, step: int) -> list[InputPartition]:
        return [ByteRange(path, file_id, some, 0, self.reader.height) for some in packed([(start, stop)], step)]

    def _lines(self, path: str, file_id: int, start: int, stop: int, step: int) -> list[InputPartition]:
        """Lines ``[start, stop)`` of a file: whole frames, and the ends of them at both sides."""
        height = self.reader.height
        (first, y0), (last, y1) = divmod(start, height), divmod(stop, height)
        if first == last:
            return [ByteRange(path, file_id, [(first, 1)], y0, y1)] if y0 < y1 else []
        out = [ByteRange(path, file_id, [(first, 1)], y0, height)] if y0 else []
        out += self._frames(path, file_id, first + (y0 > 0), last, step)
        return out + ([ByteRange(path, file_id, [(last, 1)], 0, y1)] if y1 else [])

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return self.reader.read(partition)

    def commit(self, end: dict) -> None:
        """Nothing to forget: files stay where they are."""


def whole_frames(path: str, height: int, width: int) -> int:
    """Complete frames of a file that may still be written: none before its header is there."""
    size = os.path.getsize(path)
    if size < len(RAW_HEADER):
        return 0
    with open(path, "rb") as stream:
        header = stream.read(len(RAW_HEADER))
    if header != RAW_HEADER:
        raise ValueError(f"{path}: header {header!r} is not {RAW_HEADER!r}")
    return (size - len(RAW_HEADER)) // (record_dtype(width).itemsize * height)


@dataclass
class WrittenFile(WriterCommitMessage):
    """One file of a task, still under its temporary name."""

    temporary: str | None = None
    part: int | None = None


class DetectorRawWriter(DataSourceArrowWriter):
    """One raw file per task.  Tasks write under temporary names of their own; the
    commit renames those of the successful attempts, so retries leave no copies.  New files are numbered
    after those in the folder, so appending keeps them, and overwriting removes them once the new ones are
    in place.  Values outside the pixel type stop the job."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.folder = options["path"]
        self.height, self.width = int(options.get("height", 512)), int(options.get("width", 512))
        self.overwrite = overwrite
        self.orphans = options.get("orphans", "false").lower() == "true"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        os.makedirs(self.folder, exist_ok=True)
        dtype, n_lines = record_dtype(self.width), 0
        part = TaskContext.get().partitionId()
        temporary = os.path.join(self.folder, f".part-{part:06d}-{uuid.uuid4().hex}")
        with open(temporary, "wb") as out:
            out.write(RAW_HEADER)
            for batch in iterator:
                table = {c: batch[c] for c in batch.schema.names}
                y = table["y"].to_numpy()
                if not np.array_equal(y, np.arange(n_lines, n_lines + len(y)) % self.height):
                    raise ValueError("lines must arrive as whole frames, in order")
                records = np.zeros(len(y), dtype)
                pixels = table["pixels"].flatten().to_numpy().reshape(len(y), self.width)
                if pixels.size and not 0 <= pixels.min() <= pixels.max() <= np.iinfo(dtype["pixels"].base).max:
                    raise ValueError(f"pixel values {pixels.min()}..{pixels.max()} do not fit the file's pixel type")
                records["pixels"] = pixels
                records["marker"] = table["marker"].to_numpy() if "marker" in table else np.where(y == 0, FRAME_MARKER, LINE_MARKER)
                records["counter"] = (
                    table["adc_counter"].to_numpy() if "adc_counter" in table else np.arange(n_lines, n_lines + len(y))
                )
                out.write(records.tobytes())
                n_lines += len(y)
        if n_lines % self.height and not self.orphans:
            raise ValueError("lines must arrive as whole frames, in order")
        if n_lines == 0:
            os.remove(temporary)
            return WrittenFile()
        return WrittenFile(temporary, part)

    def commit(self, messages: list[WrittenFile | None]) -> None:
        old = glob.glob(os.path.join(self.folder, "part-*.raw"))
        numbers = [int(n) for n in (os.path.basename(f)[5:-4] for f in old) if n.isdigit()]
        after = max(numbers, default=-1) + 1
        named = lambda n: os.path.join(self.folder, f"part-{n:06d}.raw")
        parts = sorted((m.part, m.temporary) for m in messages if m is not None and m.part is not None)
        for part, temporary in parts:
            os.replace(temporary, named(after + part))
        if self.overwrite:
            for f in old:
                os.remove(f)
            for part, _ in parts:
                os.replace(named(after + part), named(part))

    def abort(self, messages: list[WrittenFile | None]) -> None:
        for m in messages:
            if m is not None and m.temporary is not None and os.path.exists(m.temporary):
                os.remove(m.temporary)


class DetectorRawSource(DataSource):
    """Options: ``path`` or ``paths`` (JSON list), ``height``, ``width``,
    ``framesPerPartition``, ``linesPerPartition``, ``skipFrames``, ``maxFrames``,
    ``frames`` (JSON list, one file), ``frameCounts`` (JSON list, of the first files), ``withHeader``, ``only`` (JSON:
    per key column ``low`` and ``high``, or ``values``), ``pushFilters`` (in sessions with filter pushdown switched on), ``orphans``.  A stream takes ``path`` or ``paths``, the sizes,
    ``framesPerPartition``, ``withHeader`` and ``orphans``."""

    @classmethod
    def name(cls) -> str:
        return "detector_raw"

    def schema(self) -> str:
        header = "marker INT, adc_counter BIGINT, " if self.options.get("withHeader", "true").lower() == "true" else ""
        return f"file_id INT, frame_id BIGINT, y INT, {header}pixels ARRAY<INT>"

    def reader(self, schema) -> DataSourceReader:
        pushed = self.options.get("pushFilters", "false").lower() == "true"
        return (PushedRawReader if pushed else DetectorRawReader)(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return DetectorRawStream(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return DetectorRawWriter(self.options, overwrite)


def read_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    geometry: Geometry = Geometry(),
    *,
    skip: int = 0,
    max_frames: int | None = None,
    frames: Sequence[int] | None = None,
    frames_per_partition: int | None = None,
    lines_per_partition: int | None = None,
    with_header: bool = True,
    frame_counts: Sequence[int] | None = None,
    only: dict[str, range | Sequence[int]] | None = None,
    push_filters: bool = False,
    orphans: bool = False,
) -> DataFrame:
    """Read raw files as lines.  ``with_header=False`` drops marker and counter at the scan.

    ``frame_counts``, the frames of the first files where known, spares looking at them again; the other files are
    looked at as far as needed.  ``only`` limits what is read: numbers or a range for any of ``file_id``, ``frame_id``
    and ``y``.  ``push_filters`` lets Spark push conditions on them down (the session's switch for it is set); the
    table may then serve one query only, see the module.  With ``orphans`` the lines of an incomplete last frame of a
    file are read too, and it counts as a frame; every file is looked at then.
    """
    spark.dataSource.register(DetectorRawSource)
    if push_filters:
        spark.conf.set(PUSHDOWN, "true")
    entries = [paths] if isinstance(paths, (str, os.PathLike)) else list(paths)
    reader = (
        spark.read.format("detector_raw")
        .option("paths", json.dumps([os.fspath(p) for p in entries]))
        .option("height", geometry.height)
        .option("width", geometry.width)
        .option("skipFrames", skip)
        .option("withHeader", str(with_header).lower())
        .option("pushFilters", str(push_filters).lower())
        .option("orphans", str(orphans).lower())
    )
    limits = {
        column: {"low": some.start, "high": some.stop - 1} if isinstance(some, range) and some.step == 1 else {"values": [int(v) for v in some]}
        for column, some in (only or {}).items()
    }
    if unknown := set(limits) - {"file_id", "frame_id", "y"}:
        raise ValueError(f"only file_id, frame_id and y can be limited, not {sorted(unknown)}")
    optional = {
        "only": json.dumps(limits) if limits else None,
        "maxFrames": max_frames,
        "frames": None if frames is None else json.dumps([int(f) for f in frames]),
        "framesPerPartition": frames_per_partition,
        "frameCounts": None if frame_counts is None else json.dumps(list(frame_counts)),
        "linesPerPartition": lines_per_partition,
    }
    for name, value in optional.items():
        if value is not None:
            reader = reader.option(name, value)
    return reader.load()


def stream_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    geometry: Geometry = Geometry(),
    *,
    frames_per_partition: int | None = None,
    with_header: bool = True,
    orphans: bool = False,
) -> DataFrame:
    """A stream of the lines of complete frames in files that grow, and in files still to come (see ``DetectorRawStream``).

    With ``orphans`` lines come as they are written, those of incomplete frames too.
    """
    spark.dataSource.register(DetectorRawSource)
    entries = [paths] if isinstance(paths, (str, os.PathLike)) else list(paths)
    reader = (
        spark.readStream.format("detector_raw")
        .option("paths", json.dumps([os.fspath(p) for p in entries]))
        .option("height", geometry.height)
        .option("width", geometry.width)
        .option("withHeader", str(with_header).lower())
        .option("orphans", str(orphans).lower())
    )
    if frames_per_partition is not None:
        reader = reader.option("framesPerPartition", frames_per_partition)
    return reader.load()


def read_raw_frames(
    spark: SparkSession, path: str, frame_ids: Sequence[int], geometry: Geometry = Geometry(), *, orphans: bool = False
) -> DataFrame:
    """The frames at the given positions of one raw file, with their place in the request as ``pos``; repeats allowed.

    Only their bytes are read.  More than one file, or a position outside the file, is an error.  With ``orphans`` an
    incomplete last frame can be asked for too.
    """
    paths = resolve_paths(path)
    if len(paths) != 1:
        raise ValueError(f"frames are read from one file, {path!r} names {len(paths)}")
    file = inspect_file(paths[0], geometry.height, geometry.width, orphans)
    n_frames = file.n_started if orphans else file.n_frames
    only = {"frame_id": sorted({int(f) for f in frame_ids})}
    rows = read_raw(spark, paths, geometry, frame_counts=[n_frames], only=only, orphans=orphans)
    return read_frames_at(rows, frame_ids, n_frames=n_frames)


def write_raw(
    rows: DataFrame,
    folder: str,
    geometry: Geometry,
    *,
    n_files: int,
    overwrite: bool = False,
    append: bool = False,
    orphans: bool = False,
) -> None:
    """Write complete frames as ``n_files`` raw files; their name order is frame order.

    Frames are brought together by a range shuffle, so a file holds whole frames.
    An existing folder is refused unless ``overwrite``, or ``append`` (new files are numbered after the old ones).
    An incomplete frame is an error; with ``orphans`` the last one of a file may have its first lines only.
    """
    if os.path.exists(folder) and not (overwrite or append):
        raise FileExistsError(f"{folder} exists")
    spark = rows.sparkSession
    spark.dataSource.register(DetectorRawSource)
    kept = [c for c in ("marker", "adc_counter") if c in rows.columns]
    (
        rows.select("file_id", "frame_id", "y", *kept, "pixels")
        .repartitionByRange(n_files, "file_id", "frame_id")
        .sortWithinPartitions("file_id", "frame_id", "y")
        .write.format("detector_raw")
        .mode("overwrite" if overwrite else "append")
        .option("height", geometry.height)
        .option("width", geometry.width)
        .option("orphans", str(orphans).lower())
        .save(folder)
    )


def raw_inventory(spark: SparkSession, paths: str | Sequence[str], geometry: Geometry = Geometry()) -> DataFrame:
    """``file_id, path, n_frames, orphan_lines`` of raw files, from headers and sizes only."""
    files = inspect_files(resolve_paths(paths), geometry.height, geometry.width)
    rows = [(i, f.path, f.n_frames, f.orphan_lines) for i, f in enumerate(files)]
    return spark.createDataFrame(rows, "file_id int, path string, n_frames bigint, orphan_lines bigint")
