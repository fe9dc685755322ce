"""Synthetic frames, raw files, and brute-force answers for small grids.

The brute force walks pixels and lines one at a time with the standard
library's definitions; it shares nothing with the library under test.
"""

from __future__ import annotations

import math
import statistics
import struct

import numpy as np

from framewell.geometry import Geometry

SMALL = Geometry(height=6, width=16, n_asics=4)


def make_frames(geometry: Geometry = SMALL, n_frames: int = 40, seed: int = 7) -> np.ndarray:
    """Frames with baselines, common mode, hits, sentinels and four odd pixels.

    (0,0) stuck, (0,1) hot, (0,2) cold, (1,5) only sentinels.
    """
    rng = np.random.default_rng(seed)
    h, w = geometry.height, geometry.width
    base = rng.integers(5000, 9000, (h, w))
    noise = rng.normal(0, 4, (n_frames, h, w))
    noise[:, 0, 1] *= 30
    noise[:, 0, 2] *= 0.02
    shift = rng.normal(0, 15, (n_frames, h, geometry.n_asics, 2))
    columns = np.arange(w)
    block, parity = columns // geometry.asic_width, (columns % geometry.asic_width) % 2
    frames = base + noise + shift[:, :, np.minimum(block, geometry.n_asics - 1), parity]
    hits = rng.random(frames.shape) < 0.02
    frames[hits] += rng.exponential(400, hits.sum())
    frames = np.clip(np.round(frames), 1, 65534).astype(np.int64)
    sentinel = rng.random(frames.shape)
    frames[sentinel < 0.01] = 0
    frames[sentinel > 0.99] = 65535
    frames[:, 0, 0] = 7000
    frames[:, 1, 5] = np.where(np.arange(n_frames) % 2, 0, 65535)
    return frames


def rows_frame(spark, frames: np.ndarray, file_id: int = 0):
    rows = [
        (file_id, f, y, [int(v) for v in frames[f, y]]) for f in range(len(frames)) for y in range(frames.shape[1])
    ]
    return spark.createDataFrame(rows, "file_id int, frame_id bigint, y int, pixels array<int>")


def map_frame(spark, **columns):
    """Per-pixel table from equally shaped 2-D arrays."""
    names = list(columns)
    shape = columns[names[0]].shape
    types = {"f": "double", "i": "bigint", "b": "boolean"}
    rows = [(y, x, *[columns[n][y, x].item() for n in names]) for y in range(shape[0]) for x in range(shape[1])]
    fields = ", ".join(f"{n} {types[columns[n].dtype.kind]}" for n in names)
    return spark.createDataFrame(rows, f"y int, x int, {fields}")


def as_map(df, column: str, geometry: Geometry = SMALL) -> np.ndarray:
    out = np.full((geometry.height, geometry.width), None, dtype=object)
    for row in df.select("y", "x", column).collect():
        assert out[row["y"], row["x"]] is None, "pixel twice"
        out[row["y"], row["x"]] = row[column]
    assert all(v is not None for v in out.ravel()), "pixel missing"
    return np.array(out.tolist())


# -- raw files -----------------------------------------------------------------------------
def write_raw(path, frames: np.ndarray, *, extra_lines: int = 0, header: bytes = b"16BU0000", bad_markers=()) -> str:
    counter = 0
    with open(path, "wb") as out:
        out.write(header)
        lines = [(y, frame[y]) for frame in frames for y in range(frames.shape[1])]
        lines += [(y, frames[0][y]) for y in range(extra_lines)]
        for i, (y, pixels) in enumerate(lines):
            marker = 0xFFFF if y == 0 else 0xFFFE
            if i in bad_markers:
                marker = 0x1234
            out.write(struct.pack("<HI", marker, counter))
            out.write(struct.pack(f"<{len(pixels)}H", *[int(p) for p in pixels]))
            counter += 1
    return str(path)


# -- brute force ------------------------------------------------------------------------------
def valid(value: float, top: int = 65535) -> bool:
    return value not in (0, top)


def spread(values, ddof: int) -> float:
    n = len(values)
    if n - ddof <= 0:
        return math.nan
    mean = math.fsum(values) / n
    return math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (n - ddof))


def median_or_nan(values) -> float:
    return statistics.median(values) if values else math.nan


def brute_median(frames: np.ndarray) -> np.ndarray:
    _, h, w = frames.shape
    return np.array([[median_or_nan([v for v in frames[:, y, x].tolist() if valid(v)]) for x in range(w)] for y in range(h)])


def brute_clip(frames: np.ndarray, n_sigma: float = 3.0, max_iter: int = 5):
    """Offsets, clip counts, survivors per pixel and the trace of the rounds."""
    _, h, w = frames.shape
    pixels = {(y, x): [v for v in frames[:, y, x].tolist() if valid(v)] for y in range(h) for x in range(w)}
    kept = dict(pixels)
    mean = {p: math.fsum(v) / len(v) if v else math.nan for p, v in pixels.items()}
    sd = {p: spread(v, 0) if v else math.nan for p, v in pixels.items()}
    trace = []
    for _ in range(max_iter):
        moved = 0
        for p in pixels:
            kept[p] = [v for v in kept[p] if v <= mean[p] + n_sigma * sd[p]]
            new = math.fsum(kept[p]) / max(len(kept[p]), 1)
            moved += (new - mean[p]) ** 2 > 1e-6
            mean[p] = new
            sd[p] = math.sqrt(math.fsum((v - new) ** 2 for v in kept[p]) / max(len(kept[p]) - 1, 1))
        trace.append((sum(len(pixels[p]) - len(kept[p]) for p in pixels), moved))
        if moved == 0:
            break
    grid = lambda f: np.array([[f((y, x)) for x in range(w)] for y in range(h)])
    return grid(lambda p: mean[p]), grid(lambda p: len(pixels[p]) - len(kept[p])), kept, trace


def brute_common_mode(line, offsets, geometry: Geometry, *, per_asic=True, split=False, skip=None, propagate=False):
    """Medians of one line (list per slice of one or two values) and the corrected line.

    ``skip[x]`` leaves a pixel out of the medians.
    """
    width = geometry.asic_width if per_asic else geometry.width
    n = geometry.n_asics if per_asic else 1
    residual = [float(v) - float(o) for v, o in zip(line, offsets)]
    corrected, medians = list(residual), []
    for s in range(n):
        for parity in (0, 1) if split else (None,):
            columns = [x for x in range(s * width, (s + 1) * width) if parity is None or (x - s * width) % 2 == parity]
            used = [residual[x] for x in columns if not (skip is not None and skip[x])]
            if propagate and any(math.isnan(v) for v in used):
                value = math.nan
            else:
                value = median_or_nan([v for v in used if not math.isnan(v)])
            medians.append(value)
            for x in columns:
                corrected[x] = residual[x] - (value if math.isfinite(value) else 0.0)
    return medians, corrected
