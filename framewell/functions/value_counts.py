"""Arrow kernels over counted values: one list of ``(adc, n)`` per pixel.

A pixel's list has at most ``2**n_bits`` entries.  Spark groups and orders them;
the kernels walk all pixels of a batch at once, where array lambdas took some
fifteen times longer.  Sums are whole numbers about each pixel's median,
so they are exact at any bit depth and for any number of frames.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType


def _segments(adc: pa.Array, n: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat values and counts, start and length of each pixel's part."""
    bounds = adc.offsets.to_numpy().astype(np.int64)
    values = adc.flatten().to_numpy().astype(np.int64)
    counts = n.flatten().to_numpy().astype(np.int64)
    return values, counts, bounds[:-1] - bounds[0], np.diff(bounds)


def _centred(values: np.ndarray, counts: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values about the median of their pixel, the counts, and these medians.

    Where a sum of squares might not fit 64 bits both become Python integers.
    """
    upto, total = np.cumsum(counts), np.add.reduceat(counts, starts)
    base = values[np.searchsorted(upto, upto[starts] - counts[starts] + (total - 1) // 2, side="right")]
    about = values - np.repeat(base, lengths)
    fits = int(np.abs(about).max()) ** 2 * int(total.max()) < 1 << 63
    kind = np.int64 if fits else object
    return about.astype(kind), counts.astype(kind), base


def _moments(about: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(np.add.reduceat(w, starts) for w in (weights, weights * about, weights * about * about))


def _spread(s0: np.ndarray, s1: np.ndarray, s2: np.ndarray, divisor: np.ndarray) -> np.ndarray:
    """Square root of the squared distances from the mean, divided by ``divisor``."""
    s0, s1, s2, divisor = (np.asarray(s).astype(float) for s in (s0, s1, s2, divisor))
    return np.sqrt(np.maximum(s2 - s1 * (s1 / s0), 0.0) / divisor)


@arrow_udf(DoubleType())
def weighted_median(adc: pa.Array, n: pa.Array) -> pa.Array:
    """Median of each list of counted values, ascending by ``adc``."""
    values, counts, starts, _ = _segments(adc, n)
    if not len(starts):
        return pa.array([], pa.float64())
    upto = np.cumsum(counts)
    total = np.add.reduceat(counts, starts)
    before = upto[starts] - counts[starts]
    at = lambda rank: values[np.searchsorted(upto, before + rank, side="right")]
    return pa.array((at((total - 1) // 2) + at(total // 2)) / 2.0)


@arrow_udf(DoubleType())
def weighted_spread(adc: pa.Array, n: pa.Array) -> pa.Array:
    """Sample standard deviation of each list of counted values, ascending by ``adc``; NULL below two values."""
    values, counts, starts, lengths = _segments(adc, n)
    if not len(starts):
        return pa.array([], pa.float64())
    about, weights, _ = _centred(values, counts, starts, lengths)
    s0, s1, s2 = _moments(about, weights, starts)
    alone = (s0 < 2).astype(bool)
    return pa.array(_spread(s0, s1, s2, np.where(alone, 1, s0 - 1)), mask=alone)


def clip_rounds(n_sigma: float, max_iter: int):
    """UDF ``(adc, n) -> struct`` of the state after each clipping round.

    ``mu``, ``keep`` (a value survives while ``adc <= keep``), ``kept`` and
    ``shift`` (how far the mean moved), one entry per round.
    """
    fields = "mu: array<double>, keep: array<double>, kept: array<bigint>, shift: array<double>"

    @arrow_udf(f"struct<{fields}>")
    def rounds(adc: pa.Array, n: pa.Array) -> pa.Array:
        values, counts, starts, lengths = _segments(adc, n)
        if not len(starts):
            nothing = pa.array([], pa.list_(pa.float64()))
            return pa.StructArray.from_arrays(
                [nothing, nothing, pa.array([], pa.list_(pa.int64())), nothing], ["mu", "keep", "kept", "shift"]
            )
        about, weights, base = _centred(values, counts, starts, lengths)
        keep = np.full(len(starts), np.inf)
        history: list[tuple[np.ndarray, ...]] = []

        s0, s1, s2 = _moments(about, weights, starts)
        mean = lambda n, s: ((s + base * n) / np.maximum(n, 1)).astype(float)
        mu, sd = mean(s0, s1), _spread(s0, s1, s2, s0)  # population spread to start with
        for _ in range(max_iter):
            keep = np.minimum(keep, mu + n_sigma * sd)
            kept, s1, s2 = _moments(about, np.where(values <= np.repeat(keep, lengths), weights, 0), starts)
            new_mu = mean(kept, s1)
            history.append((new_mu, keep, kept.astype(np.int64), np.abs(new_mu - mu)))
            mu, sd = new_mu, _spread(np.maximum(kept, 1), s1, s2, np.maximum(kept - 1, 1))

        ends = pa.array(np.arange(0, (len(starts) + 1) * max_iter, max_iter, dtype=np.int32)[: len(starts) + 1])
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.stack(part, axis=1).reshape(-1))) for part in zip(*history)]
        return pa.StructArray.from_arrays(lists, ["mu", "keep", "kept", "shift"])

    return rounds
