"""Arrow kernels over whole readout lines.

The common mode of a line is a set of medians over fixed slices of its pixel
array.  Array lambdas can say that, but they are interpreted element by
element; on 512-pixel lines they measured about five times slower than one
vectorised call per Arrow batch, so this is the one place where the library
leaves the JVM.  The kernels only see the lines of one batch: partitioning,
joining and aggregating stay with Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql.functions import arrow_udf


def _as_matrix(lines: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column as a (lines, width) float32 matrix, NULL as NaN."""
    values = lines.flatten().to_numpy(zero_copy_only=False)
    if len(values) != len(lines) * width:
        raise ValueError(f"every readout line must hold exactly {width} pixels")
    return values.reshape(len(lines), width).astype(np.float32)


def _as_lists(matrix: np.ndarray) -> pa.Array:
    n, k = matrix.shape
    offsets = pa.array(np.arange(0, (n + 1) * k, k, dtype=np.int32)[: n + 1])
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.reshape(-1).astype(np.float32)))


def _median_last_axis(values: np.ndarray, skip_nan: bool) -> np.ndarray:
    """Median along the last axis; NaN is either skipped or passed on."""
    size = values.shape[-1]
    ranked = np.sort(values, axis=-1)  # NaN sorts last
    n_good = size - np.isnan(ranked).sum(axis=-1)
    low = np.maximum(n_good - 1, 0) // 2
    high = np.minimum(n_good // 2, size - 1)
    pick = lambda at: np.take_along_axis(ranked, at[..., None], axis=-1)[..., 0]
    middle = (pick(low) + pick(high)) * np.float32(0.5)
    usable = n_good > 0 if skip_nan else n_good == size
    return np.where(usable, middle, np.float32(np.nan))


def slice_medians(
    width: int,
    n_slices: int,
    slice_width: int,
    *,
    split_parity: bool,
    sentinels: tuple[int, int] | None,
    skip_nan: bool,
):
    """UDF ``(pixels, reference) -> array<float>`` of per-slice medians.

    Works on ``pixels - reference`` in float32.  A NaN reference leaves the
    pixel out, and so does an ADC value in ``sentinels``.  With
    ``split_parity`` slice ``s`` yields the medians of its even and odd columns
    (counted inside the slice) at ``2*s`` and ``2*s + 1``.
    """

    @arrow_udf("array<float>")
    def medians(pixels: pa.Array, reference: pa.Array) -> pa.Array:
        adc = _as_matrix(pixels, width)
        residual = adc - _as_matrix(reference, width)
        if sentinels is not None:
            residual[np.isin(adc, np.float32(sentinels))] = np.nan
        blocks = residual[:, : n_slices * slice_width].reshape(-1, n_slices, slice_width)
        parities = (blocks[..., 0::2], blocks[..., 1::2]) if split_parity else (blocks,)
        found = [
            _median_last_axis(p, skip_nan) if p.shape[-1] else np.full(p.shape[:2], np.nan, np.float32)
            for p in parities
        ]
        return _as_lists(np.stack(found, axis=-1).reshape(len(pixels), -1))

    return medians


def corrected_lines(
    width: int, slice_width: int, *, sentinels: tuple[int, int] | None
):
    """UDF ``(pixels, reference, medians) -> array<float>``: the corrected line.

    Every pixel loses its reference and its slice's median; pixels that are
    sentinels, have a NaN reference or sit in a slice without a median are NaN.
    """

    @arrow_udf("array<float>")
    def corrected(pixels: pa.Array, reference: pa.Array, medians: pa.Array) -> pa.Array:
        adc = _as_matrix(pixels, width)
        value = adc - _as_matrix(reference, width)
        value -= np.repeat(_as_matrix(medians, width // slice_width), slice_width, axis=1)
        if sentinels is not None:
            value[np.isin(adc, np.float32(sentinels))] = np.nan
        return _as_lists(value)

    return corrected


def irregular_medians(width: int, bounds: list[tuple[int, int]], *, sentinels: tuple[int, int] | None, skip_nan: bool):
    """UDF ``(pixels, reference) -> array<float>``: the median of each block ``[x0, x1)`` of a line, as :func:`slice_medians`."""

    @arrow_udf("array<float>")
    def medians(pixels: pa.Array, reference: pa.Array) -> pa.Array:
        adc = _as_matrix(pixels, width)
        residual = adc - _as_matrix(reference, width)
        if sentinels is not None:
            residual[np.isin(adc, np.float32(sentinels))] = np.nan
        found = [_median_last_axis(residual[:, a:b], skip_nan) for a, b in bounds]
        return _as_lists(np.stack(found, axis=-1) if found else np.empty((len(pixels), 0), np.float32))

    return medians
