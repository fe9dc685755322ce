"""Detector geometry: frame size, readout blocks (ASICs) and ADC range.

A frame is ``height`` readout lines of ``width`` pixels.  The columns are cut
into ``n_asics`` equal blocks; the block at position ``i`` covers columns
``[i*w, (i+1)*w)`` and is called ``C{n-1-i}`` (names run right to left).
Columns beyond the last whole block belong to no block but stay active.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.functions.columns import int_div


@dataclass(frozen=True)
class Geometry:
    """Fixed sizes of one detector.

    ``masked`` holds block *positions* (left to right) that are switched off.
    """

    height: int = 512
    width: int = 512
    n_asics: int = 8
    n_bits: int = 16
    masked: tuple[int, ...] = ()

    def __post_init__(self) -> None:
        if min(self.height, self.width, self.n_asics, self.n_bits) < 1:
            raise ValueError("height, width, n_asics and n_bits must be positive")
        if self.n_asics > self.width:
            raise ValueError(f"{self.n_asics} ASICs do not fit into {self.width} columns")
        object.__setattr__(self, "masked", tuple(int(i) for i in self.masked))

    # -- sizes -----------------------------------------------------------------
    @property
    def asic_width(self) -> int:
        return self.width // self.n_asics

    @property
    def n_pixels(self) -> int:
        return self.height * self.width

    @property
    def underflow(self) -> int:
        return 0

    @property
    def overflow(self) -> int:
        return (1 << self.n_bits) - 1

    def asic_name_at(self, position: int) -> str:
        return f"C{self.n_asics - 1 - position}"

    def with_masked_names(self, names: Iterable[str]) -> Geometry:
        """The same detector with blocks masked by name instead of by position."""
        by_name = {self.asic_name_at(i): i for i in range(self.n_asics)}
        unknown = sorted(set(names) - set(by_name))
        if unknown:
            raise ValueError(f"unknown ASIC names {unknown}; have {sorted(by_name)}")
        return replace(self, masked=tuple(sorted(by_name[n] for n in names)))

    # -- column expressions ----------------------------------------------------
    def asic_position(self, x: Column | str = "x") -> Column:
        """Block position of a column, NULL for columns in no block."""
        pos = int_div(x, self.asic_width)
        return F.when(pos < self.n_asics, pos)

    def asic_name(self, x: Column | str = "x") -> Column:
        return self.asic_name_of(self.asic_position(x))

    def asic_name_of(self, position: Column) -> Column:
        return F.concat(F.lit("C"), (F.lit(self.n_asics - 1) - position).cast("string"))

    def is_active(self, x: Column | str = "x") -> Column:
        """True where the pixel is read out (its block is not masked)."""
        if not self.masked:
            return F.lit(True)
        return ~int_div(x, self.asic_width).isin(*self.masked)

    # -- small dimension tables ------------------------------------------------
    def asic_dim(self, spark: SparkSession) -> DataFrame:
        """One row per block: ``asic_pos, asic, x0, x1`` (``x1`` exclusive)."""
        pos = F.col("id").cast("int")
        return spark.range(self.n_asics).select(
            pos.alias("asic_pos"),
            self.asic_name_of(pos).alias("asic"),
            (pos * self.asic_width).alias("x0"),
            ((pos + 1) * self.asic_width).alias("x1"),
        )

    def grid(self, spark: SparkSession) -> DataFrame:
        """Every pixel coordinate ``(y, x)`` once."""
        return spark.range(self.n_pixels).select(
            int_div("id", self.width).alias("y"),
            (F.col("id") % self.width).cast("int").alias("x"),
        )
