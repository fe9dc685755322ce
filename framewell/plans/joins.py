"""Joins whose small side is broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewell.plans.settle import settle_counted

# Largest table sent to every executor, in estimated bytes and in rows.
BROADCAST_BYTES = 128 * 1024 * 1024
BROADCAST_KEYS = 1_000_000


def join_bounded(
    big: DataFrame, small: DataFrame, on: list[str], *, rows: int, row_bytes: int, how: str = "inner"
) -> DataFrame:
    """Join a side of at most ``rows`` rows (a bound set by the geometry).

    Within ``BROADCAST_BYTES`` it is broadcast; a larger detector map falls back
    to a shuffled join that Catalyst and AQE plan from real sizes.
    """
    fits = rows * row_bytes <= BROADCAST_BYTES
    return big.join(F.broadcast(small) if fits else small, on, how)


def drop_keys(big: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``big`` without the rows whose key is in ``keys``.

    The keys are written and counted first: none leaves ``big`` untouched, a
    bounded number is broadcast, more are anti-joined with a shuffle.
    """
    keys, n = settle_counted(keys, "keys")
    if n == 0:
        return big
    return big.join(F.broadcast(keys) if n <= BROADCAST_KEYS else keys, on, "left_anti")


def join_counted(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a side that is settled and counted before it may be broadcast."""
    small, n = settle_counted(small, "side")
    return big.join(F.broadcast(small) if n <= BROADCAST_KEYS else small, on, how)
