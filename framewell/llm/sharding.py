"""Placement of rows on shards through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size (start and step from a hash of its name).  The shards take turns claiming
their next free slot until none is left, so their shares differ by one slot at
most, and adding or removing a shard moves few slots between the others.  The
table has a fixed number of slots (65,537 by default), independent of the data;
it is broadcast and places a row in constant time.  A key that holds many rows
can be spread over several shards with ``spread``.

Defined cases: a null key is placed like the empty string; equal keys always share
their shards; an empty table stays empty; other columns are passed through,
except that ``slot``, ``shard`` and ``shard_name`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537


def _number(label: str) -> int:
    return int.from_bytes(hashlib.md5(label.encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """The shard number of every slot; ``slots`` must be a prime of at least the number of shards."""
    n = len(shards)
    if not n or len(set(shards)) != n:
        raise ValueError("shards need distinct names, and there must be one at least")
    if slots < n or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime not below the number of shards")
    start = [_number(f"start {s}") % slots for s in shards]
    step = [_number(f"step {s}") % (slots - 1) + 1 for s in shards]
    turn, owner = [0] * n, np.full(slots, -1, dtype=np.int32)
    for taken in range(slots):
        shard = taken % n
        while owner[slot := (start[shard] + turn[shard] * step[shard]) % slots] >= 0:
            turn[shard] += 1
        owner[slot] = shard
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 60 bits of its MD5 modulo the table size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots))


def place(
    rows: DataFrame,
    key: Column,
    shards: Sequence[str],
    *,
    slots: int = SLOTS,
    spread: int = 1,
    within: Column | None = None,
) -> DataFrame:
    """``rows`` with ``slot``, ``shard`` (number) and ``shard_name``.

    ``spread`` above 1 deals a key's rows over that many neighbouring slots by a hash of
    ``within``, for keys too large for one shard.
    """
    spark: SparkSession = rows.sparkSession
    owner = lookup_table(shards, slots)
    table = spark.createDataFrame(
        [(i, int(s), shards[s]) for i, s in enumerate(owner)], "slot bigint, shard int, shard_name string"
    )
    slot = slot_of(key, slots)
    if spread > 1:
        if within is None:
            raise ValueError("spread needs the column that tells a key's rows apart")
        slot = F.pmod(slot + F.pmod(F.xxhash64(within), F.lit(spread)), F.lit(slots))
    own = [c for c in rows.columns if c not in table.columns]
    placed = rows.select(*[F.col(f"`{c}`") for c in own], slot.alias("slot"))
    # the table has `slots` rows whatever the data
    return placed.join(F.broadcast(table), "slot")
