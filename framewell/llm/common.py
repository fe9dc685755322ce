"""Shared helpers of the training-data operators: sized broadcasts and joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from framewell.plans.settle import settle

# Largest table sent to every executor, in bytes of its values.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot when it holds more than one row in this many; there can be no more hot keys than this.
HOT_SHARE = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; any further columns stay out of the way."""
    return df.select(*[F.col(f"`{theirs}`").alias(ours) for ours, theirs in columns.items()])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with so many underscores in front that no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name = "_" + name
        taken.add(name)
        out.append(name)
    return out


def settle_sized(df: DataFrame, value_bytes: Column, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` and add up ``value_bytes`` over its rows on the way."""
    seen = Observation()
    written = settle(df.observe(seen, F.coalesce(F.sum(value_bytes), F.lit(0)).alias("n")), name)
    return written, seen.get["n"]


def join_sized(big: DataFrame, small: DataFrame, on, value_bytes: Column, name: str, how: str = "left") -> DataFrame:
    """Join a side that is written and measured first: broadcast within the limit, shuffled beyond it."""
    small, size = settle_sized(small, value_bytes, name)
    return big.join(F.broadcast(small) if size <= BROADCAST_BYTES else small, on, how)


def join_classes(rows: DataFrame, classes: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of rows to their class (one row per ``key``, ``size`` = how many rows it has).

    Keys with more than a thousandth of all rows, a thousand of them at most, are
    broadcast, so the rows of a hot key are never brought together; the others
    are joined with a shuffle.  Both inputs should be settled tables.
    """
    total, most = classes.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    hot = F.col(size) * HOT_SHARE > total
    if most * HOT_SHARE <= total:
        return rows.join(classes, key)
    hot_classes = F.broadcast(classes.where(hot))
    if dict(rows.dtypes)[key] == "bigint":
        is_hot = F.col(key).isin([r[0] for r in classes.where(hot & F.col(key).isNotNull()).select(key).collect()])
        return rows.where(is_hot).join(hot_classes, key).unionByName(rows.where(~is_hot).join(classes.where(~hot), key))
    spread = rows.join(hot_classes, key)
    rest = rows.join(hot_classes.select(key), key, "left_anti").join(classes.where(~hot), key)
    return spread.unionByName(rest)
