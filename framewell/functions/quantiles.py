"""Exact quantiles of columns too long to sort in one task.

The wanted ranks are bracketed: each pass counts the values of the current
brackets in ``BINS`` equal slices, keeps the slice that holds the rank and
continues with that slice's own minimum and maximum until they meet.  A pass
sends ``BINS`` rows per bracket and task, whatever the number of values or
copies.  The values are written once, so a pass never repeats what made them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewell.functions.columns import NAN
from framewell.plans.joins import join_counted
from framewell.plans.settle import settle

BINS = 4096


def exact_quantile(df: DataFrame, value: str, q: float, keys: list[str], *, nan_result: bool = True) -> DataFrame:
    """``keys, quantile``: linear-interpolated quantile of ``value`` per group.

    NULL is skipped.  A NaN in a group makes its quantile NaN, or is skipped with
    ``nan_result=False``.
    """
    return exact_quantiles(df, value, [q], keys, nan_result=nan_result).drop("i")


def exact_quantiles(
    df: DataFrame, value: str, qs: Sequence[float], keys: list[str], *, nan_result: bool = True
) -> DataFrame:
    """``keys, i, quantile``: as :func:`exact_quantile` for the i-th of several probabilities."""
    values = settle(df.select(*keys, F.col(value).cast("double").alias("v")).where("v IS NOT NULL"), "values")
    number = F.when(~F.isnan("v"), F.col("v"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(qs)]))
    groups = df.select(*keys).distinct().select(*keys, wanted.alias("wanted")).select(*keys, "wanted.*")
    sizes = settle(
        values.groupBy(*keys).agg(
            F.count(number).alias("n"),
            F.count_if(F.isnan("v")).alias("n_nan"),
            F.min(number).alias("lo"),
            F.max(number).alias("hi"),
        ),
        "sizes",
    )
    found = _narrow(values.where(~F.isnan("v")), sizes.select("*", wanted.alias("wanted")).select(*keys, "wanted.*", "n", "lo", "hi"), keys)
    out = groups.join(sizes.select(*keys, "n_nan"), keys, "left").join(found, [*keys, "i"], "left")
    poisoned = F.col("quantile").isNull() | (F.col("n_nan") > 0 if nan_result else F.lit(False))
    return out.select(*keys, "i", F.when(poisoned, F.lit(NAN)).otherwise(F.col("quantile")).alias("quantile"))


def _narrow(values: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Bracket the two ranks around each wanted place until each bracket is a single value."""
    at = (F.col("n") - 1) * F.col("q")
    ranks = F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))).alias("rank")
    state = settle(
        wanted.where("n > 0").select(*keys, "i", at.alias("at"), ranks, "lo", "hi", F.lit(0).cast("bigint").alias("below")),
        "brackets",
    )
    slice_no = F.when(
        F.col("hi") > F.col("lo"),
        F.least(F.floor((F.col("v") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * BINS), F.lit(BINS - 1)),
    ).otherwise(F.lit(0).cast("bigint"))
    bracket = [*keys, "lo", "hi"]
    while state.where("lo < hi").limit(1).count():
        open_brackets = state.where("lo < hi").select(*bracket).distinct()
        inside = join_counted(values, open_brackets, keys).where(F.col("v").between(F.col("lo"), F.col("hi")))
        slices = inside.groupBy(*bracket, slice_no.alias("slice")).agg(
            F.count(F.lit(1)).alias("n_slice"), F.min("v").alias("slice_lo"), F.max("v").alias("slice_hi")
        )
        running = Window.partitionBy(*bracket).orderBy("slice")
        slices = slices.withColumn("upto", F.sum("n_slice").over(running))
        within = F.col("rank") - F.col("below")
        holds = (within < F.col("upto")) & (within >= F.col("upto") - F.col("n_slice"))
        narrowed = (
            state.where("lo < hi")
            .join(slices, bracket)
            .where(holds)
            .select(
                *keys,
                "i",
                "at",
                "rank",
                F.col("slice_lo").alias("lo"),
                F.col("slice_hi").alias("hi"),
                (F.col("below") + F.col("upto") - F.col("n_slice")).alias("below"),
            )
        )
        state = settle(state.where("lo >= hi").unionByName(narrowed), "brackets")
    lower, upper = F.min("lo"), F.max("lo")
    between = (lower + (upper - lower) * (F.first("at") - F.floor(F.first("at")))).alias("quantile")
    return state.groupBy(*keys, "i").agg(between)
