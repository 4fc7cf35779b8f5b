"""Ranks, extremes, lags and moving averages per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.ordering import join_null_safe, ntile_global


def group_extremes(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows holding the least or the greatest value of their group, ties kept.

    The extremes come from one map-side combined aggregate and are joined back
    on the group, so a hot group is never gathered in one task.
    """
    keys = list(keys)
    ends = df.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    hit = (F.col(value) == F.col("__lo")) | (F.col(value) == F.col("__hi"))
    return join_null_safe(df, ends, keys).where(hit).drop("__lo", "__hi")


def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, ties: bool = True, name: str = "rank"
) -> DataFrame:
    """The first ``n`` rows per group in ``order``; ``ties`` keeps equal last ones.

    Spark cuts each map task's rows to the ``n`` best per group before the
    shuffle (group-limit plan), so a hot group costs ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    place = F.rank() if ties else F.row_number()
    return df.withColumn(name, place.over(w)).where(F.col(name) <= n)


def decile_lift(
    df: DataFrame, prediction: str, target: str, tie: str, n: int = 10, within: Sequence[str] = ("data",)
) -> DataFrame:
    """Mean target per tile of descending prediction, per split."""
    tiled = ntile_global(
        df.select(*within, prediction, target, tie), [F.desc(prediction), F.asc(tie)], n, within, "decile"
    )
    return tiled.groupBy(*within, "decile").agg(F.avg(target).alias(target), F.count(F.lit(1)).alias("n"))


# The functions below run over one row per step of a calendar-bound series
# (see timeseries.regular_series), never over raw rows.


def lag_difference(df: DataFrame, keys: Sequence[str], order: str, value: str, lags: Sequence[int], name: str) -> DataFrame:
    """Apply ``x - lag(x, k)`` once per ``k`` in ``lags``."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumn(name, F.col(value))
    for k in lags:
        out = out.withColumn(name, F.col(name) - F.lag(name, k).over(w))
    return out


def trailing_mean(df: DataFrame, keys: Sequence[str], order: str, value: str, n: int, name: str) -> DataFrame:
    """Simple moving average, NULL until ``n`` values are present."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
    return df.withColumn(name, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def centred_mean(df: DataFrame, keys: Sequence[str], order: str, value: str, period: int, name: str) -> DataFrame:
    """Centred moving average over one period; an even period halves both ends."""
    half = period // 2
    w = Window.partitionBy(*keys).orderBy(order)
    full = w.rowsBetween(-half, half)
    total = F.sum(value).over(full)
    if period % 2 == 0:
        total = total - (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2
    return df.withColumn(name, F.when(F.count(value).over(full) == 2 * half + 1, total / period))
