"""Aggregates behind plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import join_null_safe, quantiles


def histogram(df: DataFrame, column: str, width: float, keys: Sequence[str] = (), origin: float = 0.0) -> DataFrame:
    """Counts per bin of fixed ``width``; ``lo`` is the bin's lower edge."""
    bin_no = F.floor((F.col(column) - F.lit(origin)) / F.lit(width))
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("lo", F.col("bin") * F.lit(float(width)) + F.lit(float(origin)))


def histogram_bins(df: DataFrame, column: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal bins between the least and the greatest value."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    if lo is None:  # no values, no bins
        return df.where("false").groupBy(*keys, F.lit(0).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins or 1.0
    bin_no = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    return df.where(F.col(column).isNotNull()).groupBy(*keys, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, column: str, keys: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Quartiles, mean, whisker ends and outlier count per group."""
    keys = list(keys)
    q = quantiles(df, column, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys)
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    inside = (F.col(column) >= F.col("q1") - reach) & (F.col(column) <= F.col("q3") + reach)
    return (
        join_null_safe(df, q, keys)
        .groupBy(*keys)
        .agg(
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.avg(column).alias("mean"),
            F.min(F.when(inside, F.col(column))).alias("whisker_lo"),
            F.max(F.when(inside, F.col(column))).alias("whisker_hi"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def box_outliers(df: DataFrame, column: str, keys: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """The rows beyond the fences of their group."""
    keys = list(keys)
    q = quantiles(df, column, {"__q1": 0.25, "__q3": 0.75}, keys)
    reach = F.lit(whisker) * (F.col("__q3") - F.col("__q1"))
    outside = (F.col(column) < F.col("__q1") - reach) | (F.col(column) > F.col("__q3") + reach)
    return join_null_safe(df, q, keys).where(outside).drop("__q1", "__q3")


def standardise(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """``(x - mean) / sd`` with whole-table moments from one aggregate."""
    m = df.agg(*[f(c).alias(f"{p}{c}") for c in columns for f, p in ((F.avg, "m_"), (F.stddev_samp, "s_"))]).first()
    return df.withColumns(
        {
            c + suffix: F.try_divide(F.col(c) - F.lit(m[f"m_{c}"]), F.lit(m[f"s_{c}"]).cast("double"))
            for c in columns
        }
    )
