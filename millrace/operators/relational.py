"""Projection, filters, joins and group summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import is_missing
from millrace.operators.ordering import column_quantiles, join_null_safe


def select_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Contiguous columns from ``first`` to ``last``."""
    names = df.columns
    return df.select(*names[names.index(first) : names.index(last) + 1])


def select_grouped(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Projection that always keeps the grouping keys."""
    return df.select(*keys, *[c for c in columns if c not in keys])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _complete(df: DataFrame, columns: Sequence[str]) -> Column:
    types = {f.name: f.dataType for f in df.schema}
    flag = F.lit(True)
    for c in columns:
        flag = flag & ~is_missing(c, isinstance(types[c], (T.DoubleType, T.FloatType)))
    return flag


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with neither NULL nor NaN in ``columns`` (all columns by default)."""
    return df.where(_complete(df, columns or df.columns))


def complete_flag(df: DataFrame, columns: Sequence[str] | None = None, name: str = "complete") -> DataFrame:
    """Boolean completeness per row."""
    return df.withColumn(name, _complete(df, columns or df.columns))


def lookup_join(df: DataFrame, dim: DataFrame, left_key: str, right_key: str, how: str = "left") -> DataFrame:
    """Join on differently named keys, keeping the left one.

    No broadcast hint: Spark broadcasts ``dim`` only while its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond that.
    """
    return df.join(dim, df[left_key] == dim[right_key], how).drop(dim[right_key])


def join_lookup_twice(
    df: DataFrame, dim: DataFrame, left_keys: Sequence[str], dim_key: str, prefixes: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join the same lookup once per left key, its columns prefixed each time."""
    out = df
    for key, prefix in zip(left_keys, prefixes, strict=True):
        copy = dim.toDF(*[f"{prefix}{c}" for c in dim.columns])
        out = out.join(copy, out[key] == copy[f"{prefix}{dim_key}"], how).drop(f"{prefix}{dim_key}")
    return out


def natural_join(x: DataFrame, y: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name both sides share."""
    shared = [c for c in x.columns if c in set(y.columns)]
    if not shared:
        raise ValueError("the tables share no column")
    return x.join(y, shared, how)


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Frequency table."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """``value / sum(value)`` per key, by aggregate and join.

    A window would hold all rows of a hot key in one task; here the totals are
    pre-aggregated and the (small) result is joined back.
    """
    keys = list(keys)
    total = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    return join_null_safe(df, total, keys).withColumn(name, F.try_divide(F.col(value), F.col("__total"))).drop("__total")


def contingency(df: DataFrame, row: str, col: str, levels: Sequence) -> DataFrame:
    """Two-way count table with one column per declared level of ``col``."""
    wide = df.groupBy(row).pivot(col, list(levels)).agg(F.count(F.lit(1)))
    return wide.na.fill(0, [str(v) for v in levels])


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, quartiles, mean, max and missing count of numeric columns, one row each.

    All columns are looked at side by side in every scan, without a row per cell.
    """
    columns = list(columns)
    made = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        there = F.when(~(x.isNull() | F.isnan(x)), x)
        made += [F.min(there).alias(f"min{i}"), F.avg(there).alias(f"mean{i}"), F.max(there).alias(f"max{i}"), F.count_if(there.isNull()).alias(f"missing{i}")]
    basic = df.agg(*made).first()
    mid = column_quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    rows = [
        (c, basic[f"min{i}"], mid[c]["q1"], mid[c]["median"], basic[f"mean{i}"], mid[c]["q3"], basic[f"max{i}"], basic[f"missing{i}"])
        for i, c in enumerate(columns)
    ]
    names = ("min", "q1", "median", "mean", "q3", "max")
    return df.sparkSession.createDataFrame(rows, "column string, " + ", ".join(f"{n} double" for n in names) + ", missing bigint")


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per level of text columns, in long form."""
    long = df.select(*columns).unpivot([], list(columns), "column", "level")
    return count_by(long, ["column", "level"])


def dims(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))


def key_of_max(df: DataFrame, key: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """The key that holds the largest value, of any type; the smallest such key on ties."""
    most = df.groupBy(*keys).agg(F.max(value).alias("__most"))
    held = join_null_safe(df.select(*keys, key, value), most, keys) if keys else df.join(most, F.col(value) == F.col("__most"))
    return held.where(F.col(value) == F.col("__most")).groupBy(*keys).agg(F.min(key).alias(key), F.max(value).alias(value))


def drop_key_of_max(df: DataFrame, key: str, value: str) -> DataFrame:
    """All rows but the one holding the largest value; rows with a NULL key stay."""
    return df.join(key_of_max(df, key, value).select(key), key, "left_anti")


def keep_nonempty(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of those keys whose values sum to more than zero."""
    alive = df.groupBy(key).agg(F.sum(value).alias("__s")).where("__s > 0").select(key)
    return df.join(alive, key, "left_semi")
