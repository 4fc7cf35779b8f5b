"""Stacking tables and changing between long and wide."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bind_rows(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns absent on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bind_tagged(frames: dict[str, DataFrame], tag: str = "data") -> DataFrame:
    """UNION ALL with a source column."""
    return bind_rows(*[f.withColumn(tag, F.lit(k)) for k, f in frames.items()])


def spread(df: DataFrame, ids: Sequence[str], key: str, value: str, values: Sequence, fill=None) -> DataFrame:
    """Long to wide.  ``values`` are the new columns, so no extra scan finds them."""
    wide = df.groupBy(*ids).pivot(key, list(values)).agg(F.first(value))
    return wide if fill is None else wide.na.fill(fill, [str(v) for v in values])


def gather(df: DataFrame, ids: Sequence[str], columns: Sequence[str], key: str = "key", value: str = "value", drop_null: bool = False) -> DataFrame:
    """Wide to long."""
    long = df.unpivot(list(ids), list(columns), key, value)
    return long.dropna(subset=[value]) if drop_null else long


def lists_per_key(df: DataFrame, key: str, value: str, chunk: int) -> DataFrame:
    """Distinct values per key as sorted lists of bounded length.

    ``value`` must be a non-negative integer id.  A list covers one id range
    of width ``chunk``, so a key with very many values gets several rows
    instead of one unbounded array.
    """
    part = F.floor(F.col(value) / chunk).alias("chunk")
    return df.groupBy(key, part).agg(F.sort_array(F.collect_set(value)).alias("items"))


def explode_lists(df: DataFrame, keys: Sequence[str], items: str, name: str = "item") -> DataFrame:
    return df.select(*keys, F.explode(items).alias(name))


def bin_key(df: DataFrame, column: str, width: float, name: str = "bin", origin: float = 0.0) -> DataFrame:
    return df.withColumn(name, F.floor((F.col(column) - F.lit(origin)) / F.lit(width)))
