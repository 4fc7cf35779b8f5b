"""File sources and sinks.  Text formats always take an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Any URI scheme Spark has a filesystem for."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    null_token: str | None = None,
    trim: bool = False,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Delimited text, plain or compressed, quotes doubled inside quoted fields.

    Without ``schema`` the types are inferred, which costs one more pass over
    the files.  ``names`` renames the columns by position.
    """
    reader = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", trim)
        .option("ignoreTrailingWhiteSpace", trim)
    )
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    out = reader.csv(path)
    return out.toDF(*names) if names else out


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = None, null_token: str = "", mode: str = "errorifexists") -> str:
    writer = df.write.mode(mode).option("header", header).option("escape", '"').option("nullValue", null_token)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON object per line."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).json(path)
    return path
