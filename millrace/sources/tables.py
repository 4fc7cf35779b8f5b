"""Catalog tables, remote tables and saved models."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.ordering import positions
from millrace.session import stable


def table(spark: SparkSession, name: str) -> DataFrame:
    """Lazy handle on a table or view."""
    return spark.table(name)


def sql(spark: SparkSession, text: str) -> DataFrame:
    """Lazy handle on a SQL text."""
    return spark.sql(text)


def register(df: DataFrame, name: str) -> DataFrame:
    """Give the frame a session name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def copy_rows(spark: SparkSession, rows: Sequence, schema: StructType | str, name: str) -> DataFrame:
    """Put a few local rows into the cluster under a session name."""
    return register(spark.createDataFrame(rows, schema), name)


def save_table(df: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> DataFrame:
    """Persistent copy in the catalog, external when ``path`` is given."""
    writer = df.write.mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def create_table(spark: SparkSession, name: str, columns: str, using: str = "parquet", path: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS`` with declared column types."""
    opts = ", ".join(f"'{k}' '{v}'" for k, v in (options or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {using}"
        + (f" OPTIONS ({opts})" if opts else "")
        + (f" LOCATION '{path}'" if path else "")
    )
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def load_into(df: DataFrame, name: str) -> DataFrame:
    """Append rows to a table, matched by position."""
    df.write.insertInto(name)
    return df.sparkSession.table(name)


def append_with_ids(table: DataFrame, new_rows: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """``table`` plus ``new_rows``; missing ids continue after the largest one.

    Columns absent from ``new_rows`` become NULL.  Rows that bring their own id
    keep it; the others are numbered in ``order`` (which must be total).
    """
    if id_column not in new_rows.columns:
        new_rows = new_rows.withColumn(id_column, F.lit(None).cast(table.schema[id_column].dataType))
    given = new_rows.where(F.col(id_column).isNotNull())
    blank = positions(new_rows.where(F.col(id_column).isNull()).drop(id_column), order, name="__p").drop("__p_total")
    top = table.select(id_column).unionByName(given.select(id_column)).agg(F.max(id_column)).first()[0] or 0
    kind = table.schema[id_column].dataType
    numbered = blank.withColumn(id_column, (F.col("__p") + F.lit(top)).cast(kind)).drop("__p")
    return table.unionByName(given, allowMissingColumns=True).unionByName(numbered, allowMissingColumns=True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Compute once, keep the rows in the checkpoint folder, register the result."""
    return register(stable(df), name)


def cache_table(spark: SparkSession, name: str) -> None:
    spark.catalog.cacheTable(name)


def uncache_table(spark: SparkSession, name: str) -> None:
    spark.catalog.uncacheTable(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, kind string, temporary boolean")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def describe_columns(df: DataFrame) -> DataFrame:
    """Column names, types and order as rows."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def glimpse(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """Column names and types with the first ``n`` values in a declared order."""
    head = df.orderBy(*order).limit(n)
    text = head.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    shown = text.unpivot([], df.columns, "column", "v").groupBy("column").agg(F.sort_array(F.collect_list("v")).alias("values"))
    return describe_columns(df).join(shown, "column", "left")


def explain_text(df: DataFrame) -> str:
    """The formatted physical plan."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``: a whole table or a pushed query.

    A whole table is read in parallel slices of ``column``; credentials are
    always the caller's ``properties``.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    out = {"url": url, **(properties or {})}
    out.update({"dbtable": table} if table else {"query": query})
    if column:
        if table is None or bounds is None or partitions is None:
            raise ValueError("parallel reads need table, bounds and partitions")
        out.update(
            partitionColumn=column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return out


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, mode: str = "errorifexists") -> None:
    df.write.format("jdbc").mode(mode).options(**jdbc_options(url, table, properties=properties)).save()


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path
