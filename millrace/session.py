"""Session helpers: shared scratch space, lineage cuts, bounded fetches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession

#: Spark's setting that deletes a query's shuffle files when the query ends
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can see, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests) gets a folder of
    its own; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="millrace-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/scratch/{label}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and read that copy from now on.

    Used where later steps refer to physical row positions, which must not
    change when a lost executor's work is repeated.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fetch_small(df: DataFrame, limit: int, what: str) -> list[Row]:
    """Bring a table known to be small to the driver, failing beyond ``limit`` rows."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows


def stored(df: DataFrame, label: str, *parts: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet below the shared folder and read again, with its path for :func:`discard`.

    ``parts`` are columns whose values get a folder of their own.

    The shuffle files of the write go when it ends, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.partitionBy(*parts).parquet(path) if parts else df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`stored` wrote, in whatever store holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
