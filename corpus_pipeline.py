"""A training corpus from raw documents: five stages, each on what the one before kept.

Toxic documents go, then exact copies, near copies and documents that hold
benchmark passages; what is left is mixed to the source weights.  Nulls, empty
texts and extra columns pass through every stage as its operator states; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination, exact_dedup, mixing, simhash_dedup, toxicity
from millrace.llm.queries import remainder
from millrace.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the compression model, fitted on this table's labels, calls toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels, learn=remainder("doc_id", 5) != 0))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest id, of each group of equal texts."""
    return exact_dedup.without_copies(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints."""
    return simhash_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold ten words in a row of a benchmark item, or a whole shorter item."""
    return decontamination.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights; ``copy`` numbers the repeats."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus of ``documents``; every stage is written and read again in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: zstandard compression, XXH64 fingerprints and components have no SQL form; tests/llm compares with plain Python
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
