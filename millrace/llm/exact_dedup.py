"""Exact duplicates by a tree merge of sorted digest runs.

Every partition turns its texts into a run of digests, sorted and with equal
ones merged.  Then partitions exchange runs in binomial rounds: in round ``r``
the partitions that differ only in the ``r``-th group of four bits of their
number split the digests among themselves by the same bits of the digest.  Up
to 16 sorted runs meet in a partition and are merged into one, in which every
digest keeps one identifier and its number of documents.  After the last round
a digest lies in the one partition whose number its low bits spell.

Runs are ordered by a 64-bit hash.  Two entries are merged only if the SHA-256
of the texts and their lengths agree too, so a collision of the short hash
keeps both.  A digest held by a third of all documents is one entry per run,
so no partition ever sees more than 16 of it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import ascii_lower, byte_slices, few_rows, set_apart
from millrace.session import stable

#: bits of the partition number settled in a round: 16 runs meet
ROUND_BITS = 4
RUN = "owner int, short bigint, sha binary, n_bytes bigint, id bigint, n bigint"
ORDER = ["short", "sha", "n_bytes"]


def _digests(column: str, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, column):
            # bytes.lower changes A to Z only
            texts = [(t.as_buffer().to_pybytes() if t.is_valid else b"").lower() for t in batch.column(column).cast(pa.large_string())]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column(key).cast(pa.int64()),
                    "short": pa.array(np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64).view(np.int64)),
                    "sha": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    return run


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``short``, ``sha``, ``n_bytes`` of every row's text, lower-cased from A to Z; null is empty."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_digests("text", "id"), "id bigint, short bigint, sha binary, n_bytes bigint")


def _merged(largest: bool):
    """Merge equal neighbours of a sorted stream; one open entry is carried from batch to batch."""
    pick = np.maximum if largest else np.minimum

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            # a column that Spark knows to have no nulls comes as such, that of a held entry does not
            t = t.cast(pa.schema([f.with_nullable(True) for f in t.schema]))
            t = pa.concat_tables([held, t]) if held is not None else t
            if not t.num_rows:
                continue
            same = np.ones(t.num_rows - 1, bool)
            for c in ORDER:
                x = t.column(c).combine_chunks()
                same &= pc.equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.flatnonzero(~same) + 1])
            out = t.take(pa.array(first))
            for c, how in (("id", pick), ("n", np.add)):
                values = how.reduceat(t.column(c).to_numpy(), first)
                out = out.set_column(out.schema.get_field_index(c), c, pa.array(values))
            held = out.slice(out.num_rows - 1)
            yield out.slice(0, out.num_rows - 1)
        if held is not None:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables(batches):
            yield from t.combine_chunks().to_batches()

    return run


def merge_runs(entries: DataFrame, partitions: int, largest: bool = False) -> DataFrame:
    """One row per distinct digest: ``short``, ``sha``, ``n_bytes``, ``id`` (smallest or largest), ``n``.

    ``entries`` are rows of :func:`digests`.  ``partitions`` is rounded up to a
    power of two.  Null ids lose against any other.
    """
    bits = max(0, math.ceil(math.log2(max(1, partitions))))
    # a null must lose, so it becomes the far end of the numbers and is turned back below
    last = -(1 << 63) if largest else (1 << 63) - 1
    runs = entries.select(
        F.pmod(F.spark_partition_id(), F.lit(1 << bits)).cast("int").alias("owner"),
        "short", "sha", "n_bytes", F.coalesce("id", F.lit(last)).alias("id"), F.lit(1).cast("long").alias("n"),
    )
    runs = runs.sortWithinPartitions(*ORDER).mapInArrow(_merged(largest), RUN)
    for low in range(0, bits, ROUND_BITS):
        mask = ((1 << min(ROUND_BITS, bits - low)) - 1) << low
        settled = F.col("owner").bitwiseAND(F.lit(~mask)).bitwiseOR(F.col("short").bitwiseAND(F.lit(mask).cast("long")).cast("int"))
        runs = runs.withColumn("owner", settled).repartitionById(1 << bits, F.col("owner"))
        runs = runs.sortWithinPartitions(*ORDER).mapInArrow(_merged(largest), RUN)
    if not bits:
        runs = runs.coalesce(1).sortWithinPartitions(*ORDER).mapInArrow(_merged(largest), RUN)
    return runs.select("short", "sha", "n_bytes", F.nullif("id", F.lit(last)).alias("id"), "n")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "min", partitions: int | None = None) -> DataFrame:
    """Per row of ``docs``: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null text counts
    as empty.  Of equal texts the row with the smallest (``keep="min"``) or
    largest key is kept.  Rows that repeat both key and text are one document
    and share its verdict; a null key is kept only where all keys of the group
    are null.  Keys are whole numbers.
    """
    if keep not in ("min", "max"):
        raise ValueError(keep)
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stable(digests(docs, key, text))
    # only groups of more than one document have news for their rows
    many = stable(merge_runs(rows, partitions, keep == "max").where("n > 1"))
    many = many.select(F.col("sha").alias("__sha"), F.col("n_bytes").alias("__bytes"), F.col("id").alias("__keep"), F.col("n").alias("__n"))
    out = rows.join(many, (F.col("sha") == F.col("__sha")) & (F.col("n_bytes") == F.col("__bytes")), "left")
    keep_id = F.when(F.col("__n").isNull(), F.col("id")).otherwise(F.col("__keep"))
    return out.select(
        F.col("id").alias(key),
        keep_id.alias("keep_id"),
        F.coalesce("__n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "min") -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` drops, and without repeats of a kept row.

    The rows come back with all their columns; of rows that repeat key and
    text an arbitrary one stays.  Columns of any name pass through.
    """
    docs, (key, text), back = set_apart(docs, key, text)
    groups = exact_groups(docs, key, text, keep).select(F.col(key).alias("__k"), F.col("text_sha256").alias("__s"), "kept")
    seen = stable(groups.groupBy("__k", "__s", "kept").agg(F.count(F.lit(1)).alias("__rows")).where("not kept or __rows > 1"))
    marked = docs.withColumn("__sha", F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256))
    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("__sha") == F.col("__s"))
    out = marked.join(few_rows(seen.select("__k", "__s")), same, "left_anti")
    again = seen.where("kept").select("__k", "__s")
    if again.limit(1).count():
        out = out.unionByName(marked.join(few_rows(again), same, "left_semi").dropDuplicates([key, "__sha"]))
    return back(out.drop("__sha"))
