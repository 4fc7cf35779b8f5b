"""Repeatable samples, splits, folds and bootstrap weights.

All of them hash a unique key, so a lost task that runs again draws the same
rows.  None of them sorts a whole stratum in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.ordering import join_null_safe
from millrace.session import stable

BUCKETS = 1 << 16


def hash_order(key: Sequence[str], seed: int) -> Column:
    """A whole number below 2^60 from the key and the seed, which any SQL engine with MD5 can make too."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))), 1, 15), 16, 10).cast("long")


def hash_unit(key: Sequence[str], seed: int) -> Column:
    """Uniform number in [0, 1) per key."""
    return hash_order(key, seed).cast("double") / float(1 << 60)


def _first_by_hash(df: DataFrame, key: Sequence[str], strata: Sequence[str], take: Column, seed: int, flag: str) -> DataFrame:
    """Flag the first ``take`` rows of every stratum in hash order.

    ``take`` is an expression over ``n``, the stratum's row count.  Rows are
    counted per (stratum, hash bucket); whole buckets below the cut are taken,
    and only the one bucket that straddles it is ranked.
    """
    strata = list(strata)
    marked = df.withColumn("__h", hash_order(key, seed)).withColumn("__b", F.pmod("__h", F.lit(BUCKETS)))
    counts = marked.groupBy(*strata, "__b").agg(F.count(F.lit(1)).alias("__c"))
    # at most BUCKETS rows per stratum in this window
    by = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    running = by.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        counts.withColumn("__upto", F.sum("__c").over(running))
        .withColumn("n", F.sum("__c").over(by))
        .withColumn("__take", take)
        .withColumn("__need", F.col("__take") - (F.col("__upto") - F.col("__c")))
        .select(*strata, "__b", "__need", (F.col("__upto") <= F.col("__take")).alias("__all"))
    )
    keyed = join_null_safe(marked, cut, [*strata, "__b"])
    edge = (~F.col("__all")) & (F.col("__need") > 0)
    ranks = Window.partitionBy(*strata).orderBy("__h", *key) if strata else Window.partitionBy("__b").orderBy("__h", *key)
    straddling = keyed.where(edge).withColumn(flag, F.row_number().over(ranks) <= F.col("__need"))
    rest = keyed.where(~edge).withColumn(flag, F.col("__all"))
    return rest.unionByName(straddling).drop("__h", "__b", "__need", "__all")


def sample_n(df: DataFrame, key: Sequence[str], n: int, seed: int = 1) -> DataFrame:
    """Exactly ``n`` rows (all of them if fewer)."""
    return _first_by_hash(df, key, [], F.lit(n), seed, "__in").where("__in").drop("__in")


def sample_frac(df: DataFrame, key: Sequence[str], fraction: float, seed: int = 1) -> DataFrame:
    return df.where(hash_unit(key, seed) < fraction)


def hash_split(df: DataFrame, key: Sequence[str], fractions: dict[str, float], seed: int = 1, name: str = "data") -> DataFrame:
    """Tag each row with one split name."""
    total = sum(fractions.values())
    u, edge, tag = hash_unit(key, seed), 0.0, F.lit(list(fractions)[-1])
    pieces = []
    for label, f in fractions.items():
        edge += f / total
        pieces.append((label, edge))
    for label, upper in reversed(pieces[:-1]):
        tag = F.when(u < upper, F.lit(label)).otherwise(tag)
    return df.withColumn(name, tag)


def stratified_split(df: DataFrame, key: Sequence[str], label: str, p: float, seed: int = 1, name: str = "data") -> DataFrame:
    """``train`` for ceil(p*n) rows of every level of ``label``, ``test`` for the rest."""
    flagged = _first_by_hash(df, key, [label], F.ceil(F.lit(p) * F.col("n")), seed, "__in")
    return flagged.withColumn(name, F.when(F.col("__in"), "train").otherwise("test")).drop("__in")


def quantile_groups(df: DataFrame, value: str, edges: Sequence[float], name: str) -> DataFrame:
    """Group number of a numeric label among ascending cut points."""
    group = F.lit(0)
    for e in edges:
        group = group + (F.col(value) > F.lit(float(e))).cast("int")
    return df.withColumn(name, group)


def assign_folds(df: DataFrame, key: Sequence[str], k: int, seed: int = 1, name: str = "fold") -> DataFrame:
    return df.withColumn(name, F.pmod(hash_order(key, seed), F.lit(k)).cast("int"))


def bootstrap(df: DataFrame, key: Sequence[str], resamples: int, seed: int = 1) -> DataFrame:
    """Rows with their draw count per resample, Poisson(1) from a hash; see :func:`bootstrap_exact` for resamples of exact size.

    Each row is drawn independently, which is the form of resampling with
    replacement that needs no exchange of rows; a resample's size is the row
    count only on average.
    """
    draws = df.withColumn("resample", F.explode(F.sequence(F.lit(1), F.lit(resamples))))

    def weight(u: Column) -> Column:
        cumulative, count = 0.0, F.lit(0)
        for i in range(18):
            cumulative += math.exp(-1.0) / math.factorial(i)
            count = count + (u >= cumulative).cast("int")
        return count

    # a list of one: the hash is made once per row, not once per comparison and again in a filter
    counts = F.transform(F.array(hash_unit([*key, "resample"], seed)), weight)
    return draws.withColumn("draws", F.explode(F.filter(counts, lambda n: n > 0)))


#: bits of a bucket's number that one level of the splitting tree settles
SPLIT_BITS = 10


def _dealt(seed: int, level: int):
    """Deal each node's draws to its children in proportion to their rows, by a generator seeded with the node."""

    def run(batches):
        for batch in batches:
            out = []
            for resample, node, draws, sizes in zip(*(batch.column(c).to_pylist() for c in ("resample", "node", "draws", "sizes"))):
                rng = np.random.Generator(np.random.Philox(key=[(seed << 32 | resample) & (1 << 64) - 1, level << 60 | node]))
                share = np.asarray(sizes, float)
                out.append(rng.multinomial(draws, share / share.sum()).tolist())
            columns = [batch.column("resample"), batch.column("node"), pa.array(out, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["resample", "node", "given"])

    return run


def bootstrap_exact(df: DataFrame, key: Sequence[str], resamples: int, seed: int = 1, bucket_rows: int = 256) -> DataFrame:
    """Rows with their draw count per resample, drawn with replacement, as many draws as rows in every resample.

    Rows lie in hash buckets of about ``bucket_rows``.  A resample's draws go
    down a tree over the buckets: a node splits its draws among its children by
    a multinomial draw over their row counts, seeded by the node, and a bucket
    among its rows.  That is the distribution of independent draws, without a
    row per draw, and a task that runs again deals the same.  ``key`` is unique;
    rows that share one are drawn each for itself.  Rows without a draw are left out.
    """
    if resamples < 1 or bucket_rows < 1:
        raise ValueError("resamples and bucket_rows start at 1")
    n = df.count()
    bits = max(0, math.ceil(math.log2(max(1, n) / bucket_rows)))
    whole = F.struct(*[F.col(c) for c in df.columns]).alias("row")
    marked = df.select(F.shiftright(hash_order(key, seed), 60 - bits).alias("node"), F.struct(*key).alias("key"), whole)
    in_order = F.array_sort(
        F.collect_list(F.struct("key", "row")), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
    )
    buckets = stable(marked.groupBy("node").agg(in_order.alias("rows")))
    sizes = buckets.select("node", F.size("rows").cast("long").alias("rows"))
    nodes = df.sparkSession.range(1, resamples + 1).select(F.col("id").cast("int").alias("resample"), F.lit(0).cast("long").alias("node"), F.lit(n).cast("long").alias("draws"))
    done = level = 0
    while done < bits:
        width = min(SPLIT_BITS, bits - done)
        done += width
        child = F.shiftright("node", bits - done)
        below = sizes.groupBy(child.alias("child")).agg(F.sum("rows").alias("rows"))
        below = below.groupBy(F.shiftright("child", width).alias("node")).agg(F.sort_array(F.collect_list(F.struct("child", "rows"))).alias("below"))
        below = below.select("node", F.col("below.child").alias("children"), F.col("below.rows").alias("sizes"))
        dealt = nodes.join(below, "node").select("resample", "node", "draws", "sizes").mapInArrow(
            _dealt(seed, level), "resample int, node bigint, given array<bigint>"
        )
        parts = dealt.join(below, "node").select("resample", F.explode(F.arrays_zip("children", "given")).alias("p"))
        nodes = stable(parts.select("resample", F.col("p.children").alias("node"), F.col("p.given").alias("draws")).where("draws > 0"))
        level += 1
    one_each = F.array_repeat(F.lit(1).cast("long"), F.col("rows").cast("int")).alias("sizes")
    last = nodes.join(sizes, "node").select("resample", "node", "draws", one_each)
    dealt = last.mapInArrow(_dealt(seed, level), "resample int, node bigint, given array<bigint>")
    drawn = dealt.join(buckets, "node").select("resample", F.explode(F.arrays_zip("rows", "given")).alias("d"))
    return drawn.select("d.rows.row.*", "resample", F.col("d.given").cast("int").alias("draws")).where("draws > 0")
