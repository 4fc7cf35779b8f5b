"""Transactions, frequent itemsets and association rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.relational import count_by
from millrace.session import stable

SEPARATOR = "\x1f"


def transactions(df: DataFrame, tx: str, item: str) -> DataFrame:
    """``(tx, items)``.  A transaction holds each item once, so a list never outgrows the catalogue."""
    return df.groupBy(tx).agg(F.sort_array(F.collect_set(item)).alias("items"))


def transactions_from_columns(df: DataFrame, tx: str, columns: dict[str, Column]) -> DataFrame:
    """Items ``name=value`` from table columns; a NULL gives no item."""
    cells = [
        F.when(c.isNotNull(), F.concat(F.lit(f"{name}="), c.cast("string"))) for name, c in columns.items()
    ]
    return df.select(tx, F.sort_array(F.array_compact(F.array(*cells))).alias("items"))


def summary(baskets: DataFrame, tx: str, top: int = 5) -> DataFrame:
    """Long ``(section, name, value)``: totals, density, most frequent items, size distribution."""
    baskets = stable(baskets)
    items = baskets.select(F.explode("items").alias("item"))
    sizes = count_by(baskets.select(F.size("items").alias("size")), ["size"], "n")
    per_item = count_by(items, ["item"])
    n, cells = sizes.agg(F.sum("n"), F.sum(F.col("n") * F.col("size"))).first()
    kinds = per_item.count()
    wide = baskets.sparkSession.createDataFrame(
        [("transactions", float(n)), ("items", float(kinds)), ("density", cells / n / kinds)], "name string, value double"
    )
    most = per_item.orderBy(F.desc("n"), "item").limit(top)
    return (
        wide.select(F.lit("total").alias("section"), "name", "value")
        .unionByName(most.select(F.lit("frequent").alias("section"), F.col("item").alias("name"), F.col("n").cast("double").alias("value")))
        .unionByName(sizes.select(F.lit("size").alias("section"), F.col("size").cast("string").alias("name"), F.col("n").cast("double").alias("value")))
    )


def item_frequency(baskets: DataFrame, top: int | None = None) -> DataFrame:
    """Share of transactions holding each item, greatest first."""
    baskets = stable(baskets)
    n = baskets.count()
    out = count_by(baskets.select(F.explode("items").alias("item")), ["item"]).select(
        "item", (F.col("n") / F.lit(n)).alias("frequency")
    )
    out = out.orderBy(F.desc("frequency"), "item")
    return out if top is None else out.limit(top)


def itemsets(baskets: DataFrame, support: float, maxlen: int = 10) -> DataFrame:
    """Frequent itemsets of at most ``maxlen`` items with their counts.

    Ten items is the usual default of rule miners; the miner itself counts
    itemsets of every length.
    """
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=0.0).fit(baskets)
    return model.freqItemsets.where(F.size("items") <= maxlen).select(F.sort_array("items").alias("items"), "freq")


def rules(
    baskets: DataFrame,
    support: float,
    confidence: float,
    lhs: Sequence[str] | None = None,
    rhs: str | None = None,
    minlen: int = 1,
    maxlen: int = 10,
) -> DataFrame:
    """Rules with one item on the right side.

    ``minlen`` and ``maxlen`` bound the items of both sides together; length 1
    means a rule with an empty left side, whose confidence is the item's
    support.  ``lhs`` and ``rhs`` fix a side.
    """
    baskets = stable(baskets)  # counted once and scanned twice by the miner
    n = baskets.count()
    sets = stable(itemsets(baskets, support, maxlen))
    return _rules_of(sets, n, confidence, lhs, rhs, minlen)


def _rules_of(sets: DataFrame, n: int, confidence: float, lhs, rhs, minlen: int) -> DataFrame:
    """Rules of mined itemsets: each set meets its subsets by equi joins on the items."""
    made = sets.where(F.size("items") >= 2).select("items", "freq", F.explode("items").alias("rhs"))
    made = made.withColumn("antecedent", F.array_remove("items", F.col("rhs")))
    left = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("left_freq"))
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("rhs"), F.col("freq").alias("right_freq"))
    made = made.join(left, "antecedent")
    if minlen <= 1:
        empty = single.select(
            F.array().cast("array<string>").alias("antecedent"), "rhs", F.array("rhs").alias("items"),
            F.col("right_freq").alias("freq"), F.lit(n).cast("bigint").alias("left_freq"),
        )
        made = made.unionByName(empty)
    made = made.withColumn("confidence", F.col("freq") / F.col("left_freq")).where(
        (F.col("confidence") >= confidence) & (F.size("items") >= minlen)
    )
    out = made.join(single, "rhs").select(
        "antecedent", F.array("rhs").alias("consequent"), (F.col("freq") / F.lit(n)).alias("support"), "confidence",
        (F.col("confidence") / (F.col("right_freq") / F.lit(n))).alias("lift"), F.col("freq").alias("count"),
    )
    if lhs is not None:
        out = out.where(F.col("antecedent") == F.sort_array(F.array(*[F.lit(x) for x in lhs])))
    if rhs is not None:
        out = out.where(F.col("consequent")[0] == rhs)
    return out


def rule_table(found: DataFrame) -> DataFrame:
    """Rules with both sides as text."""
    return found.select(
        F.array_join("antecedent", ",").alias("lhs"), F.array_join("consequent", ",").alias("rhs"),
        "support", "confidence", "lift", "count",
    )


def sort_rules(found: DataFrame, by: str, n: int | None = None) -> DataFrame:
    """Rule table in descending order of a measure, ties by text."""
    out = rule_table(found).orderBy(F.desc(by), "lhs", "rhs")
    return out if n is None else out.limit(n)


def _subsets_in_use(sets: DataFrame, longest: int) -> DataFrame:
    """``sets`` and all their nonempty subsets, each once, made by dropping one item at a time."""
    out = now = sets
    for size in range(longest, 1, -1):
        dropped = now.where(F.size("__items") == size)
        dropped = dropped.select(F.explode(F.transform("__items", lambda x: F.array_remove("__items", x))).alias("__items"))
        now = stable(now.where(F.size("__items") < size).unionByName(dropped).distinct())
        out = out.unionByName(now)
    return out.distinct()


def prune_rules(found: DataFrame, by: str) -> DataFrame:
    """Drop every rule whose items include all items of an earlier rule.

    Earlier means a greater ``by``, ties by rule text; both sides count as one
    item set.  Instead of comparing all rules with each other, the earliest rule
    inside every subset of the rules' items is passed on from subsets of one
    item less, by equi joins; rules may be of any length.
    """
    found = stable(found)  # mined once, read three times below
    place = F.struct((-F.round(by, 12)).alias("m"), F.array_join("antecedent", ",").alias("l"), F.array_join("consequent", ",").alias("r"))
    keyed = found.withColumn("__items", F.sort_array(F.concat("antecedent", "consequent"))).withColumn("__place", place)
    keyed = keyed.withColumn("__size", F.size("__items"))
    earliest = stable(keyed.groupBy(F.array_join("__items", SEPARATOR).alias("__set")).agg(F.min("__place").alias("__first")))
    # an item set's best earlier rule is its own or that of a set with one item less: sets are walked from short to long
    longest = keyed.agg(F.max("__size")).first()[0] or 0
    best = None
    sets = stable(_subsets_in_use(keyed.select("__items").distinct(), longest))
    for size in range(1, longest + 1):
        now = sets.where(F.size("__items") == size).select("__items", F.array_join("__items", SEPARATOR).alias("__set"))
        now = now.join(earliest, "__set", "left")
        if best is not None:
            less = now.select("__set", F.explode(F.transform("__items", lambda x: F.array_join(F.array_remove("__items", x), SEPARATOR))).alias("__less"))
            less = less.join(best.select(F.col("__set").alias("__less"), F.col("__best").alias("__below")), "__less")
            less = less.groupBy("__set").agg(F.min("__below").alias("__below"))
            now = now.join(less, "__set", "left").withColumn("__first", F.least("__first", "__below"))
        step = stable(now.select("__set", F.col("__first").alias("__best")))
        hit = keyed.where(F.col("__size") == size).withColumn("__set", F.array_join("__items", SEPARATOR)).join(step, "__set")
        hit = hit.where(F.col("__best") < F.col("__place")).select("antecedent", "consequent")
        hits = hit if size == 1 else hits.unionByName(hit)
        best = step.where(F.col("__best").isNotNull())
    if not longest:
        return found
    return found.join(hits, ["antecedent", "consequent"], "left_anti")
