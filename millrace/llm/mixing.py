"""Mix sources to target weights by repeating documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.texts import few_rows, set_apart, word_array, SPACE
from millrace.session import stable

#: hexadecimal digits of the hash that seed a draw: 2^48 steps
DIGITS = 12


def word_count(text: Column) -> Column:
    """Number of words between white space; null has none."""
    return F.size(word_array(text, SPACE)).cast("long")


def source_targets(
    sized: DataFrame,
    source: str = "source",
    size: str = "size",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``weight``, ``target``, ``rate``.

    Sources in code-point order (null last) take ``weights`` in turn and share
    ``share`` times all sizes.  No target exceeds ``most`` times its source's
    size.  Giving the excess of capped sources to the others by weight, again
    and again, ends at ``target = min(most * size, level * weight)`` for one
    common level.  With sources ordered by the level at which each one caps,
    the capped ones come first, so running sums give the level.  The windows
    run over one row per source.  Sources without words get target 0, as does
    an empty table; ``share`` above ``most`` caps every source.
    """
    per = stable(sized.groupBy(F.col(source).alias("__source")).agg(F.sum(size).cast("long").alias("source_size")))
    turn = (F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1))
    per = per.withColumn("__cap", most * F.col("source_size")).withColumn("__caps_at", F.col("__cap") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    upto = everything.orderBy("__caps_at", F.col("__source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "*",
        (share * F.sum("source_size").over(everything)).alias("__total"),
        F.coalesce(F.sum("__cap").over(upto), F.lit(0.0)).alias("__capped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0))).alias("__open"),
    )
    # the level if exactly the sources before this one were capped; the first that does not cap this one stands,
    # and it is the largest such, since later ones only fall
    level = (F.col("__total") - F.col("__capped")) / F.col("__open")
    per = per.withColumn("__level", F.max(F.when(level <= F.col("__caps_at"), level)).over(everything))
    target = F.when(F.col("__caps_at") <= F.col("__level"), F.col("__cap")).otherwise(
        F.coalesce(F.col("__level") * F.col("weight"), F.col("__cap"))
    )
    per = per.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(F.lit(0.0)))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return per.select(F.col("__source").alias(source), "source_size", "weight", "target", rate.alias("rate"))


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the key alone, so a task that runs again draws the same."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def mix_counts(
    docs: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", seed: str = "mix"
) -> DataFrame:
    """``docs`` with ``source_size``, ``target``, ``rate`` and ``copies`` of the document's source.

    ``copies`` is floor(rate) plus one where the hash-seeded draw falls below
    the fraction.  Null keys share one draw, repeated rows draw alike.
    """
    per = targets.select(F.col(source).alias("__s"), "source_size", "target", "rate")
    docs, (key, source), back = set_apart(docs, key, source)
    out = docs.drop("source_size", "target", "rate", "copies").join(
        few_rows(per), F.col(source).eqNullSafe(F.col("__s")), "left"
    )
    whole = F.floor("rate")
    extra = (draw(F.col(key), seed) < F.col("rate") - whole).cast("int")
    return back(out.withColumn("copies", (whole + extra).cast("int")).drop("__s"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """The mixed corpus: every document ``copies`` times, numbered in ``copy`` from 0.

    Other columns pass through whatever their names, but those named like a
    result (``copy``, ``copies``, ``source_size``, ``target``, ``rate``) are replaced or go.  Null
    and empty texts count no words; they repeat at their source's rate, so a
    source without words takes no part.  An empty table mixes to an empty one.
    """
    targets = stable(source_targets(docs.select(F.col(source), word_count(F.col(text)).alias("size")), source, "size", weights, share, most))
    out = mix_counts(docs, targets, key, source, seed).where("copies > 0")
    again = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    gone = ("copy", "copies", "source_size", "target", "rate")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in gone], again)
