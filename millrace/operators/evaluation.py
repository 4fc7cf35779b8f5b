"""Classification reports and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.relational import count_by


def accuracy(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def mark_correct(df: DataFrame, label: str, prediction: str, name: str = "correct") -> DataFrame:
    return df.withColumn(name, F.col(label) == F.col(prediction))


def confusion(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """Counts per (label, prediction), the base of every report below."""
    return count_by(df, [*keys, label, prediction])


def overall_report(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, accuracy, kappa and no-information rate, per group if ``keys``."""
    keys = list(keys)
    cells = confusion(df, label, prediction, keys)
    rows = cells.groupBy(*keys, F.col(label).alias("c")).agg(F.sum("n").alias("rows"))
    cols = cells.groupBy(*keys, F.col(prediction).alias("c")).agg(F.sum("n").alias("cols"))
    agreed = cells.where(F.col(label) == F.col(prediction)).select(*keys, F.col(label).alias("c"), F.col("n").alias("hit"))
    both = rows.join(cols, [*keys, "c"], "full").join(agreed, [*keys, "c"], "left").na.fill(0, ["rows", "cols", "hit"])
    n = F.sum("rows").cast("double")
    seen = F.sum("hit") / n
    chance = F.sum(F.col("rows").cast("double") * F.col("cols")) / (n * n)
    return both.groupBy(*keys).agg(
        F.sum("rows").alias("n"),
        seen.alias("accuracy"),
        F.try_divide(seen - chance, 1 - chance).alias("kappa"),
        (F.max("rows") / n).alias("no_information_rate"),
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class: sensitivity, specificity, predictive values, prevalence, balanced accuracy."""
    cells = confusion(df, label, prediction)
    total = cells.agg(F.sum("n")).first()[0] or 0
    rows = cells.groupBy(F.col(label).alias("class")).agg(F.sum("n").alias("__r"))
    cols = cells.groupBy(F.col(prediction).alias("class")).agg(F.sum("n").alias("__c"))
    agreed = cells.where(F.col(label) == F.col(prediction)).select(F.col(label).alias("class"), F.col("n").alias("__h"))
    both = rows.join(cols, "class", "full").join(agreed, "class", "left").na.fill(0, ["__r", "__c", "__h"])
    tp, n = F.col("__h"), F.lit(total)
    fn, fp = F.col("__r") - tp, F.col("__c") - tp
    tn = n - tp - fn - fp

    def ratio(a: Column, b: Column) -> Column:
        return F.try_divide(a.cast("double"), b.cast("double"))

    out = both.select(
        "class",
        ratio(tp, tp + fn).alias("sensitivity"), ratio(tn, tn + fp).alias("specificity"),
        ratio(tp, tp + fp).alias("ppv"), ratio(tn, tn + fn).alias("npv"), ratio(tp + fn, n).alias("prevalence"),
    )
    return out.withColumn("balanced_accuracy", (F.col("sensitivity") + F.col("specificity")) / 2)


def compare_models(metrics: DataFrame, keys: Sequence[str] = ("model", "metric"), value: str = "value") -> DataFrame:
    """Spread of a metric over resamples; input has one row per (model, resample, metric)."""
    return metrics.groupBy(*keys).agg(
        F.min(value).alias("min"), F.percentile(value, 0.25).alias("q1"), F.percentile(value, 0.5).alias("median"),
        F.avg(value).alias("mean"), F.percentile(value, 0.75).alias("q3"), F.max(value).alias("max"),
    )


def actual_vs_predicted(df: DataFrame, actual: str, prediction: str, keys: Sequence[str], floor: int = 0) -> DataFrame:
    """Mean actual and mean predicted per group with more than ``floor`` rows."""
    return df.groupBy(*keys).agg(
        F.avg(actual).alias(actual), F.avg(prediction).alias(prediction), F.count(F.lit(1)).alias("freq")
    ).where(F.col("freq") > floor)
