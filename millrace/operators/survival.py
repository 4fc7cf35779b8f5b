"""Survival curves and hazard regressions on ``(time, event)`` columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import AFTSurvivalRegression, GeneralizedLinearRegression
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import tails
from millrace.operators.ordering import ranged, scan_ranges
from millrace.session import stable

Z95 = 1.959963984540054
TIE_CHUNK = 4096


def kaplan_meier(df: DataFrame, time: str, event: str, keys: Sequence[str] = ()) -> DataFrame:
    """At risk, events, survival, standard error and 95% log interval per distinct time.

    Subjects are counted per time first; the running products go over ranges
    of distinct times, so neither many subjects nor many times gather in one
    task.  Error and interval are NULL once survival is 0.
    """
    keys = list(keys)
    counts = (
        df.where(F.col(time).isNotNull())
        .groupBy(*keys, F.col(time).alias("time"))
        .agg(F.count(F.lit(1)).alias("__c"), F.sum(F.col(event).cast("long")).alias("events"))
    )
    at_risk = scan_ranges(ranged(counts, keys, ["time"]), keys, ["time"], sums={"__upto": "__c"})
    at_risk = at_risk.withColumn("at_risk", F.col("__upto_total") - F.col("__upto") + F.col("__c"))
    n, d = F.col("at_risk"), F.col("events")
    curve = scan_ranges(
        at_risk, keys, ["time"],
        sums={"__green": F.coalesce(F.try_divide(d.cast("double"), n * (n - d)), F.lit(0.0))},
        products={"survival": F.lit(1.0) - d / n},
    )
    s, se = F.col("survival"), F.sqrt("__green")
    alive = s > 0
    return curve.select(
        *keys, "time", "at_risk", "events", (F.col("__c") - d).alias("censored"), "survival",
        F.when(alive, s * se).alias("std_error"),
        F.when(alive, s * F.exp(-Z95 * se)).alias("lo95"),
        F.when(alive, F.least(F.lit(1.0), s * F.exp(Z95 * se))).alias("hi95"),
    )


def risk_table(df: DataFrame, time: str, times: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Subjects still at risk at each time of a grid, per group."""
    counts = df.groupBy(*keys).agg(
        *[F.count_if(F.col(time) >= F.lit(t)).alias(str(i)) for i, t in enumerate(times)]
    )
    long = counts.unpivot(list(keys), [str(i) for i in range(len(times))], "__i", "at_risk")
    grid = F.element_at(F.lit([float(t) for t in times]), F.col("__i").cast("int") + 1)
    return long.select(*keys, grid.alias("time"), "at_risk")


def _table(spark, names: Sequence[str], coef: np.ndarray, cov: np.ndarray) -> DataFrame:
    rows = []
    for i, n in enumerate(names):
        se = math.sqrt(max(cov[i, i], 0.0))
        z = coef[i] / se if se else math.nan
        rows.append((n, float(coef[i]), math.exp(coef[i]), se, float(z), tails.normal_two_sided(z)))
    return spark.createDataFrame(
        rows, "term string, estimate double, exp_estimate double, std_error double, z double, p double"
    )


def _newton(start: np.ndarray, evaluate, rounds: int = 30, tolerance: float = 1e-9):
    """Maximise with step halving; ``evaluate(b)`` gives value, gradient and Hessian."""
    b = start
    value, grad, hess = evaluate(b)
    for _ in range(rounds):
        try:
            step = np.linalg.solve(-hess, grad)
        except np.linalg.LinAlgError:
            step = np.linalg.lstsq(-hess, grad, rcond=None)[0]
        if grad @ step <= 0:
            step = grad / max(float(np.abs(np.diag(hess)).max()), 1e-12)
        size = 1.0
        while True:
            trial = evaluate(b + size * step)
            if (math.isfinite(trial[0]) and trial[0] >= value - 1e-12) or size < 1e-6:
                break
            size /= 2
        gain, b = trial[0] - value, b + size * step
        value, grad, hess = trial
        if abs(gain) <= tolerance * (abs(value) + tolerance):
            break
    return b, value, np.linalg.pinv(-hess)


def cox_ph(df: DataFrame, time: str, event: str, x: Sequence[str], rounds: int = 30) -> tuple[DataFrame, float]:
    """Proportional hazards with Efron ties; coefficient table and log likelihood.

    Each Newton step is one aggregate per distinct time, suffix sums over
    fixed ranges of times and one final sum; only p x p numbers reach the
    driver.  Covariates are centred first.
    """
    spark, p = df.sparkSession, len(x)
    rows = df.where(F.greatest(*[F.col(c).isNull() for c in (time, event, *x)], F.lit(False)) == F.lit(False))
    mean = rows.agg(*[F.avg(F.col(c).cast("double")) for c in x]).first()
    rows = rows.select(
        F.col(time).alias("time"), F.col(event).cast("double").alias("event"),
        *[(F.col(c).cast("double") - F.lit(float(m))).alias(f"x{i}") for i, (c, m) in enumerate(zip(x, mean, strict=True))],
    )
    ranges = ranged(rows.select("time").distinct(), [], ["time"])
    data = stable(rows.join(ranges, "time"))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    xs = [F.col(f"x{i}") for i in range(p)]

    def evaluate(b: np.ndarray):
        eta = F.lit(0.0)
        for i in range(p):
            eta = eta + F.lit(float(b[i])) * xs[i]
        w, dead = F.exp(eta), F.col("event")
        moments = {"0": w, **{f"1_{i}": w * xs[i] for i in range(p)}, **{f"2_{i}_{j}": w * xs[i] * xs[j] for i, j in pairs}}
        per_time = data.groupBy("__range", "time").agg(
            F.sum(dead).alias("d"), F.sum(dead * eta).alias("t0"),
            *[F.sum(dead * xs[i]).alias(f"t1_{i}") for i in range(p)],
            *[F.sum(m).alias(f"a{k}") for k, m in moments.items()],
            *[F.sum(dead * m).alias(f"e{k}") for k, m in moments.items()],
        )
        risk = scan_ranges(per_time, [], ["time"], sums={f"r{k}": f"a{k}" for k in moments}, descending=True).where("d > 0")
        # Efron: the k-th of d tied deaths sees the risk set less k/d of the dying
        chunks = risk.withColumn(
            "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("d") - 1) / TIE_CHUNK).cast("long")))
        ).repartition("time", "chunk")
        ties = chunks.withColumn(
            "k", F.explode(F.sequence(F.col("chunk") * TIE_CHUNK, F.least(F.col("d").cast("long") - 1, (F.col("chunk") + 1) * TIE_CHUNK - 1)))
        )
        share = F.col("k") / F.col("d")

        def left(k: str) -> Column:
            return F.col(f"r{k}") - share * F.col(f"e{k}")

        s = ties.select(
            "k", "d", "t0", *[f"t1_{i}" for i in range(p)], *[left(k).alias(f"s{k}") for k in moments]
        )
        first = F.col("k") == 0
        u = [F.col(f"s1_{i}") / F.col("s0") for i in range(p)]
        got = s.agg(
            (F.sum(F.when(first, F.col("t0")).otherwise(0.0)) - F.sum(F.log("s0"))).alias("l"),
            *[(F.sum(F.when(first, F.col(f"t1_{i}")).otherwise(0.0)) - F.sum(u[i])).alias(f"g{i}") for i in range(p)],
            *[F.sum(F.col(f"s2_{i}_{j}") / F.col("s0") - u[i] * u[j]).alias(f"h{i}_{j}") for i, j in pairs],
        ).first()
        hess = np.zeros((p, p))
        for i, j in pairs:
            hess[i, j] = hess[j, i] = -got[f"h{i}_{j}"]
        return got["l"], np.array([got[f"g{i}"] for i in range(p)]), hess

    b, value, cov = _newton(np.zeros(p), evaluate, rounds)
    return _table(spark, x, b, cov), value


def exponential_regression(df: DataFrame, time: str, event: str, x: Sequence[str]) -> DataFrame:
    """Exponential survival regression of log time, as a Poisson model with offset log time."""
    data = VectorAssembler(inputCols=list(x), outputCol="__f").transform(
        df.select(F.col(event).cast("double").alias("__e"), F.log(time).alias("__o"), *[F.col(c).cast("double") for c in x])
    )
    model = GeneralizedLinearRegression(
        family="poisson", link="log", labelCol="__e", offsetCol="__o", featuresCol="__f", tol=1e-10, maxIter=50
    ).fit(data)
    try:
        se = model.summary.coefficientStandardErrors
    except UnsupportedOperationException:  # a constant covariate leaves no standard errors
        se = [None] * (len(x) + 1)
    terms = [("(Intercept)", -float(model.intercept), se[-1])] + [
        (n, -float(c), s) for n, c, s in zip(x, model.coefficients, se[:-1], strict=True)
    ]
    return df.sparkSession.createDataFrame(
        [(t, e, s, e / s if s else None) for t, e, s in terms], "term string, estimate double, std_error double, z double"
    )


def weibull_regression(df: DataFrame, time: str, event: str, x: Sequence[str]) -> DataFrame:
    """Weibull survival regression of log time; the last row is the scale."""
    data = VectorAssembler(inputCols=list(x), outputCol="__f").transform(
        df.select(F.col(time).cast("double").alias("__t"), F.col(event).cast("double").alias("__e"), *[F.col(c).cast("double") for c in x])
    )
    model = AFTSurvivalRegression(labelCol="__t", censorCol="__e", featuresCol="__f", maxIter=200, tol=1e-9).fit(data)
    rows = [("(Intercept)", float(model.intercept))] + [(n, float(c)) for n, c in zip(x, model.coefficients, strict=True)]
    return df.sparkSession.createDataFrame([*rows, ("scale", float(model.scale))], "term string, estimate double")


def loglogistic_regression(df: DataFrame, time: str, event: str, x: Sequence[str], rounds: int = 50) -> tuple[DataFrame, float]:
    """Log-logistic survival regression; ``log(scale)`` is the last term.

    Newton steps, each one aggregate of score and Hessian terms.
    """
    spark, p = df.sparkSession, len(x)
    data = stable(  # every step reads it again
        df.select(
            F.log(time).alias("y"), F.col(event).cast("double").alias("d"), F.lit(1.0).alias("x0"),
            *[F.col(c).cast("double").alias(f"x{i + 1}") for i, c in enumerate(x)],
        )
    )
    xs = [F.col(f"x{i}") for i in range(p + 1)]
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]

    def evaluate(b: np.ndarray):
        log_scale, scale = float(b[-1]), math.exp(float(b[-1]))
        mu = F.lit(0.0)
        for i in range(p + 1):
            mu = mu + F.lit(float(b[i])) * xs[i]
        t = data.withColumn("z", (F.col("y") - mu) / scale)
        z, d = F.col("z"), F.col("d")
        # log(1 + e^z) without overflow
        soft = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        q = F.lit(1.0) / (1.0 + F.exp(-z))
        first, second = d - (1.0 + d) * q, -(1.0 + d) * q * (1.0 - q)
        got = t.agg(
            F.sum(d * (z - F.lit(log_scale) - F.col("y")) - (1.0 + d) * soft).alias("l"),
            *[F.sum(-first * xs[i] / scale).alias(f"g{i}") for i in range(p + 1)],
            F.sum(-first * z - d).alias("gs"),
            *[F.sum(second * xs[i] * xs[j] / (scale * scale)).alias(f"h{i}_{j}") for i, j in pairs],
            *[F.sum((second * z + first) * xs[i] / scale).alias(f"hs{i}") for i in range(p + 1)],
            F.sum(second * z * z + first * z).alias("hss"),
        ).first()
        m = p + 2
        hess = np.zeros((m, m))
        for i, j in pairs:
            hess[i, j] = hess[j, i] = got[f"h{i}_{j}"]
        for i in range(p + 1):
            hess[i, -1] = hess[-1, i] = got[f"hs{i}"]
        hess[-1, -1] = got["hss"]
        return got["l"], np.array([*(got[f"g{i}"] for i in range(p + 1)), got["gs"]]), hess

    mean, sd = data.agg(F.avg("y"), F.stddev_pop("y")).first()
    start = np.zeros(p + 2)
    start[0], start[-1] = mean, math.log(max(sd, 1e-6) * math.sqrt(3.0) / math.pi)
    b, value, cov = _newton(start, evaluate, rounds)
    return _table(spark, ["(Intercept)", *x, "log(scale)"], b, cov), value
