"""Regular series ``(key, ts, value, pos)`` with one row per calendar step.

:func:`regular_series` first aggregates raw rows per (key, step) with map-side
combine.  After it a key has at most one row per step of the calendar, so the
per-key windows and grouped maps below handle tens of thousands of rows at the
very most, whatever the size or skew of the raw table; many keys spread over
the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import tails
from millrace.operators.ordering import join_null_safe
from millrace.operators.regression import Gram, ols
from millrace.operators.windows import centred_mean


def regular_series(
    df: DataFrame, keys: Sequence[str], ts: str, value: Column, step: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Aggregate ``value`` per key and calendar step; ``pos`` counts steps from 1.

    A step without rows between a key's first and last gets a row with a NULL
    value, so positions, lags and seasons follow the calendar.  Rows without a
    timestamp have no step.  Steps of a day or more give a DATE.  ``start`` and ``end`` bound the raw
    timestamps (both inclusive) before anything is shuffled.
    """
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end))
    cut = F.date_trunc(step, ts)
    if step in ("day", "week", "month", "quarter", "year"):
        cut = cut.cast("date")
    out = df.where(F.col(ts).isNotNull()).groupBy(*keys, cut.alias("ts")).agg(value.alias("value"))
    every = F.expr("interval 3 months" if step == "quarter" else f"interval 1 {step}")
    spans = out.groupBy(*keys).agg(F.sequence(F.min("ts"), F.max("ts"), every).alias("__all"))
    spans = spans.select(*keys, F.explode("__all").alias("ts"))
    same = F.col("a.ts") == F.col("b.ts")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    out = spans.alias("a").join(out.alias("b"), same, "left").select("a.*", "b.value")
    w = Window.partitionBy(*keys).orderBy("ts")
    return out.withColumn("pos", F.row_number().over(w).cast("bigint"))


def _by(key: str):
    return Window.partitionBy(key).orderBy("pos")


def decompose(series: DataFrame, key: str, period: int) -> DataFrame:
    """Additive trend, seasonal figure (centred to sum 0) and remainder."""
    trended = centred_mean(series, [key], "pos", "value", period, "trend").withColumn(
        "season", F.pmod(F.col("pos") - 1, F.lit(period))
    )
    raw = trended.groupBy(key, "season").agg(F.avg(F.col("value") - F.col("trend")).alias("raw"))
    middle = raw.groupBy(key).agg(F.avg("raw").alias("middle"))
    figure = raw.join(middle, key).select(key, "season", (F.col("raw") - F.col("middle")).alias("seasonal"))
    return trended.join(figure, [key, "season"]).withColumn(
        "remainder", F.col("value") - F.col("trend") - F.col("seasonal")
    )


def adjusted(parts: DataFrame) -> DataFrame:
    """Seasonally adjusted, detrended and doubly adjusted columns of a decomposition."""
    return parts.withColumns(
        {
            "seasonally_adjusted": F.col("value") - F.col("seasonal"),
            "detrended": F.col("value") - F.col("trend"),
            "doubly_adjusted": F.col("value") - F.col("trend") - F.col("seasonal"),
        }
    )


def log_series(series: DataFrame) -> DataFrame:
    """Natural log of the values; a value at or below zero becomes NULL."""
    return series.withColumn("value", F.when(F.col("value") > 0, F.log("value")))


def acf(series: DataFrame, key: str, max_lag: int) -> DataFrame:
    """Autocorrelations ``(key, lag, acf, n)`` with divisor n; missing pairs are passed over."""
    n_all = Window.partitionBy(key)
    demeaned = series.select(
        key, "pos", (F.col("value") - F.avg("value").over(n_all)).alias("d")
    )
    w = _by(key)
    lagged = demeaned.select(key, "d", *[F.lag("d", k).over(w).alias(f"l{k}") for k in range(1, max_lag + 1)])
    square = F.sum(F.col("d") * F.col("d"))
    wide = lagged.groupBy(key).agg(
        F.count("d").alias("n"),
        F.lit(1.0).alias("0"),
        *[F.try_divide(F.sum(F.col("d") * F.col(f"l{k}")), square).alias(str(k)) for k in range(1, max_lag + 1)],
    )
    long = wide.unpivot([key, "n"], [str(k) for k in range(max_lag + 1)], "lag", "acf")
    return long.withColumn("lag", F.col("lag").cast("int"))


def partial_from_acf(r: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from autocorrelations r[0..K] (Durbin-Levinson)."""
    out = np.zeros(len(r) - 1)
    phi = np.zeros(0)
    for k in range(1, len(r)):
        top = r[k] - phi @ r[k - 1 : 0 : -1] if k > 1 else r[1]
        bottom = 1.0 - phi @ r[1:k]
        last = top / bottom if bottom else 0.0
        phi = np.append(phi - last * phi[::-1], last)
        out[k - 1] = last
    return out


def pacf(series: DataFrame, key: str, max_lag: int) -> DataFrame:
    """Partial autocorrelations; each group holds the max_lag + 1 autocorrelations of one series."""
    table = acf(series, key, max_lag).select(key, "lag", "acf")
    kind = table.schema[key].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.sort_values("lag")["acf"].to_numpy()
        values = partial_from_acf(r)
        return pd.DataFrame({key: pdf[key].iloc[0], "lag": np.arange(1, len(values) + 1), "pacf": values})

    return table.groupBy(key).applyInPandas(solve, f"`{key}` {kind}, lag int, pacf double")


def box_test(series: DataFrame, key: str, lag: int = 1) -> DataFrame:
    """Box-Pierce and Ljung-Box statistics with chi-square tails."""
    r2 = F.col("acf") * F.col("acf")
    stats = (
        acf(series, key, lag)
        .where("lag > 0")
        .groupBy(key)
        .agg(
            (F.max("n") * F.sum(r2)).alias("box_pierce"),
            (F.max("n") * (F.max("n") + 2) * F.sum(r2 / (F.col("n") - F.col("lag")))).alias("ljung_box"),
        )
    )

    @F.pandas_udf("double")
    def tail(x: pd.Series) -> pd.Series:
        return x.map(lambda v: tails.chi2_tail(v, lag))

    return stats.withColumns({"p_box_pierce": tail("box_pierce"), "p_ljung_box": tail("ljung_box")})


# Published Dickey-Fuller critical values (constant and trend) by
# series length and lower tail probability.
ADF_LENGTHS = [25, 50, 100, 250, 500, 100000]
ADF_PROBS = [0.01, 0.025, 0.05, 0.10, 0.90, 0.95, 0.975, 0.99]
ADF_CRITICAL = [
    [-4.38, -3.95, -3.60, -3.24, -1.14, -0.80, -0.50, -0.15],
    [-4.15, -3.80, -3.50, -3.18, -1.19, -0.87, -0.58, -0.24],
    [-4.04, -3.73, -3.45, -3.15, -1.22, -0.90, -0.62, -0.28],
    [-3.99, -3.69, -3.43, -3.13, -1.23, -0.92, -0.64, -0.31],
    [-3.98, -3.68, -3.42, -3.13, -1.24, -0.93, -0.65, -0.32],
    [-3.96, -3.66, -3.41, -3.12, -1.25, -0.94, -0.66, -0.33],
]


def adf_statistic(x: np.ndarray, lags: int) -> float:
    """t value of the lagged level in the regression of differences on level, trend and lagged differences."""
    d = np.diff(x)
    rows = np.arange(lags, len(d))
    design = [np.ones(len(rows)), rows + 1.0, x[rows]]
    design += [d[rows - j] for j in range(1, lags + 1)]
    a = np.column_stack(design)
    coef, *_ = np.linalg.lstsq(a, d[rows], rcond=None)
    left = d[rows] - a @ coef
    s2 = left @ left / (len(rows) - a.shape[1])
    se = np.sqrt(s2 * np.linalg.pinv(a.T @ a)[2, 2])
    return float(coef[2] / se) if se > 0 else math.nan


def adf_test(series: DataFrame, key: str, lags: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test per series, NULLs removed.

    Default lag order trunc((n-1)^(1/3)); p by interpolation in the table,
    clipped to its ends.  A series without values, or too short for one degree
    of freedom, has NULL for statistic and p, and so has a constant one.
    """
    kind = series.schema[key].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("pos")["value"].dropna().to_numpy(dtype=float)
        k = int(max(len(x) - 1, 0) ** (1 / 3)) if lags is None else lags
        spare = len(x) - 1 - k - (3 + k)
        stat = adf_statistic(x, k) if spare > 0 else math.nan
        if not math.isfinite(stat):
            return pd.DataFrame({key: [pdf[key].iloc[0]], "lags": [k], "statistic": [math.nan], "p": [math.nan]})
        crit = [np.interp(len(x), ADF_LENGTHS, [row[j] for row in ADF_CRITICAL]) for j in range(len(ADF_PROBS))]
        p = float(np.interp(stat, crit, ADF_PROBS))
        return pd.DataFrame({key: [pdf[key].iloc[0]], "lags": [k], "statistic": [stat], "p": [p]})

    return series.select(key, "pos", F.col("value").cast("double")).groupBy(key).applyInPandas(
        solve, f"`{key}` {kind}, lags int, statistic double, p double"
    )


def future_index(series: DataFrame, key: str, n: int) -> DataFrame:
    """The next ``n`` steps per key after its last one, at the median step.

    A median of 28 to 31 days means calendar months, 90 to 92 quarters, 365 or
    366 years; any other step is a fixed number of seconds.
    """
    ts = F.col("ts").cast("timestamp")
    step = F.unix_timestamp(ts) - F.unix_timestamp(F.lag(ts).over(_by(key)))
    found = (
        series.select(key, "pos", ts.alias("t"), step.alias("s"))
        .groupBy(key)
        .agg(F.median("s").alias("s"), F.max("t").alias("last"), F.max("pos").alias("last_pos"))
    )
    day = F.col("s") / 86400
    months = F.when(day.between(28, 31), 1).when(day.between(90, 92), 3).when(day.between(365, 366), 12)
    ahead = found.withColumn("months", months).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(n))))
    by_month = F.add_months(F.col("last").cast("date"), (F.col("months") * F.col("h")).cast("int")).cast("timestamp")
    by_second = F.timestamp_seconds(F.unix_timestamp("last") + (F.col("s") * F.col("h")).cast("bigint"))
    kind = series.schema["ts"].dataType
    return ahead.select(
        key, F.when(F.col("months").isNotNull(), by_month).otherwise(by_second).cast(kind).alias("ts"),
        (F.col("last_pos") + F.col("h")).alias("pos"), "h",
    )


def index_summary(series: DataFrame, key: str) -> DataFrame:
    """Rows, first and last step and the distribution of step lengths in seconds."""
    ts = F.col("ts").cast("timestamp")
    step = F.unix_timestamp(ts) - F.unix_timestamp(F.lag(ts).over(_by(key)))
    s = series.select(key, "ts", step.cast("double").alias("s"))
    return s.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
        F.min("s").alias("step_min"),
        F.percentile("s", 0.25).alias("step_q1"),
        F.percentile("s", 0.5).alias("step_median"),
        F.avg("s").alias("step_mean"),
        F.percentile("s", 0.75).alias("step_q3"),
        F.max("s").alias("step_max"),
    )


def time_signature(df: DataFrame, ts: str) -> DataFrame:
    """Calendar columns of a timestamp.

    Weeks count from 1 January in sevens (``week``) or by ISO rules; ``mweek``
    is the Sunday-based week within the month, ``mday7`` the how-manyth of its
    weekday a day is within the month.
    """
    c = F.col(ts).cast("timestamp")
    first = F.trunc(c, "month")
    return df.withColumns(
        {
            "index_num": F.unix_timestamp(c),
            "year": F.year(c),
            "year_iso": F.extract(F.lit("YEAROFWEEK"), c),
            "half": F.when(F.quarter(c) <= 2, 1).otherwise(2),
            "quarter": F.quarter(c),
            "month": F.month(c),
            "month_xts": F.month(c) - 1,
            "month_lbl": F.date_format(c, "MMMM"),
            "day": F.dayofmonth(c),
            "hour": F.hour(c),
            "minute": F.minute(c),
            "second": F.second(c),
            "hour12": F.pmod(F.hour(c), F.lit(12)),
            "am_pm": F.when(F.hour(c) < 12, 1).otherwise(2),
            "wday": F.dayofweek(c),
            "wday_xts": F.dayofweek(c) - 1,
            "wday_lbl": F.date_format(c, "EEEE"),
            "mday": F.dayofmonth(c),
            "qday": F.datediff(c, F.trunc(c, "quarter")) + 1,
            "yday": F.dayofyear(c),
            "mweek": F.floor((F.dayofmonth(c) + F.dayofweek(first) - 2) / 7) + 1,
            "week": F.floor((F.dayofyear(c) - 1) / 7) + 1,
            "week_iso": F.weekofyear(c),
            "week2": F.pmod(F.floor((F.dayofyear(c) - 1) / 7) + 1, F.lit(2)),
            "week3": F.pmod(F.floor((F.dayofyear(c) - 1) / 7) + 1, F.lit(3)),
            "week4": F.pmod(F.floor((F.dayofyear(c) - 1) / 7) + 1, F.lit(4)),
            "mday7": F.floor((F.dayofmonth(c) - 1) / 7) + 1,
        }
    )


SIGNATURE_NUMBERS = [
    "index_num", "year", "year_iso", "half", "quarter", "month", "month_xts", "day", "hour", "minute",
    "second", "hour12", "am_pm", "wday", "wday_xts", "mday", "qday", "yday", "mweek", "week", "week_iso",
    "week2", "week3", "week4", "mday7",
]


def signature_forecast(series: DataFrame, key: str, h: int) -> DataFrame:
    """Regress each series on its calendar columns and predict the next ``h`` steps.

    Columns explained by earlier ones are left out of the fit.  Every series is
    solved in its own grouped map, which sees one row per calendar step.
    """
    past = time_signature(series, "ts").select(key, "value", *[F.col(c).cast("double").alias(c) for c in SIGNATURE_NUMBERS])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        z = pdf[[*SIGNATURE_NUMBERS, "value"]].dropna().to_numpy(float)
        if not len(z):
            return pd.DataFrame({key: pdf[key].iloc[:1], "b0": [None], "b": [[0.0] * len(SIGNATURE_NUMBERS)]})
        centre = z.mean(axis=0)
        d = z - centre
        est = ols(Gram(SIGNATURE_NUMBERS, "value", {}, float(len(z)), centre, d.sum(axis=0), d.T @ d)).estimates()
        slopes = [est.get(c, 0.0) for c in SIGNATURE_NUMBERS]
        return pd.DataFrame({key: pdf[key].iloc[:1].to_list(), "b0": [est["(Intercept)"]], "b": [slopes]})

    kind = series.schema[key].dataType.simpleString()
    model = past.groupBy(key).applyInPandas(solve, f"`{key}` {kind}, b0 double, b array<double>")
    ahead = join_null_safe(time_signature(future_index(series, key, h), "ts"), model, [key])
    terms = F.zip_with(F.array(*[F.col(c).cast("double") for c in SIGNATURE_NUMBERS]), F.col("b"), lambda x, b: x * b)
    return ahead.select(key, "ts", "pos", "h", (F.col("b0") + F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)).alias("prediction"))


def forecast_errors(df: DataFrame, actual: str, prediction: str) -> DataFrame:
    e = F.col(actual) - F.col(prediction)
    return df.withColumns({"error": e, "error_pct": F.try_divide(e, F.col(actual))})


def error_summary(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """ME, RMSE, MAE, MAPE and MPE of the error columns, missing ones left out."""
    e, p = F.col("error"), F.col("error_pct")
    return df.groupBy(*keys).agg(
        F.avg(e).alias("me"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(F.abs(p)).alias("mape"),
        F.avg(p).alias("mpe"),
    )


def ar1_forecast(series: DataFrame, key: str, h: int, value: str = "value") -> DataFrame:
    """First-order autoregression by conditional least squares, ``h`` steps ahead.

    The forecast has the closed form mu + phi^h (last - mu).
    """
    pairs = series.select(key, "pos", F.col(value).alias("x"), F.lag(value).over(_by(key)).alias("before"))
    fit = pairs.groupBy(key).agg(
        F.regr_slope("x", "before").alias("phi"),
        F.regr_intercept("x", "before").alias("c"),
        F.max_by("x", "pos").alias("last"),
        F.max("pos").alias("last_pos"),
    )
    steps = fit.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(h))))
    mu = F.try_divide(F.col("c"), 1 - F.col("phi"))
    return steps.select(
        key, "phi", (F.col("last_pos") + F.col("h")).alias("pos"), "h",
        (mu + F.pow("phi", F.col("h")) * (F.col("last") - mu)).alias("point"),
    )
