"""Per-series solvers: seasonal autoregression, and tables from fitted models.

Input is a frame of :func:`millrace.operators.timeseries.regular_series`; one
grouped-map call handles one series, whose length is bounded by the calendar.
Outputs are long tables, so a model is fitted once and read several ways.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.timeseries import future_index

Z80, Z95 = 1.2815515655446004, 1.959963984540054


def regular_values(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Values and positions in order; a step without a value lies on the line between its neighbours."""
    pdf = pdf.sort_values("pos")
    x, pos = pdf["value"].to_numpy(float), pdf["pos"].to_numpy()
    known = ~np.isnan(x)
    return (x if known.all() or not known.any() else np.interp(pos, pos[known], x[known])), pos


def _difference(x: np.ndarray, d: int, seasonal: int, period: int) -> np.ndarray:
    for _ in range(d):
        x = np.diff(x)
    for _ in range(seasonal):
        x = x[period:] - x[:-period]
    return x


def _ar_polynomial(phi: np.ndarray, seasonal: np.ndarray, period: int) -> np.ndarray:
    """Lag weights of (1 - phi(B)) (1 - seasonal(B^period)), as d_t = sum w_j d_{t-j}."""
    a = np.concatenate([[1.0], -phi])
    b = np.zeros(period * len(seasonal) + 1)
    b[0] = 1.0
    for i, s in enumerate(seasonal, start=1):
        b[i * period] = -s
    return -np.convolve(a, b)[1:]


def _fit_seasonal_ar(d: np.ndarray, p: int, sp: int, period: int, start: int):
    """Conditional least squares, alternating between the two factors."""
    phi, sea = np.zeros(p), np.zeros(sp)
    rows = np.arange(start, len(d))

    def lagged(x, lags):
        return np.column_stack([x[rows - k] for k in lags]) if lags else np.zeros((len(rows), 0))

    def filtered(weights, step):
        out = d.copy()
        for i, w in enumerate(weights, start=1):
            shifted = np.zeros_like(d)
            shifted[i * step :] = d[: -i * step]
            out = out - w * shifted
        return out

    for _ in range(50 if p and sp else 1):
        old = np.concatenate([phi, sea])
        if p:
            x = filtered(sea, period)
            phi = np.linalg.lstsq(lagged(x, list(range(1, p + 1))), x[rows], rcond=None)[0]
        if sp:
            x = filtered(phi, 1)
            sea = np.linalg.lstsq(lagged(x, [period * i for i in range(1, sp + 1)]), x[rows], rcond=None)[0]
        if np.allclose(old, np.concatenate([phi, sea]), rtol=0, atol=1e-10):
            break
    w = _ar_polynomial(phi, sea, period)
    e = d[rows] - sum((w[j] * d[rows - j - 1] for j in range(len(w))), np.zeros(len(rows)))
    return phi, sea, w, float(e @ e), len(rows)


def _forecast_ar(x: np.ndarray, w: np.ndarray, s2: float, d: int, sd: int, period: int, h: int):
    """Point forecasts and standard errors of the undifferenced series."""
    full = np.concatenate([[1.0], -w])
    for _ in range(d):
        full = np.convolve(full, [1.0, -1.0])
    for _ in range(sd):
        full = np.convolve(full, np.concatenate([[1.0], np.zeros(period - 1), [-1.0]]))
    weights = -full[1:]
    path = list(x)
    psi = [1.0]
    for k in range(h):
        path.append(sum(weights[j] * path[len(path) - 1 - j] for j in range(len(weights))))
        if k:
            psi.append(sum(weights[j] * psi[k - 1 - j] for j in range(min(k, len(weights)))))
    return np.array(path[len(x) :]), np.sqrt(s2 * np.cumsum(np.square(psi)))


def _long_enough(x: np.ndarray, p: int, d: int, sp: int, sd: int, period: int) -> bool:
    """At least one more error than weights after differencing, and some value."""
    return len(x) - d - sd * period - p - sp * period > p + sp and bool(np.isfinite(x).all())


def _with_dates(points: DataFrame, series: DataFrame, key: str, h: int) -> DataFrame:
    at = future_index(series, key, h)
    points = points.withColumnsRenamed({key: "__key", "h": "__h"})
    return at.join(points, F.col(key).eqNullSafe(F.col("__key")) & (F.col("h") == F.col("__h"))).drop("__key", "__h")


def series_numbers(series: DataFrame, key: str) -> DataFrame:
    return series.select(key, "pos", F.col("value").cast("double").alias("value"))


def seasonal_ar_forecast(
    series: DataFrame, key: str, period: int, h: int, p: int = 1, d: int = 1, sp: int = 1, sd: int = 1
) -> DataFrame:
    """Forecast table of an order (p,d,0)(sp,sd,0)[period] autoregression.

    Fitted by conditional least squares on the differenced series, forecast
    recursively and transformed back.  A series without values, or with too few
    steps for one more error than weights, has NULL forecasts.
    """
    kind = series.schema[key].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x = regular_values(pdf)[0]
        if _long_enough(x, p, d, sp, sd, period):
            diffed = _difference(x, d, sd, period)
            phi, sea, w, rss, n = _fit_seasonal_ar(diffed, p, sp, period, p + sp * period)
            point, se = _forecast_ar(x, w, rss / n, d, sd, period, h)
        else:
            point = se = np.full(h, math.nan)
        return pd.DataFrame(
            {
                key: pdf[key].iloc[0], "h": np.arange(1, h + 1), "point": point,
                "lo80": point - Z80 * se, "hi80": point + Z80 * se, "lo95": point - Z95 * se, "hi95": point + Z95 * se,
            }
        )

    schema = f"`{key}` {kind}, h int, point double, lo80 double, hi80 double, lo95 double, hi95 double"
    return _with_dates(series_numbers(series, key).groupBy(key).applyInPandas(solve, schema), series, key, h)


def choose_order(series: DataFrame, key: str, period: int, max_p: int = 2, max_sp: int = 1, d: int = 1, sd: int = 1) -> DataFrame:
    """AIC of every candidate order per series, the least marked ``chosen``.

    All candidates of a series are fitted on the same rows, so their AIC values
    compare.  In a series without values, or too short for the largest of them,
    none has one and none is chosen.
    """
    kind = series.schema[key].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x = regular_values(pdf)[0]
        fine = _long_enough(x, max_p, d, max_sp, sd, period)
        x = _difference(x, d, sd, period) if fine else x
        rows = []
        for p, sp in itertools.product(range(max_p + 1), range(max_sp + 1)):
            if not fine:
                rows.append((p, sp, math.nan))
                continue
            *_, rss, n = _fit_seasonal_ar(x, p, sp, period, max_p + max_sp * period)
            rows.append((p, sp, n * math.log(max(rss, 1e-300) / n) + 2 * (p + sp + 1)))
        out = pd.DataFrame(rows, columns=["p", "sp", "aic"])
        out.insert(0, key, pdf[key].iloc[0])
        out["chosen"] = fine & (out.index == (out["aic"].idxmin() if fine else -1))
        return out

    return series_numbers(series, key).groupBy(key).applyInPandas(
        solve, f"`{key}` {kind}, p int, sp int, aic double, chosen boolean"
    )


def tidy(model: DataFrame, key: str) -> DataFrame:
    """Model parameters as rows; a form without one has none."""
    return model.where("kind = 'parameter' AND value IS NOT NULL").select(key, F.col("name").alias("term"), F.col("value").alias("estimate"))


def augment(model: DataFrame, key: str) -> DataFrame:
    """Actual, fitted and residual per step."""
    wide = (
        model.where("kind = 'state' AND name IN ('actual', 'fitted')")
        .groupBy(key, "pos").pivot("name", ["actual", "fitted"]).agg(F.first("value"))
    )
    return wide.withColumn("residual", F.col("actual") - F.col("fitted"))


def components(model: DataFrame, key: str) -> DataFrame:
    """Observed value, level, slope and season per step in long form."""
    return model.where("kind = 'state' AND name <> 'fitted'").select(
        key, "pos", F.when(F.col("name") == "actual", "observed").otherwise(F.col("name")).alias("component"), "value"
    )


def forecast_table(model: DataFrame, series: DataFrame, key: str, h: int) -> DataFrame:
    """Point forecasts and intervals with their dates."""
    names = ["point", "lo80", "hi80", "lo95", "hi95"]
    wide = (
        model.where("kind = 'forecast'")
        .groupBy(key, F.col("pos").cast("int").alias("h")).pivot("name", names).agg(F.first("value"))
    )
    return _with_dates(wide, series, key, h)


def glance(model: DataFrame, key: str, period: int) -> DataFrame:
    """One row of fit quality per series.

    The log likelihood is -n/2 ln(sum of squared errors), constants dropped;
    MASE scales by the in-sample mean absolute seasonal difference.
    """
    from pyspark.sql.window import Window

    w = Window.partitionBy(key).orderBy("pos")
    a = augment(model, key).withColumns(
        {"naive": F.abs(F.col("actual") - F.lag("actual", period).over(w)), "before": F.lag("residual").over(w)}
    )
    e, pct = F.col("residual"), F.try_divide(F.col("residual"), F.col("actual")) * 100
    middle = F.avg(e).over(Window.partitionBy(key))
    a = a.withColumn("m", middle)
    quality = a.groupBy(key).agg(
        F.avg(e).alias("me"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        F.avg(pct).alias("mpe"), F.avg(F.abs(pct)).alias("mape"),
        F.try_divide(F.avg(F.abs(e)), F.avg("naive")).alias("mase"),
        F.try_divide(F.sum((e - F.col("m")) * (F.col("before") - F.col("m"))), F.sum((e - F.col("m")) * (e - F.col("m")))).alias("acf1"),
    )
    fit = model.where("kind = 'fit'").groupBy(key).pivot("name", ["sigma", "loglik", "aic", "bic"]).agg(F.first("value"))
    quality = quality.withColumnRenamed(key, "__key")
    return fit.join(quality, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def sweep(model: DataFrame, series: DataFrame, key: str, h: int) -> DataFrame:
    """Actual, fitted and forecast stacked under ``series_kind``, with dates and bounds."""
    states = model.where("kind = 'state' AND name IN ('actual', 'fitted')").select(
        key, "pos", F.col("name").alias("series_kind"), "value"
    )
    dated = series.select(F.col(key).alias("__key"), F.col("pos").alias("__pos"), "ts")
    past = states.join(dated, F.col(key).eqNullSafe(F.col("__key")) & (F.col("pos") == F.col("__pos"))).drop("__key", "__pos")
    ahead = forecast_table(model, series, key, h).select(
        key, "pos", F.lit("forecast").alias("series_kind"), F.col("point").alias("value"), "ts", "lo80", "hi80", "lo95", "hi95"
    )
    return past.unionByName(ahead, allowMissingColumns=True)
