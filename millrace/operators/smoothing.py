"""Exponential smoothing in every form of error, trend and season, with forecasts.

A form is named by error (A additive, M multiplicative), trend (N none, A
additive, Ad damped) and season (N none, A, M): ``AAA``, ``MAdM``.  Error forms
share their recursions; they differ in the likelihood and in the spread of forecasts.

Input is a frame of :func:`millrace.operators.timeseries.regular_series`; one
grouped-map call handles one series, whose length is bounded by the calendar.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.forecasting import Z80, Z95, regular_values, series_numbers

FORMS = [e + t + s for e in "AM" for t in ("N", "A", "Ad") for s in "NAM"]
#: fewest known values of a form without a season; a season needs two periods
FEWEST = 4
#: values a weight can take on one axis of the grid, and how often the grid is refined
AXIS, REFINED = 7, 3
#: paths that give the intervals of forms without a formula, and what they reach
PATHS = 4_000
REACH = {"lo80": 10.0, "hi80": 90.0, "lo95": 2.5, "hi95": 97.5}
WEIGHTS = ("alpha", "beta", "gamma", "phi")


def parts(form: str) -> tuple[str, str, str]:
    """Error, trend and season of a form."""
    if form not in FORMS:
        raise ValueError(f"no form of exponential smoothing: {form}")
    return form[0], form[1:-1], form[-1]


def used(form: str) -> np.ndarray:
    """Which of alpha, beta, gamma and phi the form has."""
    _, trend, season = parts(form)
    return np.array([True, trend != "N", season != "N", trend == "Ad"])


def n_parameters(form: str, period: int) -> int:
    """Weights, first states and the variance."""
    _, trend, season = parts(form)
    return 3 + 2 * (trend != "N") + (trend == "Ad") + (period if season != "N" else 0)


def fits(x: np.ndarray, form: str, period: int) -> bool:
    """Whether a series is long enough for a form, and above zero where the form multiplies."""
    return len(x) >= (max(FEWEST, 2 * period) if form.endswith(("AA", "NA", "dA", "M")) else FEWEST) and ("M" not in form or x.min() > 0)


def first_states(x: np.ndarray, form: str, period: int) -> tuple[float, float, np.ndarray]:
    """Level and slope before the first step, from the means of the first two periods (halves, if shorter), and the season's figure."""
    _, trend, season = parts(form)
    width = min(period, len(x) // 2)
    first, second = x[:width].mean(), x[width : 2 * width].mean()
    step = (second - first) / width if trend != "N" else 0.0
    line = first + (np.arange(width) - (width - 1) / 2) * step
    if season == "N":
        figure = np.zeros(period)
    elif season == "A":
        figure = x[:period] - line
        figure = figure - figure.mean()
    else:
        figure = x[:period] / line
        figure = figure / figure.mean()
    return first - step * (width + 1) / 2, step, figure


def smooth(x: np.ndarray, form: str, period: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One-step forecasts (steps x weight sets), states (steps x 3 x sets) and last season (sets x period).

    ``weights`` has a row per set: alpha, beta, gamma, phi.
    """
    _, trend, season_kind = parts(form)
    alpha, beta, gamma, phi = weights.T
    if trend == "N":
        beta, phi = 0.0 * beta, 0.0 * phi
    elif trend == "A":
        phi = np.ones_like(phi)
    k = len(weights)
    level0, slope0, figure = first_states(x, form, period)
    level, slope, season = np.full(k, level0), np.full(k, slope0), np.tile(figure, (k, 1))
    fitted, states = np.empty((len(x), k)), np.empty((len(x), 3, k))
    for t, value in enumerate(x):
        s, drift = season[:, t % period], phi * slope
        base = level + drift
        point = base * s if season_kind == "M" else base + s
        fitted[t] = point
        e = value - point
        share = e / s if season_kind == "M" else e
        level, slope = base + alpha * share, drift + beta * share
        if season_kind != "N":
            s = s + gamma * (e / base if season_kind == "M" else e)
            season[:, t % period] = s
        states[t] = level, slope, s
    return fitted, states, season


def costs(x: np.ndarray, form: str, fitted: np.ndarray) -> np.ndarray:
    """-2 log likelihood of each column of one-step forecasts, constants dropped."""
    n = len(x)
    e = x[:, None] - fitted
    with np.errstate(all="ignore"):
        if form[0] == "M":
            cost = n * np.log(np.maximum(np.square(e / fitted).sum(axis=0), 1e-300)) + 2 * np.log(np.abs(fitted)).sum(axis=0)
            cost = np.where((fitted > 0).all(axis=0), cost, np.inf)
        else:
            cost = n * np.log(np.maximum(np.square(e).sum(axis=0), 1e-300))
    return np.where(np.isfinite(cost), cost, np.inf)


def fit(x: np.ndarray, form: str, period: int) -> tuple[np.ndarray, float]:
    """Weights of the least cost on a grid refined around the best, and that cost."""
    axes_used = used(form)
    centre, width = np.array([0.5, 0.25, 0.25, 0.89]), np.array([0.49, 0.249, 0.249, 0.09])
    low, high = np.array([1e-4, 1e-4, 1e-4, 0.8]), np.array([0.9999, 0.9999, 0.9999, 0.98])
    best, best_cost = np.where(axes_used, centre, 0.0), math.inf
    for _ in range(REFINED):
        axes = [
            np.clip(np.linspace(c - w, c + w, AXIS), lo, hi) if on else np.zeros(1)
            for c, w, lo, hi, on in zip(centre, width, low, high, axes_used, strict=True)
        ]
        grid = np.array([g for g in itertools.product(*axes) if g[1] <= g[0] and g[2] <= 1 - g[0]] or [best])
        with np.errstate(all="ignore"):
            cost = costs(x, form, smooth(x, form, period, grid)[0])
        at = int(np.argmin(cost))
        if cost[at] < best_cost:
            best, best_cost = grid[at], float(cost[at])
        centre, width = np.where(axes_used, best, centre), width / 3
    return best, best_cost


def aicc(cost: float, form: str, period: int, n: int) -> float:
    k = n_parameters(form, period)
    return cost + 2 * k + (2 * k * (k + 1) / (n - k - 1) if n > k + 1 else math.inf)


def candidates(x: np.ndarray, period: int, forms: Sequence[str]) -> list[tuple[str, np.ndarray, float]]:
    """Form, weights and AICc of every form that the series allows."""
    out = []
    for form in forms:
        if fits(x, form, period):
            weights, cost = fit(x, form, period)
            out.append((form, weights, aicc(cost, form, period, len(x))))
    return out


def spread(form: str, weights: np.ndarray, period: int, h: int) -> np.ndarray | None:
    """Standard deviation of the forecasts over that of the errors; None where there is no formula."""
    error, trend, season = parts(form)
    if error == "M" or season == "M":
        return None
    alpha, beta, gamma, phi = weights
    phi = {"N": 0.0, "A": 1.0, "Ad": phi}[trend]
    j = np.arange(1, h + 1)
    effect = alpha + (beta * np.cumsum(phi**j) if trend != "N" else 0.0) + np.where((j % period == 0) & (season != "N"), gamma, 0.0)
    return np.sqrt(1.0 + np.concatenate([[0.0], np.cumsum(np.square(effect[:-1]))]))


def ahead(form: str, weights: np.ndarray, period: int, n: int, state: np.ndarray, season: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """Continue a series from its last state, a path per row of ``errors`` (relative ones in forms with M)."""
    error, trend, season_kind = parts(form)
    alpha, beta, gamma, phi = weights
    phi = {"N": 0.0, "A": 1.0, "Ad": phi}[trend]
    m, h = errors.shape
    level, slope, figure = np.full(m, state[0]), np.full(m, state[1]), np.tile(season, (m, 1))
    out = np.empty((m, h))
    for j in range(h):
        s = figure[:, (n + j) % period]
        base = level + phi * slope
        point = base * s if season_kind == "M" else base + s
        e = errors[:, j] * (point if error == "M" else 1.0)
        out[:, j] = point + e
        share = e / s if season_kind == "M" else e
        level, slope = base + alpha * share, phi * slope + (beta * share if trend != "N" else 0.0)
        if season_kind != "N":
            figure[:, (n + j) % period] = s + gamma * (e / base if season_kind == "M" else e)
    return out


def forecasts(x: np.ndarray, form: str, weights: np.ndarray, period: int, h: int, sigma: float, seed: int) -> dict[str, np.ndarray]:
    """Point forecasts and bounds: by formula where there is one, else from simulated paths."""
    _, states, season = smooth(x, form, period, weights[None, :])
    last, figure = states[-1, :, 0], season[0]
    point = ahead(form, weights, period, len(x), last, figure, np.zeros((1, h)))[0]
    wide = spread(form, weights, period, h)
    if wide is not None:
        return {"point": point} | {n: point + z * sigma * wide for n, z in (("lo80", -Z80), ("hi80", Z80), ("lo95", -Z95), ("hi95", Z95))}
    with np.errstate(all="ignore"):
        paths = ahead(form, weights, period, len(x), last, figure, np.random.default_rng(seed).normal(0.0, sigma, (PATHS, h)))
    return {"point": point} | {n: np.nanpercentile(paths, q, axis=0) for n, q in REACH.items()}


def _model_rows(x: np.ndarray, pos: np.ndarray, known: int, period: int, h: int, chosen, seed: int) -> list[tuple]:
    """Long rows of one series; without a chosen form everything but the values is missing."""
    nothing = math.nan
    n = len(x)
    if chosen is None:
        fitted, states, weights, figures = np.full(n, nothing), np.full((n, 3), nothing), np.full(4, nothing), None
        rows = [("form", 0, None, nothing)]
        quality = dict.fromkeys(("sigma", "loglik", "aic", "bic"), nothing)
    else:
        form, weights, score = chosen
        out, all_states, _ = smooth(x, form, period, weights[None, :])
        fitted, states = out[:, 0], all_states[:, :, 0]
        k = n_parameters(form, period)
        e = (x - fitted) / (fitted if form[0] == "M" else 1.0)
        sigma = math.sqrt(e @ e / max(n - k + 1, 1))
        loglik = -0.5 * float(costs(x, form, out)[0])
        quality = {"sigma": sigma, "loglik": loglik, "aic": -2 * loglik + 2 * k, "bic": -2 * loglik + math.log(n) * k}
        figures = forecasts(x, form, weights, period, h, sigma, seed)
        weights = np.where(used(form), weights, nothing)
        if form.endswith("N"):
            states = states * [1.0, 1.0, nothing]
        if form[1] == "N":
            states = states * [1.0, nothing, 1.0]
        rows = [("form", 0, form, score)]
    for name, values in (("actual", x), ("fitted", fitted), ("level", states[:, 0]), ("slope", states[:, 1]), ("season", states[:, 2])):
        rows += [("state", int(p), name, float(v)) for p, v in zip(pos, values)]
    rows += [("parameter", 0, name, float(v)) for name, v in zip(WEIGHTS, weights)]
    rows += [("fit", 0, name, v) for name, v in quality.items()]
    for name in ("point", *REACH):
        values = figures[name] if figures is not None else np.full(h, nothing)
        rows += [("forecast", j + 1, name, float(v)) for j, v in enumerate(values)]
    return rows


def ets(
    series: DataFrame, key: str, period: int, h: int, forms: str | Sequence[str] = FORMS, weights: Sequence[float] | None = None
) -> DataFrame:
    """Exponential smoothing of every series in the form of the least AICc among ``forms`` (or the one form given), in long form.

    Columns ``(key, kind, pos, name, value)``: kind ``form`` names the chosen
    form with its AICc, ``state`` holds actual, fitted, level, slope and season
    per step, ``parameter`` the weights, ``fit`` sigma (of relative errors where
    errors multiply) and the likelihood, ``forecast`` the point and interval
    values with ``pos`` the step ahead.  Intervals of forms with M come from
    simulated paths, seeded by the key.  ``weights`` fixes alpha, beta, gamma and phi of a single form.

    A season needs two periods, other forms four values, and forms with M
    values above zero.  A series that allows none of ``forms`` has the same rows
    with NULL in place of everything but its own values; steps without a value
    lie on the line between their neighbours.
    """
    forms = [forms] if isinstance(forms, str) else list(forms)
    for form in forms:
        parts(form)
    if weights is not None and len(forms) != 1:
        raise ValueError("fixed weights need a single form")
    kind = series.schema[key].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x, pos = regular_values(pdf)
        known = int(np.isfinite(pdf["value"].to_numpy(float)).sum())
        name = pdf[key].iloc[0]
        chosen = None
        if known and weights is not None and fits(x, forms[0], period):
            fixed = np.array(weights, float)
            cost = float(costs(x, forms[0], smooth(x, forms[0], period, fixed[None, :])[0])[0])
            chosen = forms[0], fixed, aicc(cost, forms[0], period, len(x))
        elif known >= FEWEST and weights is None:
            found = [c for c in candidates(x, period, forms)]
            chosen = min(found, key=lambda c: c[2]) if found else None
        rows = _model_rows(x, pos, known, period, h, chosen, zlib.crc32(str(name).encode()))
        out = pd.DataFrame(rows, columns=["kind", "pos", "name", "value"])
        out.insert(0, key, name)
        return out

    return series_numbers(series, key).groupBy(key).applyInPandas(
        solve, f"`{key}` {kind}, kind string, pos long, name string, value double"
    )


def choose_form(series: DataFrame, key: str, period: int, forms: Sequence[str] = FORMS) -> DataFrame:
    """AICc of every form that a series allows, the least marked ``chosen``.

    A series that allows none has one row with NULL in ``form`` and ``aicc``.
    """
    kind = series.schema[key].dataType.simpleString()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        x, _ = regular_values(pdf)
        known = int(np.isfinite(pdf["value"].to_numpy(float)).sum())
        rows = [(form, score) for form, _, score in candidates(x, period, forms)] if known >= FEWEST else []
        best = min(range(len(rows)), key=lambda i: rows[i][1]) if rows else None
        out = pd.DataFrame([(*r, i == best) for i, r in enumerate(rows)] or [(None, math.nan, False)], columns=["form", "aicc", "chosen"])
        out["aicc"] = out["aicc"].replace(math.inf, math.nan)
        out.insert(0, key, pdf[key].iloc[0])
        return out

    return series_numbers(series, key).groupBy(key).applyInPandas(solve, f"`{key}` {kind}, form string, aicc double, chosen boolean")
