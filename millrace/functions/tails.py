"""Tail probabilities for the few numbers of a fitted-model summary (driver side)."""

from __future__ import annotations

import math

import numpy as np


def normal_tail(z: float) -> float:
    """P(Z > z)."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta integral (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|)."""
    if math.isnan(t) or df <= 0:
        return math.nan
    return beta_cdf(df / (df + t * t), df / 2.0, 0.5)


def _beta_fractions(p: np.ndarray, q: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The continued fraction of many arguments; those that have settled are left out of further steps."""
    tiny = 1e-300

    def away(x):
        return np.where(np.abs(x) > tiny, x, tiny)

    c, d = np.ones_like(z), 1.0 / away(1.0 - (p + q) * z / (p + 1.0))
    out, value, at = d.copy(), d.copy(), np.arange(len(z))
    for m in range(1, 500):
        for numerator in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1.0 / away(1.0 + numerator * d)
            c = away(1.0 + numerator / c)
            value = value * d * c
        out[at] = value
        more = np.abs(d * c - 1.0) > 1e-15
        if not more.any():
            break
        c, d, p, q, z, value, at = (x[more] for x in (c, d, p, q, z, value, at))
    return out


def t_two_sided_many(t: np.ndarray, df: float) -> np.ndarray:
    """P(|T| > |t|) of many values at once; NaN stays NaN."""
    t = np.asarray(t, float)
    if df <= 0:
        return np.full(t.shape, math.nan)
    a, b = df / 2.0, 0.5
    x = df / (df + t * t)
    swap = x >= (a + 1.0) / (a + b + 2.0)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
    with np.errstate(all="ignore"):
        # 1 - x is t^2 / (df + t^2), which loses no digits for small t
        z = np.where(swap, t * t / (df + t * t), z)
        front = np.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + p * np.log(z) + q * np.log1p(-z)) / p
        value = np.ones_like(t)
        going = np.flatnonzero(np.isfinite(t) & (t != 0))
        value[going] = _beta_fractions(p[going], q[going], z[going])
        out = np.where(swap, 1.0 - front * value, front * value)
    return np.where(np.isinf(t), 0.0, np.where(t == 0, 1.0, out))


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    if f <= 0:
        return 1.0
    return beta_cdf(d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0)


def gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma."""
    if x <= 0.0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return 1.0 - total * scale
    tiny = 1e-300
    b = x + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h * scale


def chi2_tail(x: float, df: float) -> float:
    """P(chi-square > x)."""
    return gamma_tail(df / 2.0, x / 2.0)


def t_quantile(p: float, df: float) -> float:
    """Upper quantile by bisection: P(T <= q) = p for p >= 0.5."""
    lo, hi = 0.0, 1.0
    while 1.0 - t_two_sided(hi, df) / 2.0 < p:
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if 1.0 - t_two_sided(mid, df) / 2.0 < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


def normal_quantile(p: float) -> float:
    """Standard normal quantile by bisection."""
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if 1.0 - normal_tail(mid) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


# Rational approximations of the normal quantile (Wichura, AS 241), highest power first.
_MIDDLE = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
     13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
    (5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
     5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0),
)
_OUTER = (
    (7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258,
     3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459,
     0.68976733498510000455, 1.6763848301838038494, 2.05319162663775882187, 1.0),
)
_FAR = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093,
     0.29656057182850489123, 1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
    (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4,
     0.0148753612908506148525, 0.13692988092273580531, 0.59983220655588793769, 1.0),
)


def normal_quantiles(p: np.ndarray) -> np.ndarray:
    """Normal quantiles of many probabilities at once."""
    p = np.asarray(p, float)
    q = p - 0.5
    tail = np.sqrt(-np.log(np.clip(np.minimum(p, 1 - p), 1e-300, 0.5)))

    def ratio(parts, x):
        return np.polyval(parts[0], x) / np.polyval(parts[1], x)

    outer = np.sign(q) * np.where(tail <= 5, ratio(_OUTER, tail - 1.6), ratio(_FAR, tail - 5))
    return np.where(np.abs(q) <= 0.425, q * ratio(_MIDDLE, 0.180625 - q * q), outer)
