"""Least squares from one distributed cross-product aggregate.

:func:`gram` reduces the rows to sums of (centred) products, a p x p matrix.
Every model on a subset of the columns, every nested test and every
information criterion then follows on the driver from that small matrix, with
no further scan.  :func:`grouped_grams` has such a matrix per group as rows; models
of any number of groups, and of cross-validation folds, are solved where those
rows lie.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import tails
from millrace.operators.ordering import positions, quantiles, ranged, scan_ranges
from millrace.session import stable

#: up to so many columns one expression per product is faster than matrix products in Python
MAX_JVM_COLUMNS = 16
#: levels of a block, of which pairs meet in :func:`pairwise_t`
LEVELS_PER_BLOCK = 512


@dataclass
class Gram:
    """Sums about a common centre; the last column is the response."""

    names: list[str]
    response: str
    exprs: dict[str, Column]
    n: float
    centre: np.ndarray
    sums: np.ndarray
    cross: np.ndarray

    def __sub__(self, other: Gram) -> Gram:
        return Gram(
            self.names, self.response, self.exprs, self.n - other.n, self.centre,
            self.sums - other.sums, self.cross - other.cross,
        )

    @property
    def means(self) -> np.ndarray:
        return self.centre + self.sums / self.n

    def about_mean(self) -> np.ndarray:
        return self.cross - np.outer(self.sums, self.sums) / self.n

    def about_zero(self) -> np.ndarray:
        c, s = self.centre, self.sums
        return self.cross + np.outer(c, s) + np.outer(s, c) + self.n * np.outer(c, c)


def _predictors(x: Sequence[str] | dict[str, Column]) -> dict[str, Column]:
    return dict(x) if isinstance(x, dict) else {c: F.col(c) for c in x}


def _numbers(df: DataFrame, y: str, exprs: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """Keys as ``g0`` .., predictors and response as ``x0`` .., of the complete rows."""
    cols = [e.cast("double").alias(f"x{i}") for i, e in enumerate([*exprs.values(), F.col(y)])]
    data = df.select(*[F.col(k).alias(f"g{i}") for i, k in enumerate(keys)], *cols)
    return data.where(~F.greatest(*[F.isnan(f"x{i}") | F.col(f"x{i}").isNull() for i in range(len(cols))], F.lit(False)))


def gram(df: DataFrame, y: str, x: Sequence[str] | dict[str, Column]) -> Gram:
    """Cross products of the complete rows.

    Products are taken about the means, which keeps large offsets (years, epoch
    seconds) from cancelling.  Few columns take one scan, which moves the means
    along; for many a first scan finds them.
    """
    exprs = _predictors(x)
    names = list(exprs)
    p = len(names) + 1
    data = _numbers(df, y, exprs, [])
    if p <= MAX_JVM_COLUMNS // 2:
        n = F.count(F.lit(1))
        upper = [F.covar_pop(f"x{i}", f"x{j}") * n for i in range(p) for j in range(i, p)]
        row = data.agg(n.alias("n"), F.array(*[F.avg(f"x{i}") for i in range(p)]).alias("means"), F.array(*upper).alias("upper")).first()
        if not row["n"]:
            raise ValueError("no complete rows")
        return Gram(names, y, exprs, *_unpacked(row["n"], np.array(row["means"]), np.zeros(p), np.array(row["upper"])))
    first = data.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(p)]).first()
    centre = np.array([first[i] if first[i] is not None else 0.0 for i in range(p)])
    row = (_cross_columns if p <= MAX_JVM_COLUMNS else _cross_batches)(data, centre).first()
    if row is None or not row["n"]:
        raise ValueError("no complete rows")
    return Gram(names, y, exprs, *_unpacked(row["n"], centre, np.array(row["sums"]), np.array(row["upper"])))


def grouped_grams(df: DataFrame, y: str, x: Sequence[str] | dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """``g0`` .. (the keys), ``n``, ``means`` and ``upper`` (the triangle of products about the group's own means) per group."""
    exprs = _predictors(x)
    data = _numbers(df, y, exprs, keys)
    names = [f"g{i}" for i in range(len(keys))]
    p = len(exprs) + 1
    if p > MAX_JVM_COLUMNS // 2:
        return _moment_batches(data, p, names)
    n = F.count(F.lit(1))
    upper = F.array(*[F.covar_pop(f"x{i}", f"x{j}") * n for i in range(p) for j in range(i, p)])
    return data.groupBy(*names).agg(n.alias("n"), F.array(*[F.avg(f"x{i}") for i in range(p)]).alias("means"), upper.alias("upper"))


def _joined(a: tuple, b: tuple) -> tuple:
    """Count, means and products about the means of two sets together."""
    n = a[0] + b[0]
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


#: groups that a task adds up before it hands them on
HELD_GROUPS = 4_096


def _moment_batches(data: DataFrame, p: int, keys: list[str]) -> DataFrame:
    """The same for many columns: one matrix product per Arrow batch and group, joined in the task and then per group."""
    columns = [f"x{i}" for i in range(p)]
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in data.schema if f.name in keys]
    at = np.triu_indices(p)
    schema = ", ".join([*kinds, "n long", "means array<double>", "upper array<double>"])

    def rows(held):
        heads = {k: [g[i] for g in held] for i, k in enumerate(keys)}
        body = {"n": [m[0] for m in held.values()], "means": [m[1] for m in held.values()], "upper": [m[2][at] for m in held.values()]}
        return pd.DataFrame(heads | body)

    def partial(batches):
        held: dict = {}
        for pdf in batches:
            for g, part in pdf.groupby(keys, sort=False, dropna=False):
                z = part[columns].to_numpy()
                mean = z.mean(axis=0)
                g = tuple(None if v != v else v for v in (g if isinstance(g, tuple) else (g,)))
                now = len(z), mean, (z - mean).T @ (z - mean)
                held[g] = _joined(held[g], now) if g in held else now
            if len(held) > HELD_GROUPS:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)

    def joined(pdf):
        total = None
        for n, mean, upper in zip(pdf["n"], pdf["means"], pdf["upper"]):
            now = _unpacked(n, np.asarray(mean), np.zeros(p), np.asarray(upper))
            now = now[0], now[1], now[3]
            total = now if total is None else _joined(total, now)
        head = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame(head | {"n": [int(total[0])], "means": [total[1]], "upper": [total[2][at]]})

    return data.mapInPandas(partial, schema).groupBy(*keys).applyInPandas(joined, schema)


def _about(names: list[str], response: str, n: float, means, upper, centre: np.ndarray | None = None) -> Gram:
    """The sums of a row of :func:`grouped_grams` about its means, or about ``centre``."""
    means = np.asarray(means, float)
    n, _, sums, cross = _unpacked(n, means, np.zeros(len(means)), np.asarray(upper, float))
    if centre is None:
        return Gram(names, response, {}, n, means, sums, cross)
    d = means - centre
    return Gram(names, response, {}, n, centre, n * d, cross + n * np.outer(d, d))


def _unpacked(n: float, centre: np.ndarray, sums: np.ndarray, upper: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    p = len(centre)
    cross = np.zeros((p, p))
    i, j = np.triu_indices(p)
    cross[i, j] = cross[j, i] = upper
    return float(n), centre, np.asarray(sums, float), cross


def _cross_columns(data: DataFrame, centre: np.ndarray) -> DataFrame:
    p = len(centre)
    d = [F.col(f"x{i}") - F.lit(float(centre[i])) for i in range(p)]
    sums = F.array(*[F.sum(x) for x in d]).alias("sums")
    upper = F.array(*[F.sum(d[i] * d[j]) for i in range(p) for j in range(i, p)]).alias("upper")
    return data.agg(F.count(F.lit(1)).alias("n"), sums, upper)


def _cross_batches(data: DataFrame, centre: np.ndarray) -> DataFrame:
    """The same sums for many columns: one matrix product per Arrow batch."""
    p = len(centre)
    at = np.triu_indices(p + 1)

    def partial(batches):
        total = 0.0
        for pdf in batches:
            z = np.column_stack([np.ones(len(pdf)), pdf.to_numpy() - centre])
            total = total + z.T @ z
        if not np.isscalar(total):
            yield pd.DataFrame({"i": range(len(at[0])), "v": total[at]})

    summed = data.mapInPandas(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    m = summed.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda r: r["v"]).alias("m")).where("size(m) > 0")
    size = (p + 1) * (p + 2) // 2
    return m.select(F.col("m")[0].cast("long").alias("n"), F.slice("m", 2, p).alias("sums"), F.slice("m", p + 2, size - p - 1).alias("upper"))


def _per_group(rows: DataFrame, names: Sequence[str], solve, out: list[tuple[str, pa.DataType, str]]) -> DataFrame:
    """``solve(n, means, upper)`` for every row of :func:`grouped_grams`: tuples of ``out``, behind the group's keys."""
    keys = [c for c in rows.columns if c.startswith("g")]
    kinds = [f"`{n}` {rows.schema[k].dataType.simpleString()}" for k, n in zip(keys, names, strict=True)]

    def run(batches):
        for batch in batches:
            found = [solve(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("n", "means", "upper")))]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            flat = [r for f in found for r in f]
            values = [pa.array([_missing(r[i]) for r in flat], kind) for i, (_, kind, _) in enumerate(out)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(owner) for k in keys], *values], [*names, *[o[0] for o in out]])

    return rows.select(*keys, "n", "means", "upper").mapInArrow(run, ", ".join([*kinds, *[f"{o[0]} {o[2]}" for o in out]]))


def _missing(v):
    return None if isinstance(v, float) and math.isnan(v) else v


_TERM = [("term", pa.string(), "string"), *[(c, pa.float64(), "double") for c in ("estimate", "std_error", "t", "p", "n", "df", "sigma", "r2")]]


def ols_by_group(df: DataFrame, y: str, x: Sequence[str] | dict[str, Column], keys: Sequence[str], intercept: bool = True) -> DataFrame:
    """A least-squares model per group, solved where the group's sums lie: a row per group and term.

    Columns: the keys, ``term``, ``estimate``, ``std_error``, ``t``, ``p``, and
    the model's ``n``, ``df``, ``sigma`` and ``r2``.  A term explained by earlier ones in its
    group has NULL for its numbers; tests are NULL without degrees of freedom.
    Groups without a complete row have no model.  A NULL key is a group.
    """
    exprs = _predictors(x)
    names = list(exprs)
    rows = grouped_grams(df, y, x, keys)

    def solve(n, means, upper):
        fit = ols(_about(names, y, n, means, upper), intercept=intercept)
        whole = float(n), float(fit.df_resid), math.sqrt(fit.sigma2) if fit.df_resid > 0 else math.nan, float(fit.r2)
        out = []
        for (term, b), se in zip(fit.estimates().items(), map(float, fit.std_errors), strict=True):
            t = b / se if se > 0 else math.nan
            out.append((term, b, se, t, tails.t_two_sided(t, fit.df_resid), *whole))
        return out + [(a, math.nan, math.nan, math.nan, math.nan, *whole) for a in fit.aliased]

    return _per_group(rows, list(keys), solve, _TERM)


@dataclass
class Fit:
    """An estimated linear model; ``aliased`` lists columns dropped as collinear."""

    names: list[str]
    coef: np.ndarray
    cov_unscaled: np.ndarray
    intercept: bool
    n: float
    rss: float
    tss: float
    means: np.ndarray
    inner: np.ndarray
    exprs: dict[str, Column]
    response: str
    aliased: list[str] = field(default_factory=list)

    @property
    def rank(self) -> int:
        return len(self.coef)

    @property
    def df_resid(self) -> float:
        return self.n - self.rank

    @property
    def sigma2(self) -> float:
        return self.rss / self.df_resid if self.df_resid > 0 else math.nan

    @property
    def std_errors(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.cov_unscaled) * self.sigma2, 0.0))

    @property
    def aic(self) -> float:
        """n ln(RSS/n) + 2 edf."""
        return self.n * math.log(max(self.rss, 1e-300) / self.n) + 2 * self.rank

    @property
    def r2(self) -> float:
        return 1.0 - self.rss / self.tss if self.tss else math.nan

    def estimates(self) -> dict[str, float]:
        terms = (["(Intercept)"] if self.intercept else []) + self.names
        return dict(zip(terms, map(float, self.coef), strict=True))

    def predict(self) -> Column:
        """Linear predictor as a column expression."""
        est = self.estimates()
        out = F.lit(est.get("(Intercept)", 0.0))
        for n in self.names:
            out = out + F.lit(est[n]) * self.exprs[n].cast("double")
        return out

    def table(self, spark: SparkSession, level: float = 0.95) -> DataFrame:
        """One row per term: estimate, standard error, t, p and interval."""
        q = tails.t_quantile(0.5 + level / 2.0, self.df_resid)
        rows = []
        for (term, b), se in zip(self.estimates().items(), map(float, self.std_errors), strict=True):
            t = b / se if se else math.nan
            rows.append((term, b, se, t, tails.t_two_sided(t, self.df_resid), b - q * se, b + q * se))
        rows += [(a, None, None, None, None, None, None) for a in self.aliased]
        return spark.createDataFrame(
            rows, "term string, estimate double, std_error double, t double, p double, lo double, hi double"
        )

    def summary(self, spark: SparkSession) -> DataFrame:
        """One row: R2, adjusted R2, F test, residual standard error, AIC."""
        k = self.rank - (1 if self.intercept else 0)
        adj = 1.0 - (1.0 - self.r2) * (self.n - (1 if self.intercept else 0)) / self.df_resid
        f = (self.tss - self.rss) / k / self.sigma2 if k else math.nan
        row = (
            self.n, self.df_resid, math.sqrt(self.sigma2), self.r2, adj, f,
            tails.f_tail(f, k, self.df_resid) if k else math.nan, self.aic,
        )
        return spark.createDataFrame(
            [tuple(map(float, row))],
            "n double, df double, sigma double, r2 double, adj_r2 double, f double, p double, aic double",
        )


def _independent(m: np.ndarray, tolerance: float = 1e-9) -> list[int]:
    """Indices of columns not explained by the ones before them."""
    kept: list[int] = []
    left = m.copy()
    for j in range(len(m)):
        if m[j, j] > 0 and left[j, j] > tolerance * m[j, j]:
            kept.append(j)
            left = left - np.outer(left[:, j], left[j, :]) / left[j, j]
    return kept


def ols(g: Gram, subset: Sequence[str] | None = None, intercept: bool = True) -> Fit:
    """Least squares on a subset of the gathered columns."""
    wanted = list(subset) if subset is not None else g.names
    idx = [g.names.index(c) for c in wanted]
    last = len(g.names)
    m = g.about_mean() if intercept else g.about_zero()
    kept = [idx[k] for k in _independent(m[np.ix_(idx, idx)])]
    names = [g.names[k] for k in kept]
    a, b, yy = m[np.ix_(kept, kept)], m[kept, last], m[last, last]
    scale = np.sqrt(np.diag(a))
    inner = np.linalg.inv(a / np.outer(scale, scale)) / np.outer(scale, scale) if kept else np.zeros((0, 0))
    slope = inner @ b
    rss = max(float(yy - slope @ b), 0.0)
    coef, cov = slope, inner
    if intercept:
        mean = g.means[kept]
        coef = np.concatenate([[g.means[last] - mean @ slope], slope])
        corner = 1.0 / g.n + mean @ inner @ mean
        side = -(inner @ mean)
        cov = np.block([[np.array([[corner]]), side[None, :]], [side[:, None], inner]])
    return Fit(
        names, coef, cov, intercept, g.n, rss, float(yy), g.means[kept], inner, g.exprs, g.response,
        [c for c in wanted if c not in names],
    )


def step_backward(g: Gram, terms: dict[str, list[str]], intercept: bool = True) -> tuple[Fit, list[tuple[str, float]]]:
    """Drop the term that lowers AIC most until none does; returns fit and path."""
    current = dict(terms)

    def fit_of(ts):
        return ols(g, [c for cols in ts.values() for c in cols], intercept)

    best = fit_of(current)
    path = [("<none>", best.aic)]
    while current:
        trials = {t: fit_of({k: v for k, v in current.items() if k != t}) for t in current}
        term = min(trials, key=lambda t: trials[t].aic)
        if trials[term].aic >= best.aic:
            break
        best = trials[term]
        del current[term]
        path.append((term, best.aic))
    return best, path


def path_table(spark: SparkSession, path: list[tuple[str, float]]) -> DataFrame:
    rows = [(i, t, float(a)) for i, (t, a) in enumerate(path)]
    return spark.createDataFrame(rows, "step int, dropped string, aic double")


def anova(spark: SparkSession, fits: Sequence[Fit]) -> DataFrame:
    """F tests of nested models in the given order, against the largest one."""
    full = min(fits, key=lambda f: f.df_resid)
    rows = []
    for i, f in enumerate(fits):
        stat = p = ss = ddf = None
        if i:
            ss = fits[i - 1].rss - f.rss
            ddf = fits[i - 1].df_resid - f.df_resid
            if ddf:
                stat = ss / ddf / full.sigma2
                p = tails.f_tail(stat, abs(ddf), full.df_resid)
        rows.append((i + 1, f.df_resid, f.rss, ddf, ss, stat, p))
    return spark.createDataFrame(
        rows, "model int, df double, rss double, ddf double, ss double, f double, p double"
    )


def score(df: DataFrame, fit: Fit, name: str = "prediction") -> DataFrame:
    """Add the linear predictor, keeping the source columns."""
    return df.withColumn(name, fit.predict())


def influence(df: DataFrame, fit: Fit) -> DataFrame:
    """Fitted value, residual, hat value, standardised residual, Cook's distance, DFFITS."""
    shift = fit.means if fit.intercept else np.zeros(len(fit.names))
    d = [fit.exprs[n].cast("double") - F.lit(float(s)) for n, s in zip(fit.names, shift, strict=True)]
    hat = F.lit(1.0 / fit.n if fit.intercept else 0.0)
    for i in range(len(d)):
        for j in range(i, len(d)):
            hat = hat + F.lit(float(fit.inner[i, j]) * (1 if i == j else 2)) * d[i] * d[j]
    out = df.withColumns({"fitted": fit.predict(), "hat": hat})
    out = out.withColumn("residual", F.col(fit.response).cast("double") - F.col("fitted"))
    free = F.lit(1.0) - F.col("hat")
    out = out.withColumn("std_residual", F.try_divide(F.col("residual"), F.sqrt(F.lit(fit.sigma2) * free)))
    student = F.col("std_residual") * F.sqrt(
        F.lit(fit.df_resid - 1) / (F.lit(fit.df_resid) - F.col("std_residual") * F.col("std_residual"))
    )
    return out.withColumn(
        "cook", F.col("std_residual") * F.col("std_residual") * F.try_divide(F.col("hat"), free) / fit.rank
    ).withColumn("dffits", student * F.sqrt(F.try_divide(F.col("hat"), free)))


def residual_quantiles(df: DataFrame, fit: Fit) -> DataFrame:
    """Five-number summary of the residuals."""
    res = df.select((F.col(fit.response).cast("double") - fit.predict()).alias("r"))
    return quantiles(res, "r", {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})


def qq_points(df: DataFrame, value: str, key: str) -> DataFrame:
    """Sample values against normal quantiles at (i - 1/2) / n."""
    placed = positions(df.select(key, value).where(F.col(value).isNotNull()), [value, key], name="i")

    @F.pandas_udf("double")
    def normal_quantile(p: pd.Series) -> pd.Series:
        return pd.Series(tails.normal_quantiles(p.to_numpy()))

    prob = (F.col("i") - 0.5) / F.col("i_total")
    return placed.select(key, F.col(value).alias("sample"), prob.alias("p"), normal_quantile(prob).alias("theoretical"))


def cross_validate(df: DataFrame, y: str, x, fold: str) -> DataFrame:
    """``fold``, ``n``, ``rmse``, ``r2`` of models fitted without that fold, from one scan.

    Each model follows from the sums of all rows less those of its fold, and is
    solved and judged where the fold's sums lie, so there may be as many folds as
    rows.  A model without a row to learn from has NULL results, and so has the
    R2 of a fold whose response does not vary.
    """
    exprs = _predictors(x)
    names = list(exprs)
    parts = stable(grouped_grams(df, y, x, [fold]))
    p = len(names) + 1
    # the folds' sums together, about the means of all rows
    weighed = parts.agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col("means")[i]).alias(f"m{i}") for i in range(p)]).first()
    centre = np.array(weighed[1:], float) / weighed["n"] if weighed["n"] else np.zeros(p)
    at = list(zip(*np.triu_indices(p)))
    d = [F.col("means")[i] - F.lit(float(centre[i])) for i in range(p)]
    cross = parts.agg(*[F.sum(F.col("upper")[k] + F.col("n") * d[i] * d[j]).alias(f"c{k}") for k, (i, j) in enumerate(at)]).first()
    whole = _about(names, y, weighed["n"] or 0, centre, np.array([v or 0.0 for v in cross], float))

    def solve(n, means, upper):
        held = _about(names, y, n, means, upper, centre)
        rest = whole - held
        if rest.n < 1:
            return [(float(n), math.nan, math.nan)]
        fit = ols(rest)
        last = len(names)
        idx = [names.index(c) for c in fit.names]
        # about the common centre, so that far offsets do not cancel
        slope, shift = fit.coef[1:], fit.coef[0] + fit.coef[1:] @ centre[idx] - centre[last]
        w = np.concatenate([[-shift], -slope, [1.0]])
        m = np.zeros((len(idx) + 2, len(idx) + 2))
        m[0, 0] = n
        m[0, 1:] = m[1:, 0] = held.sums[[*idx, last]]
        m[1:, 1:] = held.cross[np.ix_([*idx, last], [*idx, last])]
        sse = float(max(w @ m @ w, 0.0))
        tss = float(held.about_mean()[last, last])
        return [(float(n), math.sqrt(sse / n), 1.0 - sse / tss if tss > 0 else math.nan)]

    out = [(c, pa.float64(), "double") for c in ("n", "rmse", "r2")]
    return _per_group(parts, [fold], solve, out)


def regression_report(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """RMSE, MSE, MAE, R2 and row count over the rows with both numbers, one aggregate."""
    e = F.col(label) - F.col(prediction)
    judged = F.when(e.isNotNull(), F.col(label))
    return df.groupBy(*keys).agg(
        F.count(e).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.avg(e * e), F.var_pop(judged))).alias("r2"),
    )


def fitted_lines(df: DataFrame, y: str, x: str, keys: Sequence[str]) -> DataFrame:
    """Slope and intercept per group."""
    y, x = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def _level_blocks(levels: DataFrame, k: int) -> DataFrame:
    """Pairs of blocks of numbered levels (arrays ``a_i``, ``a_g``, ``a_n``, ``a_m``, and ``b_``), each once, dealt out evenly."""
    parts_of = ("i", "g", "n", "m")
    block = F.floor((F.col("i") - 1) / LEVELS_PER_BLOCK)
    row = F.struct("i", "g", F.col("n").cast("double").alias("n"), F.col("m").cast("double").alias("m"))
    blocks = stable(levels.groupBy(block.alias("block")).agg(F.collect_list(row).alias("r")))
    count = -(-k // LEVELS_PER_BLOCK)
    cells = max(count * (count + 1) // 2, 1)
    cores = levels.sparkSession.sparkContext.defaultParallelism
    parts = min(cells, max(4 * cores, cells // 32))
    # numbers alone are paired and dealt out first: an exploded side looks as small as before, and its levels would be broadcast
    pairs = blocks.select(F.col("block").alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("b")).repartition(parts, "a", "b")
    a = blocks.select(F.col("block").alias("a"), *[F.col(f"r.{c}").alias(f"a_{c}") for c in parts_of])
    b = blocks.select(F.col("block").alias("b"), *[F.col(f"r.{c}").alias(f"b_{c}") for c in parts_of])
    return pairs.join(a, "a").join(b, "b").repartition(parts, "a", "b").drop("a", "b")


def _block_pairs(batches, s2: float | None):
    """Per some levels of a block: their level names, those they meet, places of both in a pair, t, and where it is missing."""
    for batch in batches:
        for r in range(batch.num_rows):
            ai, ag, an, am, bi, bg, bn, bm = (batch.column(c)[r].values for c in ("a_i", "a_g", "a_n", "a_m", "b_i", "b_g", "b_n", "b_m"))
            ai, an, am, bi, bn, bm = (x.to_numpy(zero_copy_only=False) for x in (ai, an, am, bi, bn, bm))
            for at in range(0, len(ai), 128):
                one, two = np.nonzero(ai[at : at + 128, None] > bi[None, :])
                one += at
                with np.errstate(all="ignore"):
                    scale = np.sqrt((s2 or 0.0) * (1.0 / an[one] + 1.0 / bn[two]))
                    missing = scale == 0
                    t = np.where(missing, math.nan, (am[one] - bm[two]) / scale)
                yield ag, bg, one, two, t, missing


def _sure_bound(cells: DataFrame, s2: float | None, spare: int, pairs: int) -> float:
    """A bound of |t| below which Holm's adjustment is sure to be 1; zero if there is none.

    With N pairs at or above the bound, the next one in the order of p is
    multiplied by ``pairs - N`` at least; where that makes 1, all after it have 1.
    """
    edges = np.concatenate([[0.0], 1e-2 * 1.01 ** np.arange(2400)])

    def count(batches):
        total = np.zeros(len(edges), np.int64)
        for *_, t, _ in _block_pairs(batches, s2):
            t = np.abs(t[~np.isnan(t)])
            total += np.bincount(np.searchsorted(edges, t, side="right") - 1, minlength=len(edges))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["edge", "c"])

    above = np.zeros(len(edges))
    for r in cells.mapInArrow(count, "edge int, c long").groupBy("edge").agg(F.sum("c").alias("c")).collect():
        above[r["edge"]] = r["c"]
    above = above[::-1].cumsum()[::-1]
    sure = np.flatnonzero((pairs - above) * tails.t_two_sided_many(edges, spare) >= 1.0 + 1e-6)
    return float(edges[sure[-1]]) if len(sure) else 0.0


def pairwise_t(df: DataFrame, value: str, group: str) -> DataFrame:
    """t tests between all pairs of group means, pooled SD, Holm adjusted.

    One aggregate gives n, mean and variance per level.  Levels are numbered
    and meet in pairs of blocks, so the levels may be any number; the pairs are
    still all made.  A count of |t| gives a bound below which the adjustment is
    1 whatever the order; only pairs above it are sorted, and the running
    maximum of the adjustment goes over ranges of their p.  Without degrees of
    freedom p is NULL.
    """
    moments = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(F.col(group).cast("string").alias("g")).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v")
    )
    levels = stable(positions(moments, ["g"], name="i"))
    free = F.sum(F.col("n") - 1)
    pool = levels.agg(free.alias("df"), F.try_divide(F.sum((F.col("n") - 1) * F.coalesce("v", F.lit(0.0))), free).alias("s2"), F.count(F.lit(1)).alias("k")).first()
    spare, s2, k = pool["df"] or 0, pool["s2"], pool["k"]
    count = k * (k - 1) // 2
    cells = _level_blocks(levels, k)
    bound = _sure_bound(cells, s2, spare, count)

    def tested(least: bool):
        def run(batches):
            for ag, bg, one, two, t, missing in _block_pairs(batches, s2):
                mine = (np.abs(t) >= bound) == least
                one, two, t, missing = one[mine], two[mine], t[mine], missing[mine]
                if len(t):
                    p = tails.t_two_sided_many(t, spare)
                    columns = [ag.take(pa.array(one)), bg.take(pa.array(two)), pa.array(t, mask=missing), pa.array(p, mask=np.isnan(p))]
                    yield pa.RecordBatch.from_arrays(columns, names=["level_a", "level_b", "t", "p"])

        return cells.mapInArrow(run, "level_a string, level_b string, t double, p double")

    order = [F.asc_nulls_last("p"), "level_a", "level_b"]
    placed = positions(tested(True), order, name="at")
    scaled = F.least(F.lit(1.0), F.col("p") * (count - F.col("at") + 1))
    top = scan_ranges(ranged(placed.withColumn("scaled", scaled), [], ["at"]), [], ["at"], maxima={"p_holm": "scaled"})
    rest = tested(False).withColumn("p_holm", F.when(F.col("p").isNotNull(), 1.0))
    return top.select("level_a", "level_b", "t", "p", F.when(F.col("p").isNotNull(), F.col("p_holm")).alias("p_holm")).unionByName(rest)


def correlation_test(df: DataFrame, x: str, y: str, level: float = 0.95) -> DataFrame:
    """Pearson r with t, p and the Fisher interval, from one aggregate.

    Without a spread in both columns r and all else is NULL; t and p need
    three rows, the interval four.  A perfect correlation has an infinite t and p of zero.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    n, together, sx, sy = both.agg(F.count(F.lit(1)), F.covar_pop(a, b), F.stddev_pop(a), F.stddev_pop(b)).first()
    r = t = p = lo = hi = None
    if n and sx > 0 and sy > 0:
        r = max(-1.0, min(1.0, together / (sx * sy)))
        if n > 2:
            t = r * math.sqrt((n - 2) / (1.0 - r * r)) if abs(r) < 1 else math.copysign(math.inf, r)
            p = tails.t_two_sided(t, n - 2) if math.isfinite(t) else 0.0
        if n > 3:
            half = tails.normal_quantile(0.5 + level / 2.0) / math.sqrt(n - 3)
            lo, hi = (math.tanh(math.atanh(r) - half), math.tanh(math.atanh(r) + half)) if abs(r) < 1 else (r, r)
    return df.sparkSession.createDataFrame([(n, r, t, p, lo, hi)], "n long, r double, t double, p double, lo double, hi double")
