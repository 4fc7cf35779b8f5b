"""Classifiers and clustering on MLlib, plus linear discriminants from moments."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import sampling
from millrace.operators.evaluation import accuracy, confusion
from millrace.operators.ordering import positions


def features_from_array(df: DataFrame, column: str, name: str = "features") -> DataFrame:
    """ML vector from an array of numbers."""
    return df.withColumn(name, array_to_vector(F.col(column).cast("array<double>")))


def packed(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores at most; nothing is shuffled.

    Fits by steps run a task per partition in every step, and each sends its
    metrics to the driver or its sums to the others.  Joins and unions leave
    hundreds of partitions, which a fit would pay for in every step.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, 1))


class PackedOneVsRest(OneVsRest):
    """One binary model per class, all fitted on the same packed rows."""

    def _fit(self, dataset: DataFrame):
        return super()._fit(packed(dataset))


def tree(label: str = "label", depth: int = 5, seed: int = 1):
    return DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=seed)


def forest(label: str = "label", trees: int = 300, depth: int = 5, seed: int = 1):
    return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)


def boosted(label: str = "label", rounds: int = 10, depth: int = 3, seed: int = 1):
    """One boosted binary model per class."""
    return PackedOneVsRest(classifier=GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed), labelCol=label, parallelism=4)


def linear_svm(label: str = "label", rounds: int = 20):
    """One linear support-vector model per class."""
    return PackedOneVsRest(classifier=LinearSVC(maxIter=rounds), labelCol=label, parallelism=4)


def perceptron(inputs: int, classes: int, hidden: Sequence[int] = (300, 150, 50), label: str = "label", rounds: int = 30, seed: int = 1):
    return MultilayerPerceptronClassifier(labelCol=label, layers=[inputs, *hidden, classes], maxIter=rounds, seed=seed)


def grid_search(train: DataFrame, estimator, grid: dict, label: str = "label", folds: int = 5, seed: int = 1):
    """Cross-validated choice among parameter values; returns the model and a metric table.

    ``grid`` maps parameter names of the estimator to the values to try.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    maps = builder.build()
    scorer = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    rows = packed(train).persist()
    try:
        fitted = CrossValidator(
            estimator=estimator, estimatorParamMaps=maps, evaluator=scorer, numFolds=folds, seed=seed, parallelism=4
        ).fit(rows)
    finally:
        rows.unpersist()
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in m.items()), float(a), float(s))
        for m, a, s in zip(maps, fitted.avgMetrics, fitted.stdMetrics, strict=True)
    ]
    return fitted.bestModel, train.sparkSession.createDataFrame(rows, "parameters string, accuracy double, sd double")


def fold_metrics(df: DataFrame, key: Sequence[str], estimator, label: str = "label", folds: int = 5, seed: int = 1) -> DataFrame:
    """Accuracy and kappa per held-out fold, long ``(resample, metric, value)``.

    The folds are kept while they are in use, fitted four at a time, and each is
    scored once: both metrics follow from its confusion counts.
    """
    tagged = sampling.assign_folds(df, key, folds, seed).persist()

    def judge(k: int) -> list[tuple[int, str, float]]:
        model = estimator.fit(tagged.where(F.col("fold") != k))
        cells = confusion(model.transform(tagged.where(F.col("fold") == k)), label, "prediction")
        counts = {(float(r[0]), float(r[1])): r["n"] for r in cells.collect()}  # classes squared
        n = sum(counts.values())
        if not n:  # no row was hashed to this fold
            return [(k, "accuracy", None), (k, "kappa", None)]
        seen = sum(c for (a, b), c in counts.items() if a == b) / n
        levels = {v for pair in counts for v in pair}
        rows, columns = ({v: sum(c for p, c in counts.items() if p[i] == v) for v in levels} for i in (0, 1))
        chance = sum(rows[v] * columns[v] for v in levels) / (n * n)
        kappa = (seen - chance) / (1 - chance) if chance < 1 else None
        return [(k, "accuracy", seen), (k, "kappa", kappa)]

    try:
        with ThreadPool(min(folds, 4)) as pool:
            rows = [r for part in pool.map(judge, range(folds)) for r in part]
    finally:
        tagged.unpersist()
    return df.sparkSession.createDataFrame(rows, "resample int, metric string, value double")


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Mean and standard deviation of each metric over folds."""
    return metrics.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))


def importance(model, names: Sequence[str], spark) -> DataFrame:
    """Feature importances of a tree model."""
    values = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values, strict=True)], "feature string, importance double")


def permutation_importance(model, df: DataFrame, key: Sequence[str], column: str, label: str, width: int, seed: int = 1) -> DataFrame:
    """Loss of accuracy when one element of the array ``column`` takes another row's value.

    Every row takes the values of the row before it in a hash order of all
    rows; the order comes from a distributed sort, so no column is gathered.
    A perceptron is scored where its rows lie, each row once: changing a feature
    changes the first layer's sums by one product.  Other models see a copy of a
    row per feature.
    """
    order = [sampling.hash_order(key, seed), *[F.col(k) for k in key]]
    placed = positions(df.select(*key, column, label), order, name="__pos")
    before = placed.select((F.col("__pos") % F.col("__pos_total") + 1).alias("__pos"), F.col(column).alias("__o"))
    shuffled = placed.join(before, "__pos").drop("__pos", "__pos_total")
    base = accuracy(model.transform(features_from_array(df, column)), label, "prediction").first()[0]
    if isinstance(model, MultilayerPerceptronClassificationModel):
        return _perceptron_importance(model, shuffled, column, label, width, base)
    each = shuffled.withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    mixed = F.transform(F.col(column), lambda x, i: F.when(i == F.col("feature"), F.get("__o", i)).otherwise(x))
    scored = model.transform(features_from_array(each.withColumn("__m", mixed), "__m"))
    return accuracy(scored, label, "prediction", ["feature"]).select(
        "feature", (F.lit(base) - F.col("accuracy")).alias("importance")
    )


class NetworkScorer:
    """The layers of a fitted perceptron as matrices."""

    def __init__(self, sizes: Sequence[int], weights: np.ndarray):
        self.layers, at = [], 0
        for a, b in zip(sizes[:-1], sizes[1:]):
            self.layers.append((weights[at : at + a * b].reshape(b, a, order="F").T, weights[at + a * b : at + (a + 1) * b]))
            at += (a + 1) * b

    def first(self, x: np.ndarray) -> np.ndarray:
        return x @ self.layers[0][0] + self.layers[0][1]

    def rest(self, z: np.ndarray) -> np.ndarray:
        """Class numbers from the first layer's sums."""
        for w, b in self.layers[1:]:
            z = (1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))) @ w + b
        return z.argmax(1)


def _perceptron_importance(model, shuffled: DataFrame, column: str, label: str, width: int, base: float) -> DataFrame:
    net = NetworkScorer([int(v) for v in model.getLayers()], model.weights.toArray())

    def judge(batches):
        right = np.zeros((width, 2))
        for pdf in batches:
            x, other = (np.vstack(pdf[c].to_list()).astype(float) for c in ("x", "o"))
            y, z = pdf["y"].to_numpy(), net.first(x)
            for j in range(width):
                moved = z + (other[:, j] - x[:, j])[:, None] * net.layers[0][0][j]
                right[j] += (net.rest(moved) == y).sum(), len(y)
        yield pd.DataFrame({"feature": np.arange(width, dtype=np.int32), "hits": right[:, 0], "n": right[:, 1]})

    rows = shuffled.select(F.col(column).cast("array<double>").alias("x"), F.col("__o").cast("array<double>").alias("o"), F.col(label).cast("double").alias("y"))
    counts = rows.mapInPandas(judge, "feature int, hits double, n double").groupBy("feature").agg(F.sum("hits").alias("h"), F.sum("n").alias("n"))
    return counts.select("feature", (F.lit(base) - F.try_divide("h", "n")).alias("importance"))


@dataclass
class Discriminant:
    """Linear score functions, one per class."""

    classes: list
    weights: np.ndarray
    offsets: np.ndarray
    means: np.ndarray
    pooled: np.ndarray


def class_moments(df: DataFrame, column: str, label: str, width: int) -> dict:
    """Count, sum and cross products of an array column per class.

    Every task adds up its Arrow batches as matrix products and emits one
    small matrix per class, which Spark then sums.
    """
    kind = df.schema[label].dataType.simpleString()

    def partial(batches):
        totals: dict = {}
        for pdf in batches:
            for c, part in pdf.groupby(label, sort=False):
                z = np.column_stack([np.ones(len(part)), np.vstack(part[column].to_list()).astype(float)])
                totals[c] = totals.get(c, 0.0) + z.T @ z
        for c, m in totals.items():
            i, j = np.triu_indices(width + 1)
            yield pd.DataFrame({"c": c, "i": i, "j": j, "v": m[i, j]})

    summed = (
        df.where(F.col(label).isNotNull() & F.col(column).isNotNull())
        .select(label, column)
        .mapInPandas(partial, f"c {kind}, i int, j int, v double")
        .groupBy("c", "i", "j")
        .agg(F.sum("v").alias("v"))
    )
    out: dict = {}
    for r in summed.collect():
        m = out.setdefault(r["c"], np.zeros((width + 1, width + 1)))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
    return out


def lda_fit(df: DataFrame, column: str, label: str, width: int) -> Discriminant:
    """Class means and pooled covariance from one pass, solved on the driver."""
    moments = class_moments(df, column, label, width)
    classes = sorted(moments)
    n = np.array([moments[c][0, 0] for c in classes])
    means = np.vstack([moments[c][0, 1:] / moments[c][0, 0] for c in classes])
    within = sum(moments[c][1:, 1:] - np.outer(m, m) * k for c, m, k in zip(classes, means, n, strict=True))
    pooled = within / (n.sum() - len(classes))
    weights = np.linalg.solve(pooled, means.T).T
    offsets = -0.5 * np.einsum("ij,ij->i", weights, means) + np.log(n / n.sum())
    return Discriminant(classes, weights, offsets, means, pooled)


def lda_score(df: DataFrame, fit: Discriminant, column: str, name: str = "prediction") -> DataFrame:
    """Class with the greatest linear score."""
    x = F.col(column).cast("array<double>")
    scores = []
    for w, b in zip(fit.weights, fit.offsets, strict=True):
        terms = F.zip_with(x, F.lit([float(v) for v in w]), lambda a, c: a * c)
        scores.append(F.aggregate(terms, F.lit(float(b)), lambda s, v: s + v))
    all_scores = F.array(*scores)
    place = F.array_position(all_scores, F.array_max(all_scores))
    return df.withColumn(name, F.element_at(F.lit(list(fit.classes)), place.cast("int")))


@dataclass
class Clusters:
    """Centres (k x width) of the start with the least ``cost``; ``costs`` are those of all starts."""

    centres: np.ndarray
    cost: float
    costs: list[float]
    features: str

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with the number of the nearest centre, the smaller one on ties; a missing vector has none."""
        centres = self.centres

        @F.pandas_udf("int")
        def nearest(x: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(x), dtype="Int32")
            known = x.notna().to_numpy()
            if known.any():
                out[known] = _squared(np.vstack(x[known].to_list()), centres).argmin(1)
            return out

        return df.withColumn(name, nearest(_numbers_of(df, self.features)))


def _numbers_of(df: DataFrame, column: str) -> Column:
    """An array of doubles from an ML vector or an array."""
    is_vector = df.schema[column].dataType.typeName() == "vectorudt"
    return vector_to_array(column) if is_vector else F.col(column).cast("array<double>")


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)
    return np.maximum(d, 0.0)


def _first_centres(data: DataFrame, k: int, starts: int, seed: int) -> np.ndarray:
    """For every start the ``k`` different vectors with the smallest hashes: starts x k x width."""
    hashes = F.array(*[F.xxhash64("x", F.lit(seed + s)) for s in range(starts)]).alias("h")
    schema = "start int, h bigint, x array<double>"

    def least(rows):
        """Rows (start, hash, vector), each hash once, the ``k`` least per start."""
        held: dict[int, dict[int, list]] = {}
        for s, h, x in rows:
            own = held.setdefault(s, {})
            if h not in own:
                own[h] = x
                if len(own) > 8 * k:
                    held[s] = {h: own[h] for h in sorted(own)[:k]}
        return pd.DataFrame([(s, h, own[h]) for s, own in held.items() for h in sorted(own)[:k]], columns=["start", "h", "x"])

    def in_task(batches):
        def rows():
            for pdf in batches:
                h = np.vstack(pdf["h"].to_list())
                for s in range(starts):
                    _, at = np.unique(h[:, s], return_index=True)
                    for i in at[:k]:
                        yield s, int(h[i, s]), pdf["x"].iloc[i]

        out = least(rows())
        if len(out):
            yield out

    def together(batches):
        out = least((r.start, r.h, r.x) for pdf in batches for r in pdf.itertuples())
        if len(out):
            yield out

    first = data.select("x", hashes).mapInPandas(in_task, schema).repartition("start").mapInPandas(together, schema)
    rows = sorted(first.collect(), key=lambda r: (r["start"], r["h"]))  # starts x k
    by = {s: [r["x"] for r in rows if r["start"] == s] for s in range(starts)}
    return np.array([by[s] for s in range(starts)], float)


def best_kmeans(df: DataFrame, k: int, starts: int = 20, seed: int = 1, features: str = "features", steps: int = 20, tolerance: float = 1e-4) -> Clusters:
    """The least-cost clusters over several random starts, all of them moved in the same scans.

    A scan assigns every vector to the nearest centre of each start and adds up
    vectors and costs per start and centre; a start ends when none of its
    centres moves by more than ``tolerance``.  Centres that lose all vectors
    stay.  Equal vectors are one candidate for a start; missing vectors take no
    part.  Starts x centres numbers go to the tasks and come back.
    """
    data = df.select(_numbers_of(df, features).alias("x")).where(F.col("x").isNotNull()).persist()
    try:
        centres = _first_centres(data, k, starts, seed)
        if not centres.size:
            raise ValueError("no vectors to cluster")
        starts, k, width = centres.shape
        going = np.ones(starts, bool)
        costs = np.full(starts, np.inf)
        for step in range(steps + 1):
            flat = centres[going].reshape(-1, width)

            def add_up(batches, flat=flat):
                total = np.zeros((len(flat), width + 2))
                for pdf in batches:
                    x = np.vstack(pdf["x"].to_list())
                    d = _squared(x, flat).reshape(len(x), -1, k)
                    near, least = d.argmin(2), d.min(2)
                    for s in range(near.shape[1]):
                        hit = np.zeros((k, len(x)))
                        hit[near[:, s], np.arange(len(x))] = 1.0
                        total[s * k : (s + 1) * k] += np.column_stack([hit.sum(1), hit @ least[:, s], hit @ x])
                yield pd.DataFrame({"i": np.arange(total.size), "v": total.ravel()})

            table = np.zeros((len(flat), width + 2))
            for r in data.mapInPandas(add_up, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
                table.flat[r["i"]] = r["v"]
            table = table.reshape(-1, k, width + 2)
            costs[going] = table[:, :, 1].sum(1)
            if step == steps:
                break
            n = table[:, :, :1]
            moved = np.where(n > 0, table[:, :, 2:] / np.maximum(n, 1.0), centres[going])
            still = np.sqrt(((moved - centres[going]) ** 2).sum(2)).max(1) <= tolerance
            centres[going] = moved
            at = np.flatnonzero(going)
            if step and still.all():
                break
            going[at[still]] = False
    finally:
        data.unpersist()
    best = int(costs.argmin())
    return Clusters(centres[best], float(costs[best]), costs.tolist(), features)


@dataclass(frozen=True)
class Fourier:
    """Seeded random Fourier features of a radial kernel ``exp(-gamma |x - y|^2)``."""

    width: int
    gamma: float
    n: int = 256
    seed: int = 1

    def of(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        turn, shift = rng.normal(0.0, math.sqrt(2 * self.gamma), (self.width, self.n)), rng.uniform(0, 2 * math.pi, self.n)
        return math.sqrt(2.0 / self.n) * np.cos(x @ turn + shift)

    def transform(self, df: DataFrame, column: str, name: str = "features") -> DataFrame:
        """``df`` with the features of an array column as an ML vector."""

        @F.pandas_udf("array<double>")
        def made(x: pd.Series) -> pd.Series:
            return pd.Series(list(self.of(np.vstack(x.to_list()))))

        return df.withColumn(name, array_to_vector(made(F.col(column).cast("array<double>"))))


def choose_gamma(
    df: DataFrame, key: Sequence[str], column: str, label: str, width: int, gammas: Sequence[float], ridge: float = 1e-2, n: int = 256, folds: int = 5, seed: int = 1
) -> list[tuple[float, float]]:
    """Cross-validated accuracy of a least-squares machine on the Fourier features of each ``gamma``, from one scan.

    A scan of packed rows adds up the features' products per fold and gamma in each task; every fold's
    machine follows from the sums of the others, and is judged by a second scan.
    """
    rows = packed(sampling.assign_folds(df, key, folds, seed)).where(F.col(label).isNotNull() & F.col(column).isNotNull())
    rows = rows.select(F.col("fold"), F.col(label).cast("string").alias("y"), F.col(column).cast("array<double>").alias("x"))
    classes = sorted(r["y"] for r in rows.select("y").distinct().collect())
    maps = [Fourier(width, g, n, seed) for g in gammas]

    def signs(y: pd.Series) -> np.ndarray:
        return np.where(y.to_numpy()[:, None] == np.array(classes)[None, :], 1.0, -1.0)

    def add_up(batches):
        total = np.zeros((len(gammas), folds, n + 1, n + 1 + len(classes)))
        for pdf in batches:
            x, y, fold = np.vstack(pdf["x"].to_list()), signs(pdf["y"]), pdf["fold"].to_numpy()
            for g, f in enumerate(maps):
                z = np.column_stack([f.of(x), np.ones(len(x))])
                for k in np.unique(fold):
                    mine = fold == k
                    total[g, k] += z[mine].T @ np.column_stack([z[mine], y[mine]])
        yield pd.DataFrame({"i": np.arange(total.size), "v": total.ravel()})

    size = (len(gammas), folds, n + 1, n + 1 + len(classes))
    sums = np.zeros(size)
    for r in rows.mapInPandas(add_up, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        sums.flat[r["i"]] = r["v"]
    weights = np.zeros((len(gammas), folds, n + 1, len(classes)))
    for g in range(len(gammas)):
        for k in range(folds):
            rest = sums[g].sum(0) - sums[g, k]
            a = rest[:, : n + 1] + ridge * np.eye(n + 1)
            weights[g, k] = np.linalg.solve(a, rest[:, n + 1 :])

    def judge(batches):
        right = np.zeros((len(gammas), 2))
        for pdf in batches:
            x, y, fold = np.vstack(pdf["x"].to_list()), signs(pdf["y"]).argmax(1), pdf["fold"].to_numpy()
            for g, f in enumerate(maps):
                z = np.column_stack([f.of(x), np.ones(len(x))])
                scores = np.einsum("ij,ijc->ic", z, weights[g][fold])
                right[g] += (scores.argmax(1) == y).sum(), len(y)
        yield pd.DataFrame({"g": np.arange(len(gammas)), "hits": right[:, 0], "n": right[:, 1]})

    got = rows.mapInPandas(judge, "g bigint, hits double, n double").groupBy("g").agg(F.sum("hits").alias("h"), F.sum("n").alias("n")).collect()
    return [(gammas[r["g"]], r["h"] / r["n"]) for r in sorted(got, key=lambda r: r["g"])]


def radial_svm(train: DataFrame, key: Sequence[str], column: str, label: str, width: int, n: int = 256, rounds: int = 20, seed: int = 1):
    """The map and the model of a radial support-vector machine: Fourier features, width by cross-validation, then linear machines.

    Widths tried are multiples of one over ``width`` times the mean variance.
    """
    spread = train.select(F.posexplode(F.col(column).cast("array<double>")).alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("v")).agg(F.avg("v")).first()[0] or 1.0
    tried = choose_gamma(train, key, column, label, width, [m / (width * spread) for m in (0.05, 0.2, 0.5, 1.0, 2.0)], n=n, seed=seed)
    gamma = max(tried, key=lambda t: t[1])[0]
    features = Fourier(width, gamma, n, seed)
    return features, linear_svm(label, rounds).fit(features.transform(train, column)), tried


def cluster_summary(df: DataFrame, cluster: str, column: str) -> DataFrame:
    """Size, centre and within-cluster sum of squares per cluster of an array column."""
    long = df.select(cluster, F.posexplode(column).alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    per = long.groupBy(cluster, "i").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), (F.var_pop("x") * F.count(F.lit(1))).alias("ss")
    )
    return per.groupBy(cluster).agg(
        F.max("n").alias("size"),
        F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre"),
        F.sum("ss").alias("within_ss"),
    )


def eligibility_pipeline(numeric: Sequence[str], categorical: Sequence[str], label: str):
    """Impute, encode and fit a binary logistic model."""
    filled = [f"{c}_filled" for c in numeric]
    index = [f"{c}_index" for c in categorical]
    hot = [f"{c}_hot" for c in categorical]
    return Pipeline(
        stages=[
            Imputer(inputCols=list(numeric), outputCols=filled, strategy="median"),
            StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep"),
            OneHotEncoder(inputCols=index, outputCols=hot),
            VectorAssembler(inputCols=[*filled, *hot], outputCol="features"),
            LogisticRegression(labelCol=label),
        ]
    )


def probabilities(df: DataFrame) -> DataFrame:
    return df.withColumn("probability", vector_to_array("probability"))
