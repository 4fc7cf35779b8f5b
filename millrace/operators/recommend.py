"""Recommenders on ratings in long form ``(user, item, rating)``, one row per cell.

A user has at most one row per item, so per-user lists are bounded by the
catalogue.  Absent rows are unknown cells.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators import sampling
from millrace.operators.neighbours import SIM_DIGITS, coded_items, coded_vectors, nearest_users, sparse_vectors
from millrace.operators.ordering import positions
from millrace.session import stable

ITEM_CHUNK = 1024
#: users that meet one copy of an item list, popular items in such a list
USER_SALT, PLACES = 4096, 64


def binarise(ratings: DataFrame, at_least: float) -> DataFrame:
    """Cells rated at least so much, as 1."""
    return ratings.where(F.col("rating") >= at_least).select("user", "item", F.lit(1).alias("rating"))


def user_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user").agg(F.avg("rating").alias("mean"))


def centre(ratings: DataFrame) -> DataFrame:
    """Ratings less the user's mean, which is kept as ``mean``."""
    return ratings.join(user_means(ratings), "user").withColumn("centred", F.col("rating") - F.col("mean"))


def denormalise(centred: DataFrame) -> DataFrame:
    return centred.withColumn("rating", F.col("centred") + F.col("mean"))


def popular_items(ratings: DataFrame) -> DataFrame:
    """Items with the sum and the mean of their centred ratings."""
    return centre(ratings).groupBy("item").agg(F.sum("centred").alias("score"), F.avg("centred").alias("offset"))


def _salts(users: DataFrame) -> int:
    """How many copies of an item list keep a join on list and user salt even."""
    return max(1, math.ceil(users.select("user").distinct().count() / USER_SALT))


def _salt(n: int) -> Column:
    return F.pmod(F.xxhash64("user"), F.lit(n)).cast("int").alias("salt")


def unknown_cells(known: DataFrame, items: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``(user, item)`` for every item a user has not rated, or for those cells of a table ``wanted`` that are unknown.

    Wanted cells are of known users and items; nothing but them is made.
    Without them the result is as large as users times items by its nature.  Items are
    gathered in hash chunks of bounded size, and every chunk is copied once per
    few thousand users, so that a chunk's copy meets only those users; only the
    missing items of a chunk are expanded.
    """
    distinct = items.select("item").distinct()
    if wanted is not None:
        cells = wanted.select("user", "item").distinct().join(known.select("user").distinct(), "user", "left_semi")
        return cells.join(distinct, "item", "left_semi").join(known.select("user", "item"), ["user", "item"], "left_anti").select("user", "item")
    chunks, salts = max(1, math.ceil(distinct.count() / ITEM_CHUNK)), _salts(known)

    def chunk() -> Column:
        return F.pmod(F.xxhash64("item"), F.lit(chunks)).alias("chunk")

    lists = distinct.groupBy(chunk()).agg(F.collect_list("item").alias("all"))
    lists = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rated = known.groupBy("user", chunk()).agg(F.collect_set("item").alias("rated"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint")))
    everyone = known.select("user").distinct().withColumn("chunk", every).withColumn("salt", _salt(salts))
    pairs = everyone.join(lists, ["chunk", "salt"]).join(rated, ["user", "chunk"], "left")
    nothing = F.array().cast(lists.schema["all"].dataType)
    return pairs.select("user", F.explode(F.array_except("all", F.coalesce("rated", nothing))).alias("item"))


def popular_ratings(train: DataFrame, known: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Predicted ratings of the unknown (or wanted) cells: user mean plus the item's mean offset."""
    items = popular_items(train)
    return (
        unknown_cells(known, items, wanted)
        .join(items.select("item", "offset"), "item")
        .join(user_means(known), "user")
        .select("user", "item", (F.col("mean") + F.col("offset")).alias("prediction"))
    )


def full_matrix(known: DataFrame, predicted: DataFrame) -> DataFrame:
    """Known ratings and predictions together, told apart by ``is_known``."""
    return known.select("user", "item", "rating", F.lit(True).alias("is_known")).unionByName(
        predicted.select("user", "item", F.col("prediction").alias("rating"), F.lit(False).alias("is_known"))
    )


def popular_top_n(train: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """First ``n`` items by popularity that a user has not rated.

    A user with ``c`` known items finds them among the first ``n + c`` popular
    ones, so only that many candidates are made per user.
    """
    items = popular_items(train).withColumn("__s", F.round("score", SIM_DIGITS))
    placed = positions(items, [F.desc("__s"), F.asc("item")], name="place").select("item", (F.col("place") - 1).alias("place"))
    salts = _salts(known)
    lists = placed.groupBy(F.floor(F.col("place") / PLACES).alias("part")).agg(F.collect_list(F.struct("place", "item")).alias("held"))
    lists = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    reach = known.groupBy("user").agg((F.count(F.lit(1)) + n).alias("c"))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("c") - 1) / PLACES))).alias("part")
    candidates = reach.select("user", "c", parts, _salt(salts)).join(lists, ["part", "salt"])
    candidates = candidates.select("user", "c", F.explode("held").alias("h")).select("user", "c", "h.*").where("place < c").drop("c")
    fresh = candidates.join(known.select("user", "item"), ["user", "item"], "left_anti")
    w = Window.partitionBy("user").orderBy("place")
    return fresh.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).drop("place")


def top_n_items(predicted: DataFrame, n: int) -> DataFrame:
    """First ``n`` predicted items per user, ties by item."""
    w = Window.partitionBy("user").orderBy(F.desc(F.round("prediction", SIM_DIGITS)), "item")
    return predicted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select("user", "item", "rank")


def random_ratings(known: DataFrame, items: DataFrame, lo: float, hi: float, seed: int = 1, wanted: DataFrame | None = None) -> DataFrame:
    """Repeatable random predictions of the unknown (or wanted) cells, the baseline to beat."""
    u = sampling.hash_unit(["user", "item"], seed)
    return unknown_cells(known, items, wanted).withColumn("prediction", F.lit(lo) + u * F.lit(hi - lo))


def _co_rated(frame: pd.DataFrame, most: int = 1 << 20):
    """Yield ``(item, other, dot)`` over the pairs of items that a user rated both, added up.

    Items are numbered.  Few items have a matrix of all their pairs, ``most``
    at the most, to which users are added as matrix products.  Otherwise users
    are taken together as long as their pairs stay under ``most``; one user's
    pairs are made in pieces of that size.  A missing value adds nothing.
    """
    sizes = frame["items"].map(len).to_numpy()
    codes, names = pd.factorize(np.concatenate(frame["items"].to_list() or [[]]))
    values = np.concatenate(frame["values"].to_list() or [[]]).astype(float)
    values[np.isnan(values)] = 0.0
    rows = np.repeat(np.arange(len(frame)), sizes)[codes >= 0]
    values, codes = values[codes >= 0], codes[codes >= 0]
    starts, width = np.searchsorted(rows, np.arange(len(frame) + 1)), len(names)

    def named(first: np.ndarray, second: np.ndarray, dots: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"item": names[first], "other": names[second], "dot": dots})

    if 0 < width * width <= most:
        dots, seen = np.zeros((width, width)), np.zeros((width, width), bool)
        step = max(1, most // width)
        for lo in range(0, len(frame), step):
            cells = slice(starts[lo], starts[min(lo + step, len(frame))])
            x, there = (np.zeros((min(step, len(frame) - lo), width)) for _ in range(2))
            np.add.at(x, (rows[cells] - lo, codes[cells]), values[cells])
            there[rows[cells] - lo, codes[cells]] = 1.0
            dots += x.T @ x
            seen |= there.T @ there > 0
        first, second = np.nonzero(seen)
        yield named(first, second, dots[first, second])
        return

    keys, products, held = [], [], 0

    def summed() -> pd.DataFrame:
        pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
        return named(pairs // width, pairs % width, np.bincount(at, np.concatenate(products), len(pairs)))

    for lo, hi in zip(starts[:-1], starts[1:]):
        step = max(1, most // max(1, hi - lo))
        for i in range(lo, hi, step):
            part = slice(i, min(i + step, hi))
            size = (part.stop - part.start) * (hi - lo)
            if held and held + size > most:
                yield summed()
                keys, products, held = [], [], 0
            keys.append((codes[part].astype(np.int64)[:, None] * width + codes[lo:hi]).ravel())
            products.append(np.outer(values[part], values[lo:hi]).ravel())
            held += size
    if held:
        yield summed()


def user_cf(train: DataFrame, known: DataFrame, nn: int = 50, block: int = 1024) -> DataFrame:
    """User-based predictions of the unknown cells.

    The mean of the neighbours' centred ratings weighted by similarity, over
    the neighbours that rated the item, plus the user's own mean.  Cells no
    neighbour rated are left out.
    """
    mine, theirs = centre(known), centre(train)
    near = nearest_users(mine, theirs, nn, block).select("user", "other", "sim")
    codes = stable(coded_items(theirs))
    vectors = coded_vectors(theirs, codes).withColumnRenamed("user", "other")
    # whole vectors go to the user; their cells are made where they are added up
    met = near.join(vectors, "other").select("user", "sim", "codes", "values").repartition("user")
    cells = met.select("user", "sim", F.explode(F.arrays_zip("codes", "values")).alias("c")).select("user", "sim", "c.codes", "c.values")
    weighed = cells.groupBy("user", F.col("codes").alias("code")).agg(
        F.try_divide(F.sum(F.col("sim") * F.col("values")), F.sum(F.abs("sim"))).alias("p")
    )
    return (
        weighed.where(F.col("p").isNotNull())
        .join(codes, "code")
        .join(known.select("user", "item"), ["user", "item"], "left_anti")
        .join(user_means(known), "user")
        .select("user", "item", (F.col("mean") + F.col("p")).alias("prediction"))
    )


def item_similarity(train: DataFrame, k: int) -> DataFrame:
    """The ``k`` most similar items per item, by cosine of centred ratings.

    Each task makes the products of co-rated pairs from its users' sparse
    vectors and adds them up before the shuffle.
    """
    vectors = sparse_vectors(centre(train))
    kind = train.schema["item"].dataType.simpleString()

    def products(batches):
        for pdf in batches:
            if not pdf.empty:
                yield from _co_rated(pdf)

    dots = (
        vectors.mapInPandas(products, f"item {kind}, other {kind}, dot double")
        .groupBy("item", "other")
        .agg(F.sum("dot").alias("dot"))
    )
    norms = centre(train).groupBy("item").agg(F.sqrt(F.sum(F.col("centred") * F.col("centred"))).alias("norm"))
    other = norms.select(F.col("item").alias("other"), F.col("norm").alias("norm_other"))
    sims = (
        dots.where("item <> other")
        .join(norms, "item")
        .join(other, "other")
        .select("item", "other", F.round(F.try_divide("dot", F.col("norm") * F.col("norm_other")), SIM_DIGITS).alias("sim"))
        .where(F.col("sim").isNotNull())
    )
    w = Window.partitionBy("item").orderBy(F.desc("sim"), "other")
    return sims.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def item_cf(train: DataFrame, known: DataFrame, k: int = 50) -> DataFrame:
    """Item-based predictions of the unknown cells.

    The user's own centred ratings weighted by similarity, over the ``k``
    nearest items of the target that the user rated, plus the user's mean.
    """
    near = item_similarity(train, k).select("item", "other", "sim")
    mine = centre(known).select("user", F.col("item").alias("other"), "centred")
    weighed = mine.join(near, "other").groupBy("user", "item").agg(
        F.try_divide(F.sum(F.col("sim") * F.col("centred")), F.sum(F.abs("sim"))).alias("p")
    )
    return (
        weighed.where(F.col("p").isNotNull())
        .join(known.select("user", "item"), ["user", "item"], "left_anti")
        .join(user_means(known), "user")
        .select("user", "item", (F.col("mean") + F.col("p")).alias("prediction"))
    )


def split_given(ratings: DataFrame, is_test: Column, given: int, order: Sequence[Column]) -> DataFrame:
    """Tag cells ``train``, or for test users ``known`` (the first ``given``) and ``hidden``.

    Test users with no more than ``given`` ratings have nothing to hide and
    are all known.
    """
    w = Window.partitionBy("user").orderBy(*order)
    marked = ratings.withColumn("__test", is_test)
    train = marked.where(~F.col("__test")).withColumn("part", F.lit("train"))
    test = marked.where("__test").withColumn(
        "part", F.when(F.row_number().over(w) <= given, "known").otherwise("hidden")
    )
    return train.unionByName(test).drop("__test")


def rating_split(ratings: DataFrame, train: float, given: int, seed: int = 1) -> DataFrame:
    """Users at random into training and test, test ratings at random into known and hidden."""
    is_test = sampling.hash_unit(["user"], seed) >= train
    return split_given(ratings, is_test, given, [sampling.hash_order(["user", "item"], seed), F.col("item")])


def user_folds(ratings: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """Fold number per user, the same for all of the user's ratings."""
    return sampling.assign_folds(ratings, ["user"], k, seed)


def rating_errors(predicted: DataFrame, hidden: DataFrame) -> DataFrame:
    """RMSE, MSE and MAE on the hidden ratings that have a prediction."""
    e = F.col("rating") - F.col("prediction")
    return hidden.join(predicted, ["user", "item"]).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae")
    )


def top_n_counts(lists: DataFrame, hidden: DataFrame, ns: Sequence[int], good: float, n_items: int, given: int) -> DataFrame:
    """Confusion counts and rates per user and list length.

    ``lists`` holds ``(user, item, rank)``, ranked once for the longest length.
    """
    users = hidden.groupBy("user").agg(F.count_if(F.col("rating") >= good).alias("good"))
    hits = lists.join(hidden.where(F.col("rating") >= good).select("user", "item"), ["user", "item"])
    lengths = F.explode(F.array(*[F.lit(n) for n in ns]))

    def upto(rows: DataFrame, name: str) -> DataFrame:
        return rows.withColumn("n", lengths).where("rank <= n").groupBy("user", "n").agg(F.count(F.lit(1)).alias(name))

    base = users.withColumn("n", lengths).join(upto(lists, "shown"), ["user", "n"], "left").join(upto(hits, "tp"), ["user", "n"], "left")
    base = base.na.fill(0, ["shown", "tp"])
    tp, shown, wanted = F.col("tp"), F.col("shown"), F.col("good")
    fp, fn = shown - tp, wanted - tp
    tn = F.lit(n_items - given) - tp - fp - fn
    return base.select(
        "user", "n", tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        F.try_divide(tp, shown).alias("precision"), F.try_divide(tp, wanted).alias("recall"),
        F.try_divide(tp, wanted).alias("tpr"), F.try_divide(fp, fp + tn).alias("fpr"),
    )


def evaluate_folds(
    ratings: DataFrame,
    fold: Column,
    k: int,
    given: int,
    order: Sequence[Column],
    lists: Callable[[DataFrame, DataFrame, int], DataFrame],
    ns: Sequence[int],
    good: float,
) -> DataFrame:
    """Averages over users per fold and list length, each fold judged by a model of the others.

    ``lists(train, known, longest)`` recommends; ``k`` folds are few, so each is
    a plan of its own.
    """
    out = None
    for f in range(k):
        parts = split_given(ratings, fold == f, given, order)
        train, known, hidden = (parts.where(F.col("part") == p).select("user", "item", "rating") for p in ("train", "known", "hidden"))
        n_items = train.select("item").distinct().count()
        counts = top_n_counts(lists(train, known, max(ns)), hidden, ns, good, n_items, given)
        part = average_counts(counts).withColumn("fold", F.lit(f))
        out = part if out is None else out.unionByName(part)
    return out


MEASURES = ["tp", "fp", "fn", "tn", "precision", "recall", "tpr", "fpr"]


def average_counts(counts: DataFrame, keys: Sequence[str] = ("n",)) -> DataFrame:
    """Averages over users, or over folds when fed per-fold averages."""
    return counts.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in MEASURES])


def roc_points(by_algorithm: dict[str, DataFrame]) -> DataFrame:
    """``(algorithm, n, fpr, tpr)`` of several evaluated recommenders."""
    out = None
    for name, counts in by_algorithm.items():
        part = average_counts(counts).select(F.lit(name).alias("algorithm"), "n", "fpr", "tpr")
        out = part if out is None else out.unionByName(part)
    return out
