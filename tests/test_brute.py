"""Distributed operators against plain computations, with hot keys and many ranges."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import OneVsRest
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from millrace.functions import tails
from millrace.operators import charts, classification, forecasting, neighbours, ordering, recommend, regression, sampling, smoothing, survival, timeseries
from millrace.operators.ordering import ntile_global, positions, quantiles, ranks, running
from millrace.operators.windows import top_n


@pytest.fixture
def many_ranges(spark):
    """Keep small shuffles in several partitions, so ranges really meet."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": np.arange(3000), "key": rng.choice(list("abcdef"), 3000), "x": rng.integers(0, 400, 3000).astype(float)})
    pdf.loc[rng.random(3000) < 0.4, "key"] = "hot"
    pdf.loc[rng.random(3000) < 0.35, "x"] = 7.0
    return pdf, spark.createDataFrame(pdf)


def test_running_over_ranges(many_ranges, skewed):
    pdf, df = skewed
    out = running(df, ["key"], ["x", "id"], sums={"s": "x"}, products={"p": F.lit(0.999)})
    assert out.rdd.getNumPartitions() > 1
    got = out.toPandas().sort_values(["key", "x", "id"])
    want = pdf.sort_values(["key", "x", "id"])
    assert got["s"].to_numpy() == pytest.approx(want.groupby("key")["x"].cumsum().to_numpy())
    place = want.groupby("key").cumcount().to_numpy() + 1
    assert got["p"].to_numpy() == pytest.approx(0.999**place)


def test_global_positions_and_tiles(many_ranges, skewed):
    pdf, df = skewed
    got = positions(df, [F.desc("x"), F.asc("id")]).toPandas().sort_values("position")
    want = pdf.sort_values(["x", "id"], ascending=[False, True])
    assert got["id"].tolist() == want["id"].tolist()
    assert got["position"].tolist() == list(range(1, 3001))
    for n in (7, 10, 4001):
        tiles = ntile_global(df, [F.desc("x"), F.asc("id")], n).toPandas().set_index("id")["ntile"]
        base, extra = divmod(3000, n)
        sizes = [base + 1] * extra + [base] * (n - extra)
        expect = np.repeat(np.arange(1, n + 1), sizes)
        assert tiles.loc[want["id"]].tolist() == expect.tolist()


def test_quantiles_with_hot_value(many_ranges, skewed):
    pdf, df = skewed
    got = quantiles(df, "x", {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}, ["key"]).toPandas().set_index("key")
    for k, part in pdf.groupby("key"):
        assert got.loc[k].to_numpy() == pytest.approx(np.quantile(part["x"], [0, 0.1, 0.5, 0.77, 1]))


def test_bracketed_quantiles(many_ranges, skewed, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(ordering, "SKETCH_ACCURACY", 450)  # the small keys fit in a sketch, the hot one is bracketed
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    sizes = pdf.groupby("key").size()
    assert sizes.min() < 450 < sizes.max()
    got = quantiles(df, "x", probs, ["key"]).toPandas().set_index("key")
    for k, part in pdf.groupby("key"):
        assert got.loc[k].to_numpy() == pytest.approx(np.quantile(part["x"], list(probs.values())))
    kept = ordering._bracketed(df.select("key", F.col("x").alias("__v")), probs, ["key"]).where("key = 'hot' AND __v IS NOT NULL")
    assert kept.agg(F.sum("__n")).first()[0] < 5 * sizes["hot"]
    assert quantiles(df, "x", probs).first() == pytest.approx(np.quantile(pdf["x"], list(probs.values())))


def test_every_bracket_holds_its_quantile(skewed, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(ordering, "SKETCH_ACCURACY", 50)
    probs = {f"q{i}": i / 40 for i in range(41)}
    for x in ("id", "x"):
        assert list(quantiles(df, x, probs).first()) == pytest.approx(list(np.quantile(pdf[x], list(probs.values()))))


def test_ranks(many_ranges, skewed):
    pdf, df = skewed
    got = ranks(df, "x", ["key"]).toPandas().set_index("id")["rank"]
    want = pdf.set_index("id").groupby("key")["x"].rank(method="min", ascending=False).astype(int)
    assert got.loc[want.index].tolist() == want.tolist()


def test_top_n_limits_before_the_shuffle(skewed):
    _, df = skewed
    plan = top_n(df, ["key"], [F.desc("x")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_samples(spark, skewed):
    pdf, df = skewed
    a = {r["id"] for r in sampling.sample_n(df, ["id"], 700, 5).collect()}
    assert len(a) == 700
    assert a == {r["id"] for r in sampling.sample_n(df.repartition(5), ["id"], 700, 5).collect()}
    assert sampling.sample_n(df, ["id"], 10000, 5).count() == 3000
    split = sampling.stratified_split(df, ["id"], "key", 0.3, 5).groupBy("key", "data").count().toPandas()
    n = pdf.groupby("key").size()
    for k in n.index:
        assert split[(split["key"] == k) & (split["data"] == "train")]["count"].iloc[0] == math.ceil(0.3 * n[k])
    folds = sampling.assign_folds(df, ["id"], 5).groupBy("fold").count().toPandas()
    assert folds["count"].sum() == 3000 and set(folds["fold"]) == set(range(5))
    tags = sampling.hash_split(df, ["id"], {"a": 0.5, "b": 0.3, "c": 0.2}).groupBy("data").count().toPandas()
    assert tags["count"].sum() == 3000 and set(tags["data"]) == {"a", "b", "c"}
    draws = sampling.bootstrap(df, ["id"], 40).agg(F.sum("draws")).first()[0] / 40
    assert draws == pytest.approx(3000, rel=0.03)


def test_box_stats(skewed):
    pdf, df = skewed
    got = charts.box_stats(df, "x", ["key"]).toPandas().set_index("key")
    for k, part in pdf.groupby("key"):
        q1, q3 = np.quantile(part["x"], [0.25, 0.75])
        inside = part["x"].between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        assert got.loc[k, "outliers"] == (~inside).sum()
        assert got.loc[k, "whisker_hi"] == part["x"][inside].max()


def test_cross_validation_equals_refits(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"id": np.arange(200), "a": rng.normal(50, 3, 200), "b": rng.normal(size=200), "fold": np.arange(200) % 4})
    pdf["y"] = 3 + 2 * pdf["a"] - pdf["b"] + rng.normal(size=200)
    got = {r[0]: r[1:] for r in regression.cross_validate(spark.createDataFrame(pdf), "y", ["a", "b"], "fold").collect()}
    for k in range(4):
        train, held = pdf[pdf["fold"] != k], pdf[pdf["fold"] == k]
        design = np.column_stack([np.ones(len(train)), train[["a", "b"]]])
        beta = np.linalg.lstsq(design, train["y"], rcond=None)[0]
        e = held["y"] - np.column_stack([np.ones(len(held)), held[["a", "b"]]]) @ beta
        assert got[k][0] == len(held)
        assert got[k][1] == pytest.approx(np.sqrt((e**2).mean()))
        assert got[k][2] == pytest.approx(1 - (e**2).sum() / ((held["y"] - held["y"].mean()) ** 2).sum())


def test_pairwise_t(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": np.repeat(["a", "b", "c"], [20, 30, 25]), "x": rng.normal(size=75)})
    rows = {(r["level_a"], r["level_b"]): r for r in regression.pairwise_t(spark.createDataFrame(pdf), "x", "g").collect()}
    parts = {k: v["x"].to_numpy() for k, v in pdf.groupby("g")}
    s2 = sum(v.var(ddof=1) * (len(v) - 1) for v in parts.values()) / (75 - 3)
    for (a, b), r in rows.items():
        t = (parts[a].mean() - parts[b].mean()) / math.sqrt(s2 * (1 / len(parts[a]) + 1 / len(parts[b])))
        assert r["t"] == pytest.approx(t)
    raw = sorted(r["p"] for r in rows.values())
    assert min(r["p_holm"] for r in rows.values()) == pytest.approx(min(1, raw[0] * 3))
    assert max(r["p_holm"] for r in rows.values()) >= raw[-1]


def test_pairwise_t_of_many_levels(spark, many_ranges):
    """780,625 pairs; Holm's adjustment against a plain one, ties included."""
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": [f"g{i:04d}" for i in range(1250)] * 2, "x": np.round(rng.normal(size=2500), 1)})
    pdf.loc[pdf["g"] < "g0030", "x"] += 12.0
    got = regression.pairwise_t(spark.createDataFrame(pdf), "x", "g").toPandas()
    assert len(got) == 1250 * 1249 // 2 == got[["level_a", "level_b"]].drop_duplicates().shape[0]
    stats = pdf.groupby("g")["x"].agg(["mean", "var"])
    s2 = stats["var"].mean()
    some = got.sample(300, random_state=1)
    want = (stats.loc[some["level_a"], "mean"].to_numpy() - stats.loc[some["level_b"], "mean"].to_numpy()) / math.sqrt(s2)
    assert some["t"].to_numpy() == pytest.approx(want)
    assert some["p"].to_numpy() == pytest.approx([tails.t_two_sided(t, 1250) for t in want], abs=1e-12)
    p = np.sort(got["p"].to_numpy())
    holm = np.maximum.accumulate(np.minimum(1.0, p * (len(p) - np.arange(len(p)))))
    assert np.sort(got["p_holm"].to_numpy()) == pytest.approx(holm, abs=1e-12)
    assert 0 < (got["p_holm"] < 0.05).sum() < len(got)


def test_pairwise_t_sorts_only_telling_pairs(spark, many_ranges, monkeypatch):
    """Three blocks of levels; the others need no place in the order of p, and pairs come with the greater level first."""
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": [f"g{i:04d}" for i in range(1100)] * 2, "x": rng.normal(size=2200)})
    pdf.loc[pdf["g"] < "g0004", "x"] += 15.0
    sizes, plain = [], regression.positions

    def spied(df, *rest, **named):
        sizes.append(df.count())
        return plain(df, *rest, **named)

    monkeypatch.setattr(regression, "positions", spied)
    got = regression.pairwise_t(spark.createDataFrame(pdf), "x", "g").toPandas()
    assert sizes[0] == 1100 and 4 * 1096 <= sizes[1] < 6000
    assert len(got) == 1100 * 1099 // 2 == got[["level_a", "level_b"]].drop_duplicates().shape[0]
    assert (got["level_a"] > got["level_b"]).all()
    got = got.sort_values("p")
    p = got["p"].to_numpy()
    assert got["p_holm"].to_numpy() == pytest.approx(np.maximum.accumulate(np.minimum(1.0, p * (len(p) - np.arange(len(p))))), abs=1e-12)


def test_pairs_of_blocks_are_numbers_until_they_are_dealt_out(spark, monkeypatch):
    """The levels of a block must not be copied per pair below a join, which would broadcast them all."""
    monkeypatch.setattr(regression, "LEVELS_PER_BLOCK", 8)
    levels = spark.range(1, 101).select(F.col("id").alias("i"), F.col("id").cast("string").alias("g"), F.lit(2).alias("n"), F.lit(1.5).alias("m"))
    cells = regression._level_blocks(levels, 100)
    made = [x for x in cells._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate explode" in x]
    assert made and all(x.split("), [")[1].startswith("block#") and "r#" not in x for x in made)
    rows = cells.collect()
    met = [(i, j) for r in rows for i in r["a_i"] for j in r["b_i"] if i > j]
    assert len(rows) == 13 * 14 // 2 and len(met) == len(set(met)) == 100 * 99 // 2


def test_pairwise_t_without_spread_or_freedom(spark):
    def of(rows):
        return [tuple(r) for r in regression.pairwise_t(spark.createDataFrame(rows, "g string, x double"), "x", "g").orderBy("level_a", "level_b").collect()]

    assert of([("a", 1.0), ("a", 1.0), ("b", 2.0), ("b", 2.0)]) == [("b", "a", None, None, None)]
    assert of([("a", 1.0), ("b", 2.0)]) == [("b", "a", None, None, None)]
    assert of([("a", 1.0), ("a", 2.0), (None, 3.0), ("b", None)]) == []



def test_model_per_group(spark):
    """100,000 groups, and small ones against a plain solver: collinear, too short, missing values, a NULL key."""
    many = spark.range(400_000).select((F.col("id") % 100_000).alias("k"), F.floor(F.col("id") / 100_000).alias("x"))
    many = many.withColumn("y", F.col("x") * F.col("k") + 1)
    out = regression.ols_by_group(many, "y", ["x"], ["k"])
    off = F.when(F.col("term") == "x", F.abs(F.col("estimate") - F.col("k"))).otherwise(F.abs(F.col("estimate") - 1))
    assert out.agg(F.count(F.lit(1)), F.max(off / (1 + F.col("k")))).first()[0] == 200_000
    assert out.agg(F.max(off / (1 + F.col("k")))).first()[0] < 1e-6

    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 90), "u": rng.normal(1e6, 1, 90), "v": rng.normal(size=90), "n": 7})
    pdf["y"] = 2 * pdf["u"] - pdf["v"] + rng.normal(size=90)
    pdf.loc[pdf["g"] == "b", "v"] = 2 * pdf["u"]
    extra = pd.DataFrame({"g": ["one", "two", "two", "gone"], "u": [1.0, 1.0, 2.0, np.nan], "v": [0.0, 3.0, 3.0, 1.0], "n": 7, "y": [5.0, 1.0, 4.0, 1.0]})
    df = spark.createDataFrame(pd.concat([pdf, extra]))
    for width in (regression.MAX_JVM_COLUMNS, 1):
        regression.MAX_JVM_COLUMNS, before = width, regression.MAX_JVM_COLUMNS
        try:
            got = regression.ols_by_group(df, "y", ["u", "v"], ["g"]).toPandas()
        finally:
            regression.MAX_JVM_COLUMNS = before
        assert set(got["g"]) == {"a", "b", None, "one", "two"}
        for g in ("a", None):
            part = pdf[pdf["g"].isna()] if g is None else pdf[pdf["g"] == g]
            design = np.column_stack([np.ones(len(part)), part["u"] - 1e6, part["v"]])
            beta, rss, *_ = np.linalg.lstsq(design, part["y"], rcond=None)
            mine = (got[got["g"].isna()] if g is None else got[got["g"] == g]).set_index("term")
            assert mine.loc[["u", "v"], "estimate"].to_numpy() == pytest.approx(beta[1:], rel=1e-6)
            assert mine.loc["u", "sigma"] == pytest.approx(math.sqrt(rss[0] / (len(part) - 3)), rel=1e-6)
            se = math.sqrt(rss[0] / (len(part) - 3) * np.linalg.inv(design.T @ design)[1, 1])
            assert mine.loc["u", "std_error"] == pytest.approx(se, rel=1e-5)
        rows = got.set_index(["g", "term"])
        assert math.isnan(rows.loc[("b", "v"), "estimate"]) and rows.loc[("b", "u"), "df"] == (pdf["g"] == "b").sum() - 2
        assert rows.loc[("two", "u"), "estimate"] == pytest.approx(3.0) and math.isnan(rows.loc[("two", "u"), "p"])
        assert rows.loc[("one", "(Intercept)"), "estimate"] == pytest.approx(5.0)


def test_correlation_of_few_rows(spark):
    def test(rows):
        return regression.correlation_test(spark.createDataFrame(rows, "x double, y double"), "x", "y").first()

    assert test([])[:] == (0, None, None, None, None, None)
    assert test([(1.0, 2.0), (None, 1.0)])[:] == (1, None, None, None, None, None)
    assert test([(1.0, 2.0), (2.0, 5.0)])[2:] == (None,) * 4
    three = test([(1.0, 2.0), (2.0, 5.0), (3.0, 4.0)])
    assert three["r"] == pytest.approx(0.654654, abs=1e-6) and three["p"] is not None and three["lo"] is None
    line = test([(float(i), 2.0 * i) for i in range(6)])
    assert line["r"] == pytest.approx(1.0) and line["p"] == pytest.approx(0.0, abs=1e-12) and line["hi"] == pytest.approx(1.0)
    assert test([(1.0, float(i)) for i in range(6)])["r"] is None


def test_tails():
    many = np.array([0.0, 1e-9, 0.3, -2.0, 7.0, 60.0, np.nan, np.inf, 1e-3])
    for df in (1, 2, 10, 15_000):
        got = tails.t_two_sided_many(many, df)
        assert np.isnan(got[6]) and got[7] == 0.0
        assert got[[0, 1, 2, 3, 4, 5, 8]] == pytest.approx([tails.t_two_sided(t, df) for t in many[[0, 1, 2, 3, 4, 5, 8]]], abs=1e-8)
    assert tails.t_two_sided_many(np.array([1e-9]), 1)[0] == pytest.approx(1 - 2 / math.pi * math.atan(1e-9), abs=1e-15)

    assert tails.t_two_sided(2.0, 10) == pytest.approx(0.07338803, abs=1e-8)
    assert tails.f_tail(3.0, 2, 20) == pytest.approx(0.07253815, abs=1e-8)
    assert tails.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert tails.chi2_tail(25.0, 10) == pytest.approx(0.005345505, abs=1e-8)
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    assert tails.t_quantile(0.975, 10) == pytest.approx(2.228138852)


@pytest.fixture(scope="module")
def lifetimes(spark):
    rng = np.random.default_rng(5)
    n = 400
    x = rng.normal(size=(n, 2))
    t = np.ceil(-np.log(rng.random(n)) / np.exp(0.6 * x[:, 0] - 0.4 * x[:, 1]) * 10)
    c = np.ceil(rng.random(n) * 30)
    pdf = pd.DataFrame({"time": np.minimum(t, c), "event": (t <= c).astype(int), "a": x[:, 0], "b": x[:, 1], "g": rng.choice(["u", "v"], n)})
    return pdf, spark.createDataFrame(pdf)


def test_kaplan_meier(many_ranges, lifetimes):
    pdf, df = lifetimes
    got = survival.kaplan_meier(df, "time", "event", ["g"]).toPandas()
    for g, part in pdf.groupby("g"):
        s = 1.0
        curve = got[got["g"] == g].sort_values("time")
        for _, row in curve.iterrows():
            n = (part["time"] >= row["time"]).sum()
            d = ((part["time"] == row["time"]) & (part["event"] == 1)).sum()
            s *= 1 - d / n
            assert (row["at_risk"], row["events"]) == (n, d)
            assert row["survival"] == pytest.approx(s)
        assert curve["survival"].is_monotonic_decreasing


def _efron(pdf, beta):
    eta = pdf[["a", "b"]].to_numpy() @ beta
    w, total = np.exp(eta), 0.0
    for t in pdf.loc[pdf["event"] == 1, "time"].unique():
        dead = ((pdf["time"] == t) & (pdf["event"] == 1)).to_numpy()
        risk = (pdf["time"] >= t).to_numpy()
        total += eta[dead].sum()
        for k in range(dead.sum()):
            total -= np.log(w[risk].sum() - k / dead.sum() * w[dead].sum())
    return total


def test_cox(many_ranges, lifetimes):
    pdf, df = lifetimes
    table, value = survival.cox_ph(df, "time", "event", ["a", "b"])
    rows = {r["term"]: r for r in table.collect()}
    best = np.array([rows["a"]["estimate"], rows["b"]["estimate"]])
    centred = pdf.assign(a=pdf["a"] - pdf["a"].mean(), b=pdf["b"] - pdf["b"].mean())
    assert value == pytest.approx(_efron(centred, best))
    for step in ([1e-3, 0], [-1e-3, 0], [0, 1e-3], [0, -1e-3]):
        assert _efron(centred, best + step) < value
    h = 1e-4
    curve = (_efron(centred, best + [h, 0]) - 2 * value + _efron(centred, best - [h, 0])) / h**2
    assert rows["a"]["std_error"] == pytest.approx(1 / math.sqrt(-curve), rel=0.05)


def _loglogistic(pdf, b):
    scale = math.exp(b[3])
    z = (np.log(pdf["time"]) - b[0] - b[1] * pdf["a"] - b[2] * pdf["b"]) / scale
    d = pdf["event"]
    return float((d * (z - b[3] - np.log(pdf["time"])) - (1 + d) * np.log1p(np.exp(z))).sum())


def test_log_logistic(lifetimes):
    pdf, df = lifetimes
    table, value = survival.loglogistic_regression(df, "time", "event", ["a", "b"])
    b = np.array([r["estimate"] for r in table.collect()])
    assert value == pytest.approx(_loglogistic(pdf, b))
    for i in range(4):
        for e in (1e-3, -1e-3):
            step = np.zeros(4)
            step[i] = e
            assert _loglogistic(pdf, b + step) < value


def test_exponential_is_the_likelihood_maximum(lifetimes):
    pdf, df = lifetimes
    rows = survival.exponential_regression(df, "time", "event", ["a", "b"]).collect()
    b = np.array([r["estimate"] for r in rows])

    def loglik(v):
        rate = np.exp(-(v[0] + v[1] * pdf["a"] + v[2] * pdf["b"]))
        return float((pdf["event"] * np.log(rate) - rate * pdf["time"]).sum())

    for i in range(3):
        for e in (1e-3, -1e-3):
            step = np.zeros(3)
            step[i] = e
            assert loglik(b + step) < loglik(b)


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(8)
    full = pd.DataFrame([(u, f"i{i:02d}", float(rng.integers(1, 6))) for u in range(60) for i in range(30)], columns=["user", "item", "rating"])
    pdf = full[rng.random(len(full)) < 0.4]
    return pdf, spark.createDataFrame(pdf)


def test_gram_of_few_columns_reads_its_rows_once(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), 1e9 + float(b), float(a) - 2 * float(b) + 7) for a, b in rng.normal(size=(200, 2))]
    read = spark.sparkContext.accumulator(0)

    def seen(r):
        read.add(1)
        return r

    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4).map(seen), "a double, b double, y double")
    got = regression.gram(df, "y", ["a", "b"])
    assert read.value == 200
    m = np.array(rows)
    assert got.means == pytest.approx(m.mean(axis=0)) and got.about_mean() == pytest.approx((m - m.mean(axis=0)).T @ (m - m.mean(axis=0)), rel=1e-6)


def test_bootstrap_hashes_once(spark):
    """One hash a row and resample, not one for each of 18 comparisons and again in the filter."""
    df = spark.range(200).withColumnRenamed("id", "k")
    out = sampling.bootstrap(df, ["k"], 10, 3)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    u = df.withColumn("resample", F.explode(F.sequence(F.lit(1), F.lit(10)))).withColumn("u", sampling.hash_unit(["k", "resample"], 3)).collect()
    steps = np.cumsum([math.exp(-1.0) / math.factorial(i) for i in range(18)])
    want = {(r["k"], r["resample"]): int((r["u"] >= steps).sum()) for r in u}
    assert {(r["k"], r["resample"]): r["draws"] for r in out.collect()} == {k: n for k, n in want.items() if n}


def test_nearest_users_in_blocks(cells):
    pdf, df = cells
    centred = recommend.centre(df).select("user", "item", "centred")
    got = neighbours.nearest_users(centred, centred, 5, block=9).toPandas()
    wide = pdf.assign(c=pdf["rating"] - pdf.groupby("user")["rating"].transform("mean")).pivot(index="user", columns="item", values="c").fillna(0)
    m = wide.to_numpy()
    sims = np.round(m @ m.T / np.outer(np.linalg.norm(m, axis=1), np.linalg.norm(m, axis=1)), 10)
    np.fill_diagonal(sims, -np.inf)
    users = wide.index.to_numpy()
    for r, u in enumerate(users):
        order = sorted(range(len(users)), key=lambda k: (-sims[r, k], users[k]))[:5]
        mine = got[got["user"] == u].sort_values("rank")
        assert mine["other"].tolist() == [users[k] for k in order]


def test_blocks_send_few_copies(spark):
    """Training vectors are sent once per block of queries, not once per thousand of them; no pair of users is shuffled."""
    assert neighbours._query_blocks(900_000, 900_000 * 25, 50, 1024, 12) <= 24
    rows = [(u, f"i{i}", float((u * i) % 5)) for u in range(40) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "user int, item string, centred double")
    plan = neighbours.nearest_in_blocks(df, df, 3, 4)._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and plan.count("Exchange") == 1


def test_neighbours_cells_stay_in_their_task(spark, cells):
    """Whole vectors of neighbours are sent to a user; a row per neighbour and item is not."""
    plan = recommend.user_cf(cells[1], cells[1], 5)._jdf.queryExecution().executedPlan().toString().splitlines()
    made = next(i for i, line in enumerate(plan) if "Generate" in line and "arrays_zip" in line)
    above = next(line for line in reversed(plan[:made]) if "Exchange" in line)
    assert "code" in above and "partial" not in above
    aggregates = [i for i, line in enumerate(plan[:made]) if "Aggregate" in line]
    assert not any("Exchange" in line for line in plan[aggregates[-2] : made])


def test_best_so_far_in_small_tiles(monkeypatch):
    """Batches, tiles, slices of items and equal vectors, against a full sort."""
    for name, n in (("QUERY_ROWS", 4), ("TRAIN_ROWS", 7), ("ITEM_COLUMNS", 3)):
        monkeypatch.setattr(neighbours, name, n)
    rng = np.random.default_rng(4)
    m = rng.integers(-1, 2, (40, 8)).astype(float)
    m[5], m[17], m[33] = 0.0, m[2], m[2]

    def packed(lo, hi):
        return neighbours._Vectors(np.arange(lo, hi), np.full(hi - lo, 8), np.tile(np.arange(8), hi - lo), m[lo:hi].ravel())

    best = neighbours._Best([packed(0, 15), packed(15, 40)], 6)
    for lo in range(0, 40, 10):
        best.meet(packed(lo, lo + 10))
    got = {}
    for user, other, sim, rank in best.found():
        for u, o, s, r in zip(user.tolist(), other.tolist(), sim.tolist(), rank.tolist()):
            got.setdefault(u, []).append((r, o, s + 0.0))
    want = nearest_by_hand(pd.DataFrame([(u, i, m[u, i]) for u in range(40) for i in range(8)], columns=["user", "item", "centred"]), 6)
    assert {u: [(o, s) for _, o, s in sorted(x)] for u, x in got.items()} == want


def nearest_by_hand(pdf, nn):
    """The nearest users of each, from all pairs."""
    wide = pdf.pivot(index="user", columns="item", values="centred").fillna(0)
    m = wide.to_numpy()
    norms = np.linalg.norm(m, axis=1)
    users = wide.index.to_numpy()
    out = {}
    for r, u in enumerate(users):
        if norms[r] > 0:
            sims = {users[k]: round(float(m[r] @ m[k] / norms[r] / norms[k]), 10) + 0.0 for k in range(len(users)) if k != r and norms[k] > 0}
            out[u] = sorted(sims.items(), key=lambda x: (-x[1], x[0]))[:nn]
    return out


def sparse_ratings(n_users, n_items, per_user, seed):
    """Groups of users who like and dislike the same of 20 items, one item that a third of all rated, and a user without any deviation."""
    rng = np.random.default_rng(seed)
    taste = rng.choice([-2.0, -1.0, 1.0, 2.0], n_items)
    rows = [(10_000, "i0000", 0.0)]
    for u in range(n_users):
        group = rng.integers(0, n_items // 20) * 20
        items = set((group + rng.integers(0, 20, per_user)).tolist()) | set(rng.integers(0, n_items, 2).tolist()) | ({0} if u % 3 == 0 else set())
        rows += [(u, f"i{i:04d}", (0.5 if i == 0 else taste[i]) + 0.125 * int(rng.integers(-3, 4))) for i in items]
    return pd.DataFrame(rows, columns=["user", "item", "centred"])


@pytest.mark.parametrize("n_items,per_user,nn", [(600, 9, 5), (4_000, 4, 20)])
def test_nearest_users_by_index(spark, n_items, per_user, nn):
    pdf = sparse_ratings(400, n_items, per_user, nn)
    df = spark.createDataFrame(pdf)
    got = neighbours.nearest_users(df, df, nn, block=64).toPandas()
    mine = {u: [(r.other, r.sim + 0.0) for r in g.sort_values("rank").itertuples()] for u, g in got.groupby("user")}
    assert mine == nearest_by_hand(pdf, nn)


def test_index_meets_few_pairs(spark):
    """Pairs met and pairs that bounds leave over, against all pairs of users."""
    pdf = sparse_ratings(900, 2_000, 10, 3)
    df = spark.createDataFrame(pdf)
    cells, users = neighbours._unit(df), 900
    postings = cells.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    probes = neighbours.probe_heads(cells, postings, 3, users).agg(F.sum("n")).first()[0]
    heads = neighbours.query_heads(cells, neighbours.answer_bounds(cells, cells, postings, 3, users), postings)
    met, left = heads.agg(F.sum("n")).first()[0], neighbours.candidate_pairs(heads, cells).count()
    assert probes < users * 60
    assert left <= met < users * users / 20
    assert left < users * users / 40
    # the list of the item that a third rated is asked by few
    assert heads.where("item = 'i0000'").count() < users / 20


def test_unknown_cells(cells, monkeypatch):
    pdf, df = cells
    monkeypatch.setattr(recommend, "ITEM_CHUNK", 7)
    got = {(r["user"], r["item"]) for r in recommend.unknown_cells(df, df).collect()}
    known = set(zip(pdf["user"], pdf["item"], strict=True))
    assert got == {(u, i) for u in pdf["user"].unique() for i in pdf["item"].unique()} - known


def test_user_who_rated_all_gets_nothing(spark, cells):
    pdf, df = cells
    everything = spark.createDataFrame([(999, i, 3.0 + (k % 2)) for k, i in enumerate(sorted(pdf["item"].unique()))], df.schema)
    top = recommend.popular_top_n(df, df.unionByName(everything), 4).toPandas()
    assert 999 not in set(top["user"])
    assert top.groupby("user").size().max() == 4


def test_rating_split_counts(cells):
    pdf, df = cells
    parts = recommend.rating_split(df, 0.8, 3, 2).toPandas()
    assert len(parts) == len(pdf)
    test = parts[parts["part"] != "train"]
    assert not set(test["user"]) & set(parts.loc[parts["part"] == "train", "user"])
    assert (test[test["part"] == "known"].groupby("user").size() == 3).all()
    assert recommend.user_folds(df, 4).groupBy("user").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0


@pytest.fixture(scope="module")
def seasonal(spark):
    rng = np.random.default_rng(2)
    months = pd.date_range("2001-01-01", periods=72, freq="MS")
    shape = 10 * np.sin(2 * np.pi * np.arange(12) / 12)
    rows = []
    for key, slope in (("a", 0.5), ("b", -0.2)):
        for i, m in enumerate(months):
            rows.append((key, m.date(), float(100 + slope * i + shape[i % 12] + rng.normal(0, 0.3)), i + 1))
    return spark.createDataFrame(rows, "key string, ts date, value double, pos bigint")


def test_forecasts_follow_trend_and_season(seasonal):
    for table in (
        forecasting.seasonal_ar_forecast(seasonal, "key", 12, 24),
        forecasting.forecast_table(smoothing.ets(seasonal, "key", 12, 24, "AAA"), seasonal, "key", 24),
        forecasting.forecast_table(smoothing.ets(seasonal, "key", 12, 24), seasonal, "key", 24),
    ):
        pdf = table.toPandas().sort_values(["key", "h"])
        assert pdf.groupby("key").size().tolist() == [24, 24]
        assert (pdf["lo95"] < pdf["lo80"]).all() and (pdf["lo80"] < pdf["point"]).all() and (pdf["point"] < pdf["hi95"]).all()
        assert str(pdf["ts"].iloc[0]) == "2007-01-01"
        shape = 10 * np.sin(2 * np.pi * np.arange(24) / 12)
        for key, slope in (("a", 0.5), ("b", -0.2)):
            want = 100 + slope * (72 + np.arange(24)) + shape
            assert np.abs(pdf[pdf["key"] == key]["point"].to_numpy() - want).max() < 3.0


def test_ets_tables(seasonal):
    model = smoothing.ets(seasonal, "key", 12, 6, "AAA")
    assert forecasting.augment(model, "key").count() == 144
    assert forecasting.tidy(model, "key").count() == 6
    fit = forecasting.glance(model, "key", 12).toPandas()
    assert (fit["mase"] < 1).all() and (fit["rmse"] < 2).all()
    kinds = forecasting.sweep(model, seasonal, "key", 6).groupBy("series_kind").count().toPandas().set_index("series_kind")["count"]
    assert kinds.to_dict() == {"actual": 144, "fitted": 144, "forecast": 12}
    assert forecasting.components(model, "key").count() == 144 * 4


def test_order_choice_and_tests(seasonal):
    orders = forecasting.choose_order(seasonal, "key", 12).toPandas()
    assert orders.groupby("key")["chosen"].sum().tolist() == [1, 1]
    best = orders[orders["chosen"]]
    assert (best["aic"].to_numpy() == orders.groupby("key")["aic"].min().to_numpy()).all()
    box = timeseries.box_test(seasonal, "key", 12).toPandas()
    assert (box["p_ljung_box"] < 0.01).all()
    both = timeseries.pacf(seasonal, "key", 5).join(timeseries.acf(seasonal, "key", 5), ["key", "lag"]).where("lag = 1").toPandas()
    assert both["pacf"].to_numpy() == pytest.approx(both["acf"].to_numpy())


def test_pacf_of_ar1():
    r = 0.6 ** np.arange(6)
    assert timeseries.partial_from_acf(r) == pytest.approx([0.6, 0, 0, 0, 0], abs=1e-12)


def test_adf_separates_walk_from_noise(spark):
    rng = np.random.default_rng(4)
    noise = rng.normal(size=300)
    rows = [("noise", i + 1, float(v)) for i, v in enumerate(noise)] + [("walk", i + 1, float(v)) for i, v in enumerate(np.cumsum(noise))]
    got = timeseries.adf_test(spark.createDataFrame(rows, "key string, pos bigint, value double"), "key").toPandas().set_index("key")
    assert got.loc["noise", "p"] <= 0.01
    assert got.loc["walk", "p"] > 0.05


def test_signature_forecast_drops_aliased_columns(seasonal):
    pdf = timeseries.signature_forecast(seasonal, "key", 12).toPandas()
    assert len(pdf) == 24 and pdf["prediction"].between(50, 170).all()


def test_column_quantiles(spark):
    """Several columns at once: ties, both signs, zeros of both signs, infinities, missing ones, few values and none."""
    rng = np.random.default_rng(5)
    n = 30_000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float), "c": np.exp(rng.normal(0, 30, n)) * rng.choice([-1, 1], n), "d": np.nan, "e": 1e300})
    pdf.loc[:9, "e"] = [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324, 1.0, -1.0, np.nan, 2.0]
    pdf.loc[rng.random(n) < 0.3, "a"] = np.nan
    pdf.loc[5:, "f"] = np.nan
    pdf.loc[:4, "f"] = [3.0, 1.0, 2.0, -7.0, 2.0]
    probs = {"min": 0.0, "low": 0.001, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 0.9995, "max": 1.0}
    got = ordering.column_quantiles(spark.createDataFrame(pdf).repartition(5), list(pdf.columns), probs)
    for c in pdf.columns:
        x = pdf[c].dropna().to_numpy()
        for name, q in probs.items():
            if not len(x):
                assert got[c][name] is None
                continue
            s, h = np.sort(x), (len(x) - 1) * q
            lo, hi = s[math.floor(h)], s[math.ceil(h)]
            want = lo if lo == hi else lo + (h - math.floor(h)) * (hi - lo)
            assert got[c][name] == want or got[c][name] == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("bucket_rows", [1, 16, 10_000])
def test_bootstrap_of_exact_size(spark, monkeypatch, bucket_rows):
    """Every resample has as many draws as rows, runs agree, and draws per row are distributed as by a plain sampler."""
    monkeypatch.setattr(sampling, "SPLIT_BITS", 3)
    n, resamples = 700, 30
    df = spark.createDataFrame([(i, "x", float(i), None) for i in range(n)], "id bigint, node string, draw double, rows string")
    runs = [sampling.bootstrap_exact(d, ["id"], resamples, 4, bucket_rows).select("resample", "id", "draws").toPandas() for d in (df, df.repartition(5))]
    key = ["resample", "id"]
    assert runs[0].sort_values(key).to_numpy().tolist() == runs[1].sort_values(key).to_numpy().tolist()
    got = runs[0].pivot(index="id", columns="resample", values="draws").reindex(range(n)).fillna(0).to_numpy()
    assert (got.sum(0) == n).all() and got.shape == (n, resamples)
    rng = np.random.default_rng(9)
    plain = np.stack([np.bincount(rng.integers(0, n, n), minlength=n) for _ in range(resamples)], axis=1)
    cells = n * resamples
    for k in range(5):
        p = (plain == k).mean()
        assert abs((got == k).mean() - p) < 5 * np.sqrt(2 * p * (1 - p) / cells)
    # resamples and neighbouring rows do not depend on each other
    assert np.abs(np.corrcoef(got.T)[np.triu_indices(resamples, 1)]).max() < 5 / np.sqrt(n)
    assert abs(np.corrcoef(got[:-1].ravel(), got[1:].ravel())[0, 1]) < 5 / np.sqrt(cells)
    again = sampling.bootstrap_exact(df, ["id"], 2, 5, bucket_rows)
    assert again.columns == [*df.columns, "resample", "draws"]
    assert sampling.bootstrap_exact(df.where("false"), ["id"], 2).count() == 0


def plain_smoothing(x, form, period, weights, h):
    """Fitted values, forecasts and c (the effect of an error j steps later, by disturbing one), step by step."""
    error, trend, season = form[0], form[1:-1], form[-1]
    a, b, g, phi = weights
    phi = {"N": 0.0, "A": 1.0, "Ad": phi}[trend]
    level, slope, figure = smoothing.first_states(x, form, period)
    figure, fitted = list(figure), []
    for t in range(len(x) + h):
        s = figure[t % period]
        base = level + phi * slope
        point = base * s if season == "M" else base + s
        fitted.append(point)
        e = (x[t] - point) if t < len(x) else 0.0
        level = base + a * (e / s if season == "M" else e)
        slope = phi * slope + (b * (e / s if season == "M" else e) if trend != "N" else 0.0)
        if season != "N":
            figure[t % period] = s + g * (e / base if season == "M" else e)
    return np.array(fitted[: len(x)]), np.array(fitted[len(x) :])


@pytest.mark.parametrize("form", smoothing.FORMS)
def test_smoothing_forms_equal_plain_recursion(form):
    rng = np.random.default_rng(2)
    t, period, h, weights = np.arange(40), 4, 9, np.array([0.4, 0.1, 0.2, 0.9])
    x = (30 + 0.5 * t) * (1 + 0.2 * np.sin(np.pi * t / 2)) + rng.normal(0, 0.5, 40)
    fitted, ahead = plain_smoothing(x, form, period, weights, h)
    assert smoothing.smooth(x, form, period, weights[None, :])[0][:, 0] == pytest.approx(fitted)
    out = smoothing.forecasts(x, form, weights, period, h, 0.02 if form[0] == "M" else 0.5, 1)
    assert out["point"] == pytest.approx(ahead)
    wide = smoothing.spread(form, weights, period, h)
    if wide is not None:
        # an error of one at the last step moves the forecasts by its effect on them
        moved = np.append(x[:-1], x[-1] + 1.0)
        effect = plain_smoothing(moved, form, period, weights, h)[1] - ahead
        first = smoothing.first_states(x, form, period)
        assert smoothing.first_states(moved, form, period)[0] == pytest.approx(first[0])
        assert np.square(wide[1:]) - np.square(wide[:-1]) == pytest.approx(np.square(effect[:-1]))
    # simulated bounds agree with the formula, and with a plain simulation in all forms
    _, states, season = smoothing.smooth(x, form, period, weights[None, :])
    sd = 0.02 if form[0] == "M" else 0.5
    paths = smoothing.ahead(form, weights, period, len(x), states[-1, :, 0], season[0], np.random.default_rng(3).normal(0, sd, (20_000, h)))
    assert out["lo95"] == pytest.approx(np.percentile(paths, 2.5, axis=0), rel=0.02)
    assert out["hi80"] == pytest.approx(np.percentile(paths, 90, axis=0), rel=0.02)


def test_short_series_beside_a_long_one(spark, seasonal):
    """NULL results for series without values or steps enough; the others are not touched."""
    import datetime as dt

    def months(key, n, values):
        return [(key, dt.date(2010 + i // 12, i % 12 + 1, 1), values(i), i + 1) for i in range(n)]

    rows = months("one", 1, float) + months("three", 3, float) + months("year", 13, lambda i: 5.0 + i % 3) + months("nulls", 40, lambda i: None)
    rows += months("two years", 26, lambda i: 5.0 + i % 12) + months("flat", 40, lambda i: 2.0) + months(None, 40, lambda i: 2.0 + i % 5)
    both = seasonal.unionByName(spark.createDataFrame(rows, seasonal.schema))
    short = {"one", "three", "year", "nulls"}

    ar = forecasting.seasonal_ar_forecast(both, "key", 12, 6).toPandas()
    alone = forecasting.seasonal_ar_forecast(seasonal, "key", 12, 6).toPandas()
    assert set(ar[ar["point"].isna()]["key"]) == short | {"two years"}
    assert ar.groupby("key", dropna=False).size().unique().tolist() == [6]
    same = ar[ar["key"].isin(["a", "b"])].sort_values(["key", "h"])["point"].to_numpy()
    assert same == pytest.approx(alone.sort_values(["key", "h"])["point"].to_numpy())

    orders = forecasting.choose_order(both, "key", 12).toPandas()
    assert set(orders[orders["aic"].isna()]["key"]) == short | {"two years"}
    assert not orders[orders["aic"].isna()]["chosen"].any() and orders["chosen"].sum() == 4

    adf = timeseries.adf_test(both, "key").toPandas()
    assert len(adf) == 9 and set(adf[adf["p"].isna()]["key"]) == {"one", "three", "nulls", "flat"}

    table = forecasting.forecast_table(smoothing.ets(both, "key", 12, 6), both, "key", 6).toPandas()
    assert len(table) == 54
    assert set(table[table["point"].isna()]["key"]) == {"one", "three", "nulls"}
    seasonal_only = forecasting.forecast_table(smoothing.ets(both, "key", 12, 6, "AAA"), both, "key", 6).toPandas()
    assert set(seasonal_only[seasonal_only["point"].isna()]["key"]) == short
    forms = smoothing.choose_form(both, "key", 12).toPandas()
    assert set(forms[forms["form"].isna()]["key"]) == {"one", "three", "nulls"}
    model = smoothing.ets(both, "key", 12, 6)
    assert forecasting.augment(model, "key").where("key = 'nulls'").count() == 40
    assert forecasting.glance(model, "key", 12).count() == 9
    assert forecasting.sweep(model, both, "key", 6).count() == 2 * both.count() + 54


@pytest.fixture
def scattered(spark):
    """Two classes apart, in far more partitions than there are cores, as a join of two hundred leaves them."""
    rng = np.random.default_rng(31)
    rows = [(i, i % 2, [float(v) for v in rng.normal(3.0 * (i % 2), 0.5, 3)]) for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(60)
    return classification.features_from_array(df, "embedding")


def _parts_of_fit(monkeypatch, kind):
    seen, fit = [], kind._fit

    def spied(self, dataset):
        seen.append(dataset.rdd.getNumPartitions())
        return fit(self, dataset)

    monkeypatch.setattr(kind, "_fit", spied)
    return seen


def test_linear_machines_fit_packed_rows(spark, scattered, monkeypatch):
    seen = _parts_of_fit(monkeypatch, OneVsRest)
    got = classification.linear_svm(rounds=3).fit(scattered).transform(scattered)
    assert seen and max(seen) <= spark.sparkContext.defaultParallelism
    assert got.count() == 240 == got.where("prediction = label").count()


def test_grid_search_fits_packed_rows(spark, scattered, monkeypatch):
    seen = _parts_of_fit(monkeypatch, CrossValidator)
    model, table = classification.grid_search(scattered, classification.tree(), {"maxDepth": [1, 2]}, folds=2)
    assert seen and max(seen) <= spark.sparkContext.defaultParallelism
    assert sorted(r["parameters"] for r in table.collect()) == ["maxDepth=1", "maxDepth=2"]
    assert model.transform(scattered).where("prediction = label").count() == 240


def test_boosted_machines_fit_packed_rows(spark, scattered, monkeypatch):
    seen = _parts_of_fit(monkeypatch, OneVsRest)
    got = classification.boosted(rounds=2).fit(scattered).transform(scattered)
    assert seen and max(seen) <= spark.sparkContext.defaultParallelism
    assert got.count() == 240 == got.where("prediction = label").count()


def test_radial_machines_add_up_packed_rows(spark, scattered, monkeypatch):
    seen, plain = [], type(scattered).mapInPandas

    def spied(self, *rest, **named):
        seen.append(self.rdd.getNumPartitions())
        return plain(self, *rest, **named)

    monkeypatch.setattr(type(scattered), "mapInPandas", spied)
    got = classification.choose_gamma(scattered, ["vec_id"], "embedding", "label", 3, [0.1, 0.5], n=16, folds=2)
    assert len(seen) == 2 and max(seen) <= spark.sparkContext.defaultParallelism
    assert [g for g, _ in got] == [0.1, 0.5] and max(a for _, a in got) > 0.95
