"""NULL and text keys, missing predictions, calendar gaps, and series solved by themselves."""

import datetime as dt
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import basket, charts, smoothing, recommend, regression, relational, sampling, timeseries, windows


@pytest.fixture(scope="module")
def keyed(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [None, "a", "b"][i % 3], float(rng.integers(0, 50))) for i in range(300)]
    return rows, spark.createDataFrame(rows, "id int, k string, x double")


def groups(rows):
    out = {}
    for i, k, x in rows:
        out.setdefault(k, []).append((i, x))
    return out


def test_extremes_and_shares_keep_null_groups(keyed):
    rows, df = keyed
    want = set()
    for part in groups(rows).values():
        ends = (min(x for _, x in part), max(x for _, x in part))
        want |= {i for i, x in part if x in ends}
    assert {r["id"] for r in windows.group_extremes(df, ["k"], "x").collect()} == want
    shares = relational.share_of_total(df, ["k"], "x").groupBy("k").agg(F.sum("share").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert {r["k"]: (round(r["s"], 9), r["n"]) for r in shares} == {None: (1.0, 100), "a": (1.0, 100), "b": (1.0, 100)}


def test_box_and_split_keep_null_groups(keyed):
    rows, df = keyed
    box = {r["k"]: r["median"] for r in charts.box_stats(df, "x", ["k"]).collect()}
    assert box == {k: pytest.approx(np.median([x for _, x in part])) for k, part in groups(rows).items()}
    split = sampling.stratified_split(df, ["id"], "k", 0.75, 2).groupBy("k", "data").count().collect()
    assert {(r["k"], r["data"]): r["count"] for r in split} == {(k, d): n for k in (None, "a", "b") for d, n in (("train", 75), ("test", 25))}


def test_histogram_of_nothing(spark, keyed):
    assert charts.histogram_bins(keyed[1].where("false"), "x", 5).count() == 0


def test_text_key_of_the_largest_value(spark):
    df = spark.createDataFrame([("w", "g", 1.0), ("v", "g", 3.0), ("u", "g", 3.0), ("t", None, 2.0), (None, "g", 3.0)], "name string, k string, x double")
    assert relational.key_of_max(df, "name", "x").first()["name"] == "u"
    assert {r["k"]: r["name"] for r in relational.key_of_max(df, "name", "x", ["k"]).collect()} == {"g": "u", None: "t"}
    assert sorted(r["name"] or "" for r in relational.drop_key_of_max(df, "name", "x").collect()) == ["", "t", "v", "w"]


def test_r2_over_judged_rows_only(spark):
    y = [1.0, 2.0, 4.0, 7.0, 100.0, -50.0]
    p = [1.5, 1.5, 4.5, 6.5, None, None]
    got = regression.regression_report(spark.createDataFrame(list(zip(y, p)), "y double, p double"), "y", "p").first()
    a, b = np.array(y[:4]), np.array(p[:4], float)
    assert got["n"] == 4
    assert got["r2"] == pytest.approx(1 - ((a - b) ** 2).sum() / ((a - a.mean()) ** 2).sum())


@pytest.mark.parametrize("step, days", [("day", 1), ("week", 7), ("month", 31), ("quarter", 92)])
def test_missing_steps_have_rows(spark, step, days):
    start = dt.datetime(2020, 1, 1)
    rows = [(k, start + dt.timedelta(days=days * i), 1.0) for k in ("a", None) for i in (0, 1, 4, 5)] + [("a", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, x double")
    got = timeseries.regular_series(df, ["k"], "ts", F.sum("x"), step).orderBy("k", "pos").toPandas()
    for _, part in got.groupby("k", dropna=False):
        assert part["pos"].tolist() == list(range(1, len(part) + 1))
        assert part["value"].isna().tolist() == [False, False, True, True, False, False]


def test_signature_forecast_solves_each_series(spark):
    days = pd.date_range("2021-01-01", periods=400, freq="D")
    rows = [(k, d.date(), i + 1, s * d.year + 3.0 * d.month + 0.5 * d.day + s) for k, s in (("a", 2.0), ("b", -1.0)) for i, d in enumerate(days)]
    series = spark.createDataFrame(rows, "key string, ts date, pos bigint, value double")
    got = timeseries.signature_forecast(series, "key", 10).collect()
    assert len(got) == 20
    for r in got:
        s = 2.0 if r["key"] == "a" else -1.0
        assert r["prediction"] == pytest.approx(s * r["ts"].year + 3.0 * r["ts"].month + 0.5 * r["ts"].day + s, rel=1e-6)


def test_co_rated_products_in_pieces():
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"items": [np.array(sorted(rng.choice(30, n, replace=False)), int) for n in (0, 5, 30, 12)]})
    frame["values"] = [rng.normal(size=len(x)) for x in frame["items"]]
    want = np.zeros((30, 30))
    for items, values in zip(frame["items"], frame["values"]):
        want[np.ix_(items, items)] += np.outer(values, values)
    for most in (1 << 20, 100, 7):
        got = np.zeros((30, 30))
        for part in recommend._co_rated(frame, most):
            np.add.at(got, (part["item"].to_numpy(int), part["other"].to_numpy(int)), part["dot"].to_numpy())
        assert got == pytest.approx(want)


def test_co_rated_products_hold_little():
    """Peak memory of a full batch: numbers and one matrix, not names and products of all pairs."""
    rng = np.random.default_rng(3)
    names = np.array([f"Brand#{i}" for i in range(25)], object)
    frame = pd.DataFrame({"items": [names] * 10_000})
    frame["values"] = [rng.normal(size=25) for _ in range(10_000)]
    tracemalloc.start()
    parts = list(recommend._co_rated(frame))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(parts) == 1 and len(parts[0]) == 625 and peak < 24 << 20


def test_co_rated_missing_names_and_values():
    frame = pd.DataFrame({"items": [np.array(["a", None, "b"], object), np.array(["b", "a"], object)], "values": [np.array([1.0, 5.0, np.nan]), np.array([2.0, 3.0])]})
    for most in (1 << 20, 3):
        got = pd.concat(recommend._co_rated(frame, most)).groupby(["item", "other"])["dot"].sum().to_dict()
        assert got == {("a", "a"): 10.0, ("a", "b"): 6.0, ("b", "a"): 6.0, ("b", "b"): 4.0}


def test_item_lists_meet_users_in_copies(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(u, f"i{i:02d}", float(rng.integers(1, 6))) for u in range(40) for i in range(30) if rng.random() < 0.4]
    df = spark.createDataFrame(rows, "user int, item string, rating double")
    plain = [{tuple(r) for r in f().collect()} for f in (lambda: recommend.unknown_cells(df, df), lambda: recommend.popular_top_n(df, df, 4))]
    monkeypatch.setattr(recommend, "USER_SALT", 3)
    monkeypatch.setattr(recommend, "PLACES", 5)
    again = [{tuple(r) for r in f().collect()} for f in (lambda: recommend.unknown_cells(df, df), lambda: recommend.popular_top_n(df, df, 4))]
    assert plain == again


def test_rules_longer_than_three_and_long_pruning(spark):
    rows = [(t, i) for t in range(30) for i in "abcdef" if (t + ord(i)) % 7] + [(100, "z")]
    baskets = basket.transactions(spark.createDataFrame(rows, "t int, i string"), "t", "i")
    found = basket.rules(baskets, 0.3, 0.1, minlen=2)
    assert max(len(r["antecedent"]) for r in found.collect()) >= 3
    table = sorted(found.collect(), key=lambda r: (-round(r["lift"], 12), ",".join(r["antecedent"]), r["consequent"][0]))
    sets = [set(r["antecedent"]) | set(r["consequent"]) for r in table]
    kept = {(tuple(r["antecedent"]), r["consequent"][0]) for i, r in enumerate(table) if not any(sets[j] <= sets[i] for j in range(i))}
    assert {(tuple(r["antecedent"]), r["consequent"][0]) for r in basket.prune_rules(found, "lift").collect()} == kept


def test_smoothing_forms_follow_the_series(spark):
    rng = np.random.default_rng(4)
    t = np.arange(96)
    wave = np.sin(2 * np.pi * t / 12)
    made = {
        "flat": 50 + rng.normal(0, 1, 96),
        "add": 50 + 0.8 * t + 12 * wave + rng.normal(0, 0.6, 96),
        "mult": (40 + 2.0 * t) * (1 + 0.4 * wave) * (1 + rng.normal(0, 0.01, 96)),
    }
    rows = [(k, dt.date(2010 + i // 12, i % 12 + 1, 1), i + 1, None if k == "add" and i == 40 else float(v)) for k, x in made.items() for i, v in enumerate(x)]
    got = smoothing.choose_form(spark.createDataFrame(rows, "key string, ts date, pos bigint, value double"), "key", 12).toPandas()
    assert len(got) == 54 and got.groupby("key")["chosen"].sum().tolist() == [1, 1, 1]
    best = got[got["chosen"]].set_index("key")["form"]
    assert best["flat"][2] == "N"
    assert best["add"][1:] in ("AA", "AdA")
    assert best["mult"][2] == "M"
    assert smoothing.choose_form(spark.createDataFrame([("z", dt.date(2010 + i // 12, i % 12 + 1, 1), i + 1, float(i - 5)) for i in range(36)], "key string, ts date, pos bigint, value double"), "key", 12).count() == 6
