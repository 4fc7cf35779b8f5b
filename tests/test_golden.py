"""Published numbers on small fixtures."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import basket as B
from millrace.operators import regression as G
from millrace.operators import relational as R
from millrace.operators import text as X
from millrace.sources import files, tables

# The public table of 32 cars.
CARS = """Mazda RX4,21,6,160,110,3.9,2.62,16.46,0,1,4,4
Mazda RX4 Wag,21,6,160,110,3.9,2.875,17.02,0,1,4,4
Datsun 710,22.8,4,108,93,3.85,2.32,18.61,1,1,4,1
Hornet 4 Drive,21.4,6,258,110,3.08,3.215,19.44,1,0,3,1
Hornet Sportabout,18.7,8,360,175,3.15,3.44,17.02,0,0,3,2
Valiant,18.1,6,225,105,2.76,3.46,20.22,1,0,3,1
Duster 360,14.3,8,360,245,3.21,3.57,15.84,0,0,3,4
Merc 240D,24.4,4,146.7,62,3.69,3.19,20,1,0,4,2
Merc 230,22.8,4,140.8,95,3.92,3.15,22.9,1,0,4,2
Merc 280,19.2,6,167.6,123,3.92,3.44,18.3,1,0,4,4
Merc 280C,17.8,6,167.6,123,3.92,3.44,18.9,1,0,4,4
Merc 450SE,16.4,8,275.8,180,3.07,4.07,17.4,0,0,3,3
Merc 450SL,17.3,8,275.8,180,3.07,3.73,17.6,0,0,3,3
Merc 450SLC,15.2,8,275.8,180,3.07,3.78,18,0,0,3,3
Cadillac Fleetwood,10.4,8,472,205,2.93,5.25,17.98,0,0,3,4
Lincoln Continental,10.4,8,460,215,3,5.424,17.82,0,0,3,4
Chrysler Imperial,14.7,8,440,230,3.23,5.345,17.42,0,0,3,4
Fiat 128,32.4,4,78.7,66,4.08,2.2,19.47,1,1,4,1
Honda Civic,30.4,4,75.7,52,4.93,1.615,18.52,1,1,4,2
Toyota Corolla,33.9,4,71.1,65,4.22,1.835,19.9,1,1,4,1
Toyota Corona,21.5,4,120.1,97,3.7,2.465,20.01,1,0,3,1
Dodge Challenger,15.5,8,318,150,2.76,3.52,16.87,0,0,3,2
AMC Javelin,15.2,8,304,150,3.15,3.435,17.3,0,0,3,2
Camaro Z28,13.3,8,350,245,3.73,3.84,15.41,0,0,3,4
Pontiac Firebird,19.2,8,400,175,3.08,3.845,17.05,0,0,3,2
Fiat X1-9,27.3,4,79,66,4.08,1.935,18.9,1,1,4,1
Porsche 914-2,26,4,120.3,91,4.43,2.14,16.7,0,1,5,2
Lotus Europa,30.4,4,95.1,113,3.77,1.513,16.9,1,1,5,2
Ford Pantera L,15.8,8,351,264,4.22,3.17,14.5,0,1,5,4
Ferrari Dino,19.7,6,145,175,3.62,2.77,15.5,0,1,5,6
Maserati Bora,15,8,301,335,3.54,3.57,14.6,0,1,5,8
Volvo 142E,21.4,4,121,109,4.11,2.78,18.6,1,1,4,2"""
NAMES = ["mpg", "cyl", "disp", "hp", "drat", "wt", "qsec", "vs", "am", "gear", "carb"]


@pytest.fixture(scope="module")
def cars(spark):
    rows = [(r.split(",")[0], *map(float, r.split(",")[1:])) for r in CARS.splitlines()]
    df = spark.createDataFrame(rows, ["model", *NAMES])
    return df.withColumns({"am0": (F.col("am") == 0).cast("double"), "am1": (F.col("am") == 1).cast("double")})


def test_car_model(spark, cars):
    fit = G.ols(G.gram(cars, "mpg", ["wt", "am0", "am1", "qsec"]), intercept=False)
    est = fit.estimates()
    assert est["wt"] == pytest.approx(-3.9165, abs=5e-5)
    assert est["am0"] == pytest.approx(9.6178, abs=5e-5)
    assert est["am1"] == pytest.approx(12.5536, abs=2e-4)
    assert est["qsec"] == pytest.approx(1.226, abs=5e-4)
    bounds = {r["term"]: (r["lo"], r["hi"]) for r in fit.table(spark).collect()}
    assert bounds["am0"] == pytest.approx((-4.64, 23.87), abs=0.01)
    assert bounds["am1"] == pytest.approx((0.15, 24.96), abs=0.01)


def test_backward_selection(spark, cars):
    dummies = {
        "cyl": S.dummies("cyl", [4.0, 6.0, 8.0], 4.0),
        "am": S.dummies("am", [0.0, 1.0], 0.0),
    }
    plain = [n for n in NAMES[1:] if n not in dummies]
    x = {**{n: F.col(n) for n in plain}, **dummies["cyl"], **dummies["am"]}
    terms = {**{n: [n] for n in plain}, **{k: list(v) for k, v in dummies.items()}}
    best, path = G.step_backward(G.gram(cars, "mpg", x), terms)
    assert sorted(best.names) == ["am_1.0", "qsec", "wt"]
    assert [a for _, a in path] == sorted((a for _, a in path), reverse=True)


def test_most_influential_car(spark, cars):
    x = ["wt", "am0", "am1", "qsec"]
    fit = G.ols(G.gram(cars, "mpg", x), intercept=False)
    cook = G.influence(cars, fit)
    top = cook.orderBy(F.desc("cook")).first()
    assert top["model"] == "Chrysler Imperial"
    again = G.ols(G.gram(cars.where("model <> 'Chrysler Imperial'"), "mpg", x), intercept=False).estimates()
    assert again["am1"] == pytest.approx(15.866, abs=5e-3)
    assert again["am0"] == pytest.approx(13.668, abs=5e-3)
    assert cook.agg(F.sum("hat")).first()[0] == pytest.approx(4.0)


def test_normalised_fit_needs_no_intercept(cars):
    from millrace.operators.charts import standardise

    g = G.gram(standardise(cars, ["mpg", "wt"]), "mpg_z", ["wt_z"])
    with_one, without = G.ols(g), G.ols(g, intercept=False)
    assert with_one.estimates()["(Intercept)"] == pytest.approx(0.0, abs=1e-12)
    assert with_one.estimates()["wt_z"] == pytest.approx(without.estimates()["wt_z"])


def test_collinear_column_is_reported(cars):
    doubled = cars.withColumn("twice", F.col("wt") * 2)
    fit = G.ols(G.gram(doubled, "mpg", ["wt", "twice", "qsec"]))
    assert fit.aliased == ["twice"]
    assert fit.estimates() == pytest.approx(G.ols(G.gram(cars, "mpg", ["wt", "qsec"])).estimates())


def test_wide_gram_equals_narrow(cars, monkeypatch):
    def grams():
        rows = G.grouped_grams(cars, "mpg", ["wt", "qsec", "hp"], ["gear"]).collect()
        return {r["g0"]: (r["n"], *r["means"], *r["upper"]) for r in rows}, G.gram(cars, "mpg", ["wt", "qsec", "hp"])

    (narrow, whole), _ = grams(), monkeypatch.setattr(G, "MAX_JVM_COLUMNS", 1)
    wide, again = grams()
    assert narrow.keys() == wide.keys()
    for k in narrow:
        assert narrow[k] == pytest.approx(wide[k])
    assert whole.n == again.n and whole.cross == pytest.approx(again.cross)


def test_confidence_differs_by_direction(spark):
    rows = [(1, ["Headset", "iPhone"]), (2, ["Headset", "iPhone"]), (3, ["iPhone"]), (4, ["iPhone"])]
    table = B.rule_table(B.rules(spark.createDataFrame(rows, "tx int, items array<string>"), 0.1, 0.1, minlen=2))
    got = {(r["lhs"], r["rhs"]): r["confidence"] for r in table.collect()}
    assert got == {("iPhone", "Headset"): 0.5, ("Headset", "iPhone"): 1.0}


TOY = ["acde", "abe", "bd", "bcde", "abd", "ade", "bce", "abde", "ce", "bcd", "abcde"]


@pytest.fixture(scope="module")
def toy(spark):
    return spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(TOY)], "tx int, items array<string>")


def test_rules_by_counting(toy):
    n = len(TOY)

    def count(items):
        return sum(set(items) <= set(s) for s in TOY)

    rows = B.rules(toy, 0.2, 0.6, minlen=1).collect()
    assert rows
    for r in rows:
        both = count([*r["antecedent"], *r["consequent"]])
        assert r["count"] == both
        assert r["support"] == pytest.approx(both / n)
        assert r["confidence"] == pytest.approx(both / (count(r["antecedent"]) if r["antecedent"] else n))
        assert r["lift"] == pytest.approx(r["confidence"] / (count(r["consequent"]) / n))
    assert any(not r["antecedent"] for r in rows)


def test_prune_rules_by_comparing_all(toy):
    found = B.rules(toy, 0.1, 0.3, minlen=2)
    rows = sorted(found.collect(), key=lambda r: (-round(r["lift"], 12), ",".join(r["antecedent"]), ",".join(r["consequent"])))
    sets = [set(r["antecedent"]) | set(r["consequent"]) for r in rows]
    kept = {
        (tuple(r["antecedent"]), tuple(r["consequent"]))
        for i, r in enumerate(rows)
        if not any(sets[j] <= sets[i] for j in range(i))
    }
    got = {(tuple(r["antecedent"]), tuple(r["consequent"])) for r in B.prune_rules(found, "lift").collect()}
    assert got == kept


POEM = [
    "Because I could not stop for Death -",
    "He kindly stopped for me -",
    "The Carriage held but just Ourselves -",
    "and Immortality",
]


def test_poem_words(spark):
    df = spark.createDataFrame(list(enumerate(POEM, start=1)), "line int, text string")
    got = [(r["line"], r["word"]) for r in X.tokenize(df, "text", position="i").orderBy("line", "i").collect()]
    assert len(got) == 20
    assert got[:4] == [(1, "because"), (1, "i"), (1, "could"), (1, "not")]
    assert got[-2:] == [(4, "and"), (4, "immortality")]


def test_insert_with_partial_columns_and_gaps(spark):
    have = spark.createDataFrame([(1, "a", "x", 10), (2, "b", "y", 20)], "id int, name string, dept string, salary int")
    new = spark.createDataFrame([(7, "c"), (None, "d"), (None, "e")], "id int, name string")
    rows = {r["name"]: (r["id"], r["salary"]) for r in tables.append_with_ids(have, new, "id", ["name"]).collect()}
    assert rows == {"a": (1, 10), "b": (2, 20), "c": (7, None), "d": (8, None), "e": (9, None)}


def test_missing_covers_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "id int, x double")
    assert [r["id"] for r in R.complete_rows(df).collect()] == [1]
    assert [r["complete"] for r in R.complete_flag(df).orderBy("id").collect()] == [True, False, False]


def test_csv_null_token_and_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,name,delay\n1,"Smith, ""J""",NA\n2,plain,5\n')
    rows = files.read_csv(spark, str(path), "id int, name string, delay int", null_token="NA").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 'Smith, "J"', None), (2, "plain", 5)]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [r[0] for r in df.select(S.round_half_even("x")).collect()] == [0.0, 2.0, 2.0]


def test_null_condition_gives_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    assert [r[0] for r in df.select(S.if_else(F.col("c"), F.lit(1), F.lit(0))).collect()] == [1, 0, None]
