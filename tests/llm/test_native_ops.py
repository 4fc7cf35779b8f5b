"""URL filter, mixing and decontamination: plans without Python, odd rows, and brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import decontamination, exact_dedup, mixing, simhash_dedup, toxicity, url_filter
from millrace.llm.queries import QUERIES
from tests.conftest import DATA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op4_url_filter", "op6_mixing", "op8_decontamination"])
def test_native_queries_run_no_python(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for unwanted in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
        assert unwanted not in text


# ---------------------------------------------------------------- urls


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "key string")


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_cascade_is_exact_over_its_universe(spark, bits):
    rng = random.Random(bits)
    universe = [f"k{i}" for i in range(3000)]
    listed = rng.sample(universe, 400)
    levels = url_filter.cascade(keys(spark, [*listed, None, "elsewhere"]), keys(spark, [*universe, *listed, None]), bits)
    got = keys(spark, [*universe, None]).where(url_filter.in_cascade(levels, F.col("key"))).collect()
    assert sorted(r["key"] for r in got) == sorted(listed)
    if bits == 1:
        assert len(levels) > 3


def test_cascade_of_nothing_and_of_everything(spark):
    some = keys(spark, ["a", "b"])
    for listed, want in ((some.where("false"), 0), (some, 2)):
        levels = url_filter.cascade(listed, some)
        assert some.where(url_filter.in_cascade(levels, F.col("key"))).count() == want
    assert url_filter.cascade(some, some.where("false")) == []


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "a.net/"), ("allow", "a.net/"), ("allow", "net/x")]
URLS = {
    "https://x.example.NET/en/1?q=net/": ("x.example.net", "/en/1", "example.net/en/", "allow"),
    "https://x.example.net/de/1": ("x.example.net", "/de/1", "net/", "block"),
    "https://notnet/": ("notnet", "/", None, "allow"),
    "https://q.net/xyz": ("q.net", "/xyz", "net/x", "allow"),
    "https://a.net/y": ("a.net", "/y", "a.net/", "block"),
    "https://b.net": ("b.net", "", None, "allow"),
    "https://b.net?x": ("b.net", "", None, "allow"),
    "//b.net/": ("", "", None, "allow"),
    "x://spam.example.com#/": ("spam.example.com", "", None, "block"),
    "x://www.SPAM.example.com/a": ("www.spam.example.com", "/a", None, "block"),
    "x://myspam.example.com/a": ("myspam.example.com", "/a", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "x://a\nb.net/é": ("a\nb.net", "/é", "net/", "block"),
}


def test_urls(spark):
    rows = [(i, u, "old", 1) for i, u in enumerate([*URLS, *URLS])] + [(None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string, host int")
    got = url_filter.filter_urls(pages, RULES, ["Spam.example.com"])
    assert sorted(got.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["url"]]
    assert url_filter.filter_urls(pages.where("false"), RULES).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages, []).collect()} == {"allow"}


# ---------------------------------------------------------------- mixing


def filled(sizes, weights, share, most):
    """Targets by giving the excess of capped sources to the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, total, capped = {}, share * sum(sizes.values()), set()
    while len(capped) < len(sizes):
        rest = total - sum(most * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in sizes if s not in capped)
        goal = {s: most * sizes[s] if s in capped else rest * weight[s] / open_weight for s in sizes}
        over = {s for s in sizes if s not in capped and goal[s] > most * sizes[s]}
        if not over:
            break
        capped |= over
    return {s: most * sizes[s] if s in capped else goal[s] for s in sizes}


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_repeated_resharing(spark, seed):
    rng = random.Random(seed)
    names = [None, *(f"s{i}" for i in range(rng.randint(1, 12)))]
    rows = [(s, rng.choice([0, 1, 5, 40, 900])) for s in names for _ in range(rng.randint(1, 4))]
    sizes = {s: sum(n for x, n in rows if x == s) for s in names}
    got = mixing.source_targets(spark.createDataFrame(rows, "source string, size bigint"))
    got = {r["source"]: r["target"] for r in got.collect()}
    want = filled(sizes, (5, 2, 1), 1.5, 2.0)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in want)


def test_mix_comes_near_its_targets_and_repeats(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    first, again = (QUERIES["op6_mixing"](spark, "/root/testdata/sf0.1") for _ in range(2))
    assert first.exceptAll(again).count() == 0
    assert first.where("taken > 2 * size").count() == 0
    per = first.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert abs(sum(r["taken"] for r in per) / sum(r["target"] for r in per) - 1) < 0.03
    mixed = mixing.mix(table)
    assert mixed.columns == [*table.columns, "copy"]
    size = mixing.word_count(F.col("text"))
    assert mixed.agg(F.sum(size)).first()[0] == sum(r["taken"] for r in per)


def test_mix_odd_rows(spark):
    rows = [(1, "a b", None, 3), (1, "a b", None, 3), (2, None, "x", 1), (3, "", "x", 1), (None, "w " * 30_000, "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy int")
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "text", "source", "copy"]
    assert got.where("source = 'x'").count() == 0
    assert mixing.mix(docs.where("false")).count() == 0


# ---------------------------------------------------------------- decontamination


def contaminated(docs, items, window):
    """Hit words and items per document by trying every place."""
    import re

    def words(t):
        return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").encode().lower().decode())

    out = []
    for i, t in docs:
        w, hit, held = words(t), set(), set()
        for item, text in items:
            b = words(text)
            n = min(window, len(b))
            grams = {tuple(b[j : j + n]) for j in range(len(b) - n + 1)} if n else set()
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in grams:
                    hit |= set(range(at, at + n))
                    held.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(held), sorted(held), bool(hit)))
    return out


@pytest.mark.parametrize("short", [False, True])
def test_winnowing_loses_nothing(spark, short):
    rng = random.Random(3)
    letters = "abcd"
    item = [(i, " ".join(rng.choice(letters) for _ in range(rng.randint(10, 16)))) for i in range(12)]
    if short:
        item += [(20, "a b c d a b c"), (21, "d, D"), (22, None), (23, "!"), (None, "a a a"), (24, "d, D")]
    docs = [(i, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    docs += [(100 + i, "x é " + t.upper().replace(" ", "\n-") + " y") for i, (_, t) in enumerate(item) if t]
    docs += [(200, None), (200, None), (201, ""), (None, docs[70][1]), (3, docs[3][1])]
    frame = spark.createDataFrame([(i, t, 1, True) for i, t in docs], "doc_id bigint, text string, item int, words boolean")
    items = spark.createDataFrame([(i, t, 1) for i, t in item], "item_id bigint, text string, words int")
    got = decontamination.decontaminate(frame, items).collect()
    want = contaminated(docs, item, 10)
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    left = decontamination.without_benchmark(frame, items)
    assert left.columns == frame.columns
    assert left.count() == sum(not w[-1] for w in want)


def test_long_spans_of_short_windows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 30_000), (2, "b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a " * 40)], "item_id bigint, text string")
    got = {r["doc_id"]: r for r in decontamination.decontaminate(docs, items).collect()}
    assert (got[1]["n_hit"], got[2]["n_hit"]) == (30_000, 0)
    assert decontamination.decontaminate(docs, items.where("false")).where("contaminated").count() == 0
    assert decontamination.decontaminate(docs.where("false"), items).count() == 0
    assert decontamination.without_benchmark(docs, items.where("false")).count() == 2


# ---------------------------------------------------------------- names


CLASH = "doc_id bigint, text string, source string, __k bigint, __s string, __c int, __h bigint, __hh int, __sha string, __score double, __n int, __key int, __body int, own_k int, at int, copy int, rate int"


def test_columns_of_any_name_pass_through(spark):
    """Columns named like an operator's own, and keys and texts under such names."""
    rows = [(i, f"text number {i % 3} of some few words here {'and more of it ' * (i % 3)}", "s", i, "x", 1, 2, 3, "y", 0.25, 4, 5, 6, 7, 8, 9, 10) for i in range(9)]
    docs = spark.createDataFrame(rows, CLASH)
    items = spark.createDataFrame([("i", rows[1][1])], "item_id string, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    kept = {
        "exact": exact_dedup.without_copies(docs, keep="max"),
        "near": simhash_dedup.one_of_each(docs, bits=0),
        "leaks": decontamination.without_benchmark(docs, items),
        "toxic": toxicity.without_toxic(docs, model, cut=2.0),
    }
    want = {"exact": {6, 7, 8}, "near": {0, 1, 2}, "leaks": {0, 2, 3, 5, 6, 8}, "toxic": set(range(9))}
    for name, out in kept.items():
        assert out.columns == docs.columns
        got = out.collect()
        assert {r["doc_id"] for r in got} == want[name] and {tuple(r) for r in got} <= set(rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == [c for c in docs.columns if c not in ("copy", "rate")] + ["copy"]
    assert mixed.count() >= 9

    names = {"doc_id": "__k", "text": "__sha", "__k": "doc_id", "__sha": "text"}
    odd = docs.withColumnsRenamed({"doc_id": "a1", "text": "b1", "__k": "c1", "__sha": "d1"}).withColumnsRenamed({"a1": "__k", "b1": "__sha", "c1": "doc_id", "d1": "text"})
    assert set(names) <= set(odd.columns)
    assert {r["__k"] for r in exact_dedup.without_copies(odd, "__k", "__sha", keep="max").collect()} == {6, 7, 8}
    assert {r["__k"] for r in decontamination.without_benchmark(odd, items, "__k", "__sha").collect()} == want["leaks"]
    assert {r["__k"] for r in simhash_dedup.one_of_each(odd, "__k", "__sha", bits=0).collect()} == {0, 1, 2}
    assert {r["__k"] for r in toxicity.without_toxic(odd, model, "__sha", cut=2.0).collect()} == set(range(9))

    at = docs.withColumn("at", F.col("doc_id")).select("at", "text")
    got = {r["at"]: r["contaminated"] for r in decontamination.decontaminate(at, items, key="at").collect()}
    assert {i for i, bad in got.items() if bad} == {1, 4, 7}


def test_listed_hosts_from_a_table(spark):
    pages = spark.createDataFrame([("http://a.Bad.example/x", 1), ("http://good.example/", 2)], "url string, __up int")
    listed = spark.createDataFrame([("BAD.example",), (None,)], "host string")
    got = url_filter.filter_urls(pages, [], listed)
    assert got.columns == ["url", "__up", "host", "path", "rule", "verdict"]
    assert {r["__up"]: r["verdict"] for r in got.collect()} == {1: "block", 2: "allow"}
