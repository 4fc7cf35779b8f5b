"""Exact and SimHash dedup against plain Python, and their odd inputs."""

import hashlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import components, exact_dedup, simhash_dedup
from tests.conftest import DATA

DOC = "doc_id bigint, text string, source string, kept boolean, id bigint"


def low(text):
    return (text or "").encode().lower().decode()


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "s", None, 7) for i, t in pairs], DOC)


ODD = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (5, "É"), (6, "é"), (6, "é"), (None, "a b"), (None, "x"), (8, "w " * 50_000)]


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("partitions", [1, 2, 64])
def test_exact_groups(spark, keep, partitions):
    pairs = ODD + [(100 + i, f"copy {i % 3}") for i in range(300)]
    got = exact_dedup.exact_groups(docs(spark, pairs).repartition(7), keep=keep, partitions=partitions).collect()
    groups = defaultdict(list)
    for i, t in pairs:
        groups[low(t)].append(i)
    want = Counter()
    for i, t in pairs:
        own = groups[low(t)]
        best = (min if keep == "min" else max)((x for x in own if x is not None), default=None)
        want[i, best, len(own), i == best, hashlib.sha256(low(t).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got) == want


def test_runs_of_several_batches(spark):
    # an Arrow batch holds 10,000 rows, so each partition merges three
    rows = spark.range(0, 60_000, 1, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id") % 25_000).alias("text"))
    got = exact_dedup.exact_groups(rows, partitions=4)
    sizes = {(r["group_size"], r["kept"]): r["count"] for r in got.groupBy("group_size", "kept").count().collect()}
    assert sizes == {(3, True): 10_000, (3, False): 20_000, (2, True): 15_000, (2, False): 15_000}
    assert got.where(F.col("keep_id") != F.col("doc_id") % 25_000).count() == 0
    assert exact_dedup.without_copies(rows, keep="max").agg(F.min("doc_id"), F.count("doc_id")).first() == (35_000, 25_000)


def test_copies_go(spark):
    left = exact_dedup.without_copies(docs(spark, ODD))
    assert left.columns == [c.split()[0] for c in DOC.split(", ")]
    assert sorted((r["doc_id"] or 0, r["text"] and r["text"][:3]) for r in left.collect()) == [
        (0, "x"), (1, "A b"), (3, None), (5, "É"), (6, "é"), (8, "w w"),
    ]


def test_colliding_short_hash_keeps_both(spark):
    rows = [(1, 5, b"a" * 32, 3), (2, 5, b"b" * 32, 3), (3, 5, b"a" * 32, 3), (4, 5, b"a" * 32, 4)]
    entries = spark.createDataFrame([(i, s, bytearray(h), n) for i, s, h, n in rows], "id bigint, short bigint, sha binary, n_bytes bigint")
    got = exact_dedup.merge_runs(entries.repartition(4), 8).collect()
    assert sorted((r["id"], r["n"]) for r in got) == [(1, 2), (2, 1), (4, 1)]


def fingerprint(text, width=3):
    words = [w for w in low(text).translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(points, bits):
    """Smallest key reachable from each (key, fingerprint), by comparing all."""
    best = {i: i for i, _ in points}
    changed = True
    while changed:
        changed = False
        for i, x in points:
            for j, y in points:
                if (x ^ y).bit_count() <= bits and best[j] < best[i]:
                    best[i], changed = best[j], True
    return best


def test_simhash_equals_brute_force(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    want = {r["doc_id"]: fingerprint(r["text"]) for r in table.collect()}
    got = simhash_dedup.near_groups(table).withColumn("hex", simhash_dedup.fingerprint_hex(F.col("fp"))).collect()
    assert {r["doc_id"]: int(r["hex"], 16) for r in got} == want
    assert {r["doc_id"]: r["component_id"] for r in got} == linked(list(want.items()), 2)


@pytest.mark.parametrize("group", [2_000, 3])
def test_pairs_lose_no_link(spark, group):
    """Also where groups are so small that nearly all of them link by shared neighbours."""
    base = [xxhash.xxh64_intdigest(b"%d" % i) for i in range(6)]
    prints = {b ^ (1 << i) ^ (1 << (i * 7 + j) % 64) for b in base for i in range(20) for j in range(4)}
    points = [(i, p) for i, p in enumerate(sorted(prints))]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in points]
    edges = simhash_dedup.near_pairs(spark.createDataFrame(signed, "node bigint, fp bigint"), 2, group)
    names = {i: i for i, _ in points} | {r["node"]: r["component"] for r in components.connected_components(edges, "a", "b").collect()}
    assert names == linked(points, 2)
    by = dict(points)
    assert all((by[r["a"]] ^ by[r["b"]]).bit_count() <= 2 for r in edges.collect())


def test_simhash_odd_rows(spark):
    got = simhash_dedup.near_groups(docs(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {(r["doc_id"], r["fp"]): r["component_id"] for r in got}
    assert by[3, 0] == by[4, 0] == 3
    assert all(c is None for (i, _), c in by.items() if i is None)
    left = simhash_dedup.one_of_each(docs(spark, ODD))
    assert left.where("doc_id = 6").count() + left.where("doc_id = 5").count() >= 1
    assert left.where("doc_id is null").count() == 2
    assert left.columns == [c.split()[0] for c in DOC.split(", ")]


def test_repeated_key_links_its_texts(spark):
    rows = [(1, "alpha beta gamma delta"), (2, "one two three four"), (5, "alpha beta gamma delta"), (5, "one two three four")]
    got = simhash_dedup.near_groups(docs(spark, rows)).collect()
    assert {r["component_id"] for r in got} == {1}


def test_empty_tables(spark):
    none = docs(spark, [(1, "a")]).where("false")
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.without_copies(none).count() == 0
    assert simhash_dedup.near_groups(none).count() == 0
    assert simhash_dedup.one_of_each(none).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(10, 60)]
    star = [(100, 100 + i) for i in range(1, 40)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components.connected_components(edges, "a", "b").collect()}
    assert got == {i: 10 for i in range(10, 61)} | {i: 100 for i in range(100, 140)}
