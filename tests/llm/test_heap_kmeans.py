"""K-means with heap-ordered bounds against plain rounds in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from millrace.llm import heap_kmeans

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, id int, distance double, scans int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 0.5, 9) for i, v in rows], SCHEMA)


def plain(rows, k, rounds, width, scale, seed):
    """(vec_id, cluster, distance) of every usable vector, and the centroids."""
    good = [(i, v) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    draw = lambda i: (i is None, hashlib.sha256(f"{seed}{i}".encode()).hexdigest())
    centres = [[math.floor(scale * x) for x in v] for _, v in sorted(good, key=lambda r: (*draw(r[0]), r[1]))[:k]]
    points = [[math.floor(scale * x) for x in v] for _, v in good]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centres)) for p in points]

    for _ in range(rounds):
        own = [j for _, j in assign()]
        for j in range(len(centres)):
            mine = [p for p, o in zip(points, own) if o == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, j, d) for (i, _), (d, j) in zip(good, assign())], centres


def check(got, rows, *how):
    want, centres = plain(rows, *how)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["centroid"] == centres[r["cluster"]]
        assert r["cluster_inertia"] == sum(d for _, j, d in want if j == r["cluster"])
        assert r["inertia"] == sum(d for _, _, d in want)


def blobs(n, width, seed, spread):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    return [(i, [m + rng.gauss(0, spread) for m in middles[i % 5]]) for i in range(n)]


@pytest.mark.parametrize("k,rounds,spread", [(1, 2, 0.3), (5, 4, 0.02), (7, 5, 0.3), (40, 5, 0.3)])
def test_equals_plain_rounds(spark, monkeypatch, k, rounds, spread):
    monkeypatch.setattr(heap_kmeans, "BLOCK", 37)
    rows = blobs(400, 6, k, spread)
    got = heap_kmeans.cluster_vectors(frame(spark, rows).repartition(5), k, rounds, 6, 256, "s").collect()
    check(got, rows, k, rounds, 6, 256, "s")


def test_gaps_spare_scans(spark):
    rows = blobs(1000, 8, 3, 0.01)
    got = heap_kmeans.cluster_vectors(frame(spark, rows), 5, 6, 8, 256, "").collect()
    check(got, rows, 5, 6, 8, 256, "")
    assert sum(r["scans"] for r in got) < 4 * len(rows)  # seven assignments


def test_odd_rows_ties_and_repeats(spark):
    same = [0.5, -0.25]
    rows = [(1, same), (2, same), (2, same), (2, [0.1, 0.2]), (None, same), (None, [9.0, 9.0]), (5, None), (6, []), (7, [1.0]), (8, [1.0, None])]
    rows += [(9, [1.0, math.nan]), (10, [math.inf, 0.0]), (11, [-1e-9, 1e6]), (12, [0.0, 0.0, 0.0])]
    rows += [(20 + i, [x, y]) for i, (x, y) in enumerate([(0, 1), (1, 0), (0, -1), (-1, 0)])]
    rows = [(i, v if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    for k in (3, 100):
        got = heap_kmeans.cluster_vectors(frame(spark, rows), k, 3, 2, 256, "2:").collect()
        check(got, rows, k, 3, 2, 256, "2:")


def test_large_numbers_are_exact_and_larger_ones_refused():
    big = np.array([[1 << 29, -(1 << 29)], [(1 << 29) - 1, 3]])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in big] for x in big]
    assert heap_kmeans.distances(big, big).tolist() == want
    with pytest.raises(ValueError):
        heap_kmeans.distances(big * 4, -big * 4)
    with pytest.raises(ValueError):
        heap_kmeans.whole(np.array([1e12]), 256)


def test_empty_table(spark):
    for rows in ([], [(1, None)]):
        got = heap_kmeans.cluster_vectors(frame(spark, rows), 4, 2, 2, 256)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "scans"]
        assert got.count() == 0
