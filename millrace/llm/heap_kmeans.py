"""K-means on whole-number vectors with heap-ordered bounds.

Vectors lie in blocks of at most 4,096, one row each, and never leave their
block: a round is one map over the blocks, written to the shared folder, and
the blocks of the round before are deleted.  There is no shuffle but that of
the clusters' sums.

In each block every cluster keeps a heap of its vectors.  A vector enters with
the gap between the distances to the second and to the nearest centroid, plus
the drift its cluster has accumulated so far.  In every round a cluster's drift
grows by the way its own centroid moved and the longest way of any other; a gap
that the drift has not reached proves that the vector's centroid is still
strictly the nearest.  Only vectors whose gap has expired are popped, measured
against all centroids exactly, and pushed with their new gap; the sums change
by those that moved.

Vectors are multiplied by ``scale`` and floored, so distances, sums and means
are exact whole numbers, and ties go to the smaller cluster number.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import discard, stable, stored

#: vectors of a block
BLOCK = 4_096
STATE = (
    "ids array<bigint>, kind string, points binary, own binary, scans binary, "
    "heap_keys binary, heap_rows binary, heap_sizes binary, sums binary, counts binary"
)
NAMES = [part.split()[0] for part in STATE.split(", ")]
#: what rounding may take from a gap, in proportion and in full
SLACK = 1e-9


@dataclass
class Centres:
    """Centroids (k x width whole numbers) and the drift each cluster has accumulated."""

    at: np.ndarray
    drift: np.ndarray

    def moved(self, to: np.ndarray) -> Centres:
        way = np.sqrt(((to - self.at).astype(float) ** 2).sum(1)) * (1 + SLACK)
        # the longest way among the others: the second longest for the one that went farthest
        other = np.full(len(way), way.max(initial=0.0))
        if len(way):
            far = int(way.argmax())
            other[far] = np.delete(way, far).max(initial=0.0)
        return Centres(to, self.drift + way + other)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances, n x k; raises where they do not fit a 64-bit number."""
    width = points.shape[1]
    most = 2 * max(int(np.abs(points).max(initial=0)), int(np.abs(centres).max(initial=0)))
    if width * most * most < 1 << 53:  # every step is a whole number that a double holds
        p, c = points.astype(float), centres.astype(float)
        return ((p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)).astype(np.int64)
    if width * most * most >= 1 << 63:
        raise ValueError("vectors too large: a squared distance needs more than 64 bits")
    p = points.astype(np.int64)
    return np.stack([((p - c) ** 2).sum(1) for c in centres.astype(np.int64)], axis=1)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number), its squared distance, and the gap to the second."""
    d = distances(points, centres)
    own = d.argmin(1)
    rows = np.arange(len(d))
    best = d[rows, own].copy()
    if d.shape[1] == 1:
        return own, best, np.full(len(d), np.inf)
    d[rows, own] = np.iinfo(np.int64).max
    gap = np.sqrt(d.min(1).astype(float)) - np.sqrt(best.astype(float))
    return own, best, gap * (1 - SLACK) - SLACK


class Block:
    """Vectors of a block, the cluster of each, one heap per cluster, and the clusters' sums."""

    def __init__(self, points: np.ndarray, own: np.ndarray, scans: np.ndarray, heaps: list, sums: np.ndarray, counts: np.ndarray):
        self.points, self.own, self.scans, self.heaps, self.sums, self.counts = points, own, scans, heaps, sums, counts

    @classmethod
    def fresh(cls, points: np.ndarray, centres: Centres) -> Block:
        k, n = len(centres.at), len(points)
        block = cls(points, np.full(n, -1, np.int32), np.zeros(n, np.int32), [[] for _ in range(k)], np.zeros((k, points.shape[1]), np.int64), np.zeros(k, np.int64))
        block.rescan(np.arange(n), centres)
        return block

    def rescan(self, rows: np.ndarray, centres: Centres) -> None:
        """Measure ``rows``, which are on no heap, against all centroids and push them again."""
        if not len(rows):
            return
        own, _, gap = nearest(self.points[rows], centres.at)
        self.scans[rows] += 1
        for cluster, row, key in zip(own.tolist(), rows.tolist(), (gap + centres.drift[own]).tolist()):
            heapq.heappush(self.heaps[cluster], (key, row))
        gone = rows[(self.own[rows] != own) & (self.own[rows] >= 0)]
        new = self.own[rows] != own
        np.subtract.at(self.sums, self.own[gone], self.points[gone].astype(np.int64))
        np.subtract.at(self.counts, self.own[gone], 1)
        np.add.at(self.sums, own[new], self.points[rows[new]].astype(np.int64))
        np.add.at(self.counts, own[new], 1)
        self.own[rows] = own

    def expire(self, centres: Centres) -> None:
        """Pop and rescan the vectors whose gap the drift has reached."""
        out = []
        for heap, drift in zip(self.heaps, centres.drift.tolist()):
            while heap and heap[0][0] <= drift:
                out.append(heapq.heappop(heap)[1])
        self.rescan(np.array(out, np.int64), centres)

    def row(self, ids: pa.Array, kind: str) -> dict:
        keys = np.array([k for heap in self.heaps for k, _ in heap], float)
        rows = np.array([r for heap in self.heaps for _, r in heap], np.int32)
        sizes = np.array([len(heap) for heap in self.heaps], np.int32)
        arrays = (self.points.astype(kind), self.own, self.scans, keys, rows, sizes, self.sums, self.counts)
        return dict(zip(NAMES, [ids, kind, *[a.tobytes() for a in arrays]]))

    @classmethod
    def read(cls, row: dict, k: int) -> Block:
        own, scans = (np.frombuffer(row[c], np.int32).copy() for c in ("own", "scans"))
        points = np.frombuffer(row["points"], row["kind"]).reshape(len(own), -1)
        entries = iter(zip(np.frombuffer(row["heap_keys"], float).tolist(), np.frombuffer(row["heap_rows"], np.int32).tolist()))
        # a heap was written in its own order, so it is one again
        heaps = [[next(entries) for _ in range(n)] for n in np.frombuffer(row["heap_sizes"], np.int32).tolist()]
        sums = np.frombuffer(row["sums"], np.int64).reshape(k, -1).copy()
        return cls(points, own, scans, heaps, sums, np.frombuffer(row["counts"], np.int64).copy())


def whole(values: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)``; raises beyond 2^30, where squares no longer fit."""
    made = np.floor(scale * values.astype(float))
    if np.abs(made).max(initial=0.0) > 1 << 30:
        raise ValueError("vectors too large: components beyond 2^30")
    return made.astype(np.int64)


def _kind(points: np.ndarray) -> str:
    """The narrowest type that holds all components."""
    return next(k for k in ("int16", "int32", "int64") if np.abs(points).max(initial=0) <= np.iinfo(k).max)


def _made(scale: float, width: int, centres: Centres) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                points = whole(part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, width), scale)
                row = Block.fresh(points, centres).row(part.column("id").to_pylist(), _kind(points))
                yield pa.RecordBatch.from_pylist([row], ARROW)

    return run


ARROW = pa.schema(
    [("ids", pa.list_(pa.int64())), ("kind", pa.string()), *[(n, pa.binary()) for n in NAMES[2:]]]
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _round(centres: Centres) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block.read(row, len(centres.at))
            block.expire(centres)
            yield pa.RecordBatch.from_pylist([block.row(row["ids"], row["kind"])], ARROW)

    return run


def _totals(k: int) -> Callable:
    """Sums and counts of a partition's blocks, a row per cluster and component; counts as component -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for row in _rows(batches):
            sums = np.frombuffer(row["sums"], np.int64).reshape(k, -1)
            total = total + np.column_stack([np.frombuffer(row["counts"], np.int64), sums])
        if not np.isscalar(total):
            cluster, part = np.indices(total.shape, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (cluster, part - 1, total)], ["cluster", "part", "total"])

    return run


def _means(blocks: DataFrame, centres: Centres) -> np.ndarray:
    """Floored means of the clusters; an empty cluster stays."""
    k, width = centres.at.shape
    parts = blocks.select("sums", "counts").mapInArrow(_totals(k), "cluster int, part int, total bigint")
    table = np.zeros((k, width + 1), np.int64)
    # clusters x components, both parameters
    for r in parts.groupBy("cluster", "part").agg(F.sum("total").alias("total")).collect():
        table[r["cluster"], r["part"] + 1] = r["total"]
    counts, sums = table[:, :1], table[:, 1:]
    return np.where(counts > 0, sums // np.maximum(counts, 1), centres.at)


def _finished(centres: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own, scans = (np.frombuffer(row[c], np.int32) for c in ("own", "scans"))
            points = np.frombuffer(row["points"], row["kind"]).reshape(len(own), -1)
            d = np.zeros(len(own), np.int64)
            for cluster in np.unique(own).tolist():
                mine = own == cluster
                d[mine] = distances(points[mine], centres[cluster : cluster + 1])[:, 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(own), pa.array(d), pa.array(scans)], ["id", "cluster", "distance", "scans"]
            )

    return run


def usable(vector: Column, width: int) -> Column:
    """Exactly ``width`` components, none null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == width) & fine, F.lit(False))


def cluster_vectors(
    vectors: DataFrame, k: int, rounds: int, width: int, scale: float, seed: str = "", key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``key``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid`` and ``scans`` of every usable vector.

    Vectors that are not :func:`usable` have no row.  The first centroids are
    the ``k`` vectors with the smallest hex SHA-256 of ``seed`` and key (null
    keys last, rows of one key by their components); fewer vectors make fewer
    clusters, and equal ones leave clusters empty, which stay where they are.
    ``distance`` is squared, ``inertia`` its sum, ``scans`` counts how often a
    vector was measured against all centroids.  Repeated rows count each; an empty table
    gives no rows; other columns are not read.  Components beyond 2^30 after
    scaling raise an error.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")).where(usable(F.col("vector"), width))
    draw = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(draw.asc_nulls_last(), "vector").limit(k).collect()
    if not first:
        return vectors.select(F.col(key).cast("long").alias(key)).where("false").select(
            key, F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.array(F.lit(0).cast("long")).alias("centroid"), F.lit(0).alias("scans"),
        )
    centres = Centres(whole(np.array([r["vector"] for r in first], float), scale), np.zeros(len(first)))
    blocks, path = stored(rows.mapInArrow(_made(scale, width, centres), STATE), "kmeans")
    for _ in range(rounds):
        centres = centres.moved(_means(blocks, centres))
        before = path
        blocks, path = stored(blocks.mapInArrow(_round(centres), STATE), "kmeans")
        discard(spark, before)
    out = stable(blocks.mapInArrow(_finished(centres.at), "id bigint, cluster int, distance bigint, scans int"))
    discard(spark, path)
    per = out.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # at most k
    total = sum(r["cluster_inertia"] for r in per)
    facts = [(r["cluster"], r["cluster_inertia"], total, centres.at[r["cluster"]].tolist()) for r in per]
    table = spark.createDataFrame(facts, "__c int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    joined = out.join(F.broadcast(table), F.col("cluster") == F.col("__c"))
    return joined.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid", "scans")
