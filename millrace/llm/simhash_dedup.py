"""Near duplicates by SimHash fingerprints and pivot distance tables.

Every distinct fingerprint gets its Hamming distances to fixed reference
fingerprints, the pivots.  By the triangle inequality two fingerprints within
``r`` bits have distances to any pivot that differ by ``r`` at most.  So pairs
whose largest coordinate difference exceeds ``r`` are discarded, and only the
survivors are compared bit by bit.

Which pairs to look at comes from pivot distances too, taken over parts of the
bits.  With the 64 bits cut into ``r + 2`` parts, two fingerprints within ``r``
bits agree in two parts at least, and then their distances to all pivots over
those two parts are equal.  Pairs are made only inside such groups of equal
distances: no link is lost, and nothing is compared across groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components
from millrace.llm.texts import byte_slices, byte_table, few_rows, set_apart, SPACE
from millrace.session import stable

SEED = 42
#: pivots over all bits, whose coordinates are compared, and over parts of them, which group
PIVOTS, PART_PIVOTS = 8, 24
#: members of a group that are compared pairwise; larger groups link by shared neighbours
GROUP = 2_000


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots(n: int) -> list[int]:
    """``n`` reference fingerprints, the same in every run, as signed 64-bit numbers."""
    return [_signed(xxhash.xxh64_intdigest(b"pivot %d" % i, seed=SEED)) for i in range(n)]


def fingerprint_of(text: bytes, width: int, table: bytes) -> int:
    """Signed 64-bit fingerprint: bit ``j`` is set if it is in over half of the shingle hashes."""
    words = text.translate(table).split()
    if not words:
        return 0
    if len(words) <= width:
        shingles: Iterator[bytes] = iter((b" ".join(words),))
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
        n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 14):  # bounded memory for long texts
        part = hashes[start : start + (1 << 14)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``id``, ``fp`` of every row: the SimHash of its ``width``-word shingles, repeats included."""
    table = byte_table(SPACE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            texts = batch.column("text").cast(pa.large_binary())
            fps = [fingerprint_of(t.as_buffer().to_pybytes() if t.is_valid else b"", width, table) for t in texts]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "fp": pa.array(fps, pa.int64())})

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, fp bigint")


def _distances(fp: Column, references: list[int], mask: int = -1) -> list[Column]:
    return [F.bit_count(fp.bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(mask))) for p in references]


def _parts(n: int) -> list[int]:
    """Bit masks of ``n`` neighbouring parts of the 64 bits."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]


def grouped(points: DataFrame, bits: int) -> DataFrame:
    """``points`` once for every pair of parts, with the pivot distances over it hashed into ``cell``."""
    masks = [_signed(x | y) for x, y in combinations(_parts(bits + 2), 2)]
    cells = [F.xxhash64(F.lit(i), *_distances(F.col("fp"), pivots(PART_PIVOTS), m)) for i, m in enumerate(masks)]
    return points.withColumn("cell", F.explode(F.array(*cells)))


def near_pairs(points: DataFrame, bits: int = 2, group: int = GROUP) -> DataFrame:
    """``a``, ``b``: nodes whose fingerprints differ in at most ``bits``, enough of them to connect all such.

    ``points`` has ``node`` and a distinct ``fp`` per row.  Groups of up to
    ``group`` members give every linked pair.  In a larger group the members
    emit every fingerprint within ``bits / 2`` of their own; those that emit
    the same one are within ``bits`` of each other and are linked to the first
    of them, and two within ``bits`` always share one.  That is linear in the
    group, and exact, for an even ``bits``.
    """
    if bits % 2 or not 0 <= bits <= 4:
        raise ValueError("bits must be 0, 2 or 4")
    table = points.withColumns({f"d{i}": d.cast("byte") for i, d in enumerate(_distances(F.col("fp"), pivots(PIVOTS)))})
    cells = stable(grouped(table, bits))
    large = stable(cells.groupBy("cell").count().where(F.col("count") > group).select("cell"))
    some_large = bool(large.limit(1).count())
    small = cells.join(few_rows(large), "cell", "left_anti") if some_large else cells

    other = small.select("cell", *[F.col(c).alias(f"o_{c}") for c in table.columns])
    apart = [F.abs(F.col(f"d{i}") - F.col(f"o_d{i}")) for i in range(PIVOTS)]
    survives = reduce(lambda x, y: x & y, [d <= bits for d in apart])
    linked = F.bit_count(F.col("fp").bitwiseXOR(F.col("o_fp"))) <= bits
    left, right = small.alias("l"), other.alias("r")
    pairs = left.join(right, (F.col("l.cell") == F.col("r.cell")) & (F.col("node") < F.col("o_node")) & survives & linked)
    pairs = pairs.select(F.col("node").alias("a"), F.col("o_node").alias("b")).distinct()
    if not some_large:
        return pairs

    crowd = cells.join(few_rows(large), "cell", "left_semi").select("node", "fp").distinct()
    masks = [0] + [reduce(lambda x, y: x | y, [1 << i for i in c]) for n in range(1, bits // 2 + 1) for c in combinations(range(64), n)]
    around = F.explode(F.transform(F.array(*[F.lit(_signed(m)) for m in masks]), lambda m: F.col("fp").bitwiseXOR(m)))
    around = stable(crowd.select("node", around.alias("point")))
    first = around.groupBy("point").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = around.join(stable(first.select("point", "a")), "point").where("a <> node")
    return pairs.unionByName(stars.select("a", F.col("node").alias("b")).distinct())


def near_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, bits: int = 2, group: int = GROUP
) -> DataFrame:
    """Per row of ``docs``: key, ``fp`` and ``component_id``.

    Rows whose fingerprints differ in at most ``bits`` bits are linked, and the
    smallest key that can be reached names the component.  Texts without words
    (null, empty) have fingerprint zero and link like any other; with fewer
    words than ``width`` the whole sequence is the one shingle.  Rows with a
    null key take part in no link: they get their fingerprint and a null
    component.  Keys are whole numbers; rows that repeat a key are linked by it.
    """
    prints = stable(with_fingerprints(docs, key, text, width))
    points = stable(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("node")))
    edges = near_pairs(points, bits, group)
    # a key with several texts links their fingerprints
    texts = prints.where("id is not null").groupBy("id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
    repeated = stable(texts.where("lo <> hi").select("id"))
    if repeated.limit(1).count():
        named = prints.join(repeated, "id").select("id", "fp").distinct().join(points, "fp").select("id", "node")
        first = stable(named.groupBy("id").agg(F.min("node").alias("a")))
        edges = edges.unionByName(named.join(first, "id").where("a <> node").select("a", F.col("node").alias("b")))
    joined = connected_components(edges, "a", "b")
    labels = stable(points.join(joined, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")))
    out = prints.join(labels, "fp", "left")
    return out.select(F.col("id").alias(key), "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, bits: int = 2) -> DataFrame:
    """``docs`` with the row of the smallest key of each component only, all columns kept.

    Rows with a null key stay; of rows that repeat a kept key an arbitrary one
    stays.  Columns of any name pass through.
    """
    docs, (key, text), back = set_apart(docs, key, text)
    groups = near_groups(docs, key, text, width, bits)
    rows = groups.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k"))
    rows = stable(rows.agg(F.min("component_id").alias("__c"), F.count(F.lit(1)).alias("__n")))
    out = docs.join(few_rows(rows.where("__c <> __k or __n > 1").select("__k")), F.col(key) == F.col("__k"), "left_anti")
    again = rows.where("__c = __k and __n > 1").select("__k")
    if again.limit(1).count():
        out = out.unionByName(docs.join(few_rows(again), F.col(key) == F.col("__k"), "left_semi").dropDuplicates([key]))
    return back(out)
