"""Merkle manifest of a dataset, with a proof per row made by pointer jumping.

Rows are the leaves of one binary tree per group; the groups' roots are the
leaves of the tree above.  Nodes are numbered within their level, so a node's
parent has half its number and its sibling differs in the lowest bit.  The tree
is built in blocks of 1,024 neighbouring nodes: a block's levels are hashed in
one task, the one node that is left goes into the next round.  A group of any
size is many blocks.

For the proofs every node holds the segment of siblings on its way to an
ancestor, at first its parent.  Joining the table with itself doubles the
distance and concatenates the two segments, until every leaf reaches the root:
five joins for 2^32 rows.  Only nodes that a later join reads stay in the table,
those on levels that the distance divides.

A digest is kept as 32 bytes and hashed as hex text.  A proof is the siblings
from the leaf upwards, left out where a run has no other node; which side a
sibling stands on follows from the position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import few_rows
from millrace.operators.ordering import join_null_safe, positions
from millrace.session import stable

#: levels hashed in one task
BLOCK_BITS = 10
#: bytes of segments that a join may broadcast
BROADCAST_BYTES = 16 << 20
#: a node with its sibling known, one that the next round goes on with, a root
INNER, OPEN, ROOT = 0, 1, 2


def leaf_digest(columns: Sequence[str]) -> Column:
    """Hex SHA-256 over the columns: ``-`` for null, else byte count, colon and value as text."""

    def part(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256)


def _parent(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join([c.hex() for c in children]).encode()).digest()


def _block_levels(carry: list[str], level: int, schema: pa.Schema) -> Callable:
    """For sorted nodes of one level: each block's nodes on all levels up to its top."""

    def block(t: pa.Table) -> Iterator[pa.Table]:
        g, idx, cnt = (t.column(c)[0].as_py() for c in ("__g", "__idx", "__cnt"))
        number, deep = idx >> BLOCK_BITS, min(BLOCK_BITS, (cnt - 1).bit_length())
        nodes, extra = t.column("__digest").to_pylist(), t.select(carry)

        def rows(at: int, first: int, siblings: list, digests: list, state: int) -> pa.Table:
            n = len(siblings)
            held = extra if level + at == 0 else pa.table([pa.nulls(n, schema.field(c).type) for c in carry], carry)
            values = {
                "__g": pa.array([g] * n, pa.int64()),
                "__level": pa.array([level + at] * n, pa.int32()),
                "__idx": pa.array(range(first, first + n), pa.int64()),
                "__cnt": pa.array([-(-cnt >> at)] * n, pa.int64()),
                "__sibling": pa.array(siblings, pa.binary()),
                "__digest": pa.array(digests, pa.binary()),
                "__state": pa.array([state] * n, pa.int32()),
            }
            return pa.table([*values.values(), *held.columns], [*values, *carry]).cast(schema)

        for step in range(deep):
            n = len(nodes)
            siblings = [nodes[j ^ 1] if j ^ 1 < n else None for j in range(n)]
            yield rows(step, number << (BLOCK_BITS - step), siblings, nodes if level + step == 0 else [None] * n, INNER)
            nodes = [_parent(nodes[j : j + 2]) for j in range(0, n, 2)]
        yield rows(deep, number, [None], nodes, OPEN if -(-cnt >> deep) > 1 else ROOT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, t]) if held is not None else t
            g = held.column("__g").to_numpy()
            b = held.column("__idx").to_numpy() >> BLOCK_BITS
            edges = [0, *((g[1:] != g[:-1]) | (b[1:] != b[:-1])).nonzero()[0] + 1]
            for start, end in zip(edges[:-1], edges[1:]):
                for out in block(held.slice(start, end - start)):
                    yield from out.to_batches()
            held = held.slice(edges[-1])
        if held is not None and held.num_rows:
            for out in block(held):
                yield from out.to_batches()

    return run


def _trees(leaves: DataFrame, carry: list[str]) -> tuple[DataFrame, DataFrame, int]:
    """All nodes below the roots, the roots, and the height of the highest tree.

    ``leaves``: ``__g`` group, ``__idx`` number from 0, ``__cnt`` leaves of the
    group, ``__digest``, and columns that the leaves' rows carry along.
    """
    most = leaves.agg(F.max("__cnt")).first()[0] or 1
    height = (most - 1).bit_length()
    fields = [f for f in leaves.schema if f.name in carry]
    kinds = ["__g long", "__level int", "__idx long", "__cnt long", "__sibling binary", "__digest binary", "__state int"]
    kinds += [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    names = [f.name for f in fields]
    rows, nodes, roots, level = leaves, [], [], 0
    while True:
        dealt = rows.repartition("__g", F.shiftright("__idx", BLOCK_BITS)).sortWithinPartitions("__g", "__idx")
        dealt = dealt.select("__g", "__idx", "__cnt", "__digest", *names)
        schema = _arrow_schema(leaves.sparkSession, kinds)
        built = stable(dealt.mapInArrow(_block_levels(names, level, schema), ", ".join(kinds)))
        nodes.append(built.where((F.col("__state") == INNER) | ((F.col("__level") == 0) & (F.col("__state") == ROOT))))
        roots.append(built.where(F.col("__state") == ROOT).select("__g", F.col("__digest").alias("__root")))
        level += BLOCK_BITS
        if level >= height:
            break
        rows = built.where(F.col("__state") == OPEN)
    for a, b in zip(nodes[1:], roots[1:]):
        nodes[0], roots[0] = nodes[0].unionByName(a), roots[0].unionByName(b)
    return nodes[0], roots[0], height


def _arrow_schema(spark, kinds: list[str]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ", ".join(kinds)).schema)


def _paths(nodes: DataFrame, height: int, names: list[str]) -> DataFrame:
    """Per leaf the segment ``__path`` of siblings up to its root, by doubling the distance."""
    held = nodes.select("__g", "__level", "__idx", "__cnt", "__digest", *names, F.coalesce("__sibling", F.lit(b"")).alias("__path"))
    far = 1
    while far < height:
        beyond = held.where(F.col("__level") % (2 * far) == far).select(
            F.col("__g").alias("__up_g"), F.col("__level").alias("__up_level"), F.col("__idx").alias("__up_idx"), F.col("__path").alias("__up")
        )
        beyond = few_rows(beyond, BROADCAST_BYTES // (64 + 32 * far))
        near = held.where(F.col("__level") % (2 * far) == 0)
        same = (
            (F.col("__g") == F.col("__up_g"))
            & (F.col("__level") + far == F.col("__up_level"))
            & (F.shiftright("__idx", far) == F.col("__up_idx"))
        )
        both = F.concat("__path", F.coalesce("__up", F.lit(b""))).alias("__path")
        held = near.join(beyond, same, "left").select("__g", "__level", "__idx", "__cnt", "__digest", *names, both)
        far *= 2
        if far < height:
            held = stable(held)  # read twice by the next join
    return held.where(F.col("__level") == 0)


def manifest(docs: DataFrame, fields: Sequence[str], key: str = "doc_id", group: str = "lang", again: Column | None = None) -> DataFrame:
    """A row per row of ``docs``: ``key``, ``group``, ``leaf``, ``subroot``, ``root`` and what a check needs.

    ``leaf`` is :func:`leaf_digest` of ``fields``; leaves of a group ascend by
    key, groups by value, nulls first in both, and rows of one key ascend by
    leaf.  Of a run of two nodes, or one at the end, the hex digests are hashed
    together; a single node of a tree is its root.  ``proof`` (binary) holds the
    siblings from the leaf to ``root``; ``position``, ``group_size``,
    ``group_position`` and ``groups`` say where they stand.  ``again`` is a
    second leaf in hex, made from the same row, that is carried along.  Other
    columns of ``docs`` are not read, so their names do not matter.  Keys are whole
    numbers.  An empty table has an empty manifest.
    """
    leaf = leaf_digest(fields)
    made = [F.col(key).cast("long").alias("__key"), F.col(group).alias("__group"), F.unhex(leaf).alias("__digest")]
    made.append(F.unhex(again if again is not None else F.lit(None).cast("string")).alias("__again"))
    placed = positions(docs.select(*made), ["__key", "__digest"], ["__group"], "__at")
    groups = placed.groupBy("__group").agg(F.max("__at_total").alias("__size"))
    groups = stable(positions(groups, ["__group"], name="__g").withColumn("__g", F.col("__g") - 1))
    leaves = join_null_safe(placed, few_rows(groups), ["__group"]).select(
        "__g", (F.col("__at") - 1).alias("__idx"), F.col("__size").alias("__cnt"), "__digest", "__key", "__again"
    )
    nodes, roots, height = _trees(stable(leaves), ["__key", "__again"])
    below = _paths(nodes, height, ["__key", "__again"])

    tops = groups.join(few_rows(roots), "__g").select(
        F.lit(0).cast("long").alias("__g"), F.col("__g").alias("__idx"), F.col("__g_total").alias("__cnt"), F.col("__root").alias("__digest"), "__group"
    )
    nodes, roots, height = _trees(stable(tops), ["__group"])
    above = _paths(nodes, height, ["__group"]).select(
        F.col("__idx").alias("__g"), "__group", F.col("__cnt").alias("__groups"), F.col("__digest").alias("__subroot"), F.col("__path").alias("__rest")
    )
    last = roots.first()
    joined = below.join(few_rows(stable(above)), "__g")

    def text(name: str) -> Column:
        return F.lower(F.hex(name))

    return joined.select(
        F.col("__key").alias(key),
        F.col("__group").alias(group if group != key else f"{group}_group"),
        text("__digest").alias("leaf"),
        text("__subroot").alias("subroot"),
        F.lit(last["__root"].hex() if last else None).alias("root"),
        F.concat("__path", "__rest").alias("proof"),
        F.col("__idx").alias("position"),
        F.col("__cnt").alias("group_size"),
        F.col("__g").alias("group_position"),
        F.col("__groups").alias("groups"),
        F.coalesce(text("__again"), text("__digest")).alias("leaf_again"),
    )


def fold(digest: bytes, proof: bytes, places: Sequence[tuple[int, int]]) -> bytes:
    """The root that a leaf and its proof lead to; ``places``: number and count of nodes, per tree upwards."""
    at = 0
    for position, n in places:
        while n > 1:
            run = [digest]
            if position ^ 1 < n:
                run.insert(1 - (position & 1), proof[at : at + 32])
                at += 32
            digest = _parent(run)
            position, n = position >> 1, (n + 1) >> 1
    return digest


def _folded(leaf: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [b.column(c).to_pylist() for c in (leaf, "proof", "position", "group_size", "group_position", "groups")]
            got = [fold(bytes.fromhex(d), p, [(i, n), (j, m)]).hex() for d, p, i, n, j, m in zip(*columns)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], [*b.schema.names, "folded_root"])

    return run


def verify(rows: DataFrame, leaf: str = "leaf_again") -> DataFrame:
    """Rows of a :func:`manifest` with ``folded_root``, made from column ``leaf`` and the proof, and ``verified``."""
    out = rows.mapInArrow(_folded(leaf), _ddl(rows) + ", folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def proof_digest(proof: str | Column = "proof") -> Column:
    """Hex SHA-256 of a proof's digests as hex text."""
    return F.sha2(F.lower(F.hex(proof)).cast("binary"), 256)
