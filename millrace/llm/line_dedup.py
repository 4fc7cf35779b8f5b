"""Incremental, reversible removal of lines that many documents share.

An index of lines has three tables.  ``refs`` has a row per document and
distinct line key; ``counts`` the exact number of documents and the largest
document of every key; ``filters`` one cuckoo filter per shard of keys, with the
keys that enough documents hold.  Adding documents raises the counts, and the keys that reach
the threshold enter their shard's filter.  Deleting documents lowers them
again: keys that fall below leave the filter, keys without documents leave the
table, and where the largest document went the next one is looked up in
``refs``.  After a deletion the index answers as if the documents had never
been added.

To clean documents, every line is tried on its shard's filter first.  Few lines
pass; only those are joined with the exact counts, which decide.

Counts are combined before the shuffle, so a line found in a third of all
documents is one row per task.  A shard sees distinct keys, never a key's
documents.  Keys are 128-bit hashes of the lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.cuckoo import Cuckoo
from millrace.llm.texts import byte_slices, few_rows
from millrace.session import discard, stable, stored

BLANK = b" \t\n\x0b\x0c\r"
#: bytes of all filters together that every task may hold; beyond it lines go to the filters
FILTER_BYTES = 32 << 20
#: tasks per shard that then share its lines
SPREAD = 8
REFS, COUNTS, FILTERS = "hi bigint, lo bigint, doc bigint", "hi bigint, lo bigint, docs bigint, top bigint", "shard int, payload binary"


@dataclass(frozen=True)
class LineIndex:
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    min_docs: int
    min_chars: int
    shards: int
    paths: tuple[str, ...] = field(default=())

    def drop(self) -> None:
        """Delete the index's tables."""
        for path in self.paths:
            discard(self.refs.sparkSession, path)


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line without white space at its ends, A-Z lower-cased; None if that is too short."""
    key = line.strip(BLANK).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _texts(column: pa.Array) -> list[bytes]:
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column.cast(pa.large_string())]


def _keys(min_chars: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            digests, docs = [], []
            for doc, text in zip(batch.column("doc").to_pylist(), _texts(batch.column("text"))):
                keys = {xxhash.xxh3_128_digest(k) for line in text.split(b"\n") if (k := line_key(line, min_chars)) is not None}
                digests += keys
                docs += [doc] * len(keys)
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            columns = [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(docs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["hi", "lo", "doc"])

    return run


def line_refs(docs: DataFrame, min_chars: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``hi``, ``lo``, ``doc``: the distinct line keys of every row."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_keys(min_chars), REFS)


def _shard(shards: int) -> Column:
    return F.pmod("hi", F.lit(shards)).cast("int").alias("shard")


def new_index(spark: SparkSession, min_docs: int = 3, min_chars: int = 20, shards: int = 64) -> LineIndex:
    """An index of no documents.  Lines of ``min_chars`` code points or more in ``min_docs`` documents repeat."""
    if min_docs < 1 or shards < 1:
        raise ValueError("min_docs and shards start at 1")
    return LineIndex(*[spark.createDataFrame([], s) for s in (REFS, COUNTS, FILTERS)], min_docs, min_chars, shards)


def insert(index: LineIndex, docs: DataFrame, key: str = "doc_id", text: str = "text") -> LineIndex:
    """The index with the rows of ``docs`` added; the old one stays as it is."""
    fresh, path = stored(line_refs(docs, index.min_chars, key, text), "line-refs")
    delta = fresh.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("top"))
    both = index.counts.withColumn("was", F.col("docs")).unionByName(delta.withColumn("was", F.lit(0).cast("long")))
    counts = both.groupBy("hi", "lo").agg(*[f("docs" if n != "was" else n).alias(n) for n, f in (("docs", F.sum), ("was", F.sum))], F.max("top").alias("top"))
    return _next(index, index.refs.unionByName(fresh), counts, (*index.paths, path))


def delete(index: LineIndex, ids: DataFrame, key: str = "doc_id") -> LineIndex:
    """The index without the documents whose ids are in column ``key``; others in it change nothing."""
    ids = ids.select(F.col(key).cast("long").alias("__id")).distinct()
    named = F.col("doc").eqNullSafe(F.col("__id"))
    gone = index.refs.join(ids, named, "left_semi")
    kept, path = stored(index.refs.join(ids, named, "left_anti"), "line-refs")
    loss = stable(gone.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("lost"), F.max("doc").alias("top_lost")))
    held = index.counts.join(loss, ["hi", "lo"], "left").withColumn("left", F.col("docs") - F.coalesce("lost", F.lit(0)))
    # only where the largest document went is the next one looked up
    stale = loss.join(index.counts, ["hi", "lo"]).where(F.col("top_lost") == F.col("top")).select("hi", "lo")
    again = kept.join(stale, ["hi", "lo"], "left_semi").groupBy("hi", "lo").agg(F.max("doc").alias("top_again"))
    top = F.when(F.col("top_lost") == F.col("top"), F.col("top_again")).otherwise(F.col("top"))
    counts = held.join(again, ["hi", "lo"], "left").select("hi", "lo", F.col("left").alias("docs"), F.col("docs").alias("was"), top.alias("top"))
    return _next(index, kept, counts, (path,))


def _next(index: LineIndex, refs: DataFrame, counts: DataFrame, paths: tuple[str, ...]) -> LineIndex:
    """Store new counts, and carry the keys that crossed the threshold into the filters."""
    many = index.min_docs
    shard = _shard(index.shards)
    counts, counted = stored(counts, "line-counts")
    crossed = (F.col("docs") >= many) != (F.col("was") >= many)
    moves = counts.where(crossed).select(shard, "hi", "lo", (F.col("docs") >= many).alias("add"))
    live = counts.where(F.col("docs") >= many).groupBy(shard).agg(F.count(F.lit(1)).alias("n"))
    # one small row per shard
    room = {r["shard"]: _head(r["head"]) for r in index.filters.select("shard", F.substring("payload", 1, 24).alias("head")).collect()}
    need = {r["shard"]: r["n"] for r in live.collect()}
    anew = [s for s, n in need.items() if n > room.get(s, 0)]
    rebuilt = F.col("shard").isin(anew)
    nothing = F.lit(None).cast("binary").alias("payload")
    whole = counts.where(F.col("docs") >= many).select(shard, "hi", "lo").where(rebuilt)
    steps = moves.where(~rebuilt).select("shard", F.when(F.col("add"), 2).otherwise(1).alias("kind"), F.col("lo"), nothing)
    steps = steps.unionByName(whole.select("shard", F.lit(2).alias("kind"), "lo", nothing))
    old = index.filters.where(~rebuilt).select("shard", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("lo"), "payload")
    # an empty filter is only its size here, and made where it is filled
    start = refs.sparkSession.createDataFrame([(s, 0, 2 * need[s]) for s in anew], "shard int, kind int, lo bigint").select("*", nothing)
    dealt = old.unionByName(start).unionByName(steps).repartition("shard").sortWithinPartitions("shard", "kind")
    filters, made = stored(dealt.mapInArrow(_filled, FILTERS), "line-filters")
    held = counts.where("docs > 0").select("hi", "lo", "docs", "top")
    return replace(index, refs=refs, counts=held, filters=filters, paths=(*paths, counted, made))


def _head(data: bytes) -> int:
    buckets = int(np.frombuffer(bytes(data), np.int64, 1)[0])
    return Cuckoo(np.zeros((buckets, 0))).room


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard: its filter, hashes to remove, hashes to add; one filter out per shard."""
    shard, held = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([held.to_bytes()], pa.binary())], ["shard", "payload"])

    for batch in batches:
        if not batch.num_rows:
            continue
        shards, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1]), [True]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if kinds[a] == 0:
                if held is not None:
                    yield out()
                payload = batch.column("payload")[a].as_py()
                shard, held = int(shards[a]), Cuckoo.sized(batch.column("lo")[a].as_py()) if payload is None else Cuckoo.from_bytes(payload)
                continue
            hashes = batch.column("lo").slice(a, b - a).to_numpy()
            (held.remove if kinds[a] == 1 else held.add)(hashes)
    if held is not None:
        yield out()


def _tried_here(filters: dict[int, bytes], shards: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {s: Cuckoo.from_bytes(p) for s, p in filters.value.items()}
        for batch in batches:
            lo, at = batch.column("lo").to_numpy(), batch.column("hi").to_numpy() % shards
            found = np.zeros(len(lo), bool)
            order = np.argsort(at, kind="stable")
            for s, rows in zip(*_runs(at, order)):
                if s in known:
                    found[rows] = known[s].has(lo[rows])
            yield batch.filter(pa.array(found))

    return run


def _runs(at: np.ndarray, order: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    values, first = np.unique(at[order], return_index=True)
    return values.tolist(), np.split(order, first[1:])


def _tried_there(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, its filter first: the lines that pass it."""
    shard, held = None, None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        payload = batch.column("payload")
        is_filter = payload.is_valid().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | is_filter[1:] | is_filter[:-1], [True]])) if len(shards) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if is_filter[a]:
                shard, held = shards[a], Cuckoo.from_bytes(payload[int(a)].as_py())
                continue
            if shards[a] == shard:
                part = batch.slice(a, b - a).select(["hi", "lo", "doc"])
                yield part.filter(pa.array(held.has(part.column("lo").to_numpy())))


def candidates(index: LineIndex, refs: DataFrame) -> DataFrame:
    """Those rows of ``refs`` whose key passes its shard's filter: all repeated ones and a few others."""
    spark = refs.sparkSession
    size = index.filters.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    if size <= FILTER_BYTES:
        held = spark.sparkContext.broadcast({r["shard"]: bytes(r["payload"]) for r in index.filters.collect()})
        return refs.mapInArrow(_tried_here(held, index.shards), REFS)
    # a shard's filter goes to several tasks, which share the lines of a frequent key
    part = F.pmod(F.xxhash64("doc"), F.lit(SPREAD)).cast("int").alias("part")
    lines = refs.select(_shard(index.shards), part, "hi", "lo", "doc", F.lit(None).cast("binary").alias("payload"))
    copies = index.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    empty = [F.lit(None).cast("long").alias(c) for c in ("hi", "lo", "doc")]
    rows = lines.unionByName(copies.select("shard", "part", *empty, "payload"))
    rows = rows.repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("payload").isNull())
    return rows.mapInArrow(_tried_there, REFS)


def repeated(index: LineIndex, refs: DataFrame) -> DataFrame:
    """Rows of ``refs`` to drop: ``min_docs`` documents hold the key, and another one is the largest."""
    exact = few_rows(index.counts.where(F.col("docs") >= index.min_docs).select("hi", "lo", "top"))
    found = candidates(index, refs).join(exact, ["hi", "lo"])
    return found.where(~F.col("doc").eqNullSafe(F.col("top"))).select("hi", "lo", "doc")


def _cleaned(min_chars: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            kept, counts, dropped = [], [], []
            for text, drops in zip(_texts(batch.column("text")), batch.column("drops")):
                lines = text.split(b"\n")
                if drops.is_valid:
                    halves = drops.values.flatten()
                    gone = np.stack([halves[0].to_numpy(), halves[1].to_numpy()], axis=1).astype(">i8").tobytes()
                    gone = {gone[i : i + 16] for i in range(0, len(gone), 16)}
                    stay = [s for s in lines if (k := line_key(s, min_chars)) is None or xxhash.xxh3_128_digest(k) not in gone]
                else:
                    stay = lines
                kept.append(b"\n".join(stay) if len(stay) < len(lines) else text)
                counts.append(len(lines))
                dropped.append(len(lines) - len(stay))
            columns = [batch.column("doc"), pa.array(kept, pa.large_binary()).cast(pa.large_string())]
            columns += [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "text", "n_lines", "n_dropped"])

    return run


def clean(index: LineIndex, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text``, ``n_lines``, ``n_dropped`` of every row of ``docs`` without its repeated lines.

    A line's key is the line without white space at its ends and with A-Z
    lower-cased.  A key of at least ``min_chars`` code points that at least ``min_docs`` indexed
    rows hold loses all its lines except in the row with the largest id that
    holds it, where all of them stay.  A null or empty text is one empty line.
    Rows that share an id are documents of their own in the count, and all of
    them keep the lines if theirs is the largest id; a null id is the smallest.
    ``docs`` need not be in the index.  Other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    drops = repeated(index, line_refs(docs, index.min_chars, key, text))
    drops = drops.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set(F.struct("hi", "lo")).alias("drops"))
    joined = rows.join(drops, F.col("doc").eqNullSafe(F.col("__doc")), "left").select("doc", "text", "drops")
    out = joined.mapInArrow(_cleaned(index.min_chars), "doc bigint, text string, n_lines bigint, n_dropped bigint")
    return out.select(F.col("doc").alias(key), F.col("text").alias(text if text != key else f"{text}_kept"), "n_lines", "n_dropped")
