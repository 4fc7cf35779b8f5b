"""The most similar vectors by exact cosine, through an inverted index with norm bounds.

Vectors are sparse: rows ``(user, item, centred)``, a missing item is zero.

First every query looks up its few most telling items, those with much of its
length and short posting lists.  The least of the ``nn`` best similarities found
there bounds the answer from below.  Vectors have length one, so what a set of
items adds to a similarity is at most the length of the query's part on them.
Each query looks up only so many of its items, cheapest first by posting list,
that the rest of it is shorter than its bound: a user that shares none of them
cannot be in the answer.  The sums over the shared ones, with the lengths of both rests, drop
most of the users that were met; the similarity of what is left is computed whole.

Queries with frequent items alone, whose lists would be as long as the whole set,
are multiplied in blocks, past which all training users stream.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from millrace.operators.ordering import positions
from millrace.session import stable

SIM_DIGITS = 10
#: users of a posting list that lie together, and places of users in one list
POSTINGS, PLACES = 4_096, 64
#: users that a query meets to find its bound, over ``nn``; share of all users beyond which a list is no help for that
PROBES, FREQUENT = 8, 0.1
#: what rounding may add to a similarity
SLACK = 2e-10
#: cells and answers that a task keeps of a block of queries
QUERY_CELLS, HELD_PAIRS = 1 << 22, 1 << 23
#: queries, training users and items that are multiplied at once
QUERY_ROWS, TRAIN_ROWS, ITEM_COLUMNS = 256, 8_192, 4_096


def sparse_vectors(centred: DataFrame) -> DataFrame:
    cells = F.sort_array(F.collect_list(F.struct("item", "centred")))
    return centred.groupBy("user").agg(cells.alias("cells")).select(
        "user", F.col("cells.item").alias("items"), F.col("cells.centred").alias("values")
    )


def coded_items(cells: DataFrame) -> DataFrame:
    """``item`` and ``code``, its number in order."""
    known = cells.select("item").where(F.col("item").isNotNull()).distinct()
    return positions(known, ["item"], name="code").select("item", F.col("code").cast("int").alias("code"))


def coded_vectors(cells: DataFrame, codes: DataFrame) -> DataFrame:
    """``user`` with the arrays ``codes`` (a missing one for an item without) and ``values`` of its cells."""
    held = cells.join(codes, "item", "left").groupBy("user").agg(F.sort_array(F.collect_list(F.struct("code", "centred"))).alias("c"))
    return held.select("user", F.col("c.code").alias("codes"), F.col("c.centred").alias("values"))


class _Vectors:
    """Vectors of length one as flat arrays; those without a length are left out."""

    def __init__(self, users: np.ndarray, sizes: np.ndarray, codes: np.ndarray, values: np.ndarray):
        row = np.repeat(np.arange(len(users)), sizes)
        length = np.sqrt(np.bincount(row, values * values, len(users)))
        kept = length > 0
        there = kept[row] & (codes >= 0)
        self.users = users[kept]
        self.row, self.codes = (np.cumsum(kept) - 1)[row[there]], codes[there]
        self.values = values[there] / length[row[there]]
        self.starts = np.searchsorted(self.row, np.arange(len(self.users) + 1))

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Vectors:
        lists, values = batch.column("codes"), batch.column("values").flatten().to_numpy(zero_copy_only=False)
        sizes = np.diff(lists.offsets.to_numpy())
        users = batch.column("user").to_numpy(zero_copy_only=False)
        return cls(users, sizes, lists.flatten().fill_null(-1).to_numpy(), values.astype(float))

    def dense(self, lo: int, hi: int, vocabulary: np.ndarray) -> np.ndarray:
        """Rows ``lo`` to ``hi`` over the sorted codes of ``vocabulary``."""
        cells = slice(self.starts[lo], self.starts[hi])
        codes = self.codes[cells]
        at = np.minimum(np.searchsorted(vocabulary, codes), len(vocabulary) - 1)
        hit = vocabulary[at] == codes
        out = np.zeros((hi - lo, len(vocabulary)))
        out[self.row[cells][hit] - lo, at[hit]] = self.values[cells][hit]
        return out


class _Best:
    """The ``nn`` best of each query so far.

    Others come in the order of their ids, so one that is as similar as the last of ``nn`` held ones is never better.
    """

    def __init__(self, chunks: Sequence[_Vectors], nn: int):
        self.chunks, self.nn = chunks, nn
        self.sims = [np.full((len(c.users), nn), -np.inf) for c in chunks]
        self.others = [np.zeros((len(c.users), nn), c.users.dtype) for c in chunks]

    def meet(self, train: _Vectors) -> None:
        for first in range(0, len(train.users), TRAIN_ROWS):
            last = min(first + TRAIN_ROWS, len(train.users))
            words = np.unique(train.codes[train.starts[first] : train.starts[last]])
            slices = [words[i : i + ITEM_COLUMNS] for i in range(0, len(words), ITEM_COLUMNS)]
            right = train.dense(first, last, slices[0]) if len(slices) == 1 else None
            for queries, sims, others in zip(self.chunks, self.sims, self.others):
                for lo in range(0, len(queries.users), QUERY_ROWS):
                    hi = min(lo + QUERY_ROWS, len(queries.users))
                    dots = np.zeros((hi - lo, last - first))
                    for part in slices:
                        left = queries.dense(lo, hi, part)
                        if left.any():
                            dots += left @ (train.dense(first, last, part) if right is None else right).T
                    self._take(dots, queries.users[lo:hi], train.users[first:last], sims[lo:hi], others[lo:hi])

    def _take(self, dots: np.ndarray, mine: np.ndarray, theirs: np.ndarray, sims: np.ndarray, others: np.ndarray) -> None:
        nn = self.nn
        least = sims[:, -1]
        bar = least + SLACK / 10
        if dots.shape[1] > nn + 1 and np.isneginf(least).any():
            # one more than wanted, since the query itself may be among them
            bar = np.maximum(bar, np.partition(dots, -nn - 1, axis=1)[:, -nn - 1] - SLACK)
        flat = np.flatnonzero(dots > bar[:, None])
        if not len(flat):
            return
        row, at = np.divmod(flat, dots.shape[1])
        sim = np.round(dots.ravel()[flat], SIM_DIGITS)
        better = (sim > least[row]) & (mine[row] != theirs[at])
        row, at, sim = row[better], at[better], sim[better]
        rows = np.unique(row)
        all_rows = np.concatenate([np.repeat(rows, nn), row])
        all_sims = np.concatenate([sims[rows].ravel(), sim])
        all_others = np.concatenate([others[rows].ravel(), theirs[at]])
        order = np.lexsort((-all_sims, all_rows))  # stable: earlier ids first among equals
        all_rows = all_rows[order]
        place = np.arange(len(order)) - np.searchsorted(all_rows, all_rows)
        order = order[place < nn]
        sims[rows] = all_sims[order].reshape(len(rows), nn)
        others[rows] = all_others[order].reshape(len(rows), nn)

    def found(self):
        for queries, sims, others in zip(self.chunks, self.sims, self.others):
            row, rank = np.nonzero(~np.isneginf(sims))
            yield queries.users[row], others[row, rank], sims[row, rank], rank + 1


def _streamed(nn: int, kinds: pa.DataType):
    """Blocks of queries, each followed by all training users in the order of their ids."""

    def out(best: _Best):
        for user, other, sim, rank in best.found():
            columns = [pa.array(user, kinds), pa.array(other, kinds), pa.array(sim), pa.array(rank, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["user", "other", "sim", "rank"])

    def run(batches):
        block, chunks, best = None, [], None
        for batch in batches:
            marks = 2 * batch.column("qb").to_numpy().astype(np.int64) + batch.column("side").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi == lo:
                    continue
                qb, side = divmod(int(marks[lo]), 2)
                if qb != block:
                    if best is not None:
                        yield from out(best)
                    block, chunks, best = qb, [], None
                vectors = _Vectors.of(batch.slice(lo, hi - lo))
                if not side:
                    chunks.append(vectors)
                else:
                    best = best or _Best(chunks, nn)
                    best.meet(vectors)
        if best is not None:
            yield from out(best)

    return run


def _query_blocks(n: int, cells: int, nn: int, block: int, cores: int) -> int:
    return max(1, math.ceil(cells / QUERY_CELLS), math.ceil(n * nn / HELD_PAIRS), min(math.ceil(n / block), 2 * cores))


def nearest_in_blocks(queries: DataFrame, train: DataFrame, nn: int, block: int) -> DataFrame:
    """The ``nn`` best per query by multiplying blocks of queries with all training users.

    A task holds the queries of a block and the best of each; the training users
    come past in batches, in the order of their ids.  Training vectors are sent
    once per block, and blocks are as few as memory and ``block`` users per core
    let them be; no pair leaves its task but the ``nn`` best.
    """
    codes = stable(coded_items(train))
    q, s = (stable(coded_vectors(x.where(F.col("user").isNotNull()), codes)) for x in (queries, train))
    n, cells = q.agg(F.count(F.lit(1)), F.sum(F.size("codes"))).first()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    blocks = _query_blocks(n, cells or 0, nn, block, cores)
    asked = q.select(F.pmod(F.xxhash64("user"), F.lit(blocks)).cast("int").alias("qb"), F.lit(0).alias("side"), "user", "codes", "values")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("qb")
    met = s.select(every, F.lit(1).alias("side"), "user", "codes", "values")
    kind = train.schema["user"].dataType
    rows = asked.unionByName(met).repartitionById(blocks, "qb").sortWithinPartitions("qb", "side", "user")
    return rows.mapInArrow(_streamed(nn, to_arrow_type(kind)), f"user {kind.simpleString()}, other {kind.simpleString()}, sim double, rank int")


def _unit(vectors: DataFrame) -> DataFrame:
    """Cells of vectors scaled to length one; vectors of length zero have none."""
    length = vectors.groupBy("user").agg(F.sqrt(F.sum(F.col("centred") * F.col("centred"))).alias("__len")).where("__len > 0")
    return vectors.join(length, "user").select("user", "item", (F.col("centred") / F.col("__len")).alias("x"))


def _ranked(cells: DataFrame, postings: DataFrame) -> tuple[DataFrame, Window]:
    """Cells with the length of their posting list, and each query's order: most length per posting first."""
    return cells.join(postings, "item"), Window.partitionBy("user").orderBy(F.desc(F.col("x") * F.col("x") / F.col("n")), "item")


def probe_heads(cells: DataFrame, postings: DataFrame, nn: int, n_train: int) -> DataFrame:
    """The first cells of each query, until their lists hold ``PROBES * nn`` users; frequent items are left out."""
    rows, w = _ranked(cells, postings.where(F.col("n") <= max(1.0, FREQUENT * n_train)))
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = rows.withColumn("before", before).where(F.col("before") < PROBES * nn)
    return kept.select("user", "item", "x", "n", F.lit(1.0).alias("rest"), F.lit(-1.0).alias("bound"))


def query_heads(cells: DataFrame, bounds: DataFrame, postings: DataFrame) -> DataFrame:
    """The cells of each query to look up: ``user``, ``item``, ``x``, ``n`` (postings), ``rest``, ``bound``.

    ``rest`` is the length of the query on its other items.  Without a bound
    above zero all cells are looked up.
    """
    rows, w = _ranked(cells, postings)
    rows = rows.join(bounds, "user", "left").withColumn("bound", F.coalesce("bound", F.lit(-1.0)))
    seen = F.sum(F.col("x") * F.col("x")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    # items nobody in the set has rated add nothing, so the length counts the others only
    whole = F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("user"))
    before = F.sqrt(F.greatest(whole - F.coalesce(seen, F.lit(0.0)), F.lit(0.0)))
    rows = rows.withColumn("before", before).withColumn("after", F.sqrt(F.greatest(F.pow("before", F.lit(2)) - F.col("x") * F.col("x"), F.lit(0.0))))
    kept = rows.where((F.col("bound") <= 0) | (F.col("before") >= F.col("bound") - SLACK))
    rest = F.when(F.col("bound") <= 0, 0.0).otherwise(F.min("after").over(Window.partitionBy("user")))
    return kept.withColumn("rest", rest).select("user", "item", "x", "n", "rest", "bound")


def candidate_pairs(heads: DataFrame, train: DataFrame) -> DataFrame:
    """``user``, ``other``, ``part`` (similarity over the shared heads) of the pairs that can reach the query's bound."""
    lists = F.ceil(F.col("n") / POSTINGS)
    held = train.join(heads.select("item", "n").distinct(), "item").select(
        "item", F.pmod(F.xxhash64("user"), lists).alias("list"), F.col("user").alias("other"), F.col("x").alias("y")
    )
    asked = heads.withColumn("list", F.explode(F.sequence(F.lit(0).cast("long"), lists.cast("long") - 1)))
    met = asked.join(held, ["item", "list"]).where("user <> other")
    sums = met.groupBy("user", "other").agg(
        F.sum(F.col("x") * F.col("y")).alias("part"), F.sum(F.col("y") * F.col("y")).alias("on"),
        F.first("rest").alias("rest"), F.first("bound").alias("bound"),
    )
    reach = F.col("part") + F.col("rest") * F.sqrt(F.greatest(1 - F.col("on"), F.lit(0.0)))
    return sums.where((F.col("bound") <= 0) | (reach >= F.col("bound") - SLACK)).select("user", "other", "part", "rest")


def _whole_similarity(pairs: DataFrame, queries: DataFrame, train: DataFrame) -> DataFrame:
    """``sim`` of pairs over all shared items; a pair without a rest is complete."""
    done = pairs.where("rest = 0").select("user", "other", F.col("part").alias("sim"))
    vector = [F.col("__c.item").alias("items"), F.col("__c.x").alias("values")]

    def listed(cells: DataFrame, name: str) -> DataFrame:
        lists = cells.groupBy(F.col("user").alias(name)).agg(F.sort_array(F.collect_list(F.struct("item", "x"))).alias("__c"))
        return lists.select(name, *vector)

    a, b = listed(queries, "user"), listed(train, "other").withColumnsRenamed({"items": "items_b", "values": "values_b"})
    both = pairs.where("rest > 0").select("user", "other").join(a, "user").join(b, "other")
    kinds = {f.name: f.dataType.simpleString() for f in both.schema}

    def dots(batches):
        for pdf in batches:
            sims = []
            for i, x, j, y in zip(pdf["items"], pdf["values"], pdf["items_b"], pdf["values_b"]):
                _, at, other = np.intersect1d(i, j, assume_unique=True, return_indices=True)
                sims.append(float(np.dot(x[at], y[other])))
            yield pd.DataFrame({"user": pdf["user"], "other": pdf["other"], "sim": np.array(sims, float)})

    return done.unionByName(both.mapInPandas(dots, f"user {kinds['user']}, other {kinds['other']}, sim double"))


def answer_bounds(cells: DataFrame, held: DataFrame, postings: DataFrame, nn: int, n_train: int) -> DataFrame:
    """``user``, ``bound``: what the ``nn``-th best similarity of a query is at least, for queries whose probes found so many."""
    pairs = candidate_pairs(probe_heads(cells, postings, nn, n_train), held)
    w = Window.partitionBy("user").orderBy(F.desc("sim"))
    best = _whole_similarity(pairs, cells, held).withColumn("rank", F.row_number().over(w))
    return best.where(F.col("rank") == nn).select("user", F.round("sim", SIM_DIGITS).alias("bound"))


def _with_strangers(found: DataFrame, queries: DataFrame, train: DataFrame, nn: int) -> DataFrame:
    """Add users who share no item, whose similarity is zero, for queries with fewer than ``nn`` above zero.

    A query that met ``c`` users finds enough strangers among the first ``nn + c + 1`` by id.
    """
    met = found.groupBy("user").agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("sim") > 0).alias("above"))
    short = queries.select("user").distinct().join(met, "user", "left").na.fill(0, ["c", "above"]).where(F.col("above") < nn)
    placed = positions(train.select(F.col("user").alias("other")).distinct(), ["other"], name="place")
    lists = placed.groupBy(F.floor((F.col("place") - 1) / PLACES).alias("list")).agg(F.collect_list(F.struct("place", "other")).alias("held"))
    reach = short.select("user", (F.col("c") + nn + 1).alias("reach"))
    reach = reach.withColumn("list", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("reach") - 1) / PLACES))))
    near = reach.join(lists, "list").select("user", "reach", F.explode("held").alias("h")).where("h.place <= reach")
    strangers = near.select("user", F.col("h.other").alias("other")).where("user <> other").join(found.select("user", "other"), ["user", "other"], "left_anti")
    return found.unionByName(strangers.withColumn("sim", F.lit(0.0)))


def nearest_users(queries: DataFrame, train: DataFrame, nn: int, block: int = 1024) -> DataFrame:
    """``user``, ``other``, ``sim``, ``rank``: the ``nn`` most similar training users per query user, by exact cosine.

    Inputs hold ``(user, item, centred)``; a vector's norm is over all its own
    cells, and one of length zero is similar to none.  Similar users rank by
    similarity rounded to ten digits, then by id.
    """
    n_train = train.select("user").distinct().count()
    if n_train <= block:
        return nearest_in_blocks(queries, train, nn, block)
    cells, held = stable(_unit(queries)), stable(_unit(train))
    postings = held.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    heads = stable(query_heads(cells, stable(answer_bounds(cells, held, postings, nn, n_train)), postings))
    dear = stable(heads.groupBy("user").agg(F.sum("n").alias("cost")).where(F.col("cost") > n_train).select("user"))
    out = None
    if dear.limit(1).count():
        out = nearest_in_blocks(queries.join(dear, "user", "left_semi"), train, nn, block)
    cheap = heads.join(dear, "user", "left_anti")
    if cheap.limit(1).count() or out is None:
        found = stable(_whole_similarity(candidate_pairs(cheap, held), cells, held).withColumn("sim", F.round("sim", SIM_DIGITS)))
        asked = cells.join(dear, "user", "left_anti")
        w = Window.partitionBy("user").orderBy(F.desc("sim"), "other")
        part = _with_strangers(found, asked, held, nn).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= nn)
        out = part if out is None else out.unionByName(part)
    return out
