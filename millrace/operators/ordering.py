"""Positions, running totals and quantiles without a single-task window.

A window with no (or a very hot) partition key moves all its rows into one
task.  The functions here range-partition the rows by ``keys + order``, work
inside each range, and add an offset per range.  A range holds a bounded share
of the rows however skewed the keys are, and the offset table has at most one
row per (range, key) pair that meets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import stable

_RANGE = "__range"


def _as_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Range-partitioned, checkpointed copy with its range number in ``__range``.

    The copy is written once so that every later use sees the same ranges.
    """
    cols = [F.col(k) for k in keys] + _as_columns(order)
    return stable(df.repartitionByRange(*cols).withColumn(_RANGE, F.spark_partition_id()))


def scan_ranges(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: dict[str, str | Column] | None = None,
    products: dict[str, str | Column] | None = None,
    descending: bool = False,
    maxima: dict[str, str | Column] | None = None,
) -> DataFrame:
    """Running sums, products and maxima over a frame made by :func:`ranged`.

    ``sums``, ``products`` and ``maxima`` map output names to expressions.  Each
    sum ``s`` also yields ``s_total``, its total over the key.  ``descending`` runs from
    the last row to the first; ``order`` must then be plain ascending columns.
    """
    keys = list(keys)
    sums = dict(sums or {})
    products = dict(products or {})
    maxima = dict(maxima or {})
    exprs = {n: F.col(e) if isinstance(e, str) else e for n, e in {**sums, **products, **maxima}.items()}

    parts = df.groupBy(_RANGE, *keys).agg(
        *[F.sum(exprs[n]).alias(f"__p_{n}") for n in sums],
        *[F.product(exprs[n]).alias(f"__p_{n}") for n in products],
        *[F.max(exprs[n]).alias(f"__p_{n}") for n in maxima],
    )
    across = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    step = F.col(_RANGE).desc() if descending else F.col(_RANGE).asc()
    before = across.orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        _RANGE,
        *keys,
        *[F.coalesce(F.sum(f"__p_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in sums],
        *[F.sum(f"__p_{n}").over(across).alias(f"{n}_total") for n in sums],
        *[F.coalesce(F.product(F.col(f"__p_{n}")).over(before), F.lit(1.0)).alias(f"__o_{n}") for n in products],
        *[F.max(f"__p_{n}").over(before).alias(f"__o_{n}") for n in maxima],
    )
    local_order = [F.desc(o) for o in order] if descending else _as_columns(order)
    inside = (
        Window.partitionBy(_RANGE, *keys)
        .orderBy(*local_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = df.select(
        "*",
        *[F.sum(exprs[n]).over(inside).alias(f"__l_{n}") for n in sums],
        *[F.product(exprs[n]).over(inside).alias(f"__l_{n}") for n in products],
        *[F.max(exprs[n]).over(inside).alias(f"__l_{n}") for n in maxima],
    )
    cond = F.col("a." + _RANGE) == F.col("b." + _RANGE)
    for k in keys:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    joined = local.alias("a").join(offsets.alias("b"), cond)
    return joined.select(
        *[F.col(f"a.{c}").alias(c) for c in df.columns],
        *[(F.col(f"a.__l_{n}") + F.col(f"b.__o_{n}")).alias(n) for n in sums],
        *[F.col(f"b.{n}_total").alias(f"{n}_total") for n in sums],
        *[(F.col(f"a.__l_{n}") * F.col(f"b.__o_{n}")).alias(n) for n in products],
        *[F.greatest(f"a.__l_{n}", f"b.__o_{n}").alias(n) for n in maxima],
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: dict[str, str | Column] | None = None,
    products: dict[str, str | Column] | None = None,
) -> DataFrame:
    """Running sums and products per key; ``order`` must be total within a key."""
    out = scan_ranges(ranged(df, keys, order), keys, order, sums, products)
    return out.drop(_RANGE)


def positions(
    df: DataFrame, order: Sequence[str | Column], keys: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """1-based position in ``order`` per key, with ``<name>_total`` the key's row count.

    One global sort numbers the rows inside every range; the number a key
    starts at comes from the row counts per (range, key).  Nothing but that
    small table is shuffled after the sort.
    """
    keys = list(keys)
    cols = [F.col(k) for k in keys] + _as_columns(order)
    # the id holds the partition number above bit 33 and the row number below
    numbered = stable(df.orderBy(*cols).withColumn("__id", F.monotonically_increasing_id()))
    numbered = numbered.select(
        *df.columns, F.shiftright("__id", 33).alias(_RANGE), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)).alias("__row")
    )
    parts = numbered.groupBy(_RANGE, *keys).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    across = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = across.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        _RANGE,
        *keys,
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__offset"),
        F.sum("__n").over(across).alias(f"{name}_total"),
    )
    cond = F.col("a." + _RANGE) == F.col("b." + _RANGE)
    for k in keys:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return numbered.alias("a").join(offsets.alias("b"), cond).select(
        *[F.col(f"a.{c}").alias(c) for c in df.columns],
        (F.col("a.__row") + F.col("b.__offset")).alias(name),
        F.col(f"b.{name}_total").alias(f"{name}_total"),
    )


def ranks(df: DataFrame, value: str, keys: Sequence[str] = (), descending: bool = True, name: str = "rank") -> DataFrame:
    """SQL ``RANK`` of every row by ``value`` per key, NULLs last.

    Equal values are counted first; the rank of a value is one more than the
    rows before it, and is joined back to the rows.
    """
    keys = list(keys)
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    placed = running(counted, keys, [order], sums={"__upto": "__n"})
    first = placed.select(*keys, value, (F.col("__upto") - F.col("__n") + 1).alias(name))
    return join_null_safe(df, first, [*keys, value])


def ntile_global(
    df: DataFrame,
    order: Sequence[str | Column],
    n: int,
    within: Sequence[str] = (),
    name: str = "ntile",
) -> DataFrame:
    """SQL ``NTILE(n)`` over the whole set, or per ``within`` group.

    ``order`` must end in a unique key.  The first ``total % n`` tiles hold one
    row more than the others.
    """
    placed = positions(df, order, within, "__pos")
    total, i = F.col("__pos_total"), F.col("__pos") - 1
    base = F.floor(total / n)
    extra = total % n
    wide = extra * (base + 1)
    tile = F.when(i < wide, F.floor(i / (base + 1))).otherwise(
        extra + F.floor((i - wide) / F.greatest(base, F.lit(1)))
    )
    return placed.withColumn(name, (tile + 1).cast("int")).drop("__pos", "__pos_total")


# A sketch with this accuracy misses a rank by at most n / SKETCH_ACCURACY rows; up to so many rows it holds every value.
SKETCH_ACCURACY = 10_000


def quantiles(
    df: DataFrame, value: str, probs: dict[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles per key; NULL and NaN values are ignored.

    A sketch per key first brackets each quantile between two values; a second
    scan counts the rows below a bracket and the values inside it, equal ones
    before the shuffle, and only those are sorted.  Brackets are wider
    than the sketch can err, so they hold their quantile; of a key that fits in
    the sketch every value is counted.  Without keys see :func:`column_quantiles`.
    """
    keys = list(keys)
    if not keys:
        found = column_quantiles(df, [value], probs)[value]
        return df.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"`{c}` double" for c in found))
    v = F.col(value).cast("double")
    data = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("__v"))
    return stable(_pick(_bracketed(data, probs, keys), probs, keys))


#: bits that one scan of a radix selection settles, and values that are few enough to look at each
DIGIT_BITS, FEW_VALUES = 13, 4_096


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the numbers."""
    bits = (x + 0.0).view(np.int64)  # -0.0 becomes 0.0
    return np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)


def _from_ordered_bits(key: int) -> float:
    return float(np.array([key if key >= 0 else key ^ ((1 << 63) - 1)], np.int64).view(np.float64)[0])


@dataclass(frozen=True)
class _Digit:
    """Values of a column whose ordered bits begin like ``prefix`` (all but the last ``done`` bits), to be told apart down to ``left`` bits."""

    column: int
    prefix: int
    done: int
    left: int


def _digit_counts(wanted: list[_Digit], names: list[str]):
    """Per wanted digit and value of it: rows, and the least and greatest ordered bits."""

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts, axis=1)
        rows = rows[:, np.lexsort((rows[1], rows[0]))]
        start = np.flatnonzero(np.concatenate([[True], (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])]))
        return np.stack([rows[0][start], rows[1][start], np.add.reduceat(rows[2], start), np.minimum.reduceat(rows[3], start), np.maximum.reduceat(rows[4], start)])

    def run(batches):
        parts: list[np.ndarray] = []
        for batch in batches:
            keys = {}
            for i in {d.column for d in wanted}:
                x = batch.column(i).to_numpy(zero_copy_only=False)
                keys[i] = np.sort(_ordered_bits(x[~np.isnan(x)]))
            for number, d in enumerate(wanted):
                own = keys[d.column]
                if d.done < 64:  # sorted, so a prefix is a stretch
                    lo, hi = d.prefix << d.done, (d.prefix << d.done) + (1 << d.done) - 1
                    own = own[np.searchsorted(own, lo, "left") : np.searchsorted(own, hi, "right")]
                if len(own):
                    digit = own >> d.left
                    start = np.flatnonzero(np.concatenate([[True], digit[1:] != digit[:-1]]))
                    n = np.diff([*start, len(own)])
                    parts.append(np.stack([np.full(len(start), number), digit[start], n, own[start], own[start + n - 1]]))
            if sum(p.shape[1] for p in parts) > 1 << 18:
                parts = [merged(parts)]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(parts)], ["w", "v", "n", "lo", "hi"])

    return run


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: dict[str, float]) -> dict[str, dict[str, float | None]]:
    """Exact linearly interpolated quantiles of several numeric columns; NULL and NaN values are ignored.

    Radix selection: a scan counts the leading bits of all columns' values at
    once, which tells the bits every wanted rank begins with; the next scan
    looks only at values that begin like that.  It ends where few values or
    one distinct value are left, after three scans of ordinary data and five at most.  Nothing
    is sorted or shuffled but those counts; a column without values has None.
    """
    columns = list(columns)
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    kinds = "w bigint, v bigint, n bigint, lo bigint, hi bigint"

    def scan(wanted: list[_Digit]) -> list[list[tuple[int, int, int, int]]]:
        rows = data.mapInArrow(_digit_counts(wanted, columns), kinds).groupBy("w", "v").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        out: list = [[] for _ in wanted]
        for r in rows.orderBy("w", "v").collect():  # at most 2 ** DIGIT_BITS per column and rank
            out[r["w"]].append((r["v"], r["n"], r["lo"], r["hi"]))
        return out

    start = [_Digit(i, 0, 64, 64 - DIGIT_BITS) for i in range(len(columns))]
    found = scan(start)
    sizes = [sum(n for _, n, _, _ in f) for f in found]
    ranks = {(i, k) for i, size in enumerate(sizes) if size for q in probs.values() for k in (math.floor((size - 1) * q), math.ceil((size - 1) * q))}
    done: dict[tuple[int, int], int] = {}
    # where each rank stands: the digit last looked at and the rank among its values
    open_ranks = {(i, k): (start[i], k) for i, k in ranks}
    counts = dict(zip(start, found))
    while open_ranks:
        following: dict[tuple[int, int], tuple[_Digit, int]] = {}
        for target, (digit, rank) in open_ranks.items():
            for v, n, lo, hi in counts[digit]:
                if rank < n:
                    break
                rank -= n
            if lo == hi or digit.left == 0:
                done[target] = lo
            else:
                left = 0 if n <= FEW_VALUES else max(0, digit.left - DIGIT_BITS)
                following[target] = _Digit(digit.column, v, digit.left, left), rank
        wanted = list(dict.fromkeys(d for d, _ in following.values()))
        counts = dict(zip(wanted, scan(wanted))) if wanted else {}
        open_ranks = following

    def quantile(i: int, q: float) -> float | None:
        if not sizes[i]:
            return None
        h = (sizes[i] - 1) * q
        lo, hi = (_from_ordered_bits(done[i, k]) for k in (math.floor(h), math.ceil(h)))
        return lo if lo == hi else lo + (h - math.floor(h)) * (hi - lo)

    return {c: {name: quantile(i, q) for name, q in probs.items()} for i, c in enumerate(columns)}


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be NULL; without keys ``right`` is one row of numbers."""
    extra = [c for c in right.columns if c not in keys]
    if not keys:
        one = right.first()
        return left.withColumns({c: F.lit(one[c]) for c in extra})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return left.alias("a").join(right.alias("b"), cond).select("a.*", *[F.col(f"b.{c}") for c in extra])


def _bracketed(data: DataFrame, probs: dict[str, float], keys: list[str]) -> DataFrame:
    """Counts ``(keys, __p, __v, __n, __size)`` of the values that can hold quantile ``__p``.

    ``__v`` is NULL for all rows below the bracket; ``__p`` is -1 for small
    keys, whose values serve every quantile.
    """
    margin = 3.0 / SKETCH_ACCURACY
    edges = [e for q in probs.values() for e in (max(0.0, q - margin), min(1.0, q + margin))]
    sketch = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__size"), F.percentile_approx("__v", edges, SKETCH_ACCURACY).alias("__e")
    )
    cuts = sketch.select(*keys, "__size", *[F.col("__e")[i].alias(f"__e{i}") for i in range(len(edges))])
    near = join_null_safe(data, cuts, keys)
    x = F.col("__v")

    def entry(p: int, held: Column) -> Column:
        return F.struct(F.lit(p).alias("p"), held.cast("double").alias("v"))

    hits = [
        F.when(x < F.col(f"__e{2 * i}"), entry(i, F.lit(None))).when(x <= F.col(f"__e{2 * i + 1}"), entry(i, x))
        for i in range(len(probs))
    ]
    small = F.col("__size") <= SKETCH_ACCURACY
    wanted = F.when(small, F.array(entry(-1, x))).otherwise(F.array_compact(F.array(*hits)))
    return (
        near.select(*keys, "__size", F.explode(wanted).alias("__h"))
        .groupBy(*keys, F.col("__h.p").alias("__p"), F.col("__h.v").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"), F.max("__size").alias("__size"))
    )


def _pick(counted: DataFrame, probs: dict[str, float], keys: list[str]) -> DataFrame:
    """Quantiles from value counts, in order of value with NULL (all lower rows) first."""
    placed = running(counted, [*keys, "__p"], [F.asc_nulls_first("__v")], sums={"__upto": "__n"})
    start, end = F.col("__upto") - F.col("__n"), F.col("__upto")
    total = F.when(F.col("__p") == -1, F.col("__upto_total")).otherwise(F.col("__size"))
    aggs = []
    for i, (out, q) in enumerate(probs.items()):
        h = (total - 1) * F.lit(float(q))
        mine = (F.col("__p") == i) | (F.col("__p") == -1)

        def at(index: Column, mine: Column = mine) -> Column:
            return F.max(F.when(mine & (start <= index) & (index < end), F.col("__v")))

        aggs += [
            at(F.floor(h)).alias(f"__lo_{out}"),
            at(F.ceil(h)).alias(f"__hi_{out}"),
            F.max(h - F.floor(h)).alias(f"__w_{out}"),
        ]
    got = placed.groupBy(*keys).agg(*aggs)
    return got.select(
        *keys,
        *[
            (F.col(f"__lo_{o}") + F.col(f"__w_{o}") * (F.col(f"__hi_{o}") - F.col(f"__lo_{o}"))).alias(o)
            for o in probs
        ],
    )
