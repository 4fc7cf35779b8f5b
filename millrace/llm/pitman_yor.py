"""Hierarchical Pitman-Yor language model.

A word is drawn in the restaurant of its context, the word before it; the end
of a text stands before the first word of the next.  All context restaurants
share one parent, the restaurant of words without context, whose own parent is
uniform over the known words and one unknown.  A dish's customers sit at
tables; every table is a customer of the parent.  A sweep seats the customers
of every word in every restaurant anew, given the tables of the sweep before;
after a few sweeps the predictive probabilities of further sweeps are averaged.

How it runs: words are known by 64-bit hashes.  A slice holds the words of a
range of hashes with their counts, a bucket the cells (pairs of context and
word) of a range of contexts, a block some rows that a task read one after the other.
They tell each other of words and pairs in packed arrays whose order both sides
know, so no word or pair is named twice:

1. Texts are turned into places in their block's sorted words, and kept so.  Every
   block sends its words to the slices, which count them, number them and send
   the numbers back.
2. Every block sends its distinct pairs, as numbers, to the buckets, which
   count them.  A context with more tokens than a bucket takes is split by its words.
3. In a sweep the buckets send the tables per context and word to the slices,
   which seat the parent restaurant and send back what the cells need; the
   buckets seat their cells anew.  A cell without customers has no table and one
   with a single customer has one, whatever is drawn; those are counted once, and only
   cells of two customers or more take part.
4. Slices and buckets send each block what its words and pairs need, and the
   block's texts are scored.

Slices, buckets and blocks are bounded in tokens, their number grows with the corpus.
Only a few totals per slice come to the driver.  Every step is written to
the shared folder, and what no later step reads is deleted.  Random numbers are
hashes of cell and sweep, so a lost task seats the same way again.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import SPACE, byte_slices, byte_table, split_words
from millrace.session import discard, stored

#: rows and bytes of text of a block; bytes of text for each slice, and fewest slices; tokens of a bucket
BLOCK_ROWS, BLOCK_BYTES = 8_192, 32 << 20
SLICE_BYTES, LEAST_SLICES, BUCKET_TOKENS = 32 << 20, 16, 4 << 20
#: sweeps before the first sample, and samples
BURN_IN, SAMPLES = 8, 4
#: bytes of text that a task turns into words at a time
TEXT_BYTES = 5 << 20
#: strength of every restaurant
STRENGTH = 1.0
#: customers of a dish up to which their tables are drawn exactly
EXACT = 24
#: the word that ends every text
END = b""
_TABLE = byte_table(SPACE)


# ---------------------------------------------------------------- words and contexts


def numbered_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, the numbers of the different words, and of each word in order, an end after every text, which of them it is."""
    at, words = split_words(texts, _TABLE)
    n = len(at) - 1
    coded = words.cast(pa.large_string()).dictionary_encode()
    kinds = [*coded.dictionary.cast(pa.large_binary()).to_pylist(), END]
    numbers = np.array([xxhash.xxh64_intdigest(w) for w in kinds], np.uint64)
    inside = np.ones(at[-1] + n, bool)
    inside[at[1:] + np.arange(n)] = False  # where the ends come to stand
    which = np.full(len(inside), len(kinds) - 1, np.int32)
    which[inside] = coded.indices.to_numpy()
    return at + np.arange(n + 1), numbers, which


# ---------------------------------------------------------------- random numbers


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalising hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(key: np.ndarray, *more: int | np.ndarray) -> np.ndarray:
    """Hashes that follow from the key and the further numbers alone."""
    with np.errstate(over="ignore"):
        for m in more:
            key = _mix(key + np.asarray(m).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return key


def _uniform(key: np.ndarray, draw: int) -> np.ndarray:
    """The ``draw``-th number in (0, 1) of every key."""
    return ((_hashed(key, draw) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


# ---------------------------------------------------------------- seating


def _log_stirling(most: int, discount: float) -> np.ndarray:
    """``out[c, t]``: log of the weight of all ways to seat ``c`` customers at ``t`` tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(1, most + 1):
        for t in range(1, c + 1):
            stay = out[c - 1, t] + math.log(c - 1 - discount * t) if c - 1 > discount * t else -np.inf
            out[c, t] = np.logaddexp(out[c - 1, t - 1], stay)
    return out


def _beyond(count: np.ndarray, fresh: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the tables beyond the first, for many customers.

    The weights' generating function is ``exp(fresh * (1 - (1 - z) ** d) / d)``.
    With ``z`` such that ``count`` customers are expected, tables and customers
    are jointly near normal, which gives the tables given the customers.
    """
    low, high = np.full(len(count), -3000.0), np.full(len(count), -1e-12)  # log of 1 - z
    goal = np.log(count / fresh)
    for _ in range(48):
        middle = (low + high) / 2
        short = np.log(-np.expm1(middle)) + (discount - 1) * middle < goal
        low, high = np.where(short, low, middle), np.where(short, middle, high)
    mean = fresh * -np.expm1(discount * low) / discount
    odds = -np.expm1(low) * np.exp(np.minimum(-low, 700.0))  # z / (1 - z)
    return mean, np.maximum(mean - count / (1 + odds * (1 - discount)), 1e-12)


def seat(count: np.ndarray, fresh: np.ndarray, discount: float, stirling: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Tables of ``count`` customers of a dish, where a new table has weight ``fresh``.

    All customers of the dish stand up and are seated anew: ``t`` tables have the
    weight of all ways to seat them at ``t``, times ``fresh ** t``.  Up to ``EXACT``
    customers this is drawn exactly, beyond by its saddle point (Poisson where
    few tables are expected, else normal).
    """
    tables = np.minimum(count, 1)
    draw = _uniform(key, 0)
    for c in range(2, EXACT + 1):
        at = np.flatnonzero(count == c)
        if len(at):
            t = np.arange(1, c + 1)
            weight = stirling[c, 1 : c + 1][None, :] + t[None, :] * np.log(fresh[at])[:, None]
            total = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), axis=1)
            tables[at] = 1 + (draw[at, None] * total[:, -1:] > total).sum(1)
    at = np.flatnonzero(count > EXACT)
    if len(at):
        mean, variance = _beyond(count[at].astype(float), fresh[at], discount)
        u, more = draw[at], np.zeros(len(at))
        few = mean < 12
        chance = np.exp(-mean)
        below = chance.copy()
        for k in range(1, 60):
            more += few & (u > below)
            chance = chance * mean / k
            below = below + chance
        v = _uniform(key[at], 1)
        normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
        more = np.where(few, more, np.rint(mean + np.sqrt(variance) * normal))
        tables[at] = np.clip(1 + more, 1, count[at]).astype(np.int64)
    return tables


@dataclass(frozen=True)
class Totals:
    """What all tasks share: words with training counts, their tokens, discounts; customers and tables of the parent."""

    known: int
    tokens: int
    discount: float
    parent_discount: float
    served: int
    parent_tables: int

    @property
    def back(self) -> float:
        """Weight of a new table in the parent, for one word."""
        return (STRENGTH + self.parent_discount * self.parent_tables) / (self.known + 1)

    def chance(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probability of words without context."""
        return (customers - self.parent_discount * tables + self.back) / (STRENGTH + self.served)


# ---------------------------------------------------------------- corpus passes


def _dump(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; whole numbers that are not negative in the narrowest type."""
    made = []
    for x in arrays:
        if x.dtype.kind in "iu" and x.dtype.itemsize > 1 and (not len(x) or x.min() >= 0):
            x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
        made.append(np.ascontiguousarray(x))
    head = json.dumps([(x.dtype.str, len(x)) for x in made]).encode()
    return len(head).to_bytes(4, "little") + head + pa.compress(b"".join(x.tobytes() for x in made), codec="zstd", asbytes=True)


def _load(data: bytes) -> list[np.ndarray]:
    """The arrays of :func:`_dump`; whole numbers below 2^16 as 32-bit ones, others as 64-bit ones."""
    n = int.from_bytes(data[:4], "little")
    head = json.loads(data[4 : 4 + n])
    body = pa.decompress(data[4 + n :], decompressed_size=sum(np.dtype(t).itemsize * k for t, k in head), codec="zstd", asbytes=True)
    out, at = [], 0
    for t, k in head:
        x = np.frombuffer(body, t, k, at)
        at += x.nbytes
        out.append(x.astype(np.int32 if x.dtype.itemsize < 4 else np.int64) if x.dtype.kind in "iu" and x.dtype.itemsize < 8 else x)
    return out


def _gaps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending[:1] * 0)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each key, from rows sorted by it."""
    now, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if held and row[key] != now:
                yield now, held
                held = []
            now = row[key]
            held.append(row)
    if held:
        yield now, held


def _made(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _dealt(df: DataFrame, key: str, *order: str) -> DataFrame:
    # a stated number, so that large packs are not put together in few partitions
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key).sortWithinPartitions(key, *order)


def encode(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted numbers of the texts' different words, tokens of each text, and each token's place among the words."""
    parts = byte_slices((pa.RecordBatch.from_arrays([c], ["text"]) for c in texts.chunks), "text", TEXT_BYTES)
    pieces = [numbered_words(part.column(0)) for part in parts]
    words = np.unique(np.concatenate([np.zeros(0, np.uint64), *[numbers for _, numbers, _ in pieces]]))
    code = [np.searchsorted(words, numbers).astype(np.int32)[which] for _, numbers, which in pieces]
    lengths = [np.diff(at) for at, *_ in pieces]
    return words, np.concatenate([np.zeros(0, np.int64), *lengths]), np.concatenate([np.zeros(0, np.int32), *code])


class Tokens:
    """A block's tokens as places among its ``n_words`` words, and which of them teach the model."""

    def __init__(self, lengths: np.ndarray, learn: np.ndarray, code: np.ndarray, n_words: int):
        self.at = np.concatenate([[0], np.cumsum(lengths)])
        self.learn, self.code, self.n_words = np.asarray(learn, bool), code, n_words

    @property
    def train(self) -> np.ndarray:
        return np.repeat(self.learn, np.diff(self.at))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training tokens and all tokens of every word."""
        return np.bincount(self.code[self.train], minlength=self.n_words), np.bincount(self.code, minlength=self.n_words)

    def keys(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Context and word of each token, in one number; a text's end stands before the next text."""
        hi = len(self.code) if hi is None else hi
        before = self.code[lo - 1 : hi - 1] if lo else np.concatenate([self.code[-1:], self.code[: hi - 1]])
        return before.astype(np.int64) * self.n_words + self.code[lo:hi]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Key of every distinct pair, ascending, and its training tokens."""
        marked = self.keys()
        marked <<= 1
        marked |= self.train
        marked.sort()
        first = np.flatnonzero(np.concatenate([[True], (marked[1:] ^ marked[:-1]) > 1]))
        c = np.add.reduceat(marked & 1, first)
        return marked[first] >> 1, c


def slice_of(words: np.ndarray, slices: int) -> np.ndarray:
    """The slice of each 64-bit word number; it ascends with the unsigned number."""
    return ((words >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def _cut(sorted_ids: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` begins in ascending part numbers."""
    return np.searchsorted(sorted_ids, np.arange(parts + 1))


ENCODED = pa.schema([("kind", pa.int32()), ("slice", pa.int32()), ("block", pa.int64()), ("pack", pa.binary()), ("ids", pa.binary())])
_ENCODED = "kind int, slice int, block bigint, pack binary, ids binary"
WORDS, TEXTS = 0, 1


def _encoded(rows: DataFrame, slices: int, block_rows: int, block_bytes: int) -> DataFrame:
    """Step 1 over ``id``, ``text``, ``train``: a row of each block's tokens and keys, and per slice one of its words with their counts."""

    def out(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        words, lengths, code = encode(t.column("text"))
        learn = pc.fill_null(t.column("train"), False).to_numpy()
        n, every = Tokens(lengths, learn, code, len(words)).counts()
        sink, ids = pa.BufferOutputStream(), t.select(["id"])
        with pa.ipc.new_stream(sink, ids.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_table(ids)
        pack = _dump(lengths, learn.astype(np.uint8), code)
        made = [{"kind": TEXTS, "slice": None, "block": block, "pack": pack, "ids": sink.getvalue().to_pybytes()}]
        cuts = _cut(slice_of(words, slices), slices)
        for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            if hi > lo:
                made.append({"kind": WORDS, "slice": i, "block": block, "pack": _dump(words[lo:hi], n[lo:hi], every[lo:hi]), "ids": None})
        pa.default_memory_pool().release_unused()
        return _made(made, ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a block's number follows from the task's and its place there, so a task that runs again numbers alike
        block, held, n, size = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in byte_slices(batches, "text", min(TEXT_BYTES, block_bytes)):
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block_rows - n)
                at += part.num_rows
                n += part.num_rows
                size += part.nbytes
                held.append(part)
                if n >= block_rows or size >= block_bytes:
                    yield out(block, held)
                    block, held, n, size = block + 1, [], 0, 0
        if held:
            yield out(block, held)

    return rows.mapInArrow(run, _ENCODED)


NUMBERED = pa.schema([("kind", pa.int32()), ("slice", pa.int32()), ("block", pa.int64()), ("size", pa.int64()), ("buckets", pa.int64()), ("pack", pa.binary())])
VOCABULARY, MAP = 0, 1


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1, in the slices: a row of all words with their counts, and one per block of where its words stand.

    A word's tokens fill buckets one after the other; ``first`` is its first
    bucket within the slice, ``span`` the number of buckets it reaches over.
    """
    for number, rows in _groups(batches, "slice"):
        parts = [(r["block"], *_load(r["pack"])) for r in rows]
        words, inverse = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
        n, every = (np.bincount(inverse, np.concatenate([p[k] for p in parts]).astype(float), len(words)).astype(np.int64) for k in (2, 3))
        upto = np.cumsum(every)
        first, last = (upto - every) // BUCKET_TOKENS, (upto - 1) // BUCKET_TOKENS
        out = [{"kind": VOCABULARY, "slice": number, "block": None, "size": len(words), "buckets": int(last.max()) + 1, "pack": _dump(words, n)}]
        at = 0
        for block, own, *_ in parts:
            ids = inverse[at : at + len(own)]
            at += len(own)
            pack = _dump(_gaps(ids), _gaps(first[ids]), (last - first)[ids])
            out.append({"kind": MAP, "slice": number, "block": block, "size": None, "buckets": None, "pack": pack})
        yield _made(out, NUMBERED)


@dataclass(frozen=True)
class Offsets:
    """Number of the first word, and of the first bucket, of every slice, and of the one behind the last."""

    words: np.ndarray
    buckets: np.ndarray

    def split(self, ids: np.ndarray) -> np.ndarray:
        """Where each slice begins in ascending word numbers."""
        return np.searchsorted(ids, self.words)


def _block_words(maps: list[tuple[int, list[np.ndarray]]], offsets: Offsets) -> tuple[np.ndarray, ...]:
    """Numbers, first buckets and spans of a block's words, and what else its maps hold; from (slice, map) in order."""
    made = []
    for number, (ids, first, span, *more) in maps:
        made.append((np.cumsum(ids) + offsets.words[number], np.cumsum(first) + offsets.buckets[number], span + 1, *more))
    return tuple(np.concatenate(x) for x in zip(*made))


def _bucket_of(u: np.ndarray, w: np.ndarray, first: np.ndarray, span: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The bucket of each pair of a block's words; a frequent context is split by its words."""
    return first[u] + ids[w] % span[u]


TO_BUCKET = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("pack", pa.binary())])


def _sent_pairs(offsets: Offsets):
    """Step 2, in the blocks: per bucket the block's pairs as word numbers, with their training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _groups(batches, "block"):
            ids, first, span = _block_words([(r["slice"], _load(r["pack"])) for r in rows[:-1]], offsets)
            key, c = Tokens(*_load(rows[-1]["pack"]), len(ids)).pairs()
            u, w = key // len(ids), key % len(ids)
            bucket = _bucket_of(u, w, first, span, ids)
            order = np.argsort(bucket, kind="stable")
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]])
            out = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                mine = order[lo:hi]
                pack = _dump(_gaps(ids[u[mine]]), ids[w[mine]], c[mine])
                out.append({"bucket": int(bucket[mine[0]]), "block": block, "pack": pack})
            yield _made(out, TO_BUCKET)
            pa.default_memory_pool().release_unused()

    return run


COUNTED = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("slice", pa.int32()), ("block", pa.int64()), ("ones", pa.int64()), ("twos", pa.int64()), ("pack", pa.binary())])
CELLS, CODES, ONCE, LISTS = 0, 1, 2, 3


def _counted(offsets: Offsets):
    """Step 2, in the buckets: the cells, each block's pairs as classes and cells, and what the slices need to know.

    A pair's class is 0, 1 or 2 training tokens (2: a cell).
    """

    def row(kind, bucket, pack, number=None, block=None, ones=0, twos=0):
        return {"kind": kind, "bucket": bucket, "slice": number, "block": block, "ones": ones, "twos": twos, "pack": pack}

    def to_slices(kind, bucket, *lists):
        """A row per slice of (ids, values) lists, ids counted from the slice's first word."""
        cuts = [offsets.split(ids) for ids, _ in lists]
        for i, start in enumerate(offsets.words[:-1]):
            arrays = []
            for (ids, values), at in zip(lists, cuts):
                arrays += [_gaps(ids[at[i] : at[i + 1]] - start), values[at[i] : at[i + 1]]]
            if any(len(x) for x in arrays):
                yield row(kind, bucket, _dump(*arrays), i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches, "bucket"):
            parts = [(r["block"], *_load(r["pack"])) for r in rows]
            u = np.concatenate([np.cumsum(p[1]) for p in parts])
            w, c = (np.concatenate([p[k] for p in parts]) for k in (2, 3))
            base, wide = u.min(), int(offsets.words[-1])
            if (int(u.max() - base) + 1) * wide >= 1 << 63:
                raise ValueError("too many different words")
            pair, inverse = np.unique((u - base) * wide + w, return_inverse=True)
            n = np.bincount(inverse, c.astype(float), len(pair)).astype(np.int64)
            u, w = pair // wide + base, pair % wide
            many, once = n >= 2, n == 1
            cu, iu, nu = np.unique(u[many], return_inverse=True, return_counts=True)
            cw, iw, nw = np.unique(w[many], return_inverse=True, return_counts=True)
            pack = _dump(cu, cw, iu, iw, n[many])
            out = [row(CELLS, bucket, pack, ones=int(once.sum()), twos=int((n == 2).sum()))]
            place, cell = np.minimum(n, 2).astype(np.uint8), np.cumsum(many) - 1
            at = 0
            for block, gaps, *_ in parts:
                mine = inverse[at : at + len(gaps)]
                at += len(gaps)
                out.append(row(CODES, bucket, _dump(place[mine], _gaps(cell[mine][place[mine] == 2])), block=block))
            out += to_slices(ONCE, bucket, *[np.unique(x[once], return_counts=True) for x in (u, w)])
            out += to_slices(LISTS, bucket, (cu, nu), (cw, nw))
            yield _made(out, COUNTED)
            pa.default_memory_pool().release_unused()

    return run


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


SEATED = pa.schema([("kind", pa.int32()), ("slice", pa.int32()), ("bucket", pa.int64()), ("served", pa.int64()), ("tables", pa.int64()), ("pack", pa.binary())])
_SEATED = "kind int, slice int, bucket bigint, served bigint, tables bigint, pack binary"
STATE = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("slice", pa.int32()), ("pack", pa.binary())])
_STATE = "kind int, bucket bigint, slice int, pack binary"
#: rows of a sweep's tables: the vectors of a slice, or the state of a bucket, and what goes to the other side
OWN, SENT = 0, 1


def _started(offsets: Offsets, discount: float):
    """The first state of every bucket, ``count ** discount`` tables a cell, and its sums for the slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches, "bucket"):
            cu, cw, iu, iw, c = _load(rows[0]["pack"])
            t = np.minimum(c, np.maximum(1, np.rint(c.astype(float) ** discount))).astype(np.int64)
            yield _state(bucket, offsets, cu, cw, iu, iw, c, t, np.zeros(len(c)))

    return run


def _state(bucket: int, offsets: Offsets, cu, cw, iu, iw, c, t, m) -> pa.RecordBatch:
    """A bucket's state, and its tables per context and per word for the slices, in the order of the lists they hold."""
    out = [{"kind": OWN, "bucket": bucket, "slice": None, "pack": _dump(cu, cw, iu, iw, c, t, m)}]
    sums = [np.bincount(i, t.astype(float), len(ids)).astype(np.int64) for i, ids in ((iu, cu), (iw, cw))]
    at_u, at_w = offsets.split(cu), offsets.split(cw)
    for i in range(len(offsets.words) - 1):
        mine = sums[0][at_u[i] : at_u[i + 1]], sums[1][at_w[i] : at_w[i + 1]]
        if len(mine[0]) + len(mine[1]):
            out.append({"kind": SENT, "bucket": bucket, "slice": i, "pack": _dump(*mine)})
    return _made(out, STATE)


FACTS = pa.schema([("slice", pa.int32()), *[(c, pa.int64()) for c in ("known", "tokens", "s1", "s2")], ("pack", pa.binary())])


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice the counts of its words, and how many pairs met once follow and are each word; with numbers for the totals."""
    for number, rows in _groups(batches, "slice"):
        _, n = _load(next(r["pack"] for r in rows if r["kind"] == VOCABULARY - 1))
        after, own, contexts = (np.zeros(len(n), np.int64) for _ in range(3))
        for r in rows:
            if r["kind"] in (ONCE, LISTS):
                iu, nu, iw, nw = _load(r["pack"])
                if r["kind"] == ONCE:
                    after[np.cumsum(iu)] += nu
                    own[np.cumsum(iw)] += nw
                contexts[np.cumsum(iw)] += nw
        facts = {"known": int((n > 0).sum()), "tokens": int(n.sum()), "s1": int((contexts == 1).sum()), "s2": int((contexts == 2).sum())}
        yield _made([{"slice": number, **facts, "pack": _dump(n, after, own)}], FACTS)


def _parent_seated(totals: Totals | None, sweep: int, offsets: Offsets):
    """Step 3, in the slices: tables behind every context and of every word, and the parent's tables; and the answers to the buckets.

    Rows of a slice: its facts, then per bucket the list of its words and the sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _groups(batches, "slice"):
            n, *once = _load(rows[0]["pack"])
            behind, tw = (x.astype(np.int64) for x in once)
            lists = {}
            for r in rows[1:]:
                if r["kind"] == LISTS:
                    iu, _, iw, _ = _load(r["pack"])
                    lists[r["bucket"]] = np.cumsum(iu), np.cumsum(iw)
                else:
                    su, sw = _load(r["pack"])
                    iu, iw = lists[r["bucket"]]
                    behind[iu] += su
                    tw[iw] += sw
            if totals is None:
                tp = np.minimum(tw, 1)
            else:
                key = _hashed((np.arange(len(n)) + offsets.words[number]).astype(np.uint64) + np.uint64(1), sweep)
                d = totals.parent_discount
                tp = seat(tw, np.full(len(tw), totals.back), d, _log_stirling(EXACT, d), key)
            out = [{"kind": OWN, "slice": number, "bucket": None, "served": int(tw.sum()), "tables": int(tp.sum()), "pack": _dump(behind, tw, tp)}]
            for bucket, (iu, iw) in lists.items():
                out.append({"kind": SENT, "slice": number, "bucket": bucket, "served": 0, "tables": 0, "pack": _dump(behind[iu], tw[iw], tp[iw])})
            yield _made(out, SEATED)

    return run


def _cells_seated(totals: Totals, sweep: int, samples: int, sampled: bool, last: bool, offsets: Offsets):
    """Step 3, in the buckets: add the sample to the means, then seat the cells anew given the slices' answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stirling = _log_stirling(EXACT, totals.discount)
        for bucket, rows in _groups(batches, "bucket"):
            cu, cw, iu, iw, c, t, m = _load(rows[0]["pack"])
            answers = [_load(r["pack"]) for r in rows[1:]]
            behind, tw, tp = (np.concatenate([a[k] for a in answers] or [np.zeros(0, np.int64)]) for k in range(3))
            if sampled:
                m = m + (c - totals.discount * t) / samples
            if not last:
                fresh = (STRENGTH + totals.discount * behind)[iu] * totals.chance(tw, tp)[iw]
                key = _hashed(_hashed(cu.astype(np.uint64)[iu] + np.uint64(1), cw[iw]), sweep)
                t = seat(c, fresh, totals.discount, stirling, key)
            yield _state(bucket, offsets, cu, cw, iu, iw, c, t, m)

    return run


@dataclass(frozen=True)
class Model:
    """What the samples say: ``texts``, ``numbered`` and ``counted`` of steps 1 and 2, ``facts`` and, per sample, vectors per
    slice, the last state of the buckets with the mean of ``count - discount * tables`` per cell, and an entry of totals per sample."""

    texts: DataFrame
    numbered: DataFrame
    counted: DataFrame
    facts: DataFrame
    vectors: list[DataFrame]
    state: DataFrame
    totals: list[Totals]
    offsets: Offsets
    paths: list[str]

    def drop(self) -> None:
        for path in self.paths:
            discard(self.state.sparkSession, path)


def count(rows: DataFrame, block_rows: int, block_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame, Offsets, list[str]]:
    """Steps 1 and 2: the blocks' texts, the slices' words and the blocks' maps, the buckets' cells and the blocks' classes."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(LEAST_SLICES, math.ceil(size / SLICE_BYTES))
    encoded, path = stored(_encoded(rows, slices, block_rows, block_bytes), "encoded", "kind")
    texts = encoded.where(F.col("kind") == TEXTS).select("block", "pack", "ids")
    words = encoded.where(F.col("kind") == WORDS).select("slice", "block", "pack")
    kinds = "kind int, slice int, block bigint, size bigint, buckets bigint, pack binary"
    numbered, words_path = stored(_dealt(words, "slice", "block").mapInArrow(_numbered, kinds), "words")
    discard(spark, f"{path}/kind={WORDS}")
    # a row per slice
    sizes = {r["slice"]: (r["size"], r["buckets"]) for r in numbered.where(F.col("kind") == VOCABULARY).select("slice", "size", "buckets").collect()}
    table = np.array([(0, 0), *[sizes.get(i, (0, 0)) for i in range(slices)]])
    offsets = Offsets(np.cumsum(table[:, 0]), np.cumsum(table[:, 1]))

    maps = numbered.where(F.col("kind") == MAP).select("block", F.lit(0).alias("kind"), "slice", "pack")
    own = texts.select("block", F.lit(1).alias("kind"), F.lit(0).alias("slice"), "pack")
    sent = _dealt(maps.unionByName(own), "block", "kind", "slice").mapInArrow(_sent_pairs(offsets), "bucket bigint, block bigint, pack binary")
    kinds = "kind int, bucket bigint, slice int, block bigint, ones bigint, twos bigint, pack binary"
    counted, pairs_path = stored(_dealt(sent, "bucket", "block").mapInArrow(_counted(offsets), kinds), "pairs")
    return texts, numbered, counted, offsets, [words_path, pairs_path]


def fit(rows: DataFrame, burn_in: int, samples: int, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> Model:
    """Count ``id``, ``text``, ``train``, and seat the cells in ``burn_in + samples`` states of which the last ``samples`` are kept."""
    spark = rows.sparkSession
    texts, numbered, counted, offsets, paths = count(rows, block_rows, block_bytes)
    vocabulary = numbered.where(F.col("kind") == VOCABULARY)
    cells = counted.where(F.col("kind") == CELLS)
    told = counted.where(F.col("kind").isin(ONCE, LISTS)).select("slice", "kind", "bucket", "pack")
    first = vocabulary.select("slice", F.lit(VOCABULARY - 1).alias("kind"), F.lit(None).cast("long").alias("bucket"), "pack")
    kinds = "slice int, known bigint, tokens bigint, s1 bigint, s2 bigint, pack binary"
    facts, path = stored(_dealt(first.unionByName(told), "slice", "kind", "bucket").mapInArrow(_facts, kinds), "facts")
    paths.append(path)
    v = facts.agg(*[_sum(x).alias(x) for x in ("known", "tokens", "s1", "s2")]).first()
    r = cells.agg(_sum("ones").alias("n1"), _sum("twos").alias("n2")).first()
    discounts = [min(0.95, max(0.05, a / (a + 2 * b + 1e-9))) for a, b in ((r["n1"], r["n2"]), (v["s1"], v["s2"]))]
    totals = Totals(v["known"], v["tokens"], *discounts, 0, 0)

    state, at = stored(_dealt(cells.select("bucket", "pack"), "bucket").mapInArrow(_started(offsets, totals.discount), _STATE), "state")
    lists = told.where(F.col("kind") == LISTS)
    own = facts.select("slice", F.lit(-1).alias("kind"), F.lit(None).cast("long").alias("bucket"), "pack")
    vectors, kept = [], []
    for s in range(burn_in + samples):
        sums = state.where(F.col("kind") == SENT).select("slice", F.lit(LISTS + 1).alias("kind"), "bucket", "pack")
        met = _dealt(own.unionByName(lists).unionByName(sums), "slice", "kind", "bucket")
        seated, held = stored(met.mapInArrow(_parent_seated(totals if s else None, s, offsets), _SEATED), "slices")
        v = seated.where(F.col("kind") == OWN).agg(_sum("served").alias("served"), _sum("tables").alias("tables")).first()
        totals = replace(totals, served=v["served"], parent_tables=v["tables"])
        sampled, last = s >= burn_in, s == burn_in + samples - 1
        answers = seated.where(F.col("kind") == SENT).select("bucket", F.lit(SENT).alias("kind"), "slice", "pack")
        mine = state.where(F.col("kind") == OWN).select("bucket", "kind", "slice", "pack")
        met = _dealt(mine.unionByName(answers), "bucket", "kind", "slice")
        state, after = stored(met.mapInArrow(_cells_seated(totals, s, samples, sampled, last, offsets), _STATE), "state")
        discard(spark, at)
        at = after
        if sampled:
            vectors.append(seated.where(F.col("kind") == OWN))
            kept.append(totals)
            paths.append(held)
        else:
            discard(spark, held)
    return Model(texts, numbered, counted, facts, vectors, state, kept, offsets, [*paths, at])


def _told_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4, in the slices: each block's words with their first bucket, span, count, and tables per sample."""
    for number, rows in _groups(batches, "slice"):
        n = _load(rows[0]["pack"])[0]
        samples = [_load(r["pack"]) for r in rows if r["kind"] == 1]
        # later samples as differences from the first, which are mostly small
        vectors = [*samples[0], *[x - first for v in samples[1:] for x, first in zip(v, samples[0])]]
        for r in rows:
            if r["kind"] == 2:
                gaps, first, span = _load(r["pack"])
                ids = np.cumsum(gaps)
                pack = _dump(gaps, first, span, n[ids], *[x[ids] for x in vectors])
                yield _made([{"block": r["block"], "kind": 0, "at": number, "pack": pack}], TOLD)


TOLD = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("at", pa.int64()), ("pack", pa.binary())])


def _told_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4, in the buckets: each block's pairs with their class, and the means of its cells."""
    for bucket, rows in _groups(batches, "bucket"):
        m = _load(rows[0]["pack"])[6]
        for r in rows[1:]:
            place, gaps = _load(r["pack"])
            pack = _dump(place.astype(np.uint8), m[np.cumsum(gaps)])
            yield _made([{"block": r["block"], "kind": 1, "at": bucket, "pack": pack}], TOLD)


def _answers(model: Model) -> DataFrame:
    """``block``, ``kind`` (0 words, 1 pairs), ``at`` (slice or bucket), ``pack``: what the texts of each block need."""
    told = "block bigint, kind int, at bigint, pack binary"
    nobody = F.lit(None).cast("long").alias("block")
    words = model.facts.select("slice", F.lit(0).alias("kind"), F.lit(-1).alias("s"), nobody, "pack")
    for s, v in enumerate(model.vectors):
        words = words.unionByName(v.select("slice", F.lit(1).alias("kind"), F.lit(s).alias("s"), nobody, "pack"))
    maps = model.numbered.where(F.col("kind") == MAP).select("slice", F.lit(2).alias("kind"), F.lit(0).alias("s"), "block", "pack")
    words = _dealt(words.unionByName(maps), "slice", "kind", "s").mapInArrow(_told_words, told)
    pairs = model.state.where(F.col("kind") == OWN).select("bucket", F.lit(0).alias("kind"), nobody, "pack")
    codes = model.counted.where(F.col("kind") == CODES).select("bucket", F.lit(1).alias("kind"), "block", "pack")
    return words.unionByName(_dealt(pairs.unionByName(codes), "bucket", "kind").mapInArrow(_told_pairs, told))


#: pairs or tokens that are worked on together
PIECE = 1 << 18


def _scored(totals: list[Totals], offsets: Offsets, pack: bytes, rows: list[dict]) -> list[np.ndarray]:
    """n_tokens, n_known, base_score and score of every text of a block, from its answers in order."""
    ids, first, span, n, *tables = _block_words([(r["at"], _load(r["pack"])) for r in rows if r["kind"] == 0], offsets)
    for k in range(3, len(tables)):
        tables[k] = tables[k] + tables[k % 3]
    p, wide = Tokens(*_load(pack), len(ids)), len(ids)
    key, _ = p.pairs()
    order = np.argsort(_bucket_of(key // wide, key % wide, first, span, ids), kind="stable")
    del ids, first, span
    place, cells = (np.concatenate(x) for x in zip(*[_load(r["pack"]) for r in rows if r["kind"] == 1]))
    values = np.where(place == 1, 1 - totals[0].discount, 0.0)
    values[place == 2] = cells
    # the means of count - discount * tables, then the probabilities
    chance = np.empty(len(key))
    chance[order] = values
    del order, values, place, cells
    new = [STRENGTH + t.discount * tables[3 * s] for s, t in enumerate(totals)]
    q = [t.chance(tables[3 * s + 1], tables[3 * s + 2]) for s, t in enumerate(totals)]
    for lo in range(0, len(key), PIECE):
        now = slice(lo, lo + PIECE)
        a, b = key[now] // wide, key[now] % wide
        mean = sum(x[a] * y[b] for x, y in zip(new, q)) / len(totals)
        chance[now] = np.log10((chance[now] + mean) / (STRENGTH + n[a]))
    del new, q, tables
    score = np.empty(len(p.code))
    for lo in range(0, len(score), PIECE):
        hi = min(lo + PIECE, len(score))
        score[lo:hi] = chance[np.searchsorted(key, p.keys(lo, hi))]
    base = np.log10((n + 1) / (totals[0].tokens + totals[0].known + 1))
    known = (n > 0).astype(np.int64)
    return [np.diff(p.at), np.add.reduceat(known[p.code], p.at[:-1]), np.add.reduceat(base[p.code], p.at[:-1]), np.add.reduceat(score, p.at[:-1])]


def score_texts(
    docs: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    burn_in: int | None = None,
    samples: int | None = None,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int | None = None,
) -> DataFrame:
    """Per row: key, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    Words are what stands between white space, A-Z lower-cased, and one end per
    text; the model learns from the rows where ``train`` is true.  ``score`` is
    the log10 probability of the whole text, ``base_score`` that of single words
    with one added to every count.  Null and empty texts are an end alone.
    Without training rows every word is the unknown one.  Repeated rows count
    and score each for itself; other columns are left out, whatever their names.
    A text of any length is whole in one task.  ``burn_in`` and ``samples``
    count states (``BURN_IN``, ``SAMPLES``).
    """
    burn_in, samples = BURN_IN if burn_in is None else burn_in, SAMPLES if samples is None else samples
    if burn_in < 1 or samples < 1 or block_rows < 1:
        raise ValueError("burn_in, samples and block_rows must be at least 1")
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"), train.alias("train"))
    model = fit(rows, burn_in, samples, block_rows, block_bytes or BLOCK_BYTES)
    totals, offsets = model.totals, model.offsets
    answers, _ = stored(_answers(model), "answers")
    model.drop()
    nothing = F.lit(None).cast("binary").alias("ids")
    texts = model.texts.select("block", F.lit(2).alias("kind"), F.lit(0).cast("long").alias("at"), "pack", "ids")
    met = _dealt(answers.select("*", nothing).unionByName(texts), "block", "kind", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, told in _groups(batches, "block"):
            out = _scored(totals, offsets, told[-1]["pack"], told[:-1])
            ids = pa.ipc.open_stream(told[-1]["ids"]).read_all().column("id").combine_chunks()
            ids = ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks)
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(x) for x in out]], ["id", "n_tokens", "n_known", "base_score", "score"])
            pa.default_memory_pool().release_unused()

    id_kind = rows.schema["id"].dataType.simpleString()
    out = met.mapInArrow(run, f"id {id_kind}, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select(
        F.col("id").alias(key),
        "n_tokens",
        "n_known",
        F.lit(totals[0].tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
