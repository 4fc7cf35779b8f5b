"""Cuckoo filters, and line dedup against plain Python through additions and deletions."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import line_dedup
from millrace.llm.cuckoo import Cuckoo

SCHEMA = "doc_id bigint, text string, lo bigint, doc string, n_lines string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", None) for i, t in rows], SCHEMA)


def hashes(n, seed=0):
    return np.random.default_rng(seed).integers(-(1 << 63), 1 << 63, n, np.int64)


@pytest.mark.parametrize("n", [1, 40, 3_000, 100_000])
def test_cuckoo_holds_all_and_gives_them_back(n):
    held, others = hashes(n), hashes(50_000, 1)
    f = Cuckoo.sized(n)
    f.add(held[: n // 2])
    f.add(held[n // 2 :])
    f = Cuckoo.from_bytes(f.to_bytes())
    assert f.n == n and f.has(held).all()
    assert f.has(others).mean() < 0.002
    f.remove(held[::2])
    assert f.n == n - len(held[::2]) and f.has(held[1::2]).all()
    f.remove(held[1::2])
    assert f.n == 0 and not f.table.any() and not len(f.extra)


def test_cuckoo_beyond_its_room():
    held = np.concatenate([hashes(200), np.full(30, 77, np.int64)])
    f = Cuckoo.sized(8)
    f.add(held)
    assert f.has(held).all() and len(f.extra) > 0
    f = Cuckoo.from_bytes(f.to_bytes())
    f.remove(held[::-1])
    assert f.n == 0 and not f.table.any() and not len(f.extra)
    with pytest.raises(KeyError):
        f.remove(np.array([5]))


def key(line, min_chars):
    k = line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    return k if len(k) >= min_chars else None


def plain(held, docs, min_docs, min_chars):
    """Kept text and counts per row of ``docs`` when ``held`` are indexed."""
    holders = defaultdict(list)
    for i, t in held:
        for k in {key(s, min_chars) for s in (t or "").split("\n")} - {None}:
            holders[k].append(i)
    first = lambda i: (i is not None, i or 0)
    gone = {k: max(h, key=first) for k, h in holders.items() if len(h) >= min_docs}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        stay = [s for s in lines if key(s, min_chars) not in gone or gone[key(s, min_chars)] == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return Counter(out)


def cleaned(index, docs):
    return Counter(tuple(r) for r in line_dedup.clean(index, docs).collect())


def corpus(n, seed, start=0):
    rng = random.Random(seed)
    shared = [f"a shared line number {i} of the corpus" for i in range(30)] + ["é" * 19, "é" * 20, "x" * 19, "y" * 20]
    rows = []
    for i in range(start, start + n):
        lines = rng.choices(shared, k=rng.randint(0, 6)) + [f"own line {rng.random()}"] * rng.randint(0, 2)
        rng.shuffle(lines)
        rows.append((i, "\n".join(rng.choice(["", " ", "\t"]) + (s.upper() if rng.random() < 0.2 else s) + rng.choice(["", "\r", "\x0b "]) for s in lines)))
    return rows


ODD = [(None, None), (None, "the very same line as below"), (7001, "the very same line as below"), (7001, "the very same line as below\n"), (7002, ""), (7003, "\n\n"),
       (7004, "word " * 50_000 + "\n" + "\n".join(["the very same line as below"] * 3)), (7005, " the very same line as below")]


@pytest.mark.parametrize("routed", [False, True])
def test_index_follows_additions_and_deletions(spark, monkeypatch, routed):
    if routed:
        monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    a, b = corpus(60, 1) + ODD, corpus(50, 2, 500)
    one = line_dedup.insert(line_dedup.new_index(spark, 3, 20, 4), frame(spark, a).repartition(5))
    two = line_dedup.insert(one, frame(spark, b))
    assert cleaned(one, frame(spark, a)) == plain(a, a, 3, 20)
    assert cleaned(two, frame(spark, a + b)) == plain(a + b, a + b, 3, 20)
    assert cleaned(one, frame(spark, b)) == plain(a, b, 3, 20)

    out = [r for r in a + b if r[0] is not None and (r[0] % 3 == 0 or r[0] == 7004)]
    left = [r for r in a + b if r not in out]
    three = line_dedup.delete(two, frame(spark, [*out, (99_999, "never there")]))
    assert cleaned(three, frame(spark, a + b)) == plain(left, a + b, 3, 20)

    back = line_dedup.delete(two, frame(spark, b))
    for x, y in ((back.counts, one.counts), (back.refs, one.refs)):
        assert Counter(tuple(r) for r in x.collect()) == Counter(tuple(r) for r in y.collect())
    for index in (one, two, three, back):
        live = defaultdict(list)
        for r in index.counts.where(f"docs >= {index.min_docs}").collect():
            live[r["hi"] % index.shards].append(r["lo"])
        held = {r["shard"]: Cuckoo.from_bytes(bytes(r["payload"])) for r in index.filters.collect()}
        assert {s: f.n for s, f in held.items() if f.n} == {s: len(v) for s, v in live.items()}
        assert all(held[s].has(np.array(v)).all() for s, v in live.items())

    again = line_dedup.insert(line_dedup.delete(three, frame(spark, left)), frame(spark, a))
    assert cleaned(again, frame(spark, a)) == plain(a, a, 3, 20)


def test_filters_grow(spark):
    index = line_dedup.new_index(spark, 1, 1, 1)
    rows = []
    for step in range(3):
        new = [(step * 1000 + i, f"line {step} {i}") for i in range(30 * 4**step)]
        rows += new
        index = line_dedup.insert(index, frame(spark, new))
    (f,) = index.filters.collect()
    assert Cuckoo.from_bytes(bytes(f["payload"])).n == len(rows)
    assert cleaned(index, frame(spark, rows)) == plain(rows, rows, 1, 1)


def test_empty_tables(spark):
    none = frame(spark, [])
    index = line_dedup.insert(line_dedup.new_index(spark), none)
    assert line_dedup.clean(index, none).count() == 0
    assert cleaned(index, frame(spark, ODD)) == plain([], ODD, 3, 20)
    assert line_dedup.delete(index, frame(spark, ODD)).counts.count() == 0


def test_tables_go(spark):
    index = line_dedup.insert(line_dedup.new_index(spark), frame(spark, ODD))
    assert index.refs.count() > 0
    index.drop()
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(index.paths[0]).count()
