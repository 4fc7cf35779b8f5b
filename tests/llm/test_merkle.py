"""Merkle manifest and its proofs against a plain tree."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, __g bigint, proof int"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, i):
    return [level[(i >> n) ^ 1] for n, level in enumerate(tree) if (i >> n) ^ 1 < len(level)]


def plain(rows):
    """(doc_id, leaf) -> leaf, subroot, root, siblings; rows may repeat."""
    first = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {g: levels([d for _, d in sorted((first(r[0]), leaf(r)) for r in rows if r[2] == g)]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for at, g in enumerate(langs):
        for i, d in enumerate(trees[g][0]):
            out.append((g, d, trees[g][-1][0], top[-1][0], "".join(siblings(trees[g], i) + siblings(top, at))))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, 7) for r in rows], SCHEMA)


def some(n, seed, langs=("en", "de", None, "é", "")):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", None]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", "tëxt", "x" * 9])) for i in range(n)]
    return rows + [(None, None, None, None, None), (None, "b", "en", 1, "t"), (3, "again", "en", 1, "t"), (3, "again", "en", 1, "t")]


@pytest.mark.parametrize("bits", [1, 3, 10])
@pytest.mark.parametrize("rows", [some(0, 1), some(70, 2), some(333, 3, ("en",)), [(5, None, "x", 2, "lone")], [(1, "s", None, 0, "w " * 50_000)]])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, bits, rows):
    monkeypatch.setattr(merkle, "BLOCK_BITS", bits)
    got = merkle.verify(merkle.manifest(frame(spark, rows).repartition(5), FIELDS)).collect()
    assert sorted(((r["lang"], r["leaf"], r["subroot"], r["root"], r["proof"].hex()) for r in got), key=repr) == plain(rows)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)


def test_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    rows = some(90, 4)
    got = merkle.manifest(frame(spark, rows), FIELDS).collect()
    assert sorted(((r["lang"], r["leaf"], r["subroot"], r["root"], r["proof"].hex()) for r in got), key=repr) == plain(rows)


def test_a_changed_row_is_found(spark):
    rows = some(200, 5)
    docs = frame(spark, rows).withColumn("n_chars_again", F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    again = merkle.leaf_digest(["n_chars_again" if f == "n_chars" else f for f in FIELDS])
    got = merkle.verify(merkle.manifest(docs, FIELDS, again=again)).collect()
    changed = {r[0] for r in rows if r[0] is not None and r[0] % 5 == 0 and r[3] is not None}
    assert {r["doc_id"] for r in got if not r["verified"]} == changed
    assert len(got) == len(rows) and len({r["root"] for r in got}) == 1


def test_empty_table(spark):
    got = merkle.verify(merkle.manifest(frame(spark, []), FIELDS))
    assert got.count() == 0 and "verified" in got.columns
