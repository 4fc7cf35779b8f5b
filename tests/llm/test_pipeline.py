"""The corpus pipeline against a plain version of every stage."""

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import mixing, toxicity
from millrace.llm.queries import remainder
from tests.conftest import DATA
from tests.llm.test_dedup import fingerprint, linked, low
from tests.llm.test_native_ops import contaminated, filled


def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), stage(spark, docs, folder).schema)
        out.append(docs.collect())
    return out


def test_every_stage_equals_a_plain_one(spark):
    table, *kept = stages(spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    judge = toxicity.fit(docs, labels, learn=remainder("doc_id", 5) != 0).scorer()

    def ids(rows):
        return sorted(r["doc_id"] for r in rows)

    want = [r for r in table if judge(r["text"].encode()) < 0.5]
    assert ids(kept[0]) == ids(want)

    newest = {}
    for r in want:
        newest[low(r["text"])] = max(r["doc_id"], newest.get(low(r["text"]), -1))
    want = [r for r in want if newest[low(r["text"])] == r["doc_id"]]
    assert ids(kept[1]) == ids(want)

    groups = linked([(r["doc_id"], fingerprint(r["text"])) for r in want], 2)
    want = [r for r in want if groups[r["doc_id"]] == r["doc_id"]]
    assert ids(kept[2]) == ids(want)

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    found = contaminated([(r["doc_id"], r["text"]) for r in want], items, 10)
    want = [r for r, f in zip(want, found) if not f[-1]]
    assert ids(kept[3]) == ids(want)
    assert 0 < len(want) < len(table)

    sizes = Counter()
    for r in want:
        sizes[r["source"]] += len(r["text"].split())
    goal = filled(dict(sizes), (5, 2, 1), 1.5, 2.0)
    draws = {r["doc_id"]: r["u"] for r in docs.select("doc_id", mixing.draw(F.col("doc_id"), "mix").alias("u")).collect()}
    copies = Counter(r["doc_id"] for r in kept[4])
    for r in want:
        rate = goal[r["source"]] / sizes[r["source"]]
        assert copies[r["doc_id"]] == int(rate) + (draws[r["doc_id"]] < rate - int(rate))
    assert all(sorted(r["copy"] for r in kept[4] if r["doc_id"] == i) == list(range(n)) for i, n in copies.items())


def test_columns_and_rows_pass_through(spark):
    columns = spark.read.parquet(f"{DATA}/documents.parquet").columns
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, DATA)
        assert after.columns == columns
        assert after.exceptAll(before).count() == 0
        before = after


SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("copy", pa.string()), ("fp", pa.int64())])


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables(spark, tmp_path, empty):
    rows = [] if empty else [
        (1, None, None, None, None, "c", 1), (2, "", "en", "a", 0, "c", 1), (None, None, None, None, None, None, None),
        (3, "Same words here again", "en", "a", 3, "c", 1), (3, "Same words here again", "en", "a", 3, "c", 1),
        (4, "same words here again", "en", "b", 3, "c", 1), (5, "long " * 30_000, "en", "b", 3, "c", 1),
    ]
    pq.write_table(pa.Table.from_pylist([dict(zip(SCHEMA.names, r)) for r in rows], SCHEMA), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([], pa.int64()), "toxic": pa.array([], pa.int32())}), tmp_path / "labels.parquet")
    pq.write_table(pa.table({"item_id": pa.array([1, None]), "text": pa.array([None, ""])}), tmp_path / "benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == SCHEMA.names[:5] + ["fp", "copy"]
    texts = {(r["text"] or "").lower()[:4] for r in got.collect()}
    assert texts <= {"same", "long", ""}
    assert empty or "long" in texts
