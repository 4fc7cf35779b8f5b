"""Queries without a SQL twin: they run, and their results keep their invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from millrace.operators import topics
from tests.conftest import DATA

QUERIES = queries()
ROWS_ONLY = sorted(set(QUERIES) - set(oracle_sql()))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def run(spark, name):
    return QUERIES[name](spark, DATA)


def test_reloaded_model_predicts_the_same(spark):
    assert run(spark, "S31_save_load_model").where("fitted <> reloaded").count() == 0


def test_dropped_table_is_gone(spark):
    assert run(spark, "S28_drop_table").where("still_there").count() == 0


def test_topic_probabilities(spark):
    sums = run(spark, "X22_topic_terms").groupBy("topic").agg(F.sum("beta").alias("s")).collect()
    assert len(sums) == 2
    assert all(r["s"] == pytest.approx(1.0) for r in sums)


def test_topics_explain_the_words_as_well_as_the_library_model(spark):
    """The log-likelihood of a corpus with known topics, against MLlib's model with the same number of steps."""
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer

    rng = np.random.default_rng(6)
    vocabulary = [f"word{i:03d}" for i in range(150)]
    kinds = rng.dirichlet(np.full(150, 0.1), 3)
    mixes = rng.dirichlet([0.3] * 3, 300)
    drawn = [rng.choice(150, 60, p=m @ kinds) for m in mixes]
    rows = [(i, " ".join(vocabulary[j] for j in words)) for i, words in enumerate(drawn)]
    rows += [(1000, None), (1001, ""), (1002, "ab c"), (None, "word001 word001")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = topics.fit_topics(docs, "doc_id", "text", 3)
    ours = topics.log_likelihood(model, docs, "text")

    held = docs.select("doc_id", topics.term_list("text").alias("terms")).where("size(terms) > 0")
    counter = CountVectorizer(inputCol="terms", outputCol="features").fit(held)
    lda = LDA(k=3, seed=1, maxIter=20, optimizer="online", subsamplingRate=1.0).fit(counter.transform(held))
    beta = lda.topicsMatrix().toArray()
    beta = beta / beta.sum(axis=0)
    theirs = 0.0
    for r in lda.transform(counter.transform(held)).collect():
        for i, n in zip(r["features"].indices, r["features"].values):
            theirs += n * np.log(beta[i] @ r["topicDistribution"].toArray())
    assert ours >= theirs
    truth = sum(np.log((m @ kinds)[words]).sum() for m, words in zip(mixes, drawn))
    assert ours >= 1.01 * truth

    mixed = {r["doc_id"]: r for r in model.document_topics(docs, "text").collect()}
    assert set(mixed) == {*range(300), None}
    assert all(sum(r["gamma"]) == pytest.approx(1.0) for r in mixed.values())
    new = model.document_topics(spark.createDataFrame([(1, "never seen")], docs.schema), "text").first()
    assert new["gamma"] == pytest.approx([1 / 3] * 3) and new["topic"] == 1


def test_topics_in_blocks(spark, monkeypatch):
    """Many blocks give the sums of one; documents stay in place and only sums per block and term are exchanged."""
    rng = np.random.default_rng(6)
    rows = [(i if i else None, " ".join(f"word{j:03d}" for j in rng.integers(0, 60, 20)) + f" own{i}") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    def weights():
        return {r["term"]: [r["t0"], r["t1"], r["t2"]] for r in topics.fit_topics(docs, "doc_id", "text", 3, max_iter=3).weights.collect()}

    one = weights()
    monkeypatch.setattr(topics, "LEAST_CELLS", 100)
    many = weights()
    assert set(one) == set(many) and len(one) == 140
    for term, w in one.items():
        assert many[term] == pytest.approx(w, rel=1e-9)
    held, _, n_terms, n_shared = topics._blocks(topics._cells(docs, "doc_id", "text", 3), 3, 1)
    assert held.select("block").distinct().count() > 2 and (n_terms, n_shared) == (140, 60)
    other = spark.range(3).select(F.col("id").cast("int").alias("block"), F.lit(0).alias("x"))
    both = held.groupBy("block").cogroup(other.groupBy("block")).applyInArrow(lambda a, b: a.select(["place"]), "place long")
    assert both._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_topic_steps_exchange_packed_sums(spark, monkeypatch):
    """A step reads a row per piece of a block; keys of several rows are one document, rare terms may be left out."""
    monkeypatch.setattr(topics, "LEAST_CELLS", 100)
    monkeypatch.setattr(topics, "PIECE_CELLS", 50)
    rng = np.random.default_rng(7)
    rows = [(i // 2 if i > 5 else None, " ".join(f"word{j:02d}" for j in rng.integers(0, 40, 30)) + f" own{i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held, terms, n_terms, n_shared = topics._blocks(topics._cells(docs, "doc_id", "text", 3), 2, 1)
    packed = held.select("block", F.expr("octet_length(ns) div 4").alias("cells"), F.expr("octet_length(firsts) div 4").alias("docs")).collect()
    want = {(d, w) for d, text in rows for w in text.split()}
    assert sum(r["cells"] for r in packed) == len(want) and sum(r["docs"] for r in packed) == len({d for d, _ in rows})
    assert len(packed) <= 2 * len(want) / 50 + 16 and n_terms == 160 == terms.select("home", "slot").distinct().count()
    model = topics.fit_topics(docs, "doc_id", "text", 2, max_iter=2)
    assert sum(model.totals) == pytest.approx(120 * 31)
    often = topics.fit_topics(docs, "doc_id", "text", 2, max_iter=2, min_docs=2)
    assert {r["term"] for r in often.weights.collect()} == {f"word{j:02d}" for j in range(40)}
    assert sum(often.totals) == pytest.approx(120 * 30)
    found = model.assign_terms(docs, "text").collect()
    assert {(r["doc_id"], r["term"]) for r in found} == want and len(found) == len(want)


def test_folds_cover_all_rows(spark):
    got = run(spark, "R12_cross_validation").collect()
    assert len(got) == 10
    assert sum(r["n"] for r in got) == 6000
    assert all(0 < r["r2"] < 1 for r in got)


def test_weibull_agrees_with_exponential_in_sign(spark):
    assert run(spark, "V07_weibull").where("term = 'scale'").first()["estimate"] > 0


def test_more_starts_never_cost_more(spark):
    from millrace.operators import classification as C

    data = C.features_from_array(spark.read.parquet(f"{DATA}/embeddings.parquet"), "embedding")
    costs = [C.best_kmeans(data, 3, n, seed=4).cost for n in (1, 4)]
    assert costs[1] <= costs[0]


def test_starts_side_by_side_equal_plain_ones(spark):
    from millrace.operators import classification as C

    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(m, 0.3, (60, 2)) for m in ((0, 0), (5, 0), (0, 5), (5, 5))])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(999, None), (1000, [0.0, 0.0]), (1001, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id int, features array<double>").repartition(4)
    model = C.best_kmeans(df, 4, 6, seed=3)
    data = df.selectExpr("features AS x").where("x IS NOT NULL")
    points = np.vstack([r["x"] for r in data.collect()])
    costs = []
    for centres in C._first_centres(data, 4, 6, 3):
        assert len({tuple(c) for c in centres}) == 4
        for _ in range(20):
            own = C._squared(points, centres).argmin(1)
            centres = np.array([points[own == j].mean(0) if (own == j).any() else centres[j] for j in range(4)])
        costs.append(C._squared(points, centres).min(1).sum())
    assert sorted(model.costs) == pytest.approx(sorted(costs), rel=1e-6) and model.cost == pytest.approx(min(costs), rel=1e-6)
    found = model.transform(df).toPandas()
    assert found["prediction"].isna().sum() == 1
    known = found[found["prediction"].notna()]
    want = C._squared(np.vstack(known["features"].to_list()), model.centres).argmin(1)
    assert (known["prediction"].to_numpy(int) == want).all()


def test_radial_machine_beats_the_linear_one(spark):
    """Rings, which no plane separates; the widths' accuracies come from folds."""
    from millrace.operators import classification as C

    rng = np.random.default_rng(3)
    radius, angle = rng.choice([1.0, 2.0, 3.0], 900), rng.uniform(0, 2 * np.pi, 900)
    x = np.column_stack([radius * np.cos(angle), radius * np.sin(angle)]) + rng.normal(0, 0.1, (900, 2))
    rows = [(i, int(radius[i]) - 1, [float(v) for v in x[i]]) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, label int, x array<double>")
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    features, model, tried = C.radial_svm(train, ["id"], "x", "label", 2)
    linear = C.linear_svm().fit(C.features_from_array(train, "x"))

    def accuracy(scored):
        return scored.selectExpr("avg(CAST(label = prediction AS INT))").first()[0]

    assert len(tried) == 5 and features.gamma == max(tried, key=lambda t: t[1])[0]
    radial = accuracy(model.transform(features.transform(test, "x")))
    assert radial > 0.95 > 0.7 > accuracy(linear.transform(C.features_from_array(test, "x")))


def test_permutation_importance_equals_a_plain_loop(spark):
    from millrace.operators import classification as C

    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] + 0.3 * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), [float(v) for v in x[i]]) for i in range(300)], "id int, label int, x array<double>")
    model = C.perceptron(4, 2, (5, 3), rounds=40).fit(C.features_from_array(df, "x"))
    net = C.NetworkScorer([4, 5, 3, 2], model.weights.toArray())
    theirs = [r["prediction"] for r in model.transform(C.features_from_array(df, "x")).orderBy("id").collect()]
    assert (net.rest(net.first(x)) == np.array(theirs)).all()
    fast = {r["feature"]: r["importance"] for r in C.permutation_importance(model, df, ["id"], "x", "label", 4).collect()}
    whole = C.MultilayerPerceptronClassificationModel
    try:
        C.MultilayerPerceptronClassificationModel = ()  # the way that copies rows
        plain = {r["feature"]: r["importance"] for r in C.permutation_importance(model, df, ["id"], "x", "label", 4).collect()}
    finally:
        C.MultilayerPerceptronClassificationModel = whole
    assert fast == pytest.approx(plain) and fast[0] == max(fast.values())


def test_discriminant_equals_matrix_form(spark):
    from millrace.operators import classification as C

    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    scored = C.lda_score(df, C.lda_fit(df, "embedding", "label", 64), "embedding").orderBy("vec_id").toPandas()
    x, y = np.vstack(scored["embedding"].to_list()).astype(float), scored["label"].to_numpy()
    classes = np.unique(y)
    means = np.vstack([x[y == c].mean(axis=0) for c in classes])
    centred = x - means[np.searchsorted(classes, y)]
    inverse = np.linalg.inv(centred.T @ centred / (len(x) - len(classes)))
    share = np.array([(y == c).mean() for c in classes])
    scores = x @ inverse @ means.T - 0.5 * np.einsum("ij,jk,ik->i", means, inverse, means) + np.log(share)
    assert scored["prediction"].tolist() == classes[scores.argmax(axis=1)].tolist()


def test_jdbc_options():
    from millrace.sources.tables import jdbc_options

    got = jdbc_options("jdbc:x://h/db", "t", column="id", bounds=(1, 9), partitions=4, properties={"user": "u"})
    assert got == {
        "url": "jdbc:x://h/db", "user": "u", "dbtable": "t", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
    }
    assert jdbc_options("u", query="SELECT 1")["query"] == "SELECT 1"
    with pytest.raises(ValueError):
        jdbc_options("u")
    with pytest.raises(ValueError):
        jdbc_options("u", "t", column="id")


def test_cache_explain_and_collect(spark):
    from millrace.sources import tables

    tables.register(spark.read.parquet(f"{DATA}/nation.parquet"), "nation_cached")
    tables.cache_table(spark, "nation_cached")
    assert spark.catalog.isCached("nation_cached")
    assert "InMemory" in tables.explain_text(spark.table("nation_cached"))
    tables.uncache_table(spark, "nation_cached")
    assert len(tables.table(spark, "nation_cached").collect()) == 25
    tables.use_database(spark, "default")
    assert tables.list_databases(spark).count() >= 1
