"""E and C: evaluation, classification and clustering."""

from pyspark.sql import functions as F

from millrace.operators import classification as C
from millrace.operators import evaluation as E
from millrace.operators import relational as R
from millrace.operators import sampling
from millrace.plans.registry import query

# A rule guesses an order's priority class from its price, to have labels and
# predictions that SQL can also make.
GUESS_SQL = """WITH g AS (SELECT o_orderkey, o_orderstatus AS label, year(o_orderdate) AS resample,
    CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 280000 THEN 'O' ELSE 'P' END AS a,
    CASE WHEN month(o_orderdate) <= 4 THEN 'F' WHEN month(o_orderdate) <= 8 THEN 'O' ELSE 'P' END AS b FROM orders)
"""


def _guesses(t):
    price, month = F.col("o_totalprice"), F.month("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("label"), F.year("o_orderdate").cast("bigint").alias("resample"),
        F.when(price < 150000, "F").when(price < 280000, "O").otherwise("P").alias("a"),
        F.when(month <= 4, "F").when(month <= 8, "O").otherwise("P").alias("b"),
    )


def _overall_sql(pred, keys=""):
    head = f"{keys}, " if keys else ""
    on = "".join(f" AND r.{k} = c.{k}" for k in [keys] if k)
    return f"""(SELECT {head.replace(keys, 'r.' + keys) if keys else ''}sum(r.n) AS n, sum(coalesce(h, 0)) / sum(r.n) AS accuracy,
    sum(r.n * coalesce(c.n, 0)) / (sum(r.n) * sum(r.n)) AS chance, max(r.n) / sum(r.n) AS no_information_rate
    FROM (SELECT {head}label, count(*) AS n, count(*) FILTER (label = {pred}) AS h FROM g GROUP BY ALL) r
    LEFT JOIN (SELECT {head}{pred} AS p, count(*) AS n FROM g GROUP BY ALL) c ON r.label = c.p{on} GROUP BY {'r.' + keys if keys else '()'})"""


@query(
    "E01_overall_report",
    GUESS_SQL + f"""SELECT CAST(n AS BIGINT) AS n, round(accuracy, 8) AS accuracy, round((accuracy - chance) / (1 - chance), 8) AS kappa,
    round(no_information_rate, 8) AS no_information_rate FROM {_overall_sql('a')}""",
)
def e01(t):
    out = E.overall_report(_guesses(t), "label", "a")
    return out.select("n", *[F.round(c, 8).alias(c) for c in ("accuracy", "kappa", "no_information_rate")])


CLASS_COLUMNS = ["sensitivity", "specificity", "ppv", "npv", "prevalence", "balanced_accuracy"]


@query(
    "E01_class_report",
    GUESS_SQL + """, k AS (SELECT unnest(['F', 'O', 'P']) AS class),
    c AS (SELECT class, count(*) FILTER (label = class AND a = class) AS tp, count(*) FILTER (label = class AND a <> class) AS fn,
        count(*) FILTER (label <> class AND a = class) AS fp, count(*) FILTER (label <> class AND a <> class) AS tn FROM k, g GROUP BY 1),
    x AS (SELECT class, tp / nullif(tp + fn, 0) AS sensitivity, tn / nullif(tn + fp, 0) AS specificity, tp / nullif(tp + fp, 0) AS ppv,
        tn / nullif(tn + fn, 0) AS npv, (tp + fn) / (tp + fn + fp + tn) AS prevalence FROM c)
    SELECT class, round(sensitivity, 8) AS sensitivity, round(specificity, 8) AS specificity, round(ppv, 8) AS ppv, round(npv, 8) AS npv,
    round(prevalence, 8) AS prevalence, round((sensitivity + specificity) / 2, 8) AS balanced_accuracy FROM x""",
)
def e01_classes(t):
    out = E.class_report(_guesses(t), "label", "a")
    return out.select("class", *[F.round(c, 8).alias(c) for c in CLASS_COLUMNS])


@query("E02_accuracy", GUESS_SQL + "SELECT round(avg(CASE WHEN label = a THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy FROM g")
def e02(t):
    return E.accuracy(_guesses(t), "label", "a").withColumn("accuracy", F.round("accuracy", 8))


@query(
    "E03_compare_models",
    GUESS_SQL + f""", m AS (SELECT 'price' AS model, accuracy, (accuracy - chance) / (1 - chance) AS kappa FROM {_overall_sql('a', 'resample')}
    UNION ALL SELECT 'month', accuracy, (accuracy - chance) / (1 - chance) FROM {_overall_sql('b', 'resample')}),
    l AS (SELECT model, 'accuracy' AS metric, accuracy AS value FROM m UNION ALL SELECT model, 'kappa', kappa FROM m)
    SELECT model, metric, round(min(value), 8) AS min, round(quantile_cont(value, 0.25), 8) AS q1, round(quantile_cont(value, 0.5), 8) AS median,
    round(avg(value), 8) AS mean, round(quantile_cont(value, 0.75), 8) AS q3, round(max(value), 8) AS max FROM l GROUP BY 1, 2""",
)
def e03(t):
    g = _guesses(t)
    parts = [
        E.overall_report(g, "label", p, ["resample"]).select(F.lit(m).alias("model"), "accuracy", "kappa") for m, p in (("price", "a"), ("month", "b"))
    ]
    long = parts[0].unionByName(parts[1]).unpivot(["model"], ["accuracy", "kappa"], "metric", "value")
    out = E.compare_models(long)
    return out.select("model", "metric", *[F.round(c, 8).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")])


@query("C15_misclassified", GUESS_SQL + "SELECT o_orderkey, label = a AS correct FROM g")
def c15(t):
    return E.mark_correct(_guesses(t), "label", "a").select("o_orderkey", "correct")


WIDTH = 64


def _vectors(t):
    return C.features_from_array(t.embeddings.select("vec_id", "label", "embedding"), "embedding")


def _split(t):
    tagged = sampling.stratified_split(_vectors(t), ["vec_id"], "label", 0.8, 7)
    return C.packed(tagged.where("data = 'train'")), tagged.where("data = 'test'")


def _judge(model, test):
    return E.class_report(model.transform(test).withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction")


@query("C01_decision_tree")
def c01(t):
    train, test = _split(t)
    return _judge(C.tree().fit(train), test)


@query("C03_random_forest")
def c03(t):
    train, test = _split(t)
    return _judge(C.forest(trees=300).fit(train), test)


@query("C04_grid_search")
def c04(t):
    return C.grid_search(_split(t)[0], C.forest(trees=300), {"featureSubsetStrategy": ["10", "30", "64"]}, folds=5)[1]


@query("C05_forest_cross_validation")
def c05(t):
    return C.metric_summary(C.fold_metrics(_vectors(t), ["vec_id"], C.forest(trees=300), folds=5))


@query("C06_boosting")
def c06(t):
    train, test = _split(t)
    return _judge(C.boosted(rounds=20).fit(train), test)


@query("C07_importance")
def c07(t):
    model = C.forest(trees=300).fit(_vectors(t))
    return C.importance(model, [f"x{i}" for i in range(WIDTH)], t.spark)


@query("C07_permutation_importance")
def c07_permutation(t):
    data = t.embeddings.select("vec_id", "label", "embedding")
    model = C.perceptron(WIDTH, 10, (20,), rounds=20).fit(C.features_from_array(data, "embedding"))
    return C.permutation_importance(model, data, ["vec_id"], "embedding", "label", WIDTH)


@query(
    "C08_class_means",
    """SELECT label, CAST(i AS INTEGER) AS i, round(avg(x), 8) AS mean FROM (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings) GROUP BY 1, 2""",
)
def c08_means(t):
    fit = C.lda_fit(t.embeddings, "embedding", "label", WIDTH)
    rows = [(int(c), i, float(v)) for c, m in zip(fit.classes, fit.means, strict=True) for i, v in enumerate(m)]
    return t.spark.createDataFrame(rows, "label int, i int, mean double").withColumn("mean", F.round("mean", 8))


@query(
    "C08_pooled_covariance",
    """WITH l AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings),
    d AS (SELECT vec_id, i, x - avg(x) OVER (PARTITION BY label, i) AS d FROM l),
    k AS (SELECT count(*) - count(DISTINCT label) AS k FROM embeddings)
    SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(sum(a.d * b.d) / max(k), 8) AS covariance FROM d a JOIN d b ON a.vec_id = b.vec_id AND a.i <= b.i, k GROUP BY 1, 2""",
)
def c08_covariance(t):
    fit = C.lda_fit(t.embeddings, "embedding", "label", WIDTH)
    rows = [(i, j, float(fit.pooled[i, j])) for i in range(WIDTH) for j in range(i, WIDTH)]
    return t.spark.createDataFrame(rows, "i int, j int, covariance double").withColumn("covariance", F.round("covariance", 8))


@query("C08_discriminant")
def c08(t):
    train, test = _split(t)
    scored = C.lda_score(test, C.lda_fit(train, "embedding", "label", WIDTH), "embedding")
    return E.class_report(scored.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction")


@query("C09_kmeans")
def c09(t):
    model = C.best_kmeans(_vectors(t), 3, 20)
    found = model.transform(_vectors(t))
    return R.count_by(found, ["prediction", "label"])


@query(
    "C10_cluster_summary",
    """WITH l AS (SELECT label % 3 AS cluster, vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings),
    p AS (SELECT cluster, i, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS ss FROM l GROUP BY 1, 2)
    SELECT cluster, max(n) AS size, round(sum(ss), 6) AS within_ss, round(sqrt(sum(m * m)), 8) AS centre_norm FROM p GROUP BY 1""",
)
def c10(t):
    out = C.cluster_summary(t.embeddings.withColumn("cluster", F.col("label") % 3), "cluster", "embedding")
    norm = F.sqrt(F.aggregate("centre", F.lit(0.0), lambda a, m: a + m * m))
    return out.select("cluster", "size", F.round("within_ss", 6).alias("within_ss"), F.round(norm, 8).alias("centre_norm"))


@query("C10_cluster_by_class")
def c10_classes(t):
    model = C.best_kmeans(_vectors(t), 3, 20)
    return R.contingency(model.transform(_vectors(t)), "label", "prediction", [0, 1, 2])


@query("C11_perceptron")
def c11(t):
    train, test = _split(t)
    return _judge(C.perceptron(WIDTH, 10).fit(train), test)


@query("C12_fold_summary")
def c12(t):
    return C.metric_summary(C.fold_metrics(_vectors(t), ["vec_id"], C.tree(), folds=5))


@query("C13_linear_svm")
def c13(t):
    train, test = _split(t)
    return _judge(C.linear_svm().fit(train), test)


@query("C13_radial_svm")
def c13_radial(t):
    train, test = _split(t)
    features, model, _ = C.radial_svm(train.select("vec_id", "label", "embedding"), ["vec_id"], "embedding", "label", WIDTH)
    return _judge(model, features.transform(test.drop("features"), "embedding"))


@query("C14_prediction_counts")
def c14(t):
    train, test = _split(t)
    return R.count_by(C.tree().fit(train).transform(test), ["prediction"])


@query("C16_eligibility")
def c16(t):
    # documents stand in for applications; unlabelled sources and short texts supply the missing values
    data = (
        t.documents.select("doc_id", "lang", "source", F.when(F.col("n_chars") > 50, F.col("n_chars")).cast("double").alias("n_chars"))
        .join(t.labels, "doc_id")
        .withColumn("quality", F.col("quality").cast("double"))
    )
    tagged = sampling.hash_split(data, ["doc_id"], {"train": 0.8, "test": 0.2}, 3)
    model = C.eligibility_pipeline(["n_chars"], ["lang", "source"], "quality").fit(tagged.where("data = 'train'"))
    return E.overall_report(model.transform(tagged.where("data = 'test'")), "quality", "prediction")
