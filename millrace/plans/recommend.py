"""K: recommenders of brands to customers."""

from pyspark.sql import functions as F

from millrace.operators import charts as C
from millrace.operators import recommend as K
from millrace.plans.ordering import hash_sql, unit_sql
from millrace.plans.registry import query
from millrace.session import stable

RATINGS_SQL = """SELECT o_custkey AS "user", p_brand AS item, avg(l_quantity) / 10 AS rating
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""
CENTRED_SQL = f"""WITH r AS ({RATINGS_SQL}), m AS (SELECT "user", avg(rating) AS mean FROM r GROUP BY 1),
c AS (SELECT r."user", item, rating, mean, rating - mean AS centred FROM r JOIN m ON r."user" = m."user"),
i AS (SELECT item, sum(centred) AS score, avg(centred) AS offs FROM c GROUP BY 1),
cells AS (SELECT m."user", i.item, mean + offs AS prediction FROM m, i WHERE NOT EXISTS (SELECT 1 FROM r WHERE r."user" = m."user" AND r.item = i.item))
"""


def ratings(t):
    """Customer x brand ratings: mean ordered quantity over ten."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    )
    return rows.groupBy(F.col("o_custkey").alias("user"), F.col("p_brand").alias("item")).agg(
        (F.avg("l_quantity") / 10).alias("rating")
    )


@query("K02_binarise", f"SELECT \"user\", item, 1 AS rating FROM ({RATINGS_SQL}) WHERE rating >= 3")
def k02(t):
    return K.binarise(ratings(t), 3.0)


@query("K03_normalise", CENTRED_SQL + 'SELECT "user", item, round(centred, 8) AS centred, round(centred + mean, 8) AS rating FROM c')
def k03(t):
    out = K.denormalise(K.centre(ratings(t)))
    return out.select("user", "item", F.round("centred", 8).alias("centred"), F.round("rating", 8).alias("rating"))


@query("K04_counts_per_user", f'SELECT "user", count(*) AS n, round(avg(rating), 8) AS mean FROM ({RATINGS_SQL}) GROUP BY 1')
def k04(t):
    return ratings(t).groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rating"), 8).alias("mean"))


@query("K04_means_per_item", f"SELECT item, count(*) AS n, round(avg(rating), 8) AS mean FROM ({RATINGS_SQL}) GROUP BY 1")
def k04_items(t):
    return ratings(t).groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rating"), 8).alias("mean"))


@query(
    "K05_rating_histogram",
    f"""SELECT CAST(floor(round(rating, 8) / 0.1::DOUBLE) AS BIGINT) AS bin, count(*) AS n FROM ({RATINGS_SQL}) GROUP BY 1""",
)
def k05(t):
    return C.histogram(ratings(t).withColumn("rating", F.round("rating", 8)), "rating", 0.1).drop("lo")


@query(
    "K05_centred_histogram",
    CENTRED_SQL + "SELECT CAST(floor(round(centred, 8) / 0.1::DOUBLE) AS BIGINT) AS bin, count(*) AS n FROM c GROUP BY 1",
)
def k05_centred(t):
    return C.histogram(K.centre(ratings(t)).withColumn("centred", F.round("centred", 8)), "centred", 0.1).drop("lo")


@query("K06_popular_model", CENTRED_SQL + "SELECT item, round(score, 6) AS score, round(offs, 8) AS offset_mean FROM i")
def k06(t):
    out = K.popular_items(ratings(t))
    return out.select("item", F.round("score", 6).alias("score"), F.round("offset", 8).alias("offset_mean"))


@query(
    "K07_top_n_items",
    CENTRED_SQL + """SELECT "user", item, rank FROM (SELECT m."user", i.item,
    row_number() OVER (PARTITION BY m."user" ORDER BY round(score, 10) DESC, i.item) AS rank FROM m, i
    WHERE NOT EXISTS (SELECT 1 FROM r WHERE r."user" = m."user" AND r.item = i.item)) WHERE rank <= 5""",
)
def k07(t):
    known = stable(ratings(t))
    out = K.popular_top_n(known, known, 5)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("K08_predict_unknown", CENTRED_SQL + 'SELECT "user", item, round(prediction, 8) AS prediction FROM cells')
def k08(t):
    known = stable(ratings(t))
    return K.popular_ratings(known, known).withColumn("prediction", F.round("prediction", 8))


BRANDS = ["Brand#11", "Brand#23", "Brand#55"]
WANTED = "(" + ", ".join(f"'{b}'" for b in BRANDS) + ")"


def _asked(users):
    """Every user with each of a few brands."""
    return users.distinct().select("user", F.explode(F.array(*[F.lit(b) for b in BRANDS])).alias("item"))


@query(
    "K08_predict_wanted",
    CENTRED_SQL + f"""SELECT "user", item, round(prediction, 8) AS prediction FROM cells WHERE item IN {WANTED} AND "user" % 3 = 0""",
)
def k08_wanted(t):
    """Only the cells asked for: three brands for every third customer."""
    known = stable(ratings(t))
    asked = _asked(t.customer.select(F.col("c_custkey").alias("user")).where("user % 3 = 0"))
    return K.popular_ratings(known, known, asked).withColumn("prediction", F.round("prediction", 8))


@query(
    "K12_random_wanted",
    CENTRED_SQL + f"""SELECT cells."user", cells.item, round(0.1::DOUBLE + {unit_sql(9, 'cells."user"', 'cells.item')} * 4.9::DOUBLE, 8) AS prediction
    FROM cells WHERE item IN {WANTED}""",
)
def k12_wanted(t):
    known = stable(ratings(t))
    asked = _asked(known.select("user"))
    return K.random_ratings(known, known, 0.1, 5.0, 9, asked).withColumn("prediction", F.round("prediction", 8))


@query(
    "K09_full_matrix",
    CENTRED_SQL + """SELECT "user", item, round(rating, 8) AS rating, true AS is_known FROM r
    UNION ALL SELECT "user", item, round(prediction, 8), false FROM cells""",
)
def k09(t):
    known = stable(ratings(t))
    return K.full_matrix(known, K.popular_ratings(known, known)).withColumn("rating", F.round("rating", 8))


@query(
    "K10_user_based",
    CENTRED_SQL + """, norm AS (SELECT "user", sqrt(sum(centred * centred)) AS len FROM c GROUP BY 1 HAVING sum(centred * centred) > 0),
    d AS (SELECT a."user" AS u, b."user" AS v, sum(a.centred * b.centred) AS dot FROM c a JOIN c b ON a.item = b.item AND a."user" <> b."user" GROUP BY 1, 2),
    allp AS (SELECT x."user" AS u, y."user" AS v, x.len * y.len AS len FROM norm x JOIN norm y ON x."user" <> y."user"),
    s AS (SELECT allp.u, allp.v, round(coalesce(dot, 0) / len, 10) AS sim FROM allp LEFT JOIN d ON d.u = allp.u AND d.v = allp.v),
    n AS (SELECT u, v, sim FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS k FROM s) WHERE k <= 50),
    p AS (SELECT n.u AS "user", c.item, sum(sim * centred) / nullif(sum(abs(sim)), 0) AS p FROM n JOIN c ON n.v = c."user" GROUP BY 1, 2)
    SELECT p."user", p.item, round(mean + p, 6) AS prediction FROM p JOIN m ON p."user" = m."user"
    WHERE p IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r WHERE r."user" = p."user" AND r.item = p.item)""",
)
def k10(t):
    known = stable(ratings(t))
    return K.user_cf(known, known, 50).withColumn("prediction", F.round("prediction", 6))


@query(
    "K11_item_based",
    CENTRED_SQL + """, norm AS (SELECT item, sqrt(sum(centred * centred)) AS len FROM c GROUP BY 1),
    d AS (SELECT a.item AS i, b.item AS j, sum(a.centred * b.centred) AS dot FROM c a JOIN c b ON a."user" = b."user" AND a.item <> b.item GROUP BY 1, 2),
    s AS (SELECT i, j, round(dot / (x.len * y.len), 10) AS sim FROM d JOIN norm x ON x.item = i JOIN norm y ON y.item = j),
    n AS (SELECT i, j, sim FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS k FROM s) WHERE k <= 50),
    p AS (SELECT c."user", n.i AS item, sum(sim * centred) / nullif(sum(abs(sim)), 0) AS p FROM n JOIN c ON n.j = c.item GROUP BY 1, 2)
    SELECT p."user", p.item, round(mean + p, 6) AS prediction FROM p JOIN m ON p."user" = m."user"
    WHERE p IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r WHERE r."user" = p."user" AND r.item = p.item)""",
)
def k11(t):
    known = stable(ratings(t))
    return K.item_cf(known, known, 50).withColumn("prediction", F.round("prediction", 6))


@query(
    "K12_random_baseline",
    CENTRED_SQL + f""", p AS (SELECT cells."user", cells.item, 0.1::DOUBLE + {unit_sql(9, 'cells."user"', 'cells.item')} * 4.9::DOUBLE AS prediction FROM cells)
    SELECT "user", item, CAST(rank AS INTEGER) AS rank FROM
    (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY round(prediction, 10) DESC, item) AS rank FROM p) WHERE rank <= 5""",
)
def k12(t):
    known = stable(ratings(t))
    return K.top_n_items(K.random_ratings(known, known, 0.1, 5.0, 9), 5)


@query(
    "K13_evaluation_split",
    f"""WITH r AS ({RATINGS_SQL}), o AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY {hash_sql(11, '"user"', 'item')}, item) AS k FROM r)
    SELECT "user", item, round(rating, 8) AS rating, CASE WHEN {unit_sql(11, '"user"')} < 0.9 THEN 'train' WHEN k <= 5 THEN 'known' ELSE 'hidden' END AS part FROM o""",
)
def k13(t):
    return K.rating_split(ratings(t), 0.9, 5, 11).withColumn("rating", F.round("rating", 8))


@query(
    "K14_user_folds",
    f"""SELECT "user", item, round(rating, 8) AS rating, CAST({hash_sql(11, '"user"')} % 4 AS INTEGER) AS fold FROM ({RATINGS_SQL})""",
)
def k14(t):
    return K.user_folds(ratings(t), 4, 11).withColumn("rating", F.round("rating", 8))


# For the SQL-checked evaluations the test users are the customers of one
# market segment and the known items are the first five by name, since the
# hash of K13 has no SQL twin.
SEGMENT, GIVEN, GOOD, LENGTHS = "FURNITURE", 5, 2.5, [1, 3, 5, 10]
SPLIT_SQL = f"""WITH r AS ({RATINGS_SQL}), o AS (SELECT r.*, c_mktsegment = '{SEGMENT}' AS test,
    row_number() OVER (PARTITION BY "user" ORDER BY item) AS k FROM r JOIN customer ON c_custkey = "user"),
train AS (SELECT * FROM o WHERE NOT test), known AS (SELECT * FROM o WHERE test AND k <= {GIVEN}), hidden AS (SELECT * FROM o WHERE test AND k > {GIVEN}),
tm AS (SELECT "user", avg(rating) AS mean FROM train GROUP BY 1), km AS (SELECT "user", avg(rating) AS mean FROM known GROUP BY 1),
i AS (SELECT item, sum(rating - mean) AS score, avg(rating - mean) AS offs FROM train JOIN tm USING ("user") GROUP BY 1)
"""
COUNTS_SQL = SPLIT_SQL + f""", cand AS (SELECT km."user", i.item, row_number() OVER (PARTITION BY km."user" ORDER BY round(score, 10) DESC, i.item) AS rank
    FROM km, i WHERE NOT EXISTS (SELECT 1 FROM known WHERE known."user" = km."user" AND known.item = i.item)),
g AS (SELECT "user", count(*) FILTER (rating >= {GOOD}) AS good FROM hidden GROUP BY 1),
x AS (SELECT g."user", n, good, count(cand.item) AS shown, count(h.item) AS tp FROM g CROSS JOIN (SELECT unnest({LENGTHS}) AS n) l
    LEFT JOIN cand ON cand."user" = g."user" AND rank <= n
    LEFT JOIN hidden h ON h."user" = g."user" AND h.item = cand.item AND h.rating >= {GOOD} GROUP BY 1, 2, 3),
y AS (SELECT "user", n, tp, shown - tp AS fp, good - tp AS fn, (SELECT count(*) FROM i) - {GIVEN} - shown - good + tp AS tn,
    tp / nullif(shown, 0) AS precision, tp / nullif(good, 0) AS recall, tp / nullif(good, 0) AS tpr FROM x),
z AS (SELECT *, fp / nullif(fp + tn, 0) AS fpr FROM y),
v AS (SELECT n, avg(tp) AS tp, avg(fp) AS fp, avg(fn) AS fn, avg(tn) AS tn, avg(precision) AS precision, avg(recall) AS recall,
    avg(tpr) AS tpr, avg(fpr) AS fpr FROM z GROUP BY 1)
"""
AVERAGES = ", ".join(f"round({m}, 8) AS {m}" for m in K.MEASURES)


def _parts(t):
    flagged = ratings(t).join(t.customer.select(F.col("c_custkey").alias("user"), (F.col("c_mktsegment") == SEGMENT).alias("is_test")), "user")
    parts = stable(K.split_given(flagged, F.col("is_test"), GIVEN, [F.col("item")]))
    return [parts.where(F.col("part") == p).select("user", "item", "rating") for p in ("train", "known", "hidden")]


def _popular_counts(t):
    train, known, hidden = _parts(t)
    n_items = train.select("item").distinct().count()
    return K.top_n_counts(K.popular_top_n(train, known, max(LENGTHS)), hidden, LENGTHS, GOOD, n_items, GIVEN)


@query(
    "K15_rating_errors",
    SPLIT_SQL + """, e AS (SELECT rating - (mean + offs) AS e FROM hidden JOIN km USING ("user") JOIN i USING (item))
    SELECT count(*) AS n, round(sqrt(avg(e * e)), 8) AS rmse, round(avg(e * e), 8) AS mse, round(avg(abs(e)), 8) AS mae FROM e""",
)
def k15(t):
    train, known, hidden = _parts(t)
    out = K.rating_errors(K.popular_ratings(train, known), hidden)
    return out.select("n", *[F.round(c, 8).alias(c) for c in ("rmse", "mse", "mae")])


@query("K16_top_n_counts", COUNTS_SQL + 'SELECT "user", CAST(n AS INTEGER) AS n, tp, fp, fn, tn, round(precision, 8) AS precision, round(fpr, 8) AS fpr FROM z')
def k16(t):
    out = _popular_counts(t)
    return out.select("user", "n", "tp", "fp", "fn", "tn", F.round("precision", 8).alias("precision"), F.round("fpr", 8).alias("fpr"))


@query("K17_average_counts", COUNTS_SQL + f"SELECT CAST(n AS INTEGER) AS n, {AVERAGES} FROM v")
def k17(t):
    out = K.average_counts(_popular_counts(t))
    return out.select("n", *[F.round(m, 8).alias(m) for m in K.MEASURES])


@query("K18_roc_popular", COUNTS_SQL + "SELECT 'popular' AS algorithm, CAST(n AS INTEGER) AS n, round(fpr, 8) AS fpr, round(tpr, 8) AS tpr FROM v")
def k18(t):
    out = K.roc_points({"popular": _popular_counts(t)})
    return out.select("algorithm", "n", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


@query("K18_roc_all_algorithms")
def k18_all(t):
    train, known, hidden = _parts(t)
    n_items, longest = train.select("item").distinct().count(), max(LENGTHS)
    lists = {
        "popular": K.popular_top_n(train, known, longest),
        "random": K.top_n_items(K.random_ratings(known, train, 0.1, 5.0, 3), longest),
        "user based": K.top_n_items(K.user_cf(train, known, 50), longest),
        "item based": K.top_n_items(K.item_cf(train, known, 50), longest),
    }
    return K.roc_points({k: K.top_n_counts(v, hidden, LENGTHS, GOOD, n_items, GIVEN) for k, v in lists.items()})


# Four folds by customer number, each judged by a model fitted on the other three.
FOLDS, FOLD_LENGTHS = 4, [1, 3, 5, 10, 15, 20]
FOLD_SQL = f"""WITH r AS ({RATINGS_SQL}), o AS (SELECT f, r.*, "user" % {FOLDS} = f AS test,
    row_number() OVER (PARTITION BY f, "user" ORDER BY item) AS k FROM r, range({FOLDS}) x(f)),
train AS (SELECT * FROM o WHERE NOT test), known AS (SELECT * FROM o WHERE test AND k <= {GIVEN}), hidden AS (SELECT * FROM o WHERE test AND k > {GIVEN}),
tm AS (SELECT f, "user", avg(rating) AS mean FROM train GROUP BY 1, 2), km AS (SELECT f, "user", avg(rating) AS mean FROM known GROUP BY 1, 2),
i AS (SELECT f, item, sum(rating - mean) AS score FROM train JOIN tm USING (f, "user") GROUP BY 1, 2),
cand AS (SELECT f, km."user", i.item, row_number() OVER (PARTITION BY f, km."user" ORDER BY round(score, 10) DESC, i.item) AS rank
    FROM km JOIN i USING (f) WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.f = km.f AND known."user" = km."user" AND known.item = i.item)),
g AS (SELECT f, "user", count(*) FILTER (rating >= {GOOD}) AS good FROM hidden GROUP BY 1, 2),
x AS (SELECT g.f, g."user", n, good, count(cand.item) AS shown, count(h.item) AS tp FROM g CROSS JOIN (SELECT unnest({FOLD_LENGTHS}) AS n) l
    LEFT JOIN cand ON cand.f = g.f AND cand."user" = g."user" AND rank <= n
    LEFT JOIN hidden h ON h.f = g.f AND h."user" = g."user" AND h.item = cand.item AND h.rating >= {GOOD} GROUP BY 1, 2, 3, 4),
y AS (SELECT f, "user", n, tp, shown - tp AS fp, good - tp AS fn, (SELECT count(*) FROM i WHERE i.f = x.f) - {GIVEN} - shown - good + tp AS tn,
    tp / nullif(shown, 0) AS precision, tp / nullif(good, 0) AS recall, tp / nullif(good, 0) AS tpr FROM x),
z AS (SELECT *, fp / nullif(fp + tn, 0) AS fpr FROM y),
v AS (SELECT f, n, {", ".join(f"avg({m}) AS {m}" for m in K.MEASURES)} FROM z GROUP BY 1, 2),
w AS (SELECT n, {", ".join(f"avg({m}) AS {m}" for m in K.MEASURES)} FROM v GROUP BY 1)
"""


def _by_fold(t, lists):
    return K.evaluate_folds(stable(ratings(t)), F.pmod("user", F.lit(FOLDS)), FOLDS, GIVEN, [F.col("item")], lists, FOLD_LENGTHS, GOOD)


@query("K14_evaluated_folds", FOLD_SQL + f"SELECT CAST(f AS INTEGER) AS fold, CAST(n AS INTEGER) AS n, {AVERAGES} FROM v")
def k14_evaluated(t):
    out = _by_fold(t, K.popular_top_n)
    return out.select("fold", "n", *[F.round(m, 8).alias(m) for m in K.MEASURES])


@query("K17_average_over_folds", FOLD_SQL + f"SELECT CAST(n AS INTEGER) AS n, {AVERAGES} FROM w")
def k17_folds(t):
    out = K.average_counts(_by_fold(t, K.popular_top_n))
    return out.select("n", *[F.round(m, 8).alias(m) for m in K.MEASURES])


@query("K18_roc_over_folds", FOLD_SQL + "SELECT 'popular' AS algorithm, CAST(n AS INTEGER) AS n, round(fpr, 8) AS fpr, round(tpr, 8) AS tpr FROM w")
def k18_folds(t):
    out = K.roc_points({"popular": _by_fold(t, K.popular_top_n)})
    return out.select("algorithm", "n", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


@query("K18_roc_item_based_over_folds")
def k18_item_folds(t):
    return K.roc_points({"item based": _by_fold(t, lambda train, known, n: K.top_n_items(K.item_cf(train, known, 50), n))})


NEAR_SQL = SPLIT_SQL + """, tc AS (SELECT train."user", item, rating - mean AS centred FROM train JOIN tm USING ("user")),
kc AS (SELECT known."user", item, rating - mean AS centred FROM known JOIN km USING ("user")),
"""


@query(
    "K15_errors_item_based",
    NEAR_SQL + """norm AS (SELECT item, sqrt(sum(centred * centred)) AS len FROM tc GROUP BY 1),
    d AS (SELECT a.item AS i, b.item AS j, sum(a.centred * b.centred) AS dot FROM tc a JOIN tc b ON a."user" = b."user" AND a.item <> b.item GROUP BY 1, 2),
    s AS (SELECT d.i, j, round(dot / (x.len * y.len), 10) AS sim FROM d JOIN norm x ON x.item = d.i JOIN norm y ON y.item = j),
    near AS (SELECT i, j, sim FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS k FROM s) WHERE k <= 50),
    p AS (SELECT kc."user", near.i AS item, sum(sim * centred) / nullif(sum(abs(sim)), 0) AS p FROM near JOIN kc ON near.j = kc.item GROUP BY 1, 2),
    e AS (SELECT rating - (mean + p) AS e FROM hidden JOIN km USING ("user") JOIN p USING ("user", item) WHERE p IS NOT NULL)
    SELECT count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(e * e), 6) AS mse, round(avg(abs(e)), 6) AS mae FROM e""",
)
def k15_items(t):
    train, known, hidden = _parts(t)
    out = K.rating_errors(K.item_cf(train, known, 50), hidden)
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mse", "mae")])


@query(
    "K15_errors_user_based",
    NEAR_SQL + """tn AS (SELECT "user", sqrt(sum(centred * centred)) AS len FROM tc GROUP BY 1 HAVING sum(centred * centred) > 0),
    kn AS (SELECT "user", sqrt(sum(centred * centred)) AS len FROM kc GROUP BY 1 HAVING sum(centred * centred) > 0),
    d AS (SELECT a."user" AS u, b."user" AS v, sum(a.centred * b.centred) AS dot FROM kc a JOIN tc b ON a.item = b.item GROUP BY 1, 2),
    allp AS (SELECT x."user" AS u, y."user" AS v, x.len * y.len AS len FROM kn x, tn y),
    s AS (SELECT allp.u, allp.v, round(coalesce(dot, 0) / len, 10) AS sim FROM allp LEFT JOIN d ON d.u = allp.u AND d.v = allp.v),
    near AS (SELECT u, v, sim FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS k FROM s) WHERE k <= 50),
    p AS (SELECT near.u AS "user", tc.item, sum(sim * centred) / nullif(sum(abs(sim)), 0) AS p FROM near JOIN tc ON near.v = tc."user" GROUP BY 1, 2),
    e AS (SELECT rating - (mean + p) AS e FROM hidden JOIN km USING ("user") JOIN p USING ("user", item) WHERE p IS NOT NULL)
    SELECT count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(e * e), 6) AS mse, round(avg(abs(e)), 6) AS mae FROM e""",
)
def k15_users(t):
    train, known, hidden = _parts(t)
    out = K.rating_errors(K.user_cf(train, known, 50), hidden)
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mse", "mae")])
