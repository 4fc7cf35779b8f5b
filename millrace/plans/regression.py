"""R: linear models of the discount amount ("gain") of line items."""

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import charts as C
from millrace.operators import evaluation as E
from millrace.operators import regression as G
from millrace.operators import relational as R
from millrace.operators import sampling
from millrace.operators import windows as W
from millrace.plans.projection import flights
from millrace.plans.ordering import hash_sql
from millrace.plans.registry import query

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_SQL = """line AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_quantity AS quantity, l_discount AS discount,
    l_extendedprice * l_discount AS gain, l_extendedprice / nullif(l_quantity, 0) AS speed FROM lineitem WHERE l_quantity > 0)"""


def line_features(t):
    rows = t.lineitem.where("l_quantity > 0")
    return rows.select(
        *KEY, "l_returnflag", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("gain"), F.try_divide("l_extendedprice", "l_quantity").alias("speed"),
    )


# closed form of the two-predictor fit of gain on quantity and discount
TWO_SQL = """, mo AS (SELECT count(*) AS n, avg(gain) AS my, avg(quantity) AS m1, avg(discount) AS m2 FROM line),
    cr AS (SELECT sum((quantity - m1) * (quantity - m1)) AS s11, sum((discount - m2) * (discount - m2)) AS s22, sum((quantity - m1) * (discount - m2)) AS s12,
        sum((quantity - m1) * (gain - my)) AS s1y, sum((discount - m2) * (gain - my)) AS s2y, sum((gain - my) * (gain - my)) AS syy FROM line, mo),
    co AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM cr),
    fit AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0, syy - b1 * s1y - b2 * s2y AS rss, syy, n, s11, s22, s12, m1, m2 FROM co, mo, cr)
"""
WITH2 = "WITH " + LINE_SQL + TWO_SQL


def _two(t):
    return G.ols(G.gram(line_features(t), "gain", ["quantity", "discount"]))


def _r(df, digits):
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "R01_ols",
    WITH2 + """SELECT '(Intercept)' AS term, round(b0, 6) AS estimate FROM fit UNION ALL SELECT 'quantity', round(b1, 6) FROM fit
    UNION ALL SELECT 'discount', round(b2, 6) FROM fit""",
)
def r01(t):
    return _two(t).table(t.spark).select("term", F.round("estimate", 6).alias("estimate"))


@query(
    "R01_ols_no_intercept",
    "WITH " + LINE_SQL + "SELECT 'quantity' AS term, round(sum(quantity * gain) / sum(quantity * quantity), 6) AS estimate FROM line",
)
def r01_no_intercept(t):
    fit = G.ols(G.gram(line_features(t), "gain", ["quantity"]), intercept=False)
    return fit.table(t.spark).select("term", F.round("estimate", 6).alias("estimate"))


@query(
    "R02_categorical_predictor",
    "WITH " + LINE_SQL + """, g AS (SELECT l_returnflag AS f, avg(gain) AS my, avg(quantity) AS mx FROM line GROUP BY 1),
    w AS (SELECT sum((quantity - mx) * (gain - my)) / sum((quantity - mx) * (quantity - mx)) AS b FROM line JOIN g ON l_returnflag = f),
    a AS (SELECT f, my - b * mx AS a FROM g, w)
    SELECT 'quantity' AS term, round(b, 6) AS estimate FROM w UNION ALL SELECT '(Intercept)', round(a, 6) FROM a WHERE f = 'A'
    UNION ALL SELECT 'l_returnflag_' || f, round(a - (SELECT a FROM a WHERE f = 'A'), 6) FROM a WHERE f <> 'A'""",
)
def r02(t):
    x = {"quantity": F.col("quantity"), **S.dummies("l_returnflag", ["A", "N", "R"], "A")}
    return G.ols(G.gram(line_features(t), "gain", x)).table(t.spark).select("term", F.round("estimate", 6).alias("estimate"))


@query(
    "R03_summary",
    WITH2 + """SELECT n::DOUBLE AS n, round(sqrt(rss / (n - 3)), 6) AS sigma, round(1 - rss / syy, 8) AS r2,
    round(1 - rss / syy * (n - 1) / (n - 3), 8) AS adj_r2, round((syy - rss) / 2 / (rss / (n - 3)), 3) AS f FROM fit""",
)
def r03(t):
    out = _two(t).summary(t.spark)
    return _r(out.select("n", "sigma", "r2", "adj_r2", "f"), {"sigma": 6, "r2": 8, "adj_r2": 8, "f": 3})


@query(
    "R03_coefficient_errors",
    WITH2 + """SELECT 'quantity' AS term, round(sqrt(rss / (n - 3) * s22 / (s11 * s22 - s12 * s12)), 8) AS std_error FROM fit
    UNION ALL SELECT 'discount', round(sqrt(rss / (n - 3) * s11 / (s11 * s22 - s12 * s12)), 6) FROM fit""",
)
def r03_errors(t):
    out = _two(t).table(t.spark).where("term <> '(Intercept)'")
    return out.select("term", F.when(F.col("term") == "quantity", F.round("std_error", 8)).otherwise(F.round("std_error", 6)).alias("std_error"))


@query(
    "R03_residual_quantiles",
    WITH2 + """SELECT round(min(r), 4) AS min, round(quantile_cont(r, 0.25), 4) AS q1, round(quantile_cont(r, 0.5), 4) AS median,
    round(quantile_cont(r, 0.75), 4) AS q3, round(max(r), 4) AS max FROM (SELECT gain - b0 - b1 * quantity - b2 * discount AS r FROM line, fit)""",
)
def r03_residuals(t):
    out = G.residual_quantiles(line_features(t), _two(t))
    return _r(out, dict.fromkeys(("min", "q1", "median", "q3", "max"), 4))


@query("R04_aic", WITH2 + "SELECT round(n * ln(rss / n) + 2 * 3, 4) AS aic FROM fit")
def r04(t):
    return _two(t).summary(t.spark).select(F.round("aic", 4).alias("aic"))


WIDE = ["quantity", "discount", "speed", "l_linenumber", "flag_n", "flag_r"]


def _wide(t):
    return line_features(t).withColumns(
        {"flag_n": (F.col("l_returnflag") == "N").cast("double"), "flag_r": (F.col("l_returnflag") == "R").cast("double")}
    )


@query("R05_step_backward")
def r05(t):
    g = G.gram(_wide(t), "gain", WIDE)
    terms = {**{c: [c] for c in WIDE[:4]}, "flag": ["flag_n", "flag_r"]}
    return G.path_table(t.spark, G.step_backward(g, terms)[1])


@query(
    "R06_anova",
    WITH2 + """, one AS (SELECT syy - s1y * s1y / s11 AS rss1 FROM cr)
    SELECT 1 AS model, (n - 2)::DOUBLE AS df, round(rss1 / 1000000, 3) AS rss, NULL::DOUBLE AS f FROM fit, one
    UNION ALL SELECT 2, (n - 3)::DOUBLE, round(rss / 1000000, 3), round((rss1 - rss) / (rss / (n - 3)), 3) FROM fit, one""",
)
def r06(t):
    g = G.gram(line_features(t), "gain", ["quantity", "discount"])
    out = G.anova(t.spark, [G.ols(g, ["quantity"]), G.ols(g)])
    return _r(out.select("model", "df", (F.col("rss") / 1000000).alias("rss"), "f"), {"rss": 3, "f": 3})


# the t quantile by its expansion around the normal one, exact to many digits with thousands of rows
T_SQL = " + ".join(
    f"({term})" for term in ("z", "(z**3 + z) / (4 * v)", "(5 * z**5 + 16 * z**3 + 3 * z) / (96 * v**2)", "(3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / (384 * v**3)")
)


@query(
    "R07_confidence_intervals",
    WITH2 + f""", k AS (SELECT *, 1.959963984540054::DOUBLE AS z, (n - 3)::DOUBLE AS v, rss / (n - 3) AS s2, s11 * s22 - s12 * s12 AS det FROM fit),
    q AS (SELECT *, {T_SQL} AS t FROM k),
    c AS (SELECT '(Intercept)' AS term, b0 AS estimate, t * sqrt(s2 * (1.0::DOUBLE / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)) AS half FROM q
        UNION ALL SELECT 'quantity', b1, t * sqrt(s2 * s22 / det) FROM q UNION ALL SELECT 'discount', b2, t * sqrt(s2 * s11 / det) FROM q)
    SELECT term, round(estimate, 5) AS estimate, round(estimate - half, 5) AS lo, round(estimate + half, 5) AS hi FROM c""",
)
def r07(t):
    return _r(_two(t).table(t.spark).select("term", "estimate", "lo", "hi"), {"estimate": 5, "lo": 5, "hi": 5})


SIMPLE_SQL = "WITH " + LINE_SQL + """, mo AS (SELECT count(*) AS n, avg(quantity) AS mx, regr_slope(gain, quantity) AS b, regr_intercept(gain, quantity) AS a FROM line),
    sx AS (SELECT sum((quantity - mx) * (quantity - mx)) AS sxx FROM line, mo),
    e AS (SELECT line.*, gain - a - b * quantity AS r, 1.0::DOUBLE / n + (quantity - mx) * (quantity - mx) / sxx AS h, n FROM line, mo, sx),
    v AS (SELECT sum(r * r) / (max(n) - 2) AS s2 FROM e),
    i AS (SELECT e.*, r / sqrt(s2 * (1 - h)) AS sr, r * r / (2 * s2) * h / ((1 - h) * (1 - h)) AS cook FROM e, v)
"""


def _simple(t):
    data = line_features(t)
    return data, G.ols(G.gram(data, "gain", ["quantity"]))


@query(
    "R08_influence",
    SIMPLE_SQL + """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(h, 10) AS hat, round(r, 5) AS residual, round(sr, 7) AS std_residual,
    round(cook, 11) AS cook FROM i""",
)
def r08(t):
    out = G.influence(*_simple(t)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "hat", "residual", "std_residual", "cook")
    return _r(out, {"hat": 10, "residual": 5, "std_residual": 7, "cook": 11})


@query(
    "R09_refit_without_most_influential",
    SIMPLE_SQL + """, k AS (SELECT * FROM i WHERE cook < (SELECT max(cook) FROM i))
    SELECT '(Intercept)' AS term, round(regr_intercept(gain, quantity), 6) AS estimate FROM k
    UNION ALL SELECT 'quantity', round(regr_slope(gain, quantity), 6) FROM k""",
)
def r09(t):
    data, fit = _simple(t)
    with_cook = G.influence(data, fit)
    top = with_cook.agg(F.max("cook").alias("top")).first()["top"]
    kept = with_cook.where(F.col("cook") < top).select(*data.columns)
    return G.ols(G.gram(kept, "gain", ["quantity"])).table(t.spark).select("term", F.round("estimate", 6).alias("estimate"))


@query(
    "R10_normalised_fit",
    "WITH " + LINE_SQL + """, z AS (SELECT (quantity - (SELECT avg(quantity) FROM line)) / (SELECT stddev_samp(quantity) FROM line) AS qz,
    (gain - (SELECT avg(gain) FROM line)) / (SELECT stddev_samp(gain) FROM line) AS gz FROM line)
    SELECT round(regr_slope(gz, qz), 8) AS with_intercept, round(sum(gz * qz) / sum(qz * qz), 8) AS without_intercept FROM z""",
)
def r10(t):
    z = C.standardise(line_features(t), ["quantity", "gain"])
    g = G.gram(z, "gain_z", ["quantity_z"])
    a, b = G.ols(g), G.ols(g, intercept=False)
    return t.spark.createDataFrame(
        [(round(a.estimates()["quantity_z"], 8), round(b.estimates()["quantity_z"], 8))], "with_intercept double, without_intercept double"
    )


@query(
    "R11_qq_points",
    """SELECT o_orderkey, o_totalprice AS sample, round((row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 0.5::DOUBLE) / count(*) OVER (), 10) AS p FROM orders""",
)
def r11(t):
    out = G.qq_points(t.orders, "o_totalprice", "o_orderkey")
    return out.select("o_orderkey", "sample", F.round("p", 10).alias("p"))


@query("R11_qq_residuals")
def r11_residuals(t):
    data = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    fit = G.ols(G.gram(data, "c_nationkey", ["c_acctbal"]))
    return G.qq_points(G.influence(data, fit).where(F.col("std_residual").isNotNull()), "std_residual", "c_custkey")


@query("R12_cross_validation")
def r12(t):
    tagged = sampling.assign_folds(_wide(t), KEY, 10, 5)
    return G.cross_validate(tagged, "gain", WIDE, "fold")


@query(
    "R12_leave_out_one_part",
    f"""WITH {LINE_SQL}, p AS (SELECT l_partkey AS part, count(*)::DOUBLE AS n, sum(quantity)::DOUBLE AS q, sum(gain)::DOUBLE AS g,
        sum(quantity * quantity)::DOUBLE AS qq, sum(quantity * gain)::DOUBLE AS qg FROM line GROUP BY 1),
    w AS (SELECT sum(n) AS n, sum(q) AS q, sum(g) AS g, sum(qq) AS qq, sum(qg) AS qg FROM p),
    r AS (SELECT part, p.n, w.n - p.n AS m, w.q - p.q AS q, w.g - p.g AS g, w.qq - p.qq AS qq, w.qg - p.qg AS qg FROM p, w),
    b AS (SELECT part, n, (qg - q * g / m) / (qq - q * q / m) AS b1, g / m AS mg, q / m AS mq FROM r),
    e AS (SELECT part, max(n) AS n, sum((gain - (mg + b1 * (quantity - mq))) ** 2) AS sse FROM line JOIN b ON l_partkey = part GROUP BY 1)
    SELECT part, n, round(sqrt(sse / n), 4) AS rmse FROM e""",
)
def r12_parts(t):
    """One fold per part, as many as the table has parts."""
    data = line_features(t).withColumnRenamed("l_partkey", "part")
    return G.cross_validate(data, "gain", ["quantity"], "part").select("part", "n", F.round("rmse", 4).alias("rmse"))


@query(
    "R12_cross_validation_two",
    f"""WITH {LINE_SQL}, h AS (SELECT *, CAST({hash_sql(5, 'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')} % 10 AS INTEGER) AS own FROM line),
    s AS (SELECT fold, avg(quantity) AS mq, avg(discount) AS md, avg(gain) AS mg, var_pop(quantity) AS qq, var_pop(discount) AS dd,
        covar_pop(quantity, discount) AS qd, covar_pop(quantity, gain) AS qg, covar_pop(discount, gain) AS dg
        FROM h, range(10) f(fold) WHERE own <> fold GROUP BY 1),
    b AS (SELECT *, (qg * dd - dg * qd) / (qq * dd - qd * qd) AS b1, (dg * qq - qg * qd) / (qq * dd - qd * qd) AS b2 FROM s),
    e AS (SELECT fold, gain, gain - (mg + b1 * (quantity - mq) + b2 * (discount - md)) AS e FROM h JOIN b ON own = fold)
    SELECT CAST(fold AS INTEGER) AS fold, count(*)::DOUBLE AS n, round(sqrt(avg(e * e)), 5) AS rmse, round(1 - sum(e * e) / (var_pop(gain) * count(*)), 7) AS r2
    FROM e GROUP BY 1""",
)
def r12_two(t):
    tagged = sampling.assign_folds(line_features(t), KEY[:4], 10, 5)
    out = G.cross_validate(tagged, "gain", ["quantity", "discount"], "fold")
    return out.select("fold", "n", F.round("rmse", 5).alias("rmse"), F.round("r2", 7).alias("r2"))


@query(
    "R13_score",
    WITH2 + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(b0 + b1 * quantity + b2 * discount, 5) AS prediction FROM line, fit",
)
def r13(t):
    out = G.score(line_features(t), _two(t))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("prediction", 5).alias("prediction"))


SCORED_SQL = """, sc AS (SELECT l_returnflag, gain, b0 + b1 * quantity + b2 * discount AS prediction FROM line, fit)
"""


@query(
    "R14_regression_metrics",
    WITH2 + SCORED_SQL + """SELECT l_returnflag, count(*) AS n, round(sqrt(avg((gain - prediction) ** 2)), 5) AS rmse, round(avg((gain - prediction) ** 2), 3) AS mse,
    round(avg(abs(gain - prediction)), 5) AS mae, round(1 - avg((gain - prediction) ** 2) / var_pop(gain), 8) AS r2 FROM sc GROUP BY 1""",
)
def r14(t):
    out = G.regression_report(G.score(line_features(t), _two(t)), "gain", "prediction", ["l_returnflag"])
    return _r(out, {"rmse": 5, "mse": 3, "mae": 5, "r2": 8})


@query(
    "R14_metrics_with_missing",
    WITH2 + SCORED_SQL + """, h AS (SELECT *, CASE WHEN gain < 6000 THEN prediction END AS seen FROM sc)
    SELECT l_returnflag, count(seen) AS n, round(sqrt(avg((gain - seen) ** 2)), 5) AS rmse, round(avg((gain - seen) ** 2), 3) AS mse,
    round(avg(abs(gain - seen)), 5) AS mae, round(1 - avg((gain - seen) ** 2) / var_pop(gain) FILTER (seen IS NOT NULL), 8) AS r2 FROM h GROUP BY 1""",
)
def r14_missing(t):
    scored = G.score(line_features(t), _two(t)).withColumn("prediction", F.when(F.col("gain") < 6000, F.col("prediction")))
    out = G.regression_report(scored, "gain", "prediction", ["l_returnflag"])
    return _r(out, {"rmse": 5, "mse": 3, "mae": 5, "r2": 8})


# The decile report: flights-like features with three lookups, a model fitted
# on the years before 2000 and judged on the later ones.
FLIGHT_SQL = """WITH line AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, year(o_orderdate) AS year, p_brand AS carrier,
    o.n_name AS origin, d.n_name AS dest, l_quantity AS quantity, l_discount AS discount, l_extendedprice * l_discount AS gain
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN part ON l_partkey = p_partkey JOIN nation o ON s_nationkey = o.n_nationkey JOIN nation d ON c_nationkey = d.n_nationkey
    WHERE l_quantity > 0),
    """
TRAIN_SQL = FLIGHT_SQL + TWO_SQL.lstrip(", ").replace("FROM line", "FROM line WHERE year < 2000").replace("WHERE year < 2000, mo", ", mo WHERE year < 2000")
SCORED_FLIGHTS_SQL = TRAIN_SQL + """, sc AS (SELECT line.*, CASE WHEN year < 2000 THEN 'train' ELSE 'valid' END AS data,
    b0 + b1 * quantity + b2 * discount AS prediction FROM line, fit)
"""


def flight_features(t):
    rows = flights(t).where("l_quantity > 0")
    rows = R.lookup_join(rows, t.part.select("p_partkey", F.col("p_brand").alias("carrier")), "l_partkey", "p_partkey")
    rows = R.join_lookup_twice(rows, t.nation.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")), ["s_nationkey", "c_nationkey"], "key", ["origin_", "dest_"])
    return rows.select(
        *KEY, F.year("o_orderdate").alias("year"), "carrier", F.col("origin_name").alias("origin"), F.col("dest_name").alias("dest"),
        F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), (F.col("l_extendedprice") * F.col("l_discount")).alias("gain"),
    )


def scored_flights(t):
    data = flight_features(t)  # not kept: the fit reads two columns, and later filters reach the tables
    fit = G.ols(G.gram(data.where("year < 2000"), "gain", ["quantity", "discount"]))
    return G.score(data, fit).withColumn("data", F.when(F.col("year") < 2000, "train").otherwise("valid"))


@query(
    "R13_decile_report",
    SCORED_FLIGHTS_SQL + """SELECT data, decile, round(sum(gain), 4) / count(*) AS gain, count(*) AS n FROM (SELECT data, gain, ntile(10) OVER (PARTITION BY data
    ORDER BY round(prediction, 4) DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS decile FROM sc) GROUP BY 1, 2""",
)
def r13_deciles(t):
    scored = scored_flights(t).withColumns({"prediction": F.round("prediction", 4), "key": F.struct(*KEY)})
    out = W.decile_lift(scored, "prediction", "gain", "key")
    return out.select("data", F.col("decile").cast("bigint").alias("decile"), (F.round(F.col("gain") * F.col("n"), 4) / F.col("n")).alias("gain"), "n")


def _means(out):
    # gains have four decimals, so their rounded sum is exact and needs no tie rule
    total = F.round(F.col("gain") * F.col("freq"), 4)
    return out.withColumns({"gain": total / F.col("freq"), "prediction": F.round("prediction", 4)})


@query(
    "R15_out_of_time_by_carrier",
    SCORED_FLIGHTS_SQL + """SELECT carrier, round(sum(gain), 4) / count(*) AS gain, round(avg(prediction), 4) AS prediction, count(*) AS freq FROM sc
    WHERE data = 'valid' GROUP BY 1 HAVING count(*) > 100""",
)
def r15(t):
    out = E.actual_vs_predicted(scored_flights(t).where("data = 'valid'"), "gain", "prediction", ["carrier"], 100)
    return _means(out)


@query(
    "R16_by_destination",
    SCORED_FLIGHTS_SQL + """SELECT dest, data, round(sum(gain), 4) / count(*) AS gain, round(avg(prediction), 4) AS prediction, count(*) AS freq FROM sc
    WHERE carrier = 'Brand#13' GROUP BY 1, 2 HAVING count(*) > 20""",
)
def r16(t):
    out = E.actual_vs_predicted(scored_flights(t).where("carrier = 'Brand#13'"), "gain", "prediction", ["dest", "data"], 20)
    return _means(out)


@query(
    "E04_actual_vs_predicted",
    SCORED_FLIGHTS_SQL + """SELECT origin, round(sum(gain), 4) / count(*) AS gain, round(avg(prediction), 4) AS prediction, count(*) AS freq FROM sc GROUP BY 1""",
)
def e04(t):
    return _means(E.actual_vs_predicted(scored_flights(t), "gain", "prediction", ["origin"]))


@query(
    "R17_pairwise_t",
    """WITH m AS (SELECT o_orderpriority AS g, count(*) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM orders GROUP BY 1),
    s AS (SELECT sum((n - 1) * v) / sum(n - 1) AS s2 FROM m)
    SELECT a.g AS level_a, b.g AS level_b, round((a.m - b.m) / sqrt(s2 * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n)), 6) AS t FROM m a JOIN m b ON a.g > b.g, s""",
)
def r17(t):
    return _r(G.pairwise_t(t.orders, "o_totalprice", "o_orderpriority").select("level_a", "level_b", "t"), {"t": 6})


@query("R17_pairwise_t_holm")
def r17_holm(t):
    return G.pairwise_t(t.orders, "o_totalprice", "o_orderpriority")


@query(
    "R18_line_per_group",
    """SELECT l_returnflag, l_linestatus, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
    FROM lineitem GROUP BY 1, 2""",
)
def r18(t):
    return _r(G.fitted_lines(t.lineitem, "l_extendedprice", "l_quantity", ["l_returnflag", "l_linestatus"]), {"slope": 6, "intercept": 4})


@query(
    "R01_model_per_customer",
    """WITH o AS (SELECT o_custkey AS k, o_totalprice::DOUBLE AS y, o_orderdate, epoch(o_orderdate::TIMESTAMP) / 86400 AS x FROM orders),
    g AS (SELECT k, count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(x, x) AS sxx, regr_syy(y, x) AS syy, avg(x) AS mx, regr_r2(y, x) AS r2 FROM o GROUP BY 1 HAVING count(*) >= 8),
    s AS (SELECT *, sqrt(greatest(syy * (1 - r2), 0) / (n - 2)) AS sigma FROM g)
    SELECT k, 'day' AS term, round(b, 3) AS estimate, round(sigma / sqrt(sxx), 3) AS std_error, n::DOUBLE AS n, round(sigma, 1) AS sigma FROM s""",
)
def r01_groups(t):
    """A trend per customer with eight orders or more."""
    rows = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_totalprice").cast("double").alias("y"), F.unix_date(F.col("o_orderdate").cast("date")).alias("day"))
    out = G.ols_by_group(rows, "y", ["day"], ["k"]).where("term = 'day' AND n >= 8")
    return out.select("k", "term", F.round("estimate", 3).alias("estimate"), F.round("std_error", 3).alias("std_error"), "n", F.round("sigma", 1).alias("sigma"))


@query(
    "R17_pairwise_many_levels",
    """WITH m AS (SELECT o_custkey::VARCHAR AS g, count(*) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM orders GROUP BY 1),
    s AS (SELECT sum((n - 1) * coalesce(v, 0)) / sum(n - 1) AS s2 FROM m)
    SELECT a.g AS level_a, count(*) AS n, round(sum((a.m - b.m) / sqrt(s2 * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n))), 4) AS t FROM m a JOIN m b ON a.g > b.g, s GROUP BY 1""",
)
def r17_many(t):
    """Every customer against every other, summed per customer."""
    out = G.pairwise_t(t.orders, "o_totalprice", "o_custkey")
    return out.groupBy("level_a").agg(F.count("p_holm").alias("n"), F.round(F.sum("t"), 4).alias("t"))
