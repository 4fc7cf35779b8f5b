"""F, D and G: scalar functions, column maps, chart data."""

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import charts as C
from millrace.operators import regression as G
from millrace.operators import relational as R
from millrace.operators import windows as W
from millrace.operators.reshape import bind_tagged
from millrace.plans.registry import query


@query(
    "F01_arithmetic",
    """SELECT l_orderkey, l_linenumber, l_extendedprice + l_tax AS a, l_extendedprice - l_tax AS b, l_extendedprice * l_tax AS c,
    l_extendedprice / nullif(l_tax, 0) AS d, l_quantity ** 2 AS e FROM lineitem""",
)
def f01(t):
    p, x = F.col("l_extendedprice"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", (p + x).alias("a"), (p - x).alias("b"), (p * x).alias("c"),
        F.try_divide(p, x).alias("d"), F.pow("l_quantity", F.lit(2)).alias("e"),
    )


@query(
    "F02_integer_division",
    "SELECT c_custkey, CAST(floor(c_acctbal / 80) AS BIGINT) AS block FROM customer",
)
def f02(t):
    return t.customer.select("c_custkey", S.floor_div("c_acctbal", 80).alias("block"))


@query(
    "F03_log_sqrt_abs_exp",
    """SELECT o_orderkey, round(ln(o_totalprice), 8) AS a, round(log10(o_totalprice), 8) AS b, round(sqrt(o_totalprice), 6) AS c,
    abs(o_totalprice - 100000) AS d, round(exp(o_totalprice / 1000000), 8) AS e FROM orders WHERE o_totalprice > 0""",
)
def f03(t):
    p = F.col("o_totalprice")
    return t.orders.where(p > 0).select(
        "o_orderkey", F.round(F.log(p), 8).alias("a"), F.round(F.log10(p), 8).alias("b"), F.round(F.sqrt(p), 6).alias("c"),
        F.abs(p - 100000).alias("d"), F.round(F.exp(p / 1000000), 8).alias("e"),
    )


@query("F04_round_half_even", "SELECT p_partkey, round_even(p_size / 2, 0) AS half FROM part")
def f04(t):
    return t.part.select("p_partkey", S.round_half_even(F.col("p_size") / 2).alias("half"))


_LABELLED = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _labelled(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left")


@query(
    "F05_if_else",
    f"SELECT d.doc_id, CASE WHEN quality = 1 THEN 'good' WHEN NOT quality = 1 THEN 'poor' END AS grade FROM {_LABELLED}",
)
def f05(t):
    return _labelled(t).select("doc_id", S.if_else(F.col("quality") == 1, F.lit("good"), F.lit("poor")).alias("grade"))


@query("F06_is_missing", f"SELECT d.doc_id, quality IS NULL AS gone FROM {_LABELLED}")
def f06(t):
    return _labelled(t).select("doc_id", S.is_missing(F.col("quality").cast("double")).alias("gone"))


@query(
    "F07_casts",
    "SELECT event_id, CAST(value AS BIGINT) AS whole, CAST(user_id AS VARCHAR) AS user_text, "
    "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM (SELECT event_id, trunc(value) AS value, user_id, props FROM events)",
)
def f07(t):
    return t.events.select(
        "event_id", F.col("value").cast("bigint").alias("whole"), F.col("user_id").cast("string").alias("user_text"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("int").alias("k"),
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "F08_relevel",
    "SELECT o_orderkey, " + ", ".join(
        f"CAST(o_orderpriority = '{p}' AS INTEGER)::DOUBLE AS \"o_orderpriority_{p}\"" for p in PRIORITIES if p != "3-MEDIUM"
    ) + " FROM orders",
)
def f08(t):
    made = S.dummies("o_orderpriority", PRIORITIES, "3-MEDIUM")
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in made.items()])


@query(
    "F09_reorder",
    """SELECT p_type, dense_rank() OVER (ORDER BY n DESC, p_type) AS position
    FROM (SELECT p_type, count(*) AS n FROM part GROUP BY 1)""",
)
def f09(t):
    from millrace.operators.ordering import positions

    return positions(R.count_by(t.part, ["p_type"]), [F.desc("n"), "p_type"]).select("p_type", "position")


@query(
    "F10_paste",
    "SELECT o_orderkey, concat_ws('-', year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS day FROM orders",
)
def f10(t):
    parts = [f("o_orderdate").cast("string") for f in (F.year, F.month, F.dayofmonth)]
    return t.orders.select("o_orderkey", S.paste(*parts, sep="-").alias("day"))


@query("F11_substr", "SELECT doc_id, substr(text, 1, 20) AS start FROM documents")
def f11(t):
    return t.documents.select("doc_id", F.substring("text", 1, 20).alias("start"))


@query("F12_tolower", "SELECT p_partkey, lower(p_type) AS kind FROM part")
def f12(t):
    return t.part.select("p_partkey", F.lower("p_type").alias("kind"))


@query("F13_str_detect", "SELECT doc_id, regexp_matches(text, '(?i)licen[cs]e|copyright') AS hit FROM documents")
def f13(t):
    return t.documents.select("doc_id", F.col("text").rlike("(?i)licen[cs]e|copyright").alias("hit"))


@query(
    "F14_str_extract",
    "SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]+') THEN regexp_extract(text, '[0-9]+') END AS digits FROM documents",
)
def f14(t):
    return t.documents.select("doc_id", S.extract_first("text", "[0-9]+").alias("digits"))


@query(
    "F15_extract_group",
    """SELECT page_id, CASE WHEN regexp_matches(html, '<title>(.*?)</title>') THEN regexp_extract(html, '<title>(.*?)</title>', 1) END AS title
    FROM pages""",
)
def f15(t):
    return t.pages.select("page_id", S.extract_first("html", "<title>(.*?)</title>", 1).alias("title"))


@query("F16_gsub", "SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '', 'g') AS bare FROM part")
def f16(t):
    return t.part.select("p_partkey", S.remove_pattern("p_name", "[aeiou]").alias("bare"))


@query(
    "F17_remove_punctuation_digits",
    r"""SELECT conv_id, turn, regexp_replace(regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g'), '[0-9]+', '', 'g') AS bare FROM conversations""",
)
def f17(t):
    return t.conversations.select("conv_id", "turn", S.remove_digits(S.remove_punctuation("text")).alias("bare"))


@query("F18_keep_ascii", r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS ascii FROM documents")
def f18(t):
    return t.documents.select("doc_id", S.keep_ascii("text").alias("ascii"))


@query("F19_datediff", "SELECT o_orderkey, CAST(date_diff('day', o_orderdate, DATE '2002-01-01') AS INTEGER) AS age FROM orders")
def f19(t):
    return t.orders.select("o_orderkey", S.days_since("o_orderdate", "2002-01-01").alias("age"))


@query(
    "F20_z_score",
    """SELECT c_custkey, round((c_acctbal - m) / s, 8) AS z FROM customer,
    (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s FROM customer)""",
)
def f20(t):
    return C.standardise(t.customer, ["c_acctbal"]).select("c_custkey", F.round("c_acctbal_z", 8).alias("z"))


@query(
    "F21_one_hot",
    "SELECT vec_id, " + ", ".join(f"CAST(label = {i} AS INTEGER) AS is_{i}" for i in range(10)) + " FROM embeddings",
)
def f21(t):
    return t.embeddings.select("vec_id", *S.one_hot("label", list(range(10))))


@query(
    "F22_scale_flatten",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)) / 255)), 8) AS total, len(embedding) AS size FROM embeddings""",
)
def f22(t):
    grid = F.array(*[F.slice("embedding", 8 * i + 1, 8) for i in range(8)])
    flat = F.transform(F.flatten(grid), lambda x: F.abs(x.cast("double")) / 255)
    total = F.aggregate(flat, F.lit(0.0), lambda a, x: a + x)
    return t.embeddings.select("vec_id", F.round(total, 8).alias("total"), F.size(flat).cast("bigint").alias("size"))


@query(
    "F25_correlation_test",
    """SELECT n, round(r, 8) AS r, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t, round(tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)), 6) AS lo,
    round(tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)), 6) AS hi FROM (SELECT count(*) AS n, corr(l_quantity, l_extendedprice) AS r FROM lineitem)""",
)
def f25(t):
    out = G.correlation_test(t.lineitem, "l_quantity", "l_extendedprice")
    return out.select("n", F.round("r", 8).alias("r"), *[F.round(c, 6).alias(c) for c in ("t", "lo", "hi")])


@query("D01_scalar_udf", r"SELECT doc_id, regexp_replace(text, 'https?://[^ \t\r\n]*', '', 'g') AS text FROM documents")
def d01(t):
    return t.documents.select("doc_id", S.remove_urls("text").alias("text"))


@query(
    "D01_scalar_udf_on_links",
    r"""SELECT doc_id, regexp_replace(left(text, length(text) // 2) || ' http://middle.example/' || doc_id || chr(9) || substr(text, length(text) // 2 + 1)
    || ' https://' || source || '.org/' || doc_id || '?q=' || lang || chr(10) || lang || ' http://x', 'https?://[^ \t\r\n]*', '', 'g') AS text FROM documents""",
)
def d01_links(t):
    """Whole texts with a link in the middle and two at the end."""
    half = F.floor(F.length("text") / 2).cast("int")
    linked = F.concat(
        F.substring(F.col("text"), F.lit(1), half), F.lit(" http://middle.example/"), F.col("doc_id").cast("string"), F.lit("\t"),
        F.substring(F.col("text"), half + 1, F.length("text")), F.lit(" https://"), "source", F.lit(".org/"), F.col("doc_id").cast("string"), F.lit("?q="), "lang",
        F.lit("\n"), "lang", F.lit(" http://x"),
    )
    return t.documents.select("doc_id", linked.alias("text")).select("doc_id", S.remove_urls("text").alias("text"))


@query("D02_elementwise_map", "SELECT event_id, value * 2 + 1 AS mapped FROM events")
def d02(t):
    @F.pandas_udf("double")
    def user_function(v: pd.Series) -> pd.Series:
        return v * 2 + 1

    return t.events.select("event_id", user_function("value").alias("mapped"))


@query(
    "D03_same_steps_per_split",
    "SELECT o_orderstatus AS data, o_orderpriority, round(avg(o_totalprice), 4) AS mean_price FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2",
)
def d03(t):
    both = bind_tagged({s: t.orders.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in ("F", "O")})
    return both.groupBy("data", "o_orderpriority").agg(F.round(F.avg("o_totalprice"), 4).alias("mean_price"))


@query(
    "D04_row_function",
    "SELECT vec_id, list_max(embedding)::DOUBLE AS top, CAST(list_position(embedding, list_max(embedding)) AS BIGINT) AS at FROM embeddings",
)
def d04(t):
    top = F.array_max("embedding")
    return t.embeddings.select("vec_id", top.cast("double").alias("top"), F.array_position("embedding", top).cast("bigint").alias("at"))


@query(
    "D05_transform_chain",
    r"""SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '[!-/:-@\[-`{-~]', '', 'g'), '[0-9]+', '', 'g'), '[ \t\r\n\f]+', ' ', 'g')) AS text
    FROM conversations""",
)
def d05(t):
    def on_text(f):
        return lambda df: df.withColumn("text", f(F.col("text")))

    out = t.conversations.select("conv_id", "turn", "text")
    for step in (F.lower, S.remove_punctuation, S.remove_digits, lambda c: F.trim(F.regexp_replace(c, r"[ \t\r\n\f]+", " "))):
        out = out.transform(on_text(step))
    return out


@query(
    "D06_many_columns",
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_linenumber * 10 AS VARCHAR) AS ten FROM "
    "(SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity FROM lineitem)",
)
def d06(t):
    wide = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("l_quantity"), (F.col("l_linenumber") * 10).alias("ten"))
    return wide.withColumns({c: F.col(c).cast("string") for c in ("l_quantity", "ten")})


@query(
    "G01_histogram",
    "SELECT CAST(floor(l_extendedprice / 2500) AS BIGINT) AS bin, count(*) AS n, floor(l_extendedprice / 2500) * 2500.0::DOUBLE AS lo FROM lineitem GROUP BY ALL",
)
def g01(t):
    return C.histogram(t.lineitem, "l_extendedprice", 2500)


@query(
    "G01_histogram_bins",
    """SELECT o_orderstatus, CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) AS BIGINT) AS bin, count(*) AS n FROM orders,
    (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) GROUP BY 1, 2""",
)
def g01_bins(t):
    return C.histogram_bins(t.orders, "o_totalprice", 30, ["o_orderstatus"]).withColumn("bin", F.col("bin").cast("bigint"))


BOX_SQL = """WITH q AS (SELECT p_brand, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
    quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
r AS (SELECT p.p_brand, l_orderkey, l_linenumber, l_extendedprice AS x, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
    FROM lineitem JOIN part p ON l_partkey = p_partkey JOIN q ON p.p_brand = q.p_brand)
"""


def _priced(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").join(
        t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    )


@query(
    "G02_box_stats",
    BOX_SQL + """SELECT p_brand, round(max(q1), 4) AS q1, round(max(median), 4) AS median, round(max(q3), 4) AS q3, round(avg(x), 4) AS mean,
    min(x) FILTER (x >= lo AND x <= hi) AS whisker_lo, max(x) FILTER (x >= lo AND x <= hi) AS whisker_hi,
    count(*) FILTER (x < lo OR x > hi) AS outliers FROM r GROUP BY 1""",
)
def g02(t):
    out = C.box_stats(_priced(t), "l_extendedprice", ["p_brand"])
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3", "mean")})


@query("G02_box_outliers", BOX_SQL + "SELECT p_brand, l_orderkey, l_linenumber, x AS l_extendedprice FROM r WHERE x < lo OR x > hi")
def g02_outliers(t):
    return C.box_outliers(_priced(t), "l_extendedprice", ["p_brand"]).select("p_brand", "l_orderkey", "l_linenumber", "l_extendedprice")


SKEWED_SQL = """WITH x AS (SELECT CASE WHEN p_size > 10 THEN p_brand END AS brand, l_orderkey, l_linenumber,
    l_extendedprice * CASE WHEN l_quantity > 49 THEN 9 ELSE 1 END AS x FROM lineitem JOIN part ON l_partkey = p_partkey),
q AS (SELECT brand, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM x GROUP BY 1)
"""


@query(
    "G02_box_outliers_null_keys",
    SKEWED_SQL + """SELECT x.brand, l_orderkey, l_linenumber, round(x, 4) AS x FROM x JOIN q ON x.brand IS NOT DISTINCT FROM q.brand
    WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)""",
)
def g02_null_keys(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("brand"), "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") * F.when(F.col("l_quantity") > 49, 9).otherwise(1)).alias("x"),
    )
    return C.box_outliers(rows, "x", ["brand"]).withColumn("x", F.round("x", 4))


@query(
    "G03_grouped_bars",
    """SELECT 'F' AS data, decile, round(avg(o_totalprice), 4) AS o_totalprice FROM (SELECT o_totalprice,
    ntile(10) OVER (ORDER BY o_custkey DESC, o_orderkey) AS decile FROM orders WHERE o_orderstatus = 'F') GROUP BY 2
    UNION ALL SELECT 'O', decile, round(avg(o_totalprice), 4) FROM (SELECT o_totalprice,
    ntile(10) OVER (ORDER BY o_custkey DESC, o_orderkey) AS decile FROM orders WHERE o_orderstatus = 'O') GROUP BY 2""",
)
def g03(t):
    rows = t.orders.where("o_orderstatus IN ('F', 'O')").withColumnRenamed("o_orderstatus", "data")
    out = W.decile_lift(rows, "o_custkey", "o_totalprice", "o_orderkey").drop("n")
    return out.select("data", F.col("decile").cast("bigint").alias("decile"), F.round("o_totalprice", 4).alias("o_totalprice"))


NAMES_SQL = """WITH names AS (SELECT year(l_shipdate) AS year, p_name AS name, l_returnflag AS sex, sum(l_quantity) AS n
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)
"""


def _names(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(
        F.year("l_shipdate").cast("bigint").alias("year"), F.col("p_name").alias("name"), F.col("l_returnflag").alias("sex")
    ).agg(F.sum("l_quantity").alias("n"))


@query(
    "G04_top_name_lines",
    NAMES_SQL + """, top AS (SELECT name, sex FROM (SELECT name, sex, rank() OVER (PARTITION BY sex ORDER BY sum(n) DESC) AS r FROM names
    WHERE year = 1996 GROUP BY 1, 2) WHERE r < 5) SELECT n.year, n.name, n.sex, n.n FROM names n JOIN top USING (name, sex)""",
)
def g04(t):
    names = _names(t)
    sums = names.where("year = 1996").groupBy("name", "sex").agg(F.sum("n").alias("total"))
    top = W.top_n(sums, ["sex"], [F.desc("total")], 4).select("name", "sex")
    return R.natural_join(names, top).select("year", "name", "sex", "n")


@query(
    "G05_yearly_totals",
    NAMES_SQL + """SELECT year, round(sum(CASE WHEN sex = 'R' THEN n ELSE 0 END) / 1000000, 8) AS returned,
    round(sum(CASE WHEN sex = 'A' THEN n ELSE 0 END) / 1000000, 8) AS accepted FROM names GROUP BY 1""",
)
def g05(t):
    def side(flag):
        return F.round(F.sum(F.when(F.col("sex") == flag, F.col("n")).otherwise(0.0)) / 1000000, 8)

    return _names(t).groupBy("year").agg(side("R").alias("returned"), side("A").alias("accepted"))


@query(
    "G06_shared_names",
    NAMES_SQL + """, s AS (SELECT name, sum(CASE WHEN sex = 'R' THEN n ELSE 0 END) AS r, sum(CASE WHEN sex = 'A' THEN n ELSE 0 END) AS a, sum(n) AS total,
    round_even(sum(year * n) / sum(n), 0) AS mean_year FROM names GROUP BY 1),
    k AS (SELECT * FROM s WHERE r > 1000 AND a > 1000)
    SELECT name, round(log10(r), 8) AS log_r, round(log10(a), 8) AS log_a, mean_year,
    round((sqrt(total) - (SELECT avg(sqrt(total)) FROM k)) / (SELECT stddev_samp(sqrt(total)) FROM k), 6) AS size FROM k""",
)
def g06(t):
    def side(flag):
        return F.sum(F.when(F.col("sex") == flag, F.col("n")).otherwise(0.0))

    shared = (
        _names(t)
        .groupBy("name")
        .agg(side("R").alias("r"), side("A").alias("a"), F.sqrt(F.sum("n")).alias("root"), S.round_half_even(S.weighted_mean("year", "n")).alias("mean_year"))
        .where("r > 1000 AND a > 1000")
    )
    return C.standardise(shared, ["root"]).select(
        "name", F.round(F.log10("r"), 8).alias("log_r"), F.round(F.log10("a"), 8).alias("log_a"), "mean_year", F.round("root_z", 6).alias("size")
    )
