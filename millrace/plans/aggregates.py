"""A: group summaries."""

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import relational as R
from millrace.operators import text
from millrace.plans.registry import query


@query("A01_global_mean", "SELECT round(avg(o_totalprice), 4) AS mean_price FROM orders")
def a01(t):
    return t.orders.agg(F.round(F.avg("o_totalprice"), 4).alias("mean_price"))


@query("A02_group_mean_count", "SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean_price, count(*) AS n FROM lineitem GROUP BY 1")
def a02(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.avg("l_extendedprice"), 4).alias("mean_price"), F.count(F.lit(1)).alias("n")
    )


@query(
    "A03_group_many_measures",
    """SELECT o_orderpriority, count(*) AS n, round(avg(l_extendedprice), 4) AS price, round(avg(l_quantity), 6) AS quantity,
    round(avg((l_extendedprice + l_tax) / nullif(l_quantity, 0)), 4) AS unit FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_discount > 0 OR l_tax > 0 GROUP BY 1""",
)
def a03(t):
    rows = t.lineitem.where((F.col("l_discount") > 0) | (F.col("l_tax") > 0)).join(
        t.orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("l_extendedprice"), 4).alias("price"),
        F.round(F.avg("l_quantity"), 6).alias("quantity"),
        F.round(F.avg(F.try_divide(F.col("l_extendedprice") + F.col("l_tax"), F.col("l_quantity"))), 4).alias("unit"),
    )


A04 = """SELECT p_type, round(avg(p_retailprice), 4) AS mean_price, max(p_size) AS largest FROM part
WHERE p_size BETWEEN 5 AND 40 GROUP BY p_type ORDER BY mean_price DESC, p_type LIMIT 5"""


@query("A04_sql_group_order_limit", A04)
def a04(t):
    return t.spark.sql(A04.replace("FROM part", "FROM {part}"), part=t.part)


@query(
    "A05_multi_key_group",
    "SELECT p_brand, p_type, p_size, round(avg(p_retailprice), 4) AS mean_price FROM part GROUP BY 1, 2, 3",
)
def a05(t):
    return t.part.groupBy("p_brand", "p_type", "p_size").agg(F.round(F.avg("p_retailprice"), 4).alias("mean_price"))


@query("A06_count", "SELECT count(*) AS n FROM lineitem")
def a06(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("A07_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12")
def a07(t):
    return R.count_by(t.orders, ["o_custkey"]).where("n > 12")


@query(
    "A08_min_label",
    "SELECT l_partkey, min(p_name) AS label, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
)
def a08(t):
    return (
        R.lookup_join(t.lineitem.select("l_partkey"), t.part.select("p_partkey", "p_name"), "l_partkey", "p_partkey", "inner")
        .groupBy("l_partkey")
        .agg(F.min("p_name").alias("label"), F.count(F.lit(1)).alias("n"))
    )


@query(
    "A09_conditional_sum",
    """SELECT year(l_shipdate) AS year, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned,
    sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS accepted FROM lineitem GROUP BY 1""",
)
def a09(t):
    def only(flag):
        return F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0.0))

    return t.lineitem.groupBy(F.year("l_shipdate").cast("bigint").alias("year")).agg(
        only("R").alias("returned"), only("A").alias("accepted")
    )


@query(
    "A10_weighted_mean",
    """SELECT p_name, round_even(sum(year(l_shipdate) * l_quantity) / sum(l_quantity), 0) AS mean_year
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def a10(t):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("p_name").agg(
        S.round_half_even(S.weighted_mean(F.year("l_shipdate"), "l_quantity")).alias("mean_year")
    )


@query("A11_frequency_table", "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2 ORDER BY n DESC, 1, 2")
def a11(t):
    return R.count_by(t.part, ["p_brand", "p_type"]).orderBy(F.desc("n"), "p_brand", "p_type")


@query("A12_tally", "SELECT event_type, hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def a12(t):
    return R.count_by(t.events.withColumn("hour", F.hour("ts").cast("bigint")), ["event_type", "hour"])


@query(
    "A13_two_step_aggregate",
    """SELECT p_brand, max(n) AS most, count(*) AS names, round(avg(n), 6) AS mean_n FROM
    (SELECT p_brand, p_name, count(*) AS n FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2) GROUP BY 1""",
)
def a13(t):
    inner = R.count_by(t.part.join(t.lineitem, F.col("l_partkey") == F.col("p_partkey")), ["p_brand", "p_name"])
    return inner.groupBy("p_brand").agg(
        F.max("n").alias("most"), F.count(F.lit(1)).alias("names"), F.round(F.avg("n"), 6).alias("mean_n")
    )


@query("A14_sum_as_double", "SELECT p_brand, CAST(sum(p_size) AS DOUBLE) AS total FROM part GROUP BY 1")
def a14(t):
    return t.part.groupBy("p_brand").agg(F.sum("p_size").cast("double").alias("total"))


@query(
    "A15_key_of_max",
    """SELECT o_orderpriority, min(o_orderkey) AS o_orderkey, max(o_totalprice) AS o_totalprice FROM orders o
    WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders i WHERE i.o_orderpriority = o.o_orderpriority) GROUP BY 1""",
)
def a15(t):
    return R.key_of_max(t.orders, "o_orderkey", "o_totalprice", ["o_orderpriority"])


@query(
    "A15_key_of_max_text",
    """SELECT p_brand, min(p_name || '#' || p_partkey) AS part, max(p_retailprice) AS p_retailprice FROM part o
    WHERE p_retailprice = (SELECT max(p_retailprice) FROM part i WHERE i.p_brand = o.p_brand) GROUP BY 1""",
)
def a15_text(t):
    named = t.part.withColumn("part", F.concat("p_name", F.lit("#"), "p_partkey"))
    return R.key_of_max(named, "part", "p_retailprice", ["p_brand"])


@query(
    "A16_contingency",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
    count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""",
)
def a16(t):
    return R.contingency(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


def _profile_sql(c):
    return (
        f"SELECT '{c}' AS \"column\", round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q1, "
        f"round(quantile_cont({c}, 0.5), 4) AS median, round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.75), 4) AS q3, "
        f"round(max({c}), 4) AS max, count(*) - count({c}) AS missing FROM lineitem"
    )


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("A17_profile", " UNION ALL ".join(_profile_sql(c) for c in PROFILED))
def a17(t):
    out = R.profile(t.lineitem, PROFILED)
    return out.select(
        "column", "missing", *[F.round(c, 4).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")]
    )


@query(
    "A17_level_counts",
    """SELECT 'l_returnflag' AS "column", l_returnflag AS level, count(*) AS n FROM lineitem GROUP BY 2
    UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2""",
)
def a17_levels(t):
    return R.level_counts(t.lineitem, ["l_returnflag", "l_linestatus"])


@query("A18_dims", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def a18(t):
    return R.dims(t.lineitem)


@query(
    "A19_chapters_per_book",
    "SELECT doc_id, count(*) AS chapters FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1",
)
def a19(t):
    return R.count_by(text.lines(t.documents.select("doc_id", "text"), "text"), ["doc_id"], "chapters")


@query("A20_levels", "SELECT DISTINCT p_type FROM part")
def a20(t):
    return t.part.select("p_type").distinct()
