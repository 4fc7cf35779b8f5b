"""P and J: projection, filters, joins."""

from pyspark.sql import functions as F

from millrace.operators import relational as R
from millrace.operators import regression as G
from millrace.plans.registry import query


@query("P01_select", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def p01(t):
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("P02_select_range", "SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def p02(t):
    return R.select_range(t.lineitem, "l_linenumber", "l_tax")


@query("P03_select_negative", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def p03(t):
    return t.part.drop("p_size", "p_retailprice")


@query("P04_grouped_select", "SELECT o_orderstatus, o_orderpriority, o_totalprice FROM orders")
def p04(t):
    return R.select_grouped(t.orders, ["o_orderstatus", "o_orderpriority"], ["o_totalprice"])


@query(
    "P05_mutate",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * l_discount AS gain, "
    "l_extendedprice * l_discount / nullif(l_quantity, 0) AS gain_per_unit FROM lineitem",
)
def p05(t):
    made = t.lineitem.withColumn("gain", F.col("l_extendedprice") * F.col("l_discount")).withColumn(
        "gain_per_unit", F.try_divide("gain", "l_quantity")
    )
    return made.select("l_orderkey", "l_linenumber", "gain", "gain_per_unit")


@query("P06_rename", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal FROM supplier")
def p06(t):
    return t.supplier.drop("s_nationkey").withColumnsRenamed({"s_suppkey": "supplier_id", "s_name": "supplier_name"})


@query("P07_lower_names", "SELECT n_nationkey, n_name, n_regionkey FROM nation JOIN customer ON c_nationkey = n_nationkey")
def p07(t):
    shouted = t.nation.toDF("N_NATIONKEY", "N_Name", "N_RegionKey")
    return R.lower_names(shouted).join(t.customer, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_nationkey", "n_name", "n_regionkey"
    )


@query("P08_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000")
def p08(t):
    return t.orders.where(F.col("o_totalprice") > 200000).select("o_orderkey", "o_totalprice")


@query(
    "P09_filter_conjunction",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 20 AND l_discount >= 0.05 AND l_returnflag = 'R'",
)
def p09(t):
    keep = (F.col("l_quantity") > 20) & (F.col("l_discount") >= 0.05) & (F.col("l_returnflag") == "R")
    return t.lineitem.where(keep).select("l_orderkey", "l_linenumber")


@query("P10_filter_in", "SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#1', 'Brand#5', 'Brand#13')")
def p10(t):
    return t.part.where(F.col("p_brand").isin("Brand#1", "Brand#5", "Brand#13")).select("p_partkey", "p_brand")


@query("P11_filter_between", "SELECT event_id, value FROM events WHERE value BETWEEN 50 AND 60")
def p11(t):
    return t.events.where(F.col("value").between(50, 60)).select("event_id", "value")


# labels cover some documents only, so the left join below has missing cells
_LABELLED = "SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _labelled(t):
    return t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left")


@query("P12_complete_rows", f"SELECT * FROM ({_LABELLED}) WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def p12(t):
    return R.complete_rows(_labelled(t), ["quality", "toxic"])


@query(
    "P13_filter_disjunction",
    "SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount > 0.09 OR l_tax > 0.07",
)
def p13(t):
    return t.lineitem.where((F.col("l_discount") > 0.09) | (F.col("l_tax") > 0.07)).select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax"
    )


@query("P14_complete_flag", f"SELECT doc_id, quality IS NOT NULL AND toxic IS NOT NULL AS complete FROM ({_LABELLED})")
def p14(t):
    return R.complete_flag(_labelled(t)).select("doc_id", "complete")


@query(
    "P15_drop_most_influential",
    """WITH s AS (SELECT avg(c_acctbal) AS mx, sum((c_acctbal - m) * (c_acctbal - m)) AS sxx, count(*) AS n,
        regr_slope(c_nationkey, c_acctbal) AS b, regr_intercept(c_nationkey, c_acctbal) AS a
        FROM customer, (SELECT avg(c_acctbal) AS m FROM customer)),
    e AS (SELECT c_custkey, c_nationkey - a - b * c_acctbal AS r, 1.0 / n + (c_acctbal - mx) * (c_acctbal - mx) / sxx AS h, n
        FROM customer, s),
    v AS (SELECT sum(r * r) / (max(n) - 2) AS s2 FROM e),
    d AS (SELECT c_custkey, r * r / (2 * s2) * h / ((1 - h) * (1 - h)) AS cook FROM e, v)
    SELECT c_custkey, c_nationkey, c_acctbal FROM customer
    WHERE c_custkey <> (SELECT c_custkey FROM d ORDER BY cook DESC, c_custkey LIMIT 1)""",
)
def p15(t):
    data = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    fit = G.ols(G.gram(data, "c_nationkey", ["c_acctbal"]))
    return R.drop_key_of_max(G.influence(data, fit), "c_custkey", "cook").select("c_custkey", "c_nationkey", "c_acctbal")


@query(
    "P16_drop_empty_documents",
    "SELECT conv_id, turn, role FROM conversations WHERE conv_id IN "
    "(SELECT conv_id FROM conversations GROUP BY 1 HAVING sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) > 0)",
)
def p16(t):
    marked = t.conversations.select("conv_id", "turn", "role", (F.col("role") == "assistant").cast("int").alias("n"))
    return R.keep_nonempty(marked, "conv_id", "n").drop("n")


@query(
    "J01_left_lookup",
    "SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey",
)
def j01(t):
    return R.lookup_join(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"),
        t.part.select("p_partkey", "p_name", "p_brand"),
        "l_partkey",
        "p_partkey",
    )


@query("J02_inner_lookup", "SELECT c_custkey, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def j02(t):
    return R.lookup_join(
        t.customer.select("c_custkey", "c_nationkey"), t.nation.select("n_nationkey", "n_name"), "c_nationkey", "n_nationkey", "inner"
    )


def flights(t):
    """Line items as flights: origin is the supplier's nation, destination the customer's."""
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    )


@query(
    "J03_lookup_joined_twice",
    """SELECT o.n_name AS origin_name, d.n_name AS dest_name, count(*) AS n FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation o ON s_nationkey = o.n_nationkey JOIN nation d ON c_nationkey = d.n_nationkey GROUP BY 1, 2""",
)
def j03(t):
    both = R.join_lookup_twice(
        flights(t), t.nation.toDF("key", "name", "region"), ["s_nationkey", "c_nationkey"], "key", ["origin_", "dest_"]
    )
    return R.count_by(both, ["origin_name", "dest_name"])


@query("J04_natural_join", "SELECT d.doc_id, d.lang, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def j04(t):
    return R.natural_join(t.documents.select("doc_id", "lang"), t.labels.select("doc_id", "quality"))


@query("J05_anti_join", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j05(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left_anti")


@query("J06_semi_join", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)")
def j06(t):
    big = t.lineitem.where("l_quantity >= 50").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_totalprice").join(big, "o_orderkey", "left_semi")


@query(
    "J07_multi_key_join",
    """SELECT a.l_returnflag, a.l_linestatus, a.n, b.big FROM
    (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) a LEFT JOIN
    (SELECT l_returnflag, l_linestatus, count(*) AS big FROM lineitem WHERE l_quantity > 49 AND l_returnflag <> 'A' GROUP BY 1, 2) b
    ON a.l_returnflag = b.l_returnflag AND a.l_linestatus = b.l_linestatus""",
)
def j07(t):
    keys = ["l_returnflag", "l_linestatus"]
    big = R.count_by(t.lineitem.where("l_quantity > 49 AND l_returnflag <> 'A'"), keys, "big")
    return R.count_by(t.lineitem, keys).join(big, keys, "left")


@query(
    "J08_join_back_top_keys",
    """WITH top AS (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 20)
    SELECT o.o_custkey, o.o_orderkey, o.o_totalprice FROM orders o JOIN top USING (o_custkey)""",
)
def j08(t):
    spent = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    top = spent.orderBy(F.desc("s"), "o_custkey").limit(20).select("o_custkey")
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice").join(F.broadcast(top), "o_custkey")


@query(
    "J09_actual_vs_forecast",
    """WITH m AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2),
    f AS (SELECT m, round(avg(v), 2) AS forecast FROM m WHERE y < 2000 GROUP BY 1)
    SELECT m.y, m.m, m.v, f.forecast FROM m LEFT JOIN f ON m.m = f.m WHERE m.y >= 2000""",
)
def j09(t):
    monthly = t.orders.groupBy(
        F.year("o_orderdate").cast("bigint").alias("y"), F.month("o_orderdate").cast("bigint").alias("m")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    forecast = monthly.where("y < 2000").groupBy("m").agg(F.round(F.avg("v"), 2).alias("forecast"))
    return monthly.where("y >= 2000").join(forecast, "m", "left")
