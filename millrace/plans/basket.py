"""B: market baskets of brands per order."""

from pyspark.sql import functions as F

from millrace.operators import basket as B
from millrace.operators import reshape
from millrace.plans.registry import query

SUPPORT, CONFIDENCE = 0.001, 0.05
PAIRS_SQL = "SELECT DISTINCT l_orderkey AS tx, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey"
RULES_SQL = f"""WITH RECURSIVE b AS MATERIALIZED ({PAIRS_SQL}), n AS (SELECT count(DISTINCT tx) AS n FROM b),
least AS (SELECT ceil({SUPPORT} * n) AS least FROM n),
o(tx, items) AS (SELECT tx, [item] FROM (SELECT *, count(*) OVER (PARTITION BY item) AS freq FROM b), least WHERE freq >= least
    UNION ALL SELECT tx, items FROM (SELECT tx, items, count(*) OVER (PARTITION BY items) AS freq FROM
        (SELECT o.tx, list_append(o.items, b.item) AS items FROM o JOIN b ON b.tx = o.tx AND b.item > o.items[-1])), least
    WHERE freq >= least AND len(items) <= 10),
f AS MATERIALIZED (SELECT items, count(*) AS freq FROM o GROUP BY items),
e AS (SELECT items, freq, unnest(items) AS rhs FROM f WHERE len(items) > 1),
r AS (SELECT list_filter(e.items, lambda i: i <> e.rhs) AS ante, e.rhs, e.freq FROM e),
m AS (SELECT array_to_string(ante, ',') AS lhs, r.rhs, len(ante) AS size, r.freq / n AS support, r.freq / a.freq AS confidence,
    r.freq / a.freq / (c.freq / n) AS lift, r.freq AS count FROM r JOIN f a ON a.items = r.ante JOIN f c ON c.items = [r.rhs], n),
k AS MATERIALIZED (SELECT * FROM m WHERE confidence >= {CONFIDENCE}),
z AS (SELECT '' AS lhs, items[1] AS rhs, 0 AS size, freq / n AS support, freq / n AS confidence, 1.0::DOUBLE AS lift, freq AS count FROM f, n
    WHERE len(items) = 1 AND freq / n >= {CONFIDENCE})
"""
SHOWN = "lhs, rhs, round(support, 8) AS support, round(confidence, 8) AS confidence, round(lift, 8) AS lift, count"


def _lines(t):
    return t.lineitem.select("l_orderkey", "l_partkey").join(
        t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    )


def _baskets(t):
    return B.transactions(_lines(t), "l_orderkey", "p_brand")


def _shown(table):
    return table.withColumns({c: F.round(c, 8) for c in ("support", "confidence", "lift")})


def _rules(t, **kw):
    return B.rules(_baskets(t), SUPPORT, CONFIDENCE, **kw)


@query("B01_transactions", f"SELECT tx AS l_orderkey, list_sort(list(item)) AS items FROM ({PAIRS_SQL}) GROUP BY 1")
def b01(t):
    return _baskets(t)


@query(
    "B02_transactions_from_columns",
    """SELECT c_custkey, list_sort(list_filter(['segment=' || c_mktsegment, 'nation=' || c_nationkey,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 5000 THEN 'balance=low' ELSE 'balance=high' END], lambda x: x IS NOT NULL)) AS items FROM customer""",
)
def b02(t):
    balance = F.when(F.col("c_acctbal") < 0, None).when(F.col("c_acctbal") < 5000, "low").otherwise("high")
    return B.transactions_from_columns(
        t.customer, "c_custkey", {"segment": F.col("c_mktsegment"), "nation": F.col("c_nationkey"), "balance": balance}
    )


@query(
    "B03_inverted_index",
    f"SELECT item, tx // 4096 AS chunk, list_sort(list(tx)) AS items FROM ({PAIRS_SQL}) GROUP BY 1, 2",
)
def b03(t):
    return reshape.lists_per_key(_lines(t).withColumnRenamed("p_brand", "item"), "item", "l_orderkey", 4096)


@query(
    "B04_summary",
    f"""WITH b AS ({PAIRS_SQL}), s AS (SELECT tx, count(*) AS size FROM b GROUP BY 1)
    SELECT 'total' AS section, 'transactions' AS name, count(*)::DOUBLE AS value FROM s
    UNION ALL SELECT 'total', 'items', count(DISTINCT item)::DOUBLE FROM b
    UNION ALL SELECT 'total', 'density', round(count(*) / count(DISTINCT tx) / count(DISTINCT item), 8) FROM b
    UNION ALL SELECT * FROM (SELECT 'frequent', item, count(*)::DOUBLE FROM b GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5)
    UNION ALL SELECT 'size', size::VARCHAR, count(*)::DOUBLE FROM s GROUP BY 2""",
)
def b04(t):
    return B.summary(_baskets(t), "l_orderkey").withColumn("value", F.round("value", 8))


@query("B05_rules", RULES_SQL + f"SELECT {SHOWN} FROM k")
def b05(t):
    return _shown(B.rule_table(_rules(t, minlen=2)))


@query(
    "B05_itemsets",
    RULES_SQL + "SELECT array_to_string(items, ',') AS items, freq FROM f",
)
def b05_itemsets(t):
    return B.itemsets(_baskets(t), SUPPORT).select(F.array_join("items", ",").alias("items"), "freq")


@query("B06_rules_with_empty_left", RULES_SQL + f"SELECT {SHOWN} FROM k UNION ALL SELECT {SHOWN} FROM z")
def b06(t):
    return _shown(B.rule_table(_rules(t, minlen=1)))


@query("B07_rules_by_right_side", RULES_SQL + f"SELECT {SHOWN} FROM k WHERE rhs = 'Brand#7'")
def b07(t):
    return _shown(B.rule_table(_rules(t, minlen=2, rhs="Brand#7")))


@query("B08_rules_by_left_side", RULES_SQL + f"SELECT {SHOWN} FROM k WHERE lhs = 'Brand#3'")
def b08(t):
    return _shown(B.rule_table(_rules(t, minlen=2, lhs=["Brand#3"])))


@query("B09_rule_length", RULES_SQL + f"SELECT {SHOWN} FROM k WHERE size <= 4")
def b09(t):
    return _shown(B.rule_table(_rules(t, minlen=2, maxlen=5)))


@query("B10_top_rules", RULES_SQL + f"SELECT {SHOWN} FROM k ORDER BY round(m.lift, 8) DESC, lhs, rhs LIMIT 10".replace("m.lift", "k.lift"))
def b10(t):
    rounded = _shown(_rules(t, minlen=2))
    return B.sort_rules(rounded, "lift", 10)


@query(
    "B11_item_frequency",
    f"""WITH b AS ({PAIRS_SQL}) SELECT item, round(count(*) / (SELECT count(DISTINCT tx) FROM b), 8) AS frequency FROM b GROUP BY 1
    ORDER BY count(*) DESC, item LIMIT 20""",
)
def b11(t):
    return B.item_frequency(_baskets(t), 20).withColumn("frequency", F.round("frequency", 8))


@query(
    "B12_prune_rules",
    RULES_SQL + f""", q AS (SELECT *, list_sort(list_append(CASE WHEN lhs = '' THEN [] ELSE string_split(lhs, ',') END, rhs)) AS items,
    row_number() OVER (ORDER BY round(lift, 12) DESC, lhs, rhs) AS place FROM k)
    SELECT {SHOWN} FROM q WHERE NOT EXISTS (SELECT 1 FROM q e WHERE e.place < q.place AND list_has_all(q.items, e.items))""",
)
def b12(t):
    return _shown(B.rule_table(B.prune_rules(_rules(t, minlen=2), "lift")))


@query(
    "B13_confidence_both_ways",
    RULES_SQL + """SELECT x.lhs AS a, x.rhs AS b, round(x.confidence, 8) AS a_to_b, round(y.confidence, 8) AS b_to_a
    FROM k x JOIN k y ON x.lhs = y.rhs AND x.rhs = y.lhs WHERE x.lhs < x.rhs""",
)
def b13(t):
    table = B.rule_table(_rules(t, minlen=2, maxlen=2))
    back = table.select(F.col("lhs").alias("b"), F.col("rhs").alias("a"), F.round("confidence", 8).alias("b_to_a"))
    there = table.select(F.col("lhs").alias("a"), F.col("rhs").alias("b"), F.round("confidence", 8).alias("a_to_b"))
    return there.where("a < b").join(back, ["a", "b"])


@query("B14_rule_table", RULES_SQL + f"SELECT {SHOWN} FROM k WHERE confidence >= 0.18")
def b14(t):
    return _shown(B.rule_table(_rules(t, minlen=2).where("confidence >= 0.18")))
