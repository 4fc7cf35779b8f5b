"""S: sources, sinks, catalog."""

import uuid

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from millrace.operators import text
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import files, tables

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDER_TYPES = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
ORDER_SQL = f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders"


def _orders(t):
    return t.orders.select(*ORDER_COLUMNS)


def _fresh(label):
    return f"{label}_{uuid.uuid4().hex[:12]}"


@query("S01_read_parquet", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s01(t):
    return files.read_parquet(t.spark, t.path("customer"))


@query("S02_write_parquet", ORDER_SQL)
def s02(t):
    path = files.write_parquet(_orders(t), scratch_path(t.spark, "orders"), ["o_orderstatus"])
    return files.read_parquet(t.spark, path).select(*ORDER_COLUMNS)


@query("S03_read_csv_header", ORDER_SQL)
def s03(t):
    path = files.write_csv(_orders(t), scratch_path(t.spark, "orders"))
    return files.read_csv(t.spark, path).withColumns(
        {c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")}
    )


@query("S04_write_csv", "SELECT event_id, user_id, event_type, value, props FROM events")
def s04(t):
    src = t.events.select("event_id", "user_id", "event_type", "value", "props")
    path = files.write_csv(src, scratch_path(t.spark, "events"))
    return files.read_csv(t.spark, path, src.schema)


@query("S05_json_lines", "SELECT conv_id, turn, role, text FROM conversations")
def s05(t):
    path = files.write_json(t.conversations, scratch_path(t.spark, "conversations"))
    return files.read_json(t.spark, path, t.conversations.schema)


@query("S06_compressed_csv_trim", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def s06(t):
    padded = t.part.select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"), "p_brand", "p_size"
    )
    path = files.write_csv(padded, scratch_path(t.spark, "part"), compression="bzip2")
    return files.read_csv(t.spark, path, "p_partkey bigint, p_name string, p_brand string, p_size int", trim=True)


@query("S07_headerless_csv", "SELECT s_suppkey AS supplier_id, s_name AS supplier, s_acctbal AS balance FROM supplier")
def s07(t):
    src = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    path = files.write_csv(src, scratch_path(t.spark, "supplier"), header=False)
    return files.read_csv(
        t.spark, path, "a bigint, b string, c double", header=False, names=["supplier_id", "supplier", "balance"]
    )


@query("S08_wide_csv_to_vector", "SELECT vec_id, label, list_transform(embedding, lambda x: round(x::DOUBLE, 6)) AS features FROM embeddings")
def s08(t):
    width = 64
    names = [f"x{i}" for i in range(width)]
    wide = t.embeddings.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    path = files.write_csv(wide, scratch_path(t.spark, "wide"))
    schema = "vec_id bigint, label int, " + ", ".join(f"{n} double" for n in names)
    back = files.read_csv(t.spark, path, schema)
    return VectorAssembler(inputCols=names, outputCol="features").transform(back).select(
        "vec_id", "label", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features")
    )


@query("S09_write_csv_table", "SELECT o_custkey, p_brand, round(avg(l_quantity) / 10, 6) AS rating FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def s09(t):
    from millrace.plans.recommend import ratings

    src = ratings(t).select(F.col("user").alias("o_custkey"), F.col("item").alias("p_brand"), F.round("rating", 6).alias("rating"))
    path = files.write_csv(src, scratch_path(t.spark, "ratings"))
    return files.read_csv(t.spark, path, src.schema)


@query("S10_csv_null_token", "SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events")
def s10(t):
    src = t.events.select("event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    path = files.write_csv(src, scratch_path(t.spark, "na"), null_token="NA")
    return files.read_csv(t.spark, path, src.schema, null_token="NA")


@query("S11_delimited_external_table", "SELECT n_nationkey, n_name, n_regionkey, count(*) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3")
def s11(t):
    path = files.write_csv(t.customer.select("c_custkey", "c_nationkey"), scratch_path(t.spark, "customer"))
    name = _fresh("customer_text")
    tables.create_table(t.spark, name, "c_custkey BIGINT, c_nationkey INT", "csv", path, {"header": "true", "sep": ","})
    return (
        tables.table(t.spark, name)
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_nationkey", "n_name", "n_regionkey")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


@query("S12_quoted_csv_external_table", "SELECT doc_id, text, lang FROM documents")
def s12(t):
    # newlines inside a field would make the files unsplittable, so they are escaped on the way out
    src = t.documents.select("doc_id", text.escape_newlines("text").alias("text"), "lang")
    path = files.write_csv(src, scratch_path(t.spark, "quoted"))
    name = _fresh("documents_text")
    tables.create_table(
        t.spark, name, "doc_id BIGINT, text STRING, lang STRING", "csv", path,
        {"header": "true", "quote": '"', "escape": '"'},
    )
    return tables.table(t.spark, name).withColumn("text", text.unescape_newlines("text"))


@query("S13_load_into_table", "SELECT p_brand, count(*) AS n FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_size > 25) GROUP BY 1")
def s13(t):
    name = _fresh("part_loaded")
    tables.save_table(t.part, name, scratch_path(t.spark, "part"))
    return tables.load_into(t.part.where("p_size > 25"), name).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("S15_sql_query", "SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1")
def s15(t):
    name = _fresh("orders_view")
    tables.register(t.orders, name)
    return tables.sql(t.spark, f"SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM {name} GROUP BY 1")


@query("S16_table_handle", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def s16(t):
    name = _fresh("customer_view")
    tables.register(t.customer, name)
    return tables.table(t.spark, name).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("S17_sql_handle", "SELECT l_returnflag, l_linestatus, avg(l_quantity) AS q FROM lineitem GROUP BY 1, 2")
def s17(t):
    name = _fresh("lineitem_view")
    tables.register(t.lineitem, name)
    return tables.sql(t.spark, f"SELECT l_returnflag, l_linestatus, avg(l_quantity) AS q FROM {name} GROUP BY 1, 2")


@query("S18_persistent_copy", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def s18(t):
    return tables.save_table(t.supplier, _fresh("supplier_copy"), scratch_path(t.spark, "supplier"))


PRIORITY_ROWS = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query("S19_copy_local_rows", "SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS weight, count(*) AS n FROM orders GROUP BY 1")
def s19(t):
    lookup = tables.copy_rows(t.spark, PRIORITY_ROWS, "o_orderpriority string, weight int", _fresh("priority"))
    return t.orders.join(lookup, "o_orderpriority").groupBy("weight").agg(F.count(F.lit(1)).alias("n"))


@query("S20_bounded_fetch", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def s20(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("S22_compute", "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1 HAVING count(*) > 10")
def s22(t):
    spent = t.orders.groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("spent"), F.count(F.lit(1)).alias("n")
    ).where("n > 10").drop("n")
    return tables.materialise(spent.withColumn("spent", F.round("spent", 2)), _fresh("spent"))


@query("S24_register", "SELECT l_shipmonth, count(*) AS n FROM (SELECT month(l_shipdate) AS l_shipmonth FROM lineitem) GROUP BY 1")
def s24(t):
    handle = tables.register(t.lineitem.select(F.month("l_shipdate").cast("bigint").alias("l_shipmonth")), _fresh("ship"))
    return handle.groupBy("l_shipmonth").agg(F.count(F.lit(1)).alias("n"))


@query(
    "S25_list_tables",
    """SELECT 'orders' AS label, 'TEMPORARY' AS kind, true AS temporary, count(*) AS n FROM orders
    UNION ALL SELECT 'customer', 'TEMPORARY', true, count(*) FROM customer""",
)
def s25(t):
    names = {_fresh(label): label for label in ("orders", "customer")}
    counts = None
    for name, label in names.items():
        part = tables.register(getattr(t, label), name).agg(F.lit(name).alias("name"), F.lit(label).alias("label"), F.count(F.lit(1)).alias("n"))
        counts = part if counts is None else counts.unionByName(part)
    return tables.list_tables(t.spark).join(counts, "name").select("label", "kind", "temporary", "n")


DESCRIBED = "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string"


@query(
    "S26_describe_columns",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c.split()[0]}' AS \"column\", '{c.split()[1]}' AS type, count({c.split()[0]}) AS filled, "
        f"count(DISTINCT {c.split()[0]}) AS kinds FROM lineitem"
        for i, c in enumerate(DESCRIBED.split(", "), start=1)
    ),
)
def s26(t):
    rows = t.lineitem.select(*[c.split()[0] for c in DESCRIBED.split(", ")])
    long = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]).unpivot([], rows.columns, "column", "value")
    counts = long.groupBy("column").agg(F.count("value").alias("filled"), F.count_distinct("value").alias("kinds"))
    return tables.describe_columns(rows).join(counts, "column").select("position", "column", "type", "filled", "kinds")


@query("S27_create_table", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
def s27(t):
    name = _fresh("customer_typed")
    tables.create_table(t.spark, name, "c_custkey BIGINT, c_name STRING", path=scratch_path(t.spark, "typed"))
    return tables.load_into(t.customer.select("c_custkey", "c_name"), name)


@query("S28_drop_table", "SELECT r_regionkey, r_name, false AS still_there FROM region")
def s28(t):
    name = _fresh("region_dropped")
    tables.save_table(t.region, name, scratch_path(t.spark, "region"))
    tables.drop_table(t.spark, name)
    return t.region.withColumn("still_there", F.lit(t.spark.catalog.tableExists(name)))


@query(
    "S29_insert_with_ids",
    """SELECT c_custkey, c_name, c_acctbal FROM customer
    UNION ALL
    SELECT CAST((SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS BIGINT), s_name, NULL
    FROM supplier""",
)
def s29(t):
    new = t.supplier.select(F.col("s_name").alias("c_name"), "s_suppkey")
    return tables.append_with_ids(
        t.customer.select("c_custkey", "c_name", "c_acctbal"), new, "c_custkey", ["s_suppkey"]
    ).drop("s_suppkey")


@query(
    "S31_save_load_model",
    """WITH s AS (SELECT avg(l_quantity) AS mq, avg(l_discount) AS md, avg(l_extendedprice) AS mp, var_pop(l_quantity) AS qq, var_pop(l_discount) AS dd,
        covar_pop(l_quantity, l_discount) AS qd, covar_pop(l_quantity, l_extendedprice) AS qp, covar_pop(l_discount, l_extendedprice) AS dp FROM lineitem),
    p AS (SELECT l_orderkey, l_linenumber, round(mp + (qp * dd - dp * qd) / (qq * dd - qd * qd) * (l_quantity - mq)
        + (dp * qq - qp * qd) / (qq * dd - qd * qd) * (l_discount - md), 3) AS fitted FROM lineitem, s)
    SELECT l_orderkey, l_linenumber, fitted, fitted AS reloaded FROM p""",
)
def s31(t):
    data = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features").transform(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice")
    )
    model = LinearRegression(labelCol="l_extendedprice", solver="normal").fit(data)
    again = LinearRegressionModel.load(tables.save_model(model, scratch_path(t.spark, "model")))
    both = again.setPredictionCol("reloaded").transform(model.setPredictionCol("fitted").transform(data))
    return both.select("l_orderkey", "l_linenumber", F.round("fitted", 3).alias("fitted"), F.round("reloaded", 3).alias("reloaded"))


@query(
    "S33_glimpse",
    "WITH h AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 3) "
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{kind}' AS type, list_sort(list({c}::VARCHAR)) AS values FROM h"
        for i, (c, kind) in enumerate({"o_orderkey": "bigint", "o_totalprice": "double", "o_orderstatus": "string"}.items(), start=1)
    ),
)
def s33(t):
    return tables.glimpse(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), ["o_orderkey"])
