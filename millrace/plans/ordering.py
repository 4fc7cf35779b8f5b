"""O and W: sorting, limits, samples, splits, windows."""

import math

from pyspark.sql import functions as F

from millrace.functions.scalars import in_years
from millrace.operators import relational as R
from millrace.operators import reshape, sampling
from millrace.operators import windows as W
from millrace.operators.ordering import ntile_global, quantiles, ranks
from millrace.plans.registry import query
from millrace.plans.timeseries import MONTHLY_SQL, monthly


@query(
    "W01_group_extremes",
    """SELECT y, m, o_orderkey, o_totalprice FROM (
    SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderkey, o_totalprice,
        min(o_totalprice) OVER w AS lo, max(o_totalprice) OVER w AS hi FROM orders
        WINDOW w AS (PARTITION BY year(o_orderdate), month(o_orderdate)))
    WHERE o_totalprice = lo OR o_totalprice = hi ORDER BY y, m, o_totalprice, o_orderkey""",
)
def w01(t):
    dated = t.orders.select(
        F.year("o_orderdate").cast("bigint").alias("y"), F.month("o_orderdate").cast("bigint").alias("m"), "o_orderkey", "o_totalprice"
    )
    return W.group_extremes(dated, ["y", "m"], "o_totalprice").orderBy("y", "m", "o_totalprice", "o_orderkey")


@query(
    "W01_group_extremes_null_keys",
    """SELECT status, o_orderkey, o_totalprice FROM (
    SELECT nullif(o_orderstatus, 'O') AS status, o_orderkey, o_totalprice,
        min(o_totalprice) OVER w AS lo, max(o_totalprice) OVER w AS hi FROM orders WINDOW w AS (PARTITION BY nullif(o_orderstatus, 'O')))
    WHERE o_totalprice = lo OR o_totalprice = hi""",
)
def w01_null_keys(t):
    rows = t.orders.select(F.nullif("o_orderstatus", F.lit("O")).alias("status"), "o_orderkey", "o_totalprice")
    return W.group_extremes(rows, ["status"], "o_totalprice")


@query(
    "W02_rank_per_group",
    """SELECT p_type, p_brand, n, rank() OVER (PARTITION BY p_type ORDER BY n DESC) AS rank
    FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2)""",
)
def w02(t):
    return ranks(R.count_by(t.part, ["p_type", "p_brand"]), "n", ["p_type"])


@query(
    "W02_rank_all_rows",
    "SELECT o_orderkey, rank() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey DESC) AS rank FROM orders",
)
def w02_rows(t):
    out = ranks(t.orders.select("o_orderkey", "o_orderstatus", "o_custkey"), "o_custkey", ["o_orderstatus"])
    return out.select("o_orderkey", "rank")


@query(
    "W03_top_k_rank",
    """SELECT p_name, l_returnflag, rank FROM (
    SELECT p_name, l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY sum(l_quantity) DESC) AS rank
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE year(l_shipdate) = 1996 GROUP BY 1, 2) WHERE rank < 5""",
)
def w03(t):
    sums = (
        t.lineitem.where(in_years("l_shipdate", 1996, 1996))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_name", "l_returnflag")
        .agg(F.sum("l_quantity").alias("q"))
    )
    top = W.top_n(sums, ["l_returnflag"], [F.desc("q")], 4)
    return top.select("p_name", "l_returnflag", F.col("rank").cast("bigint").alias("rank"))


@query(
    "W04_top_n_ties",
    """SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
    SELECT *, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS r FROM orders) WHERE r <= 10""",
)
def w04(t):
    rows = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return W.top_n(rows, ["o_orderpriority"], [F.desc("o_totalprice")], 10).drop("rank")


@query(
    "W05_ntile_whole_set",
    "SELECT o_orderkey, ntile(10) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS decile FROM orders",
)
def w05(t):
    out = ntile_global(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10, name="decile")
    return out.select("o_orderkey", F.col("decile").cast("bigint").alias("decile"))


@query(
    "W05_ntile_within_split",
    "SELECT o_orderkey, ntile(7) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS tile FROM orders",
)
def w05_within(t):
    out = ntile_global(
        t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"),
        [F.desc("o_totalprice"), F.asc("o_orderkey")], 7, ["o_orderstatus"], "tile",
    )
    return out.select("o_orderkey", F.col("tile").cast("bigint").alias("tile"))


@query(
    "W06_decile_lift",
    """SELECT data, decile, round(avg(l_extendedprice), 4) AS l_extendedprice, count(*) AS n FROM (
    SELECT l_returnflag AS data, l_extendedprice,
    ntile(10) OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC, l_orderkey * 8 + l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS decile
    FROM lineitem) GROUP BY 1, 2""",
)
def w06(t):
    key = F.struct((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"), "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("p"))
    rows = t.lineitem.select(F.col("l_returnflag").alias("data"), "l_quantity", "l_extendedprice", key.alias("key"))
    out = W.decile_lift(rows, "l_quantity", "l_extendedprice", "key")
    return out.select("data", F.col("decile").cast("bigint").alias("decile"), F.round("l_extendedprice", 4).alias("l_extendedprice"), "n")


@query(
    "W07_row_number",
    """SELECT doc_id, line_no, length(line) AS chars FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents)""",
)
def w07(t):
    from millrace.operators import text

    out = text.lines(t.documents.select("doc_id", "text"), "text")
    return out.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), F.length("line").cast("bigint").alias("chars"))


@query(
    "W08_running_section_number",
    """SELECT conv_id, turn, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS section
    FROM conversations""",
)
def w08(t):
    from millrace.operators.ordering import running

    rows = t.conversations.select("conv_id", "turn", (F.col("role") == "user").cast("int").alias("starts"))
    return running(rows, ["conv_id"], ["turn"], {"section": "starts"}).select("conv_id", "turn", "section")


@query(
    "W09_share_of_group",
    """SELECT p_type, p_brand, round(n / sum(n) OVER (PARTITION BY p_type), 8) AS share
    FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2)""",
)
def w09(t):
    out = R.share_of_total(R.count_by(t.part, ["p_type", "p_brand"]), ["p_type"], "n")
    return out.select("p_type", "p_brand", F.round("share", 8).alias("share"))


@query(
    "W09_share_of_group_null_keys",
    """SELECT kind, p_brand, round(n / sum(n) OVER (PARTITION BY kind), 8) AS share
    FROM (SELECT CASE WHEN p_size > 10 THEN p_type END AS kind, p_brand, count(*) AS n FROM part GROUP BY 1, 2)""",
)
def w09_null_keys(t):
    rows = t.part.select(F.when(F.col("p_size") > 10, F.col("p_type")).alias("kind"), "p_brand")
    out = R.share_of_total(R.count_by(rows, ["kind", "p_brand"]), ["kind"], "n")
    return out.select("kind", "p_brand", F.round("share", 8).alias("share"))


@query(
    "W10_lag_differences",
    f"""SELECT key, pos, round(d - lag(d, 12) OVER (PARTITION BY key ORDER BY pos), 2) AS diff FROM (
    SELECT key, pos, value - lag(value) OVER (PARTITION BY key ORDER BY pos) AS d FROM ({MONTHLY_SQL}))""",
)
def w10(t):
    out = W.lag_difference(monthly(t), ["key"], "pos", "value", [1, 12], "diff")
    return out.select("key", "pos", F.round("diff", 2).alias("diff"))


@query(
    "W11_trailing_mean",
    f"""SELECT key, pos, CASE WHEN count(value) OVER w = 12 THEN round(avg(value) OVER w, 5) END AS sma FROM ({MONTHLY_SQL})
    WINDOW w AS (PARTITION BY key ORDER BY pos ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
)
def w11(t):
    out = W.trailing_mean(monthly(t), ["key"], "pos", "value", 12, "sma")
    return out.select("key", "pos", F.round("sma", 5).alias("sma"))


TREND_SQL = f"""SELECT key, pos, ts, value, CASE WHEN count(value) OVER w = 13 THEN
    (sum(value) OVER w - (lag(value, 6) OVER o + lead(value, 6) OVER o) / 2) / 12 END AS trend FROM ({MONTHLY_SQL})
    WINDOW w AS (PARTITION BY key ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING), o AS (PARTITION BY key ORDER BY pos)"""


@query("W12_centred_mean", f"SELECT key, pos, round(trend, 5) AS trend FROM ({TREND_SQL})")
def w12(t):
    out = W.centred_mean(monthly(t), ["key"], "pos", "value", 12, "trend")
    return out.select("key", "pos", F.round("trend", 5).alias("trend"))


@query("O01_arrange", "SELECT p_size, p_brand, p_partkey FROM part ORDER BY 1, 2, 3")
def o01(t):
    return t.part.select("p_size", "p_brand", "p_partkey").orderBy("p_size", "p_brand", "p_partkey")


@query(
    "O02_arrange_desc_nulls_last",
    "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id ORDER BY quality DESC NULLS LAST, 1",
)
def o02(t):
    joined = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return joined.orderBy(F.desc_nulls_last("quality"), "doc_id")


@query("O03_head", "SELECT o_orderkey, o_orderdate::DATE AS day FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50")
def o03(t):
    return t.orders.orderBy("o_orderdate", "o_orderkey").limit(50).select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query("O04_tail", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 30")
def o04(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_orderkey")).limit(30)


def hash_sql(seed, *keys):
    """SQL of ``sampling.hash_order``."""
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(keys)}, '{seed}')), 1, 15) AS BIGINT)"


def unit_sql(seed, *keys):
    """SQL of ``sampling.hash_unit``."""
    return f"({hash_sql(seed, *keys)}::DOUBLE / {1 << 60}::DOUBLE)"


@query(
    "O05_sample_n",
    f"""SELECT o_orderkey, o_totalprice FROM (SELECT *, {hash_sql(7, 'o_orderkey')} AS h FROM orders)
    ORDER BY h % {sampling.BUCKETS}, h, o_orderkey LIMIT 500""",
)
def o05(t):
    return sampling.sample_n(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 500, 7)


@query("O06_sample_frac", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {unit_sql(7, 'o_orderkey')} < 0.1")
def o06(t):
    return sampling.sample_frac(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 0.1, 7)


@query(
    "O07_random_split",
    f"SELECT o_orderkey, CASE WHEN {unit_sql(1234, 'o_orderkey')} < 0.8 THEN 'train' ELSE 'valid' END AS data FROM orders",
)
def o07(t):
    return sampling.hash_split(t.orders.select("o_orderkey"), ["o_orderkey"], {"train": 0.8, "valid": 0.2}, 1234)


@query(
    "O08_stratified_split",
    """SELECT label, data, n FROM (SELECT label, 'train' AS data, CAST(ceil(0.8 * count(*)) AS BIGINT) AS n FROM embeddings GROUP BY 1
    UNION ALL SELECT label, 'test', count(*) - CAST(ceil(0.8 * count(*)) AS BIGINT) FROM embeddings GROUP BY 1) WHERE n > 0""",
)
def o08(t):
    out = sampling.stratified_split(t.embeddings.select("vec_id", "label"), ["vec_id"], "label", 0.8, 5)
    return R.count_by(out, ["label", "data"])


@query(
    "O08_stratified_split_null_keys",
    """WITH l AS (SELECT CASE WHEN label <> 3 THEN label END AS label, count(*) AS n FROM embeddings GROUP BY 1)
    SELECT label, 'train' AS data, CAST(ceil(0.8 * n) AS BIGINT) AS n FROM l
    UNION ALL SELECT label, 'test', n - CAST(ceil(0.8 * n) AS BIGINT) FROM l WHERE n > ceil(0.8 * n)""",
)
def o08_null_keys(t):
    rows = t.embeddings.select("vec_id", F.when(F.col("label") != 3, F.col("label")).alias("label"))
    return R.count_by(sampling.stratified_split(rows, ["vec_id"], "label", 0.8, 5), ["label", "data"])


@query(
    "O08_stratified_split_numeric",
    f"""WITH q AS (SELECT quantile_cont(o_totalprice, [0.2, 0.4, 0.6, 0.8]) AS e FROM orders),
    b AS (SELECT o_orderkey, o_totalprice, CAST(len(list_filter(e, lambda x: x < o_totalprice)) AS INTEGER) AS band,
        {hash_sql(5, 'o_orderkey')} AS h FROM orders, q)
    SELECT o_orderkey, o_totalprice, band, CASE WHEN row_number() OVER (PARTITION BY band ORDER BY h % {sampling.BUCKETS}, h, o_orderkey)
        <= ceil(0.7 * count(*) OVER (PARTITION BY band)) THEN 'train' ELSE 'test' END AS data FROM b""",
)
def o08_numeric(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    edges = quantiles(rows, "o_totalprice", {f"q{i}": i / 5 for i in range(1, 5)}).first()
    grouped = sampling.quantile_groups(rows, "o_totalprice", list(edges), "band")
    return sampling.stratified_split(grouped, ["o_orderkey"], "band", 0.7, 5)


@query("O09_folds", f"SELECT o_orderkey, CAST({hash_sql(3, 'o_orderkey')} % 10 AS INTEGER) AS fold FROM orders")
def o09(t):
    return sampling.assign_folds(t.orders.select("o_orderkey"), ["o_orderkey"], 10, 3)


POISSON = [sum(math.exp(-1.0) / math.factorial(j) for j in range(i + 1)) for i in range(18)]


@query(
    "O10_bootstrap",
    f"""WITH d AS (SELECT CAST(resample AS INTEGER) AS resample, o_totalprice, {' + '.join(f'CASE WHEN u >= {c!r}::DOUBLE THEN 1 ELSE 0 END' for c in POISSON)} AS draws
    FROM (SELECT r.resample, o_totalprice, {unit_sql(3, 'o_orderkey', 'r.resample')} AS u FROM orders, range(1, 26) r(resample)))
    SELECT resample, CAST(sum(draws) AS BIGINT) AS n, round(sum(draws * o_totalprice) / sum(draws), 2) AS mean_price FROM d GROUP BY 1""",
)
def o10(t):
    draws = sampling.bootstrap(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 25, 3)
    return draws.groupBy("resample").agg(
        F.sum("draws").alias("n"), F.round(F.sum(F.col("draws") * F.col("o_totalprice")) / F.sum("draws"), 2).alias("mean_price")
    )


@query(
    "O10_bootstrap_exact_size",
    """SELECT CAST(resample AS INTEGER) AS resample, count(*) AS n, true AS repeats, true AS within_5_sd FROM orders, range(1, 26) r(resample) GROUP BY 1""",
)
def o10_exact(t):
    """Draws per resample; whether some row is drawn twice, and whether the mean lies where a mean of n draws must."""
    orders = t.orders.select("o_orderkey", F.col("o_totalprice").cast("double").alias("price"))
    facts = orders.agg(F.avg("price").alias("mu"), (F.stddev_pop("price") / F.sqrt(F.count("price"))).alias("se")).first()
    draws = sampling.bootstrap_exact(orders, ["o_orderkey"], 25, 3)
    mean = F.sum(F.col("draws") * F.col("price")) / F.sum("draws")
    return draws.groupBy("resample").agg(
        F.sum("draws").alias("n"), (F.max("draws") > 1).alias("repeats"), (F.abs(mean - facts["mu"]) < 5 * facts["se"]).alias("within_5_sd")
    )


@query("O11_first_n_training", "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 100")
def o11(t):
    return t.embeddings.select("vec_id", "label").orderBy("vec_id").limit(100)


@query(
    "U01_bind_rows",
    "SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier",
)
def u01(t):
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), "c_mktsegment")
    return reshape.bind_rows(a, t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance")))


@query(
    "U02_bind_tagged",
    "SELECT 'train' AS data, o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'valid', o_orderkey FROM orders WHERE o_orderstatus = 'O'",
)
def u02(t):
    def side(status):
        return t.orders.where(F.col("o_orderstatus") == status).select("o_orderkey")

    return reshape.bind_tagged({"train": side("F"), "valid": side("O")})


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "U03_spread",
    "SELECT l_returnflag, " + ", ".join(f"count(*) FILTER (p_type = '{v}') AS \"{v}\"" for v in TYPES)
    + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
)
def u03(t):
    counts = R.count_by(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")), ["l_returnflag", "p_type"])
    return reshape.spread(counts, ["l_returnflag"], "p_type", "n", TYPES, 0)


@query(
    "U04_gather",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS key, {c} AS value FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")
    ),
)
def u04(t):
    return reshape.gather(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@query("U05_bin_key", "SELECT CAST(floor(o_totalprice / 8000) AS BIGINT) AS bin, count(*) AS n FROM orders GROUP BY 1")
def u05(t):
    return R.count_by(reshape.bin_key(t.orders, "o_totalprice", 8000), ["bin"])


@query(
    "U06_matrix_to_triples",
    """SELECT d.doc_id, 'quality' AS item, quality AS rating FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL
    UNION ALL SELECT d.doc_id, 'toxic', toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic IS NOT NULL""",
)
def u06(t):
    wide = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return reshape.gather(wide, ["doc_id"], ["quality", "toxic"], "item", "rating", drop_null=True)


BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query(
    "U07_triples_to_matrix",
    "SELECT o_custkey AS \"user\", " + ", ".join(f"round(avg(l_quantity) FILTER (p_brand = '{b}') / 10, 6) AS \"{b}\"" for b in BRANDS)
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1",
)
def u07(t):
    from millrace.plans.recommend import ratings

    rounded = ratings(t).withColumn("rating", F.round("rating", 6))
    return reshape.spread(rounded, ["user"], "item", "rating", BRANDS)


@query(
    "U08_rows_to_lists",
    "SELECT l_orderkey, l_partkey // 1024 AS chunk, list_sort(list(DISTINCT l_partkey)) AS items FROM lineitem GROUP BY 1, 2",
)
def u08(t):
    return reshape.lists_per_key(t.lineitem, "l_orderkey", "l_partkey", 1024)


@query("U09_lists_to_rows", "SELECT DISTINCT l_orderkey, l_partkey AS item FROM lineitem")
def u09(t):
    lists = reshape.lists_per_key(t.lineitem, "l_orderkey", "l_partkey", 1024)
    return reshape.explode_lists(lists, ["l_orderkey"], "items")
