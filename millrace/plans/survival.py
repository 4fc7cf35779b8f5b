"""V: time to first purchase per user, and time to shipment per line."""

from pyspark.sql import functions as F

from millrace.operators import relational as R
from millrace.operators import survival as V
from millrace.plans.registry import query

SUBJECT_SQL = """WITH f AS (SELECT user_id, min(ts) AS start, arg_min(event_type, (ts, event_id)) AS first_type,
    arg_min(value, (ts, event_id)) AS first_value FROM events GROUP BY 1),
p AS (SELECT e.user_id, min(ts) AS bought FROM events e JOIN f ON e.user_id = f.user_id AND e.ts > f.start WHERE event_type = 'purchase' GROUP BY 1),
z AS (SELECT max(ts) AS stop FROM events),
s AS (SELECT f.user_id, first_type, first_value, CASE WHEN bought IS NULL THEN 0 ELSE 1 END AS event,
    (epoch_us(coalesce(bought, stop)) - epoch_us(start)) // 60000000 + 1 AS time FROM f LEFT JOIN p ON f.user_id = p.user_id, z)
"""


def subjects(t):
    """Whole minutes from a user's first event to the first later purchase, censored at the last event of all."""
    ev = t.events.select("user_id", "ts", "event_type", "event_id", "value")
    at = F.struct("ts", "event_id")
    first = ev.groupBy("user_id").agg(
        F.min("ts").alias("start"), F.min_by("event_type", at).alias("first_type"), F.min_by("value", at).alias("first_value")
    )
    buys = ev.where("event_type = 'purchase'").select("user_id", "ts").join(first.select("user_id", "start"), "user_id").where("ts > start")
    bought = buys.groupBy("user_id").agg(F.min("ts").alias("bought"))
    stop = ev.agg(F.max("ts")).first()[0]
    end = F.coalesce("bought", F.lit(stop).cast(ev.schema["ts"].dataType))
    minutes = F.floor((F.unix_micros(end.cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))) / 60000000) + 1
    return first.join(bought, "user_id", "left").select(
        "user_id", "first_type", "first_value", F.when(F.col("bought").isNull(), 0).otherwise(1).alias("event"), minutes.alias("time")
    )


def covariates(t):
    s = subjects(t)
    return s.withColumns(
        {
            "log_value": F.log(F.col("first_value") + 1),
            "from_view": (F.col("first_type") == "view").cast("double"),
            "from_error": (F.col("first_type") == "error").cast("double"),
        }
    )


X = ["log_value", "from_view", "from_error"]


def _rounded(df):
    return df.withColumns({c: F.round(c, 8) for c in ("survival", "std_error", "lo95", "hi95")})


def _km_sql(source, keys=""):
    part = f"PARTITION BY {keys} " if keys else ""
    head = f"{keys}, " if keys else ""
    return f"""c AS (SELECT {head}time, count(*) AS c, CAST(sum(event) AS BIGINT) AS d FROM {source} GROUP BY ALL),
    k AS (SELECT {head}time, c, d, CAST(sum(c) OVER ({part}ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS n FROM c),
    g AS (SELECT *, product(1 - d / n) OVER ({part}ORDER BY time) AS s,
        sqrt(sum(CASE WHEN n > d THEN d / (n * (n - d)) ELSE 0 END) OVER ({part}ORDER BY time)) AS e FROM k)
    SELECT {head}time, n AS at_risk, d AS events, c - d AS censored, round(s, 8) AS survival, CASE WHEN s > 0 THEN round(s * e, 8) END AS std_error,
    CASE WHEN s > 0 THEN round(s * exp(-1.959963984540054 * e), 8) END AS lo95,
    CASE WHEN s > 0 THEN round(least(1, s * exp(1.959963984540054 * e)), 8) END AS hi95 FROM g"""


@query(
    "V01_survival_summary",
    SUBJECT_SQL + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", min({c})::DOUBLE AS min, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, round(avg({c}), 6) AS mean, "
        f"quantile_cont({c}, 0.75) AS q3, max({c})::DOUBLE AS max, count(*) - count({c}) AS missing FROM s"
        for c in ("time", "event")
    ),
)
def v01(t):
    return R.profile(subjects(t), ["time", "event"]).withColumn("mean", F.round("mean", 6))


@query("V02_kaplan_meier", SUBJECT_SQL + ", " + _km_sql("s"))
def v02(t):
    return _rounded(V.kaplan_meier(subjects(t), "time", "event"))


LINES_SQL = """WITH s AS (SELECT l_returnflag AS grp, date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) AS time,
    CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS event FROM lineitem)
"""


@query("V02_kaplan_meier_lines", LINES_SQL + ", " + _km_sql("s"))
def v02_lines(t):
    return _rounded(V.kaplan_meier(_lines(t), "time", "event"))


def _lines(t):
    days = F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("bigint")
    return t.lineitem.select(
        F.col("l_returnflag").alias("grp"), days.alias("time"), (F.col("l_linestatus") == "F").cast("int").alias("event")
    )


@query("V03_kaplan_meier_by_group", SUBJECT_SQL + ", " + _km_sql("s", "first_type"))
def v03(t):
    return _rounded(V.kaplan_meier(subjects(t), "time", "event", ["first_type"]))


@query("V03_kaplan_meier_lines_by_group", LINES_SQL + ", " + _km_sql("s", "grp"))
def v03_lines(t):
    return _rounded(V.kaplan_meier(_lines(t), "time", "event", ["grp"]))


GRID = [0.0, 60.0, 720.0, 1440.0, 4320.0, 10080.0]


@query(
    "V04_risk_table",
    SUBJECT_SQL + f"SELECT first_type, t.time::DOUBLE AS time, count(*) FILTER (s.time >= t.time) AS at_risk FROM s, (SELECT unnest({GRID}) AS time) t GROUP BY 1, 2",
)
def v04(t):
    return V.risk_table(subjects(t), "time", GRID, ["first_type"])


@query("V05_cox")
def v05(t):
    return V.cox_ph(covariates(t), "time", "event", X)[0]


@query("V06_exponential")
def v06(t):
    return V.exponential_regression(covariates(t), "time", "event", X)


@query("V07_weibull")
def v07(t):
    return V.weibull_regression(covariates(t), "time", "event", X)


@query("V08_log_logistic")
def v08(t):
    return V.loglogistic_regression(covariates(t), "time", "event", X)[0]
