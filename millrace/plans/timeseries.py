"""T: time-series queries."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators import forecasting as FC
from millrace.operators import smoothing as SM
from millrace.operators import timeseries as TS
from millrace.operators import windows as W
from millrace.plans.registry import query


def series_sql(table, key, ts, value, step):
    """SQL of a regular series: a row for every step between a key's first and last."""
    return f"""SELECT key, ts, value, row_number() OVER (PARTITION BY key ORDER BY ts) AS pos FROM
    (SELECT key, CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 {step})) AS DATE) AS ts FROM
        (SELECT {key} AS key, date_trunc('{step}', {ts})::DATE AS ts FROM {table}) GROUP BY 1)
    LEFT JOIN (SELECT {key} AS key, date_trunc('{step}', {ts})::DATE AS ts, {value} AS value FROM {table} GROUP BY 1, 2) USING (key, ts)"""


MONTHLY_SQL = series_sql("orders", "o_orderpriority", "o_orderdate", "round(sum(o_totalprice), 2)", "month")
DAILY_SQL = series_sql("events", "event_type", "ts", "round(sum(value), 2)", "day")
PERIOD = 12


def monthly(t):
    """Monthly order value per priority."""
    out = TS.regular_series(t.orders, ["o_orderpriority"], "o_orderdate", F.round(F.sum("o_totalprice"), 2), "month")
    return out.withColumnRenamed("o_orderpriority", "key")


def _rounded(df, keep, digits):
    return df.select(*keep, *[F.round(c, d).alias(c) for c, d in digits.items()])


@query("T01_regular_series", DAILY_SQL)
def t01(t):
    return TS.regular_series(
        t.events.withColumnRenamed("event_type", "key"), ["key"], "ts", F.round(F.sum("value"), 2), "day"
    )


@query(
    "T01_series_with_gaps",
    """WITH d AS (SELECT event_type AS key, date_trunc('day', ts)::DATE AS ts, round(sum(value), 2) AS value FROM events
        WHERE dayofweek(ts) NOT IN (0, 6) GROUP BY 1, 2),
    a AS (SELECT key, CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS DATE) AS ts FROM d GROUP BY 1)
    SELECT key, ts, value, row_number() OVER (PARTITION BY key ORDER BY ts) AS pos FROM a LEFT JOIN d USING (key, ts)""",
)
def t01_gaps(t):
    rows = t.events.where(~F.dayofweek("ts").isin(1, 7)).withColumnRenamed("event_type", "key")
    return TS.regular_series(rows, ["key"], "ts", F.round(F.sum("value"), 2), "day")


PARTS_SQL = f"""WITH s AS ({MONTHLY_SQL}),
t AS (SELECT key, pos, ts, value, (pos - 1) % 12 AS season, CASE WHEN count(value) OVER w = 13 THEN
    (sum(value) OVER w - (lag(value, 6) OVER o + lead(value, 6) OVER o) / 2) / 12 END AS trend FROM s
    WINDOW w AS (PARTITION BY key ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING), o AS (PARTITION BY key ORDER BY pos)),
r AS (SELECT key, season, avg(value - trend) AS raw FROM t GROUP BY 1, 2),
f AS (SELECT key, season, raw - avg(raw) OVER (PARTITION BY key) AS seasonal FROM r),
d AS (SELECT t.key, pos, value, trend, seasonal, value - trend - seasonal AS remainder FROM t JOIN f ON t.key = f.key AND t.season = f.season)
"""


@query(
    "T02_decompose",
    PARTS_SQL + "SELECT key, pos, round(trend, 5) AS trend, round(seasonal, 5) AS seasonal, round(remainder, 5) AS remainder FROM d",
)
def t02(t):
    return _rounded(TS.decompose(monthly(t), "key", PERIOD), ["key", "pos"], dict.fromkeys(("trend", "seasonal", "remainder"), 5))


@query(
    "T03_adjusted",
    PARTS_SQL + """SELECT key, pos, round(value - seasonal, 5) AS seasonally_adjusted, round(value - trend, 5) AS detrended,
    round(value - trend - seasonal, 5) AS doubly_adjusted FROM d""",
)
def t03(t):
    out = TS.adjusted(TS.decompose(monthly(t), "key", PERIOD))
    return _rounded(out, ["key", "pos"], dict.fromkeys(("seasonally_adjusted", "detrended", "doubly_adjusted"), 5))


@query(
    "T03_adjusted_log",
    PARTS_SQL.replace("round(sum(o_totalprice), 2)", "ln(sum(o_totalprice))")
    + "SELECT key, pos, round(value - seasonal, 8) AS seasonally_adjusted FROM d",
)
def t03_log(t):
    out = TS.adjusted(TS.decompose(TS.log_series(monthly(t)), "key", PERIOD))
    return _rounded(out, ["key", "pos"], {"seasonally_adjusted": 8})


LAGS = 15
ACF_SQL = f"""WITH s AS ({MONTHLY_SQL}), d AS (SELECT key, pos, value - avg(value) OVER (PARTITION BY key) AS d FROM s),
v AS (SELECT key, sum(d * d) AS v, count(d) AS n FROM d GROUP BY 1),
a AS (SELECT x.key, x.pos - y.pos AS lag, sum(x.d * y.d) AS c FROM d x JOIN d y ON x.key = y.key AND x.pos - y.pos BETWEEN 0 AND {LAGS} GROUP BY 1, 2),
r AS (SELECT a.key, CAST(lag AS INTEGER) AS lag, c / v AS acf, n FROM a JOIN v ON a.key = v.key)
"""


@query("T04_acf", ACF_SQL + "SELECT key, lag, n, round(acf, 8) AS acf FROM r")
def t04(t):
    return _rounded(TS.acf(monthly(t), "key", LAGS), ["key", "lag", "n"], {"acf": 8})


@query(
    "T05_pacf",
    ACF_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f""", g AS (SELECT key, list(acf ORDER BY lag) AS rho FROM r WHERE lag > 0 GROUP BY 1),
    p(key, k, phi, rho) AS (SELECT key, 1, [rho[1]], rho FROM g
        UNION ALL SELECT key, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - x * phi[k + 1 - j]), x), rho FROM
        (SELECT *, (rho[k + 1] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rho[k + 1 - j])))
            / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rho[j]))) AS x FROM p WHERE k < {LAGS}))
    SELECT key, CAST(k AS INTEGER) AS lag, round(phi[k], 7) AS pacf FROM p""",
)
def t05(t):
    return _rounded(TS.pacf(monthly(t), "key", LAGS), ["key", "lag"], {"pacf": 7})


@query(
    "T06_box_test",
    ACF_SQL + f"""SELECT key, round(max(n) * sum(acf * acf), 6) AS box_pierce,
    round(max(n) * (max(n) + 2) * sum(acf * acf / (n - lag)), 6) AS ljung_box FROM r WHERE lag > 0 GROUP BY 1""",
)
def t06(t):
    return _rounded(TS.box_test(monthly(t), "key", LAGS), ["key"], {"box_pierce": 6, "ljung_box": 6})


@query("T06_box_test_p")
def t06_p(t):
    return TS.box_test(monthly(t), "key", 1)


@query("T07_adf_test")
def t07(t):
    return TS.adf_test(monthly(t), "key")


@query(
    "T08_difference",
    f"SELECT key, pos, round(value - lag(value, 12) OVER (PARTITION BY key ORDER BY pos), 2) AS diff FROM ({MONTHLY_SQL})",
)
def t08(t):
    out = W.lag_difference(monthly(t), ["key"], "pos", "value", [PERIOD], "diff")
    return _rounded(out, ["key", "pos"], {"diff": 2})


@query(
    "T09_ar1_forecast",
    f"""WITH d AS (SELECT key, pos, value - lag(value) OVER (PARTITION BY key ORDER BY pos) AS x FROM ({MONTHLY_SQL})),
    l AS (SELECT key, pos, x, lag(x) OVER (PARTITION BY key ORDER BY pos) AS b FROM d),
    f AS (SELECT key, regr_slope(x, b) AS phi, regr_intercept(x, b) AS c, max_by(x, pos) AS last, max(pos) AS p FROM l GROUP BY 1)
    SELECT key, round(phi, 8) AS phi, p + h AS pos, CAST(h AS INTEGER) AS h,
    round(c / (1 - phi) + pow(phi, h) * (last - c / (1 - phi)), 2) AS point FROM f, range(1, 25) r(h)""",
)
def t09(t):
    d = W.lag_difference(monthly(t), ["key"], "pos", "value", [1], "d")
    return _rounded(TS.ar1_forecast(d, "key", 24, "d"), ["key", "pos", "h"], {"phi": 8, "point": 2})


@query("T10_seasonal_ar")
def t10(t):
    return FC.seasonal_ar_forecast(monthly(t), "key", PERIOD, 24)


@query("T11_choose_order")
def t11(t):
    return FC.choose_order(monthly(t), "key", PERIOD)


def _with_short(t):
    """The monthly series, and of each a copy of its first months: 2 to 30 steps, the second one without values."""
    rank = F.dense_rank().over(Window.orderBy("key"))
    keys = monthly(t).select("key").distinct().withColumn("i", rank)
    short = monthly(t).join(keys, "key").where("pos <= 7 * i - 5").select(
        F.concat(F.lit("short "), "key").alias("key"), "ts", "pos", F.when(F.col("i") != 2, F.col("value")).alias("value")
    )
    return monthly(t).select("key", "ts", "pos", "value").unionByName(short)


@query("T07_adf_short_series")
def t07_short(t):
    return TS.adf_test(_with_short(t), "key")


@query("T10_short_series")
def t10_short(t):
    return FC.seasonal_ar_forecast(_with_short(t), "key", PERIOD, 24)


@query("T11_short_series")
def t11_short(t):
    return FC.choose_order(_with_short(t), "key", PERIOD)


@query("T12_forecast_table")
def t12(t):
    series = monthly(t)
    return FC.forecast_table(SM.ets(series, "key", PERIOD, 12), series, "key", 12)


@query("T12_forecast_short_series")
def t12_short(t):
    series = _with_short(t)
    return FC.forecast_table(SM.ets(series, "key", PERIOD, 12), series, "key", 12)


@query("T13_ets")
def t13(t):
    return SM.ets(monthly(t), "key", PERIOD, 12, "AAA")


@query("T13_ets_chosen_form")
def t13_chosen(t):
    return SM.ets(monthly(t), "key", PERIOD, 12)


FIXED = (0.3, 0.1, 0.2, 0.9)
FIXED_SQL = f"""WITH RECURSIVE s AS ({MONTHLY_SQL}), v AS (SELECT key, list(value ORDER BY pos) AS x, max(pos) AS n FROM s GROUP BY 1),
i AS (SELECT key, x, n, list_avg(x[1:12]) AS first, (list_avg(x[13:24]) - list_avg(x[1:12])) / 12 AS step FROM v),
f AS (SELECT *, list_transform(range(1, 13), lambda j: x[j] - (first + (j - 1 - 5.5::DOUBLE) * step)) AS raw FROM i),
r(key, x, n, t, fitted, level, slope, season) AS (
    SELECT key, x, n, 0::BIGINT, NULL::DOUBLE, first - step * 6.5::DOUBLE, step, list_transform(raw, lambda y: y - list_avg(raw)) FROM f
    UNION ALL SELECT key, x, n, t + 1, point, level + phi * slope + a * (x[t + 1] - point), phi * slope + b * (x[t + 1] - point),
        list_transform(range(1, 13), lambda j: CASE WHEN j = t % 12 + 1 THEN season[j] + g * (x[t + 1] - point) ELSE season[j] END)
    FROM (SELECT *, level + phi * slope + season[t % 12 + 1] AS point FROM r,
        (SELECT {FIXED[0]}::DOUBLE AS a, {FIXED[1]}::DOUBLE AS b, {FIXED[2]}::DOUBLE AS g, {FIXED[3]}::DOUBLE AS phi)) WHERE t < n),
e AS (SELECT key, sqrt(sum(power(x[t] - fitted, 2)) / (max(n) - 17)) AS sigma FROM r WHERE t > 0 GROUP BY 1)
"""


@query(
    "T16_fixed_weights",
    FIXED_SQL + """SELECT key, t AS pos, round(x[t], 4) AS actual, round(fitted, 4) AS fitted, round(x[t] - fitted, 4) AS residual FROM r WHERE t > 0""",
)
def t16_fixed(t):
    model = SM.ets(monthly(t), "key", PERIOD, 24, "AAdA", FIXED)
    return _rounded(FC.augment(model, "key"), ["key", "pos"], dict.fromkeys(("actual", "fitted", "residual"), 4))


@query(
    "T12_fixed_weights",
    FIXED_SQL + f""", c AS (SELECT h, {FIXED[0]}::DOUBLE + {FIXED[1]}::DOUBLE * sum(power({FIXED[3]}::DOUBLE, h)) OVER (ORDER BY h)
        + CASE WHEN h % 12 = 0 THEN {FIXED[2]}::DOUBLE ELSE 0::DOUBLE END AS c FROM range(1, 25) q(h)),
    w AS (SELECT h, sqrt(1 + coalesce(sum(c * c) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS wide,
        sum(power({FIXED[3]}::DOUBLE, h)) OVER (ORDER BY h) AS reach FROM c),
    p AS (SELECT r.key, CAST(h AS INTEGER) AS h, n + h AS pos, level + reach * slope + season[(n + h - 1) % 12 + 1] AS point, wide * sigma AS sd
        FROM r JOIN e ON r.key = e.key, w WHERE t = n)
    SELECT key, pos, h, round(point, 3) AS point, round(point - {FC.Z80} * sd, 3) AS lo80, round(point + {FC.Z80} * sd, 3) AS hi80,
        round(point - {FC.Z95} * sd, 3) AS lo95, round(point + {FC.Z95} * sd, 3) AS hi95 FROM p""",
)
def t12_fixed(t):
    series = monthly(t)
    out = FC.forecast_table(SM.ets(series, "key", PERIOD, 24, "AAdA", FIXED), series, "key", 24)
    return _rounded(out, ["key", "pos", "h"], dict.fromkeys(("point", "lo80", "hi80", "lo95", "hi95"), 3))


@query("T13_ets_forms")
def t13_forms(t):
    return SM.choose_form(monthly(t), "key", PERIOD)


@query("T14_tidy")
def t14(t):
    return FC.tidy(SM.ets(monthly(t), "key", PERIOD, 12), "key")


@query("T15_glance")
def t15(t):
    return FC.glance(SM.ets(monthly(t), "key", PERIOD, 12), "key", PERIOD)


@query("T16_augment")
def t16(t):
    return FC.augment(SM.ets(monthly(t), "key", PERIOD, 12), "key")


@query("T17_components")
def t17(t):
    return FC.components(SM.ets(monthly(t), "key", PERIOD, 12), "key")


@query("T18_sweep")
def t18(t):
    series = monthly(t)
    return FC.sweep(SM.ets(series, "key", PERIOD, 12), series, "key", 12)


@query(
    "T19_index_summary",
    f"""SELECT key, count(*) AS n, min(ts) AS first, max(ts) AS last, min(s) AS step_min, quantile_cont(s, 0.25) AS step_q1,
    quantile_cont(s, 0.5) AS step_median, round(avg(s), 4) AS step_mean, quantile_cont(s, 0.75) AS step_q3, max(s) AS step_max
    FROM (SELECT key, ts, CAST(epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY key ORDER BY ts) AS DOUBLE) AS s FROM ({MONTHLY_SQL})) GROUP BY 1""",
)
def t19(t):
    return TS.index_summary(monthly(t), "key").withColumn("step_mean", F.round("step_mean", 4))


@query(
    "T20_time_signature",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS index_num, year(ts) AS year, isoyear(ts) AS year_iso,
    CASE WHEN month(ts) <= 6 THEN 1 ELSE 2 END::BIGINT AS half, quarter(ts) AS quarter, month(ts) AS month, month(ts) - 1 AS month_xts,
    monthname(ts) AS month_lbl, day(ts) AS day, hour(ts) AS hour, minute(ts) AS minute, CAST(floor(second(ts)) AS BIGINT) AS second,
    hour(ts) % 12 AS hour12, CASE WHEN hour(ts) < 12 THEN 1 ELSE 2 END::BIGINT AS am_pm, dayofweek(ts) + 1 AS wday, dayofweek(ts) AS wday_xts,
    dayname(ts) AS wday_lbl, day(ts) AS mday, date_diff('day', date_trunc('quarter', ts), ts) + 1 AS qday, dayofyear(ts) AS yday,
    (day(ts) + dayofweek(date_trunc('month', ts)) - 1) // 7 + 1 AS mweek, (dayofyear(ts) - 1) // 7 + 1 AS week, weekofyear(ts) AS week_iso,
    ((dayofyear(ts) - 1) // 7 + 1) % 2 AS week2, ((dayofyear(ts) - 1) // 7 + 1) % 3 AS week3, ((dayofyear(ts) - 1) // 7 + 1) % 4 AS week4,
    (day(ts) - 1) // 7 + 1 AS mday7 FROM events""",
)
def t20(t):
    out = TS.time_signature(t.events.select("event_id", "ts"), "ts").drop("ts")
    return out.withColumns({c: F.col(c).cast("bigint") for c in TS.SIGNATURE_NUMBERS})


@query(
    "T21_future_index",
    f"""SELECT key, CAST(ts + to_months(CAST(h AS INTEGER)) AS DATE) AS ts, n + h AS pos, CAST(h AS INTEGER) AS h FROM
    (SELECT key, max(ts) AS ts, count(*) AS n FROM ({MONTHLY_SQL}) GROUP BY 1), range(1, 25) r(h)""",
)
def t21(t):
    return TS.future_index(monthly(t), "key", 24)


@query("T22_signature_regression")
def t22(t):
    return TS.signature_forecast(monthly(t), "key", 12)


ERRORS_SQL = f"""WITH e AS (SELECT key, pos, value - lag(value, 12) OVER (PARTITION BY key ORDER BY pos) AS error,
    (value - lag(value, 12) OVER (PARTITION BY key ORDER BY pos)) / value AS error_pct FROM ({MONTHLY_SQL}))
"""


def _naive_errors(t):
    series = monthly(t)
    last_year = series.select("key", (F.col("pos") + PERIOD).alias("pos"), F.col("value").alias("prediction"))
    return TS.forecast_errors(series.join(last_year, ["key", "pos"], "left"), "value", "prediction")


@query("T23_forecast_errors", ERRORS_SQL + "SELECT key, pos, round(error, 2) AS error, round(error_pct, 8) AS error_pct FROM e")
def t23(t):
    return _rounded(_naive_errors(t), ["key", "pos"], {"error": 2, "error_pct": 8})


@query(
    "T24_error_summary",
    ERRORS_SQL + """SELECT key, round(avg(error), 2) AS me, round(sqrt(avg(error * error)), 2) AS rmse, round(avg(abs(error)), 2) AS mae,
    round(avg(abs(error_pct)), 8) AS mape, round(avg(error_pct), 8) AS mpe FROM e GROUP BY 1""",
)
def t24(t):
    out = TS.error_summary(_naive_errors(t), ["key"])
    return _rounded(out, ["key"], {"me": 2, "rmse": 2, "mae": 2, "mape": 8, "mpe": 8})


@query(
    "T25_date_range",
    """SELECT o_orderpriority AS key, date_trunc('quarter', o_orderdate)::DATE AS ts, count(*) AS value,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY min(o_orderdate)) AS pos FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1999-12-31' GROUP BY 1, 2""",
)
def t25(t):
    rows = t.orders.withColumnRenamed("o_orderpriority", "key")
    return TS.regular_series(rows, ["key"], "o_orderdate", F.count(F.lit(1)), "quarter", "1997-01-01", "1999-12-31")
