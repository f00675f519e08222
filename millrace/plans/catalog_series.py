"""Queries over series analytics (survey 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import series as sr
from millrace.operators import windows as wn
from millrace.operators.aggregate import cents
from millrace.plans.catalog_windows import DAILY, daily_revenue
from millrace.plans.registry import Tables, query

HOLED = f"""{DAILY}, h AS (SELECT name, date, CASE WHEN (day(date) * 7 + month(date)) % 5 < 2 THEN NULL ELSE value END AS value FROM s)"""


def holed(t: Tables):
    missing = (F.dayofmonth("date") * 7 + F.month("date")) % 5 < 2
    return daily_revenue(t).withColumn("value", F.when(~missing, F.col("value")))


POROSITY = f"""WITH {HOLED}, f AS (SELECT name, date, value IS NULL AS m FROM h),
  i AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY date) - row_number() OVER (PARTITION BY name, m ORDER BY date) AS g FROM f),
  b AS (SELECT name, count(*) AS length FROM i WHERE m GROUP BY name, g),
  n AS (SELECT name, count(*) AS n, count_if(value IS NULL) AS missing FROM h GROUP BY name)"""


@query(
    "K01",
    f"""{POROSITY} SELECT n.name, n.n, missing / n.n AS total, coalesce(sum(CASE WHEN length > 1 THEN length END), 0) / n.n AS adjusted,
    coalesce(sum(CASE WHEN length > 1 THEN length * length END), 0)::BIGINT AS penalty, coalesce(max(length), 0) AS longest
    FROM n LEFT JOIN b ON b.name = n.name GROUP BY n.name, n.n, missing""",
)
def series_porosity(t: Tables):
    return sr.porosity(holed(t), tolerance=1)


@query(
    "K02",
    f"""WITH {HOLED}, z AS (SELECT name, date, coalesce(value, 0) AS value FROM h), f AS (SELECT *, value = 0 AS m FROM z),
    i AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY date) - row_number() OVER (PARTITION BY name, m ORDER BY date) AS g FROM f),
    b AS (SELECT name, max(c) AS longest, sum(c) AS inblocks FROM (SELECT name, count(*) AS c FROM i WHERE m GROUP BY name, g) GROUP BY name),
    n AS (SELECT name, count(*) AS n, count_if(value = 0)::BIGINT AS zeros, min(date) AS start_date, max(date) AS end_date FROM z GROUP BY name)
    SELECT n.name, n, zeros, longest AS consecutive_zeros, round(zeros / n, 6) AS pct_missing, start_date, end_date,
      date_diff('day', DATE '2000-01-01', end_date) / 365 AS forecast_years, inblocks::BIGINT / n AS porosity,
      2 / (round(zeros / n, 6) + 1) + 2 / (longest + 1) + 2 / (inblocks::BIGINT / n + 1) AS robustness FROM n JOIN b ON n.name = b.name""",
)
def series_eda(t: Tables):
    return sr.eda_summary(holed(t).na.fill(0.0, ["value"]), F.lit("2000-01-01").cast("date"))


@query(
    "K03",
    """SELECT c_custkey, round(CASE WHEN c_acctbal <> 0 THEN sign(c_acctbal) * ln(abs(c_acctbal) + 1) ELSE 0 END, 9) AS logmod,
    round(CASE WHEN c_acctbal <> 0 THEN sign(c_acctbal) * log10(abs(c_acctbal)) ELSE log10(2) END, 9) AS logmod10 FROM customer""",
)
def log_modulus(t: Tables):
    return t.customer.select(
        "c_custkey",
        F.round(sr.logmod(F.col("c_acctbal")), 9).alias("logmod"),
        F.round(sr.logmod(F.col("c_acctbal"), base=10, constant=2, always_add=False), 9).alias("logmod10"),
    )


@query(
    "K04 K05 K06",
    f"""WITH {DAILY}, a AS (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi, avg(value) OVER w AS m, stddev_pop(value) OVER w AS sd FROM s WINDOW w AS (PARTITION BY name))
    SELECT name, date, round((value - lo) / nullif(hi - lo, 0), 9) AS unit, round((value - m) / nullif(sd, 0), 7) AS z,
    round(CASE WHEN lo > 0 THEN ln(value) ELSE value END, 9) AS level FROM a""",
)
def scaled_series(t: Tables):
    series = daily_revenue(t)
    out = sr.scalings(series)
    return out.select("name", "date", F.round("unit", 9).alias("unit"), F.round("z", 7).alias("z"), F.round("level", 9).alias("level"))


MONTHLY = """mo AS (SELECT c_mktsegment AS name, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def monthly_revenue(t: Tables, key: str = "c_mktsegment"):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.col(key).cast("string").alias("name"), F.trunc(F.to_date("o_orderdate"), "month").alias("date")).agg(
        F.sum(cents("o_totalprice")).cast("double").alias("value")
    )


@query(
    "K07",
    f"WITH {MONTHLY} SELECT name, date, " + ", ".join(f"CAST(month(date) = {m} AS INT) AS m{m}" for m in range(1, 12)) + " FROM mo",
)
def month_dummies(t: Tables):
    return sr.seasonal_dummies(monthly_revenue(t)).drop("value")


@query(
    "K08",
    f"""WITH {MONTHLY}, d AS (SELECT *, ln(value) - ln(lag(value) OVER (PARTITION BY name ORDER BY date)) AS change FROM mo)
    SELECT name, date, round(value - lag(value, 2) OVER (PARTITION BY name ORDER BY date), 4) AS diff, round(value, 2) AS level FROM d""",
)
def differences_inverted(t: Tables):
    series = monthly_revenue(t)
    w = wn.series_window()
    change = F.coalesce(F.ln("value") - F.ln(F.lag("value").over(w)), F.lit(0.0))
    start = F.first("value").over(w)
    changed = sr.difference(series, 2).select("*", change.alias("change"), start.alias("start"))
    level = sr.invert_log_difference(changed, "change", F.col("start"))
    return level.select("name", "date", F.round("diff", 4).alias("diff"), F.round("level", 2).alias("level"))


KPSS = f"""WITH {MONTHLY}, e AS (SELECT name, value - avg(value) OVER (PARTITION BY name) AS e, row_number() OVER (PARTITION BY name ORDER BY date) AS rn,
    count(*) OVER (PARTITION BY name) AS n FROM mo),
  l AS (SELECT DISTINCT name, n, CAST(floor(3 * sqrt(n) / 13) AS INT) AS lags FROM e),
  eta AS (SELECT name, sum(c * c) AS ss FROM (SELECT name, sum(e) OVER (PARTITION BY name ORDER BY rn) AS c FROM e) GROUP BY name),
  v0 AS (SELECT name, sum(e * e) AS v FROM e GROUP BY name),
  cov AS (SELECT a.name, sum(2 * (1 - (a.rn - b.rn) / (l.lags + 1)) * a.e * b.e) AS v FROM e a JOIN l ON a.name = l.name JOIN e b ON a.name = b.name
    AND a.rn - b.rn BETWEEN 1 AND l.lags GROUP BY a.name)
  SELECT l.name, round(eta.ss / (n * n) / ((v0.v + coalesce(cov.v, 0)) / n), 6) AS kpss FROM l JOIN eta ON l.name = eta.name JOIN v0 ON l.name = v0.name LEFT JOIN cov ON l.name = cov.name"""


@query("K09", KPSS)
def series_stationarity(t: Tables):
    return sr.stationarity(monthly_revenue(t)).select("name", F.round("kpss", 6).alias("kpss"))


NATION_MONTHS = """mo AS (SELECT c_nationkey::VARCHAR AS name, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS value
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


@query("K09 K10")
def series_order_and_period(t: Tables):
    series = monthly_revenue(t, "c_nationkey")
    return sr.stationarity(series).select("name", "order").join(sr.dominant_period(series), "name")


def kpss_sql(source: str, name: str) -> str:
    """Level-stationarity statistic per series of a table with name, i (from 1) and value."""
    return f"""e_{name} AS (SELECT name, i, value - avg(value) OVER (PARTITION BY name) AS e, count(*) OVER (PARTITION BY name) AS n FROM {source}),
    a_{name} AS (SELECT x.name, y.i - x.i AS s, max(x.n) AS n, sum(x.e * y.e) AS c FROM e_{name} x JOIN e_{name} y ON x.name = y.name AND y.i >= x.i AND y.i - x.i <= trunc(3 * sqrt(x.n) / 13) GROUP BY ALL),
    v_{name} AS (SELECT name, sum(CASE WHEN s = 0 THEN c / n ELSE 2.0::DOUBLE / n * (1 - s / (trunc(3 * sqrt(n) / 13) + 1)) * c END) AS variance FROM a_{name} GROUP BY name),
    {name} AS (SELECT name, sum(cum * cum) / max(n) / max(n) / max(variance) AS stat FROM (SELECT *, sum(e) OVER (PARTITION BY name ORDER BY i) AS cum FROM e_{name}) JOIN v_{name} USING (name) GROUP BY name)"""


@query(
    "K09",
    f"""WITH {NATION_MONTHS}, s0 AS (SELECT name, row_number() OVER (PARTITION BY name ORDER BY date) AS i, value FROM mo),
    s1 AS (SELECT name, i - 1 AS i, d AS value FROM (SELECT *, value - lag(value) OVER (PARTITION BY name ORDER BY i) AS d FROM s0) WHERE i > 1),
    {kpss_sql('s0', 'k0')}, {kpss_sql('s1', 'k1')}
    SELECT k0.name, CAST(CASE WHEN k0.stat <= 0.463 THEN 0 WHEN k1.stat <= 0.463 THEN 1 ELSE 2 END AS INT) AS "order" FROM k0 JOIN k1 USING (name)""",
)
def series_difference_order(t: Tables):
    return sr.stationarity(monthly_revenue(t, "c_nationkey")).select("name", "order")


@query(
    "K22",
    f"""WITH {NATION_MONTHS}, x AS (SELECT name, date, value AS x, value - lag(value) OVER w AS d, lag(value) OVER w AS x1, row_number() OVER w AS i FROM mo WINDOW w AS (PARTITION BY name ORDER BY date)),
    l AS (SELECT name, count(*) AS n, sum(d * d) AS dd, var_pop(d) AS vd, covar_pop(d, x1) AS c, var_pop(x1) AS v FROM x WHERE i > 1 GROUP BY name),
    p AS (SELECT name, (dd - n * (vd - c * c / v)) / 2 / (n * (vd - c * c / v) / (n - 2)) AS phi1 FROM l),
    y AS (SELECT name, d - lag(d) OVER w AS e, lag(d) OVER w AS d1, i FROM x WHERE i > 1 WINDOW w AS (PARTITION BY name ORDER BY date)),
    t AS (SELECT name, count(*) AS n, sum(e * d1) AS ed, sum(d1 * d1) AS dd, sum(e * e) AS ee FROM y WHERE i > 2 GROUP BY name)
    SELECT p.name, round(phi1, 6) AS phi1, round(ed / dd / sqrt((ee - ed * ed / dd) / (n - 1) / dd), 6) AS tau FROM p JOIN t USING (name)""",
)
def unit_root_levels(t: Tables):
    out = sr.unit_root_statistics(monthly_revenue(t, "c_nationkey"))
    return out.select("name", F.round("phi1", 6).alias("phi1"), F.round("tau", 6).alias("tau"))


@query("K22")
def series_unit_roots(t: Tables):
    return sr.unit_roots(monthly_revenue(t, "c_nationkey"))


@query(
    "K11 R06",
    """SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS ts, count(*) AS n, round(avg(value), 6) AS mean, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1, 2""",
)
def daily_events(t: Tables):
    money = t.events.withColumn("amount", cents("value"))
    out = sr.resample(money, ["event_type"], "ts", "day", "amount")
    means = t.events.groupBy("event_type", F.date_trunc("day", "ts").alias("ts")).agg(F.round(F.avg("value"), 6).alias("mean"))
    out = out.drop("mean").join(means, ["event_type", "ts"])
    return out.select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "n", "mean", F.col("total").cast("double").alias("total"))


HOUR_COLUMNS = ", ".join(f"count_if(hour(ts) = {h})::BIGINT AS h{h}" for h in range(24))


@query("K11 G14", f"SELECT CAST(ts AS DATE) AS day, {HOUR_COLUMNS} FROM events GROUP BY 1")
def hour_by_day_matrix(t: Tables):
    rows = t.events.select(F.to_date("ts").alias("day"), F.hour("ts").alias("h"))
    wide = rows.groupBy("day").pivot("h", list(range(24))).count().na.fill(0)
    return wide.select("day", *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


@query(
    "K12",
    f"""WITH {DAILY}, b AS (SELECT name, min(date) AS lo, max(date) AS hi FROM s GROUP BY name),
    g AS (SELECT name, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
    SELECT name, date, coalesce(value, 0) AS value FROM g LEFT JOIN s USING (name, date)""",
)
def complete_calendar(t: Tables):
    return sr.fill_grid(daily_revenue(t), "day", 0.0)


@query(
    "K15",
    f"""WITH {MONTHLY}, d AS (SELECT *, row_number() OVER w AS rn, value - lag(value) OVER w AS step, lag(value, 10) OVER w AS p10 FROM mo WINDOW w AS (PARTITION BY name ORDER BY date)),
    r AS (SELECT *, avg(CASE WHEN step > 0 THEN step WHEN step IS NULL THEN NULL ELSE 0 END) OVER f AS g, avg(CASE WHEN step < 0 THEN -step WHEN step IS NULL THEN NULL ELSE 0 END) OVER f AS l,
      min(value) OVER f AS lo, max(value) OVER f AS hi, avg(value) OVER (PARTITION BY name ORDER BY date ROWS 11 PRECEDING) AS a
      FROM d WINDOW f AS (PARTITION BY name ORDER BY date ROWS 13 PRECEDING))
    SELECT name, date, value, round(CASE WHEN rn > 14 THEN CASE WHEN l = 0 THEN 100.0 ELSE 100 - 100 / (1 + g / l) END END, 6) AS rsi,
      round(CASE WHEN rn >= 14 THEN (hi - value) / nullif(hi - lo, 0) * -100 END, 6) AS williams_r, round((value - p10) / p10, 9) AS proc,
      round(CASE WHEN rn >= 12 THEN a END, 4) AS sma FROM r""",
)
def price_indicators(t: Tables):
    out = sr.technical_indicators(monthly_revenue(t))
    return out.withColumns({"rsi": F.round("rsi", 6), "williams_r": F.round(F.col("williams_r"), 6), "proc": F.round("proc", 9), "sma": F.round("sma", 4)})


def ema_sql(source: str, column: str, n: int, name: str) -> str:
    """Recursive steps of an exponential average over the known values of a column."""
    return f"""k_{name} AS (SELECT name, date, {column} AS x, row_number() OVER (PARTITION BY name ORDER BY date) AS i FROM {source} WHERE {column} IS NOT NULL),
    {name} AS (SELECT name, max(date) AS date, {n}::BIGINT AS i, avg(x) AS y FROM k_{name} WHERE i <= {n} GROUP BY name HAVING count(*) = {n}
      UNION ALL SELECT k.name, k.date, k.i, k.x * (2.0::DOUBLE / {n + 1}) + e.y * (1 - 2.0::DOUBLE / {n + 1}) FROM {name} e JOIN k_{name} k ON k.name = e.name AND k.i = e.i + 1)"""


@query(
    "K15",
    f"""WITH RECURSIVE {NATION_MONTHS}, {ema_sql('mo', 'value', 12, 'fast')}, {ema_sql('mo', 'value', 26, 'slow')},
    line AS (SELECT mo.name, mo.date, f.y - s.y AS macd FROM mo LEFT JOIN fast f ON mo.name = f.name AND mo.date = f.date LEFT JOIN slow s ON mo.name = s.name AND mo.date = s.date),
    {ema_sql('line', 'macd', 9, 'sig')}
    SELECT l.name, l.date, round(l.macd, 3) AS macd, round(g.y, 3) AS signal FROM line l LEFT JOIN sig g ON l.name = g.name AND l.date = g.date""",
)
def price_macd(t: Tables):
    out = sr.macd(monthly_revenue(t, "c_nationkey"))
    return out.select("name", "date", F.round("macd", 3).alias("macd"), F.round("signal", 3).alias("signal"))


@query(
    "K14",
    f"""WITH RECURSIVE {NATION_MONTHS}, l AS (SELECT name, list(value ORDER BY date) AS p FROM (SELECT * FROM mo QUALIFY row_number() OVER (PARTITION BY name ORDER BY date DESC) <= 12) GROUP BY name HAVING count(*) = 12),
    s AS (SELECT name, 0 AS step, p, NULL::DOUBLE AS position, NULL::DOUBLE AS forecast FROM l
      UNION ALL SELECT name, step + 1, list_append(p[2:], (list_max(p) - list_min(p)) * nxt + list_min(p)), nxt, (list_max(p) - list_min(p)) * nxt + list_min(p)
      FROM (SELECT *, (p[12] - list_min(p)) / (list_max(p) - list_min(p)) + CASE WHEN (p[12] - list_min(p)) / (list_max(p) - list_min(p)) <= 0.8 THEN 0.1::DOUBLE ELSE -0.1::DOUBLE END AS nxt FROM s) WHERE step < 6)
    SELECT name, CAST(step AS INT) AS step, round(position, 6) AS position, round(forecast, 2) AS forecast, round(list_min(p), 2) AS low, round(list_max(p), 2) AS high FROM s WHERE step > 0""",
)
def expected_prices(t: Tables):
    out = sr.window_trading(monthly_revenue(t, "c_nationkey"), 12, 6)
    return out.select("name", "step", F.round("position", 6).alias("position"), *[F.round(c, 2).alias(c) for c in ("forecast", "low", "high")])


@query(
    "K16",
    """WITH c AS (SELECT CAST(o_orderdate AS DATE) AS trade_date, CAST(o_orderdate AS DATE) + CAST(30 * (o_orderkey % 12) AS INT) AS expiry, o_totalprice AS close FROM orders),
    p AS (SELECT CAST(l_shipdate AS DATE) AS trade_date, max(l_extendedprice) AS spot FROM lineitem GROUP BY 1),
    j AS (SELECT *, date_diff('month', trade_date, expiry) AS maturity FROM c JOIN p USING (trade_date)),
    m AS (SELECT CAST(date_trunc('month', trade_date) AS DATE) AS month, CAST(maturity AS INT) AS maturity, sum(CAST(close AS DECIMAL(18,2)))::DOUBLE / count(*) AS futures, sum(CAST(spot AS DECIMAL(18,2)))::DOUBLE / count(*) AS spot FROM j GROUP BY ALL)
    SELECT month, maturity, futures, spot, round((ln(futures) - ln(spot)) / ln(spot) * (12.0::DOUBLE / nullif(maturity, 0)), 9) AS excess_return FROM m""",
)
def futures_against_spot(t: Tables):
    day = F.to_date("o_orderdate")
    contracts = t.orders.select(
        day.alias("trade_date"), F.date_add(day, (F.col("o_orderkey") % 12 * 30).cast("int")).alias("expiry"), F.col("o_totalprice").alias("close")
    )
    spot = t.lineitem.groupBy(F.to_date("l_shipdate").alias("trade_date")).agg(F.max("l_extendedprice").alias("spot"))
    out = sr.futures_spread(contracts, spot)
    return out.select(
        "month", "maturity", "futures", "spot", F.round("excess_return", 9).alias("excess_return")
    )


FORECAST = f"{MONTHLY}, fc AS (SELECT name, date, value AS actual, lag(value) OVER (PARTITION BY name ORDER BY date) AS forecast FROM mo)"


def naive_forecast(t: Tables):
    return monthly_revenue(t).select(
        "name", "date", F.col("value").alias("actual"), F.lag("value").over(wn.series_window()).alias("forecast")
    )


@query(
    "K17",
    f"""WITH {FORECAST}, x AS (SELECT * FROM fc WHERE forecast IS NOT NULL),
    d AS (SELECT *, CASE WHEN lag(actual) OVER w IS NOT NULL THEN CAST(sign(forecast - lag(forecast) OVER w) = sign(actual - lag(actual) OVER w) AS INT) END AS mom,
      CASE WHEN lag(actual) OVER w IS NOT NULL THEN CAST(sign(forecast - 1e7) = sign(actual - 1e7) AS INT) END AS lng FROM x WINDOW w AS (PARTITION BY name ORDER BY date)),
    h(horizon, hend) AS (VALUES ('short_term', DATE '1996-05-01'), ('medium_term', DATE '1997-09-01'), ('long_term', DATE '1999-05-01'))
    SELECT name, horizon, count(*) AS periods, round(avg(abs((actual - forecast) / actual)), 9) AS mape, round(sqrt(avg((actual - forecast) * (actual - forecast))), 3) AS rmse,
    round(avg(least(actual, forecast) / greatest(actual, forecast)), 9) AS minmax_accuracy, round(avg(mom), 9) AS direction_mom, round(avg(lng), 9) AS direction_long
    FROM d, h WHERE date >= DATE '1996-01-01' AND date <= hend GROUP BY name, horizon""",
)
def forecast_accuracy(t: Tables):
    def day(text):
        return F.lit(text).cast("date")

    horizons = {"short_term": day("1996-05-01"), "medium_term": day("1997-09-01"), "long_term": day("1999-05-01")}
    rows = naive_forecast(t).where(F.col("forecast").isNotNull())
    out = sr.accuracy(rows, horizons, day("1996-01-01"), F.lit(1e7))
    digits = {"mape": 9, "rmse": 3, "minmax_accuracy": 9, "direction_mom": 9, "direction_long": 9}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "K18",
    f"""WITH {DAILY} SELECT name, count_if(date <= DATE '1999-12-31')::BIGINT AS train_rows, count_if(date > DATE '1999-12-31')::BIGINT AS validation_rows FROM s GROUP BY name""",
)
def train_validation(t: Tables):
    train, validation = sr.split_by_date(daily_revenue(t), F.lit("1999-12-31").cast("date"))
    tagged = train.select("name", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(validation.select("name", F.lit(0).alias("a"), F.lit(1).alias("b")))
    return tagged.groupBy("name").agg(F.sum("a").alias("train_rows"), F.sum("b").alias("validation_rows"))


@query(
    "K18",
    """SELECT o_orderkey, o_totalprice, CASE WHEN ('0x' || substr(md5('7|' || o_orderkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.8 THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def hashed_split(t: Tables):
    return sr.split_by_hash(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 0.8, 7)


@query(
    "K19",
    """WITH s AS (SELECT o_custkey::VARCHAR AS name, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value FROM orders GROUP BY 1, 2),
    i AS (SELECT * FROM s WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'),
    c AS (SELECT name FROM i GROUP BY name HAVING count(*) / 24 >= 0.2)
    SELECT i.* FROM i JOIN c USING (name)""",
)
def covered_series(t: Tables):
    series = t.orders.groupBy(F.col("o_custkey").cast("string").alias("name"), F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("value"))
    return sr.select_series(series, F.lit("1996-01-01").cast("date"), F.lit("1997-12-31").cast("date"), 0.2, F.lit(24))


@query(
    "K20",
    """WITH w AS (SELECT event_type AS name, CAST(date_trunc('week', ts) AS DATE) AS date, count_if(value > 40)::BIGINT AS longs, count_if(value <= 40)::BIGINT AS shorts FROM events GROUP BY 1, 2)
    SELECT *, (longs - lag(longs) OVER v) - (shorts - lag(shorts) OVER v) AS net_length FROM w WINDOW v AS (PARTITION BY name ORDER BY date)""",
)
def weekly_net_length(t: Tables):
    weekly = t.events.groupBy(F.col("event_type").alias("name"), F.to_date(F.date_trunc("week", "ts")).alias("date")).agg(
        F.count_if(F.col("value") > 40).alias("longs"), F.count_if(F.col("value") <= 40).alias("shorts")
    )
    return sr.net_length(weekly, "longs", "shorts")


@query(
    "K21",
    f"""WITH {FORECAST}, e AS (SELECT name, date, (actual - forecast) / 1e6 AS v FROM fc WHERE forecast IS NOT NULL),
    mm AS (SELECT *, v - avg(v) OVER (PARTITION BY name) AS c FROM e),
    jb AS (SELECT name, count(*) AS n, avg(c*c) AS m2, avg(c*c*c) AS m3, avg(c*c*c*c) AS m4 FROM mm GROUP BY name),
    d AS (SELECT name, date, v - lag(v) OVER (PARTITION BY name ORDER BY date) AS d FROM e),
    dc AS (SELECT name, d - avg(d) OVER (PARTITION BY name) AS d, row_number() OVER (PARTITION BY name ORDER BY date) AS rn, count(*) OVER (PARTITION BY name) AS m FROM d WHERE d IS NOT NULL),
    ss AS (SELECT name, max(m) AS m, sum(d * d) AS ss FROM dc GROUP BY name),
    cc AS (SELECT a.name, a.rn - b.rn AS k, sum(a.d * b.d) AS c FROM dc a JOIN dc b ON a.name = b.name AND a.rn - b.rn BETWEEN 1 AND 20 GROUP BY 1, 2),
    lb AS (SELECT cc.name, max(m) * (max(m) + 2) * sum((c / ss) * (c / ss) / (m - k)) AS q FROM cc JOIN ss ON cc.name = ss.name GROUP BY cc.name)
    SELECT jb.name, n, round(n / 6 * (m3 * m3 / (m2 * m2 * m2) + (m4 / (m2 * m2) - 3) * (m4 / (m2 * m2) - 3) / 4), 6) AS jarque_bera, round(q, 6) AS ljung_box,
      round(exp(-n / 6 * (m3 * m3 / (m2 * m2 * m2) + (m4 / (m2 * m2) - 3) * (m4 / (m2 * m2) - 3) / 4) / 2), 9) AS jb_p FROM jb JOIN lb ON jb.name = lb.name""",
)
def error_tests(t: Tables):
    errors = naive_forecast(t).where(F.col("forecast").isNotNull())
    errors = errors.select("name", "date", ((F.col("actual") - F.col("forecast")) / 1e6).alias("value"))
    out = sr.residual_tests(errors)
    return out.select("name", "n", F.round("jarque_bera", 6).alias("jarque_bera"), F.round("ljung_box", 6).alias("ljung_box"), F.round("jb_p", 9).alias("jb_p"))
