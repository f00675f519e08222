"""Queries over aggregates (survey 2.4), windows (2.5) and set operations (2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates as dt
from millrace.operators import aggregate as ag
from millrace.operators import cleanse as cl
from millrace.operators import ordered as od
from millrace.operators import setops as so
from millrace.operators import windows as wn
from millrace.operators.aggregate import cents
from millrace.plans.registry import Tables, query

D2 = "CAST({} AS DECIMAL(18,2))"


def daily_revenue(t: Tables):
    """Series per market segment: (name, date, value), one row per segment and day."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.col("c_mktsegment").alias("name"), F.to_date("o_orderdate").alias("date")).agg(
        F.sum(cents("o_totalprice")).cast("double").alias("value")
    )


DAILY = """s AS (SELECT c_mktsegment AS name, CAST(o_orderdate AS DATE) AS date,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


@query(
    "A01 A02",
    """SELECT CASE WHEN l_quantity < 25 THEN 'small' ELSE 'large' END AS lot, year(l_shipdate)::INT AS ship_year,
      quarter(l_shipdate)::INT AS ship_quarter, count(*) AS n, sum(l_quantity) AS quantity, max(l_extendedprice) AS dearest,
      min(l_extendedprice) AS cheapest, round(avg(l_discount), 6) AS mean_discount FROM lineitem GROUP BY ALL""",
)
def lots_by_quarter(t: Tables):
    lot = F.when(F.col("l_quantity") < 25, "small").otherwise("large").alias("lot")
    return t.lineitem.groupBy(
        lot, F.year("l_shipdate").alias("ship_year"), F.quarter("l_shipdate").alias("ship_quarter")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("quantity"),
        F.max("l_extendedprice").alias("dearest"),
        F.min("l_extendedprice").alias("cheapest"),
        F.round(F.avg("l_discount"), 6).alias("mean_discount"),
    )


ROLLUP_SQL = """WITH c AS (SELECT right('000000' || CAST(l_partkey * 37 % 1000000 AS VARCHAR), 6) AS code, l_quantity AS quantity FROM lineitem)
SELECT substring(code, 1, 6) AS code, 6 AS width, sum(quantity) AS quantity FROM c GROUP BY 1
UNION ALL SELECT substring(code, 1, 4), 4, sum(quantity) FROM c GROUP BY 1
UNION ALL SELECT substring(code, 1, 2), 2, sum(quantity) FROM c GROUP BY 1"""


@query("A03", ROLLUP_SQL)
def code_rollup(t: Tables):
    code = F.lpad((F.col("l_partkey") * 37 % 1_000_000).cast("string"), 6, "0")
    coded = t.lineitem.select(code.alias("code"), F.col("l_quantity").alias("quantity"))
    return ag.prefix_rollup(coded, "code", "quantity", [6, 4, 2])


@query(
    "A05 A06",
    """SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(*) AS n FROM lineitem GROUP BY 1
    HAVING count(*) > 500 AND sum(l_tax) > 0""",
)
def wide_suppliers(t: Tables):
    grouped = t.lineitem.groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count(F.lit(1)).alias("n"), F.sum("l_tax").alias("_tax")
    )
    return grouped.where("n > 500 AND _tax > 0").drop("_tax")


@query("A06", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_values(t: Tables):
    return t.customer.select("c_mktsegment", "c_nationkey").distinct()


@query(
    "A07",
    """SELECT l_suppkey, round(avg(l_extendedprice / nullif(l_quantity, 0)), 6) AS mean_ratio,
    round(stddev_samp(l_extendedprice / nullif(l_quantity, 0)), 4) AS sd_ratio FROM lineitem GROUP BY 1""",
)
def price_ratio_spread(t: Tables):
    ratio = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    return t.lineitem.groupBy("l_suppkey").agg(
        F.round(F.avg(ratio), 6).alias("mean_ratio"), F.round(F.stddev_samp(ratio), 4).alias("sd_ratio")
    )


@query(
    "A08",
    """SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS l_extendedprice, max(l_quantity) AS l_quantity
    FROM lineitem GROUP BY ALL""",
)
def dedup_by_max(t: Tables):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_extendedprice").alias("l_extendedprice"), F.max("l_quantity").alias("l_quantity")
    )


@query(
    "A10 V12",
    """WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN DATE '1990-01-01' END AS start_date FROM customer),
    r AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders GROUP BY 1)
    SELECT c_custkey, coalesce(start_date, lo) AS start_date, hi AS end_date FROM a LEFT JOIN r ON o_custkey = c_custkey""",
)
def fill_series_dates(t: Tables):
    attributes = t.customer.select(
        "c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.lit("1990-01-01").cast("date")).alias("start_date")
    )
    span = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi")
    )
    return attributes.join(span, "c_custkey", "left").select(
        "c_custkey", F.coalesce("start_date", "lo").alias("start_date"), F.col("hi").alias("end_date")
    )


@query(
    "A11 W13",
    """SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS amount, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS share
    FROM orders GROUP BY 1""",
)
def priority_shares(t: Tables):
    return ag.share_of_total(t.orders, ["o_orderpriority"], F.count(F.lit(1)))


@query(
    "A12",
    """SELECT hour(ts)::INT AS hour, round(avg(value), 6) AS mean, median(value) AS median, count(*) AS n FROM events GROUP BY 1""",
)
def hourly_mean_and_median(t: Tables):
    hourly = t.events.withColumn("hour", F.hour("ts"))
    medians = ag.group_medians(hourly, ["hour"], "value")
    means = hourly.groupBy("hour").agg(F.round(F.avg("value"), 6).alias("mean"), F.count(F.lit(1)).alias("n"))
    return means.join(medians, "hour")


@query(
    "A12",
    """SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd,
    min(value) AS low, max(value) AS high FROM events GROUP BY 1""",
)
def describe_by_type(t: Tables):
    return t.events.groupBy("event_type").agg(
        F.count("value").alias("n"),
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_samp("value"), 6).alias("sd"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


UNIT_HOURS = """u AS (SELECT event_type AS kind, user_id % 5 AS unit, date_trunc('hour', ts) AS ts,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS load,
  CAST(sum(CAST(value AS DECIMAL(18,2)) * (7 + event_id % 5)) AS DOUBLE) AS heat FROM events GROUP BY ALL),
cap AS (SELECT kind, unit, greatest(coalesce(nullif(CASE WHEN unit % 2 = 0 THEN 150.0 ELSE 0.0 END::DOUBLE, 0), max(load)), max(load)) AS capacity
  FROM u GROUP BY kind, unit)"""


def unit_hours(t: Tables):
    """Hourly load and heat of generating units, from event values."""
    heat = (cents("value") * (F.lit(7) + F.col("event_id") % 5)).cast("decimal(24,2)")
    return t.events.groupBy(
        F.col("event_type").alias("kind"), (F.col("user_id") % 5).alias("unit"), F.date_trunc("hour", "ts").alias("ts")
    ).agg(F.sum(cents("value")).cast("double").alias("load"), F.sum(heat).cast("double").alias("heat"))


def with_capacity(hours):
    nameplate = F.when(F.col("unit") % 2 == 0, 150.0).otherwise(0.0)
    top = od.add_group_stats(hours, ["kind", "unit"], _top=F.max("load"))
    return top.withColumn("capacity", ag.estimated_capacity(nameplate, F.col("_top"))).drop("_top")


@query(
    "A13 A14",
    f"""WITH {UNIT_HOURS}, f AS (SELECT * FROM u JOIN cap USING (kind, unit) WHERE load >= 0.3 * capacity AND load > 0)
    SELECT kind, unit, round(sum(heat) / sum(load), 6) AS heat_rate, round(sum(heat / load) / sum(load), 6) AS summed_rate
    FROM f GROUP BY ALL""",
)
def unit_heat_rates(t: Tables):
    hours = with_capacity(unit_hours(t))
    unit = ["kind", "unit"]
    weighted = ag.heat_rates(hours, unit, "load", "heat", "capacity", 0.3)
    summed = ag.heat_rates(hours, unit, "load", "heat", "capacity", 0.3, mode="reference")
    both = weighted.join(summed.withColumnRenamed("heat_rate", "summed_rate"), unit)
    return both.select(*unit, F.round("heat_rate", 6).alias("heat_rate"), F.round("summed_rate", 6).alias("summed_rate"))


@query(
    "A15 A14",
    f"""WITH {UNIT_HOURS} SELECT kind, unit, round(sum(load) / 720 / max(capacity), 9) AS capacity_factor
    FROM u JOIN cap USING (kind, unit) GROUP BY ALL""",
)
def unit_capacity_factor(t: Tables):
    hours = with_capacity(unit_hours(t))
    factors = ag.capacity_factor(hours, ["kind", "unit"], "load", "capacity", F.lit(30 * 24))
    return factors.withColumn("capacity_factor", F.round("capacity_factor", 9))


@query(
    "A16 W11",
    f"""WITH {UNIT_HOURS}, p AS (SELECT *, lag(load) OVER w AS pl, lag(ts) OVER w AS pt FROM u WINDOW w AS (PARTITION BY kind, unit ORDER BY ts)),
    r AS (SELECT kind, unit, CASE WHEN date_diff('hour', pt, ts) = 1 AND load <> 0 AND pl <> 0 THEN (load - pl) / 60 END AS ramp FROM p)
    SELECT kind, unit, round(CASE WHEN max(ramp) > 0 THEN max(ramp) END, 9) AS ramp_up,
    round(CASE WHEN min(ramp) < 0 THEN -min(ramp) END, 9) AS ramp_down FROM r GROUP BY ALL""",
)
def unit_ramp_rates(t: Tables):
    hours = od.segment_hot(unit_hours(t), ["kind", "unit"], "ts")
    ramps = ag.ramp_rates(hours, ["kind", "unit"], "ts", "load")
    return ramps.select("kind", "unit", F.round("ramp_up", 9).alias("ramp_up"), F.round("ramp_down", 9).alias("ramp_down"))


BANDS = " ".join(f"WHEN load < {i / 10} * capacity THEN '< {i}0%'" for i in range(1, 10))
PROFILE = f"""{UNIT_HOURS}, b AS (SELECT kind, unit, CASE {BANDS.replace("< 10%", "< 10%")} WHEN load <= capacity THEN '<100%' ELSE '>100%' END AS bucket
  FROM u JOIN cap USING (kind, unit)),
prof AS (SELECT kind, unit, bucket, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY kind, unit) AS share FROM b GROUP BY kind, unit, bucket)"""


@query("W07 P28", f"WITH {PROFILE} SELECT * FROM prof")
def load_bucket_shares(t: Tables):
    hours = with_capacity(unit_hours(t))
    bands = hours.withColumn("bucket", cl.decile_band(F.col("load"), F.col("capacity")))
    return ag.load_profile(bands, ["kind", "unit"], "bucket")


@query(
    "W06",
    f"""WITH {PROFILE}, r AS (SELECT *, rank() OVER w AS rk, lag(share) OVER w AS lg, lead(share) OVER w AS ld FROM prof
      WINDOW w AS (PARTITION BY kind, unit ORDER BY bucket)),
    p AS (SELECT *, row_number() OVER (PARTITION BY kind, unit ORDER BY rk) AS rn FROM r
      WHERE (lg < share AND ld < share AND share > 5) OR (share > 10 AND bucket <> '< 10%'))
    SELECT kind, unit, bucket, CAST(regexp_extract(bucket, '(\\d+)%', 1) AS INT) - 10 AS minimum_load_pct FROM p WHERE rn = 1""",
)
def minimum_loads(t: Tables):
    hours = with_capacity(unit_hours(t))
    bands = hours.withColumn("bucket", cl.decile_band(F.col("load"), F.col("capacity")))
    profile = ag.load_profile(bands, ["kind", "unit"], "bucket")
    return ag.minimum_stable_load(profile, ["kind", "unit"], "bucket")


@query(
    "A17",
    """SELECT 'l_quantity' AS metric, l_returnflag, min(l_quantity) AS low, round(avg(l_quantity), 6) AS mean, max(l_quantity) AS high FROM lineitem GROUP BY 2
    UNION SELECT 'l_discount', l_returnflag, min(l_discount), round(avg(l_discount), 6), max(l_discount) FROM lineitem GROUP BY 2
    UNION SELECT 'l_tax', l_returnflag, min(l_tax), round(avg(l_tax), 6), max(l_tax) FROM lineitem GROUP BY 2""",
)
def stacked_metrics(t: Tables):
    stacked = ag.metric_summary(t.lineitem, "l_returnflag", ["l_quantity", "l_discount", "l_tax"])
    return stacked.withColumn("mean", F.round("mean", 6))


@query(
    "A18 U07",
    """SELECT 'orders' AS "table", count(*) AS rows FROM orders UNION ALL SELECT 'customer', count(*) FROM customer
    UNION ALL SELECT 'events', count(*) FROM events""",
)
def row_counts(t: Tables):
    return ag.table_counts({"orders": t.orders, "customer": t.customer, "events": t.events})


@query("A19", "SELECT p_type, p_size, count(*) AS n FROM part GROUP BY ALL")
def part_frequencies(t: Tables):
    return t.part.groupBy("p_type", "p_size").agg(F.count(F.lit(1)).alias("n"))


@query(
    "A21 R06",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count_if(o_orderstatus = 'F')::BIGINT AS F,
      count_if(o_orderstatus = 'O')::BIGINT AS O, count_if(o_orderstatus = 'P')::BIGINT AS P FROM orders GROUP BY 1),
    p AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, max(l_extendedprice) AS price FROM lineitem GROUP BY 1)
    SELECT m.month, F, O, P, price FROM m LEFT JOIN p USING (month)""",
)
def monthly_status_with_price(t: Tables):
    monthly = ag.pivot_counts(
        t.orders.select(F.trunc(F.to_date("o_orderdate"), "month").alias("month"), "o_orderstatus"),
        ["month"], "o_orderstatus", ["F", "O", "P"],
    )
    price = t.lineitem.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("month")).agg(
        F.max("l_extendedprice").alias("price")
    )
    return monthly.join(price, "month", "left")


@query(
    "W01 D05",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey, l_suppkey, l_quantity, l_tax, l_discount) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_lines(t: Tables):
    order = [F.desc("l_shipdate"), F.desc("l_extendedprice"), *map(F.asc, ("l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_discount"))]
    return od.top_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )


@query(
    "D05",
    """WITH c AS (SELECT l_orderkey, l_suppkey, count(*) AS copies FROM lineitem GROUP BY 1, 2)
    SELECT copies, count(*) AS keys, sum(copies - 1)::BIGINT AS removed FROM c GROUP BY copies""",
)
def dedup_report(t: Tables):
    """How many lines of an order with one supplier are removed when one of them is kept."""
    return cl.dedup_with_report(t.lineitem, ["l_orderkey", "l_suppkey"], [F.asc("l_linenumber")])[1]


@query("W03", "SELECT p_name, row_number() OVER (ORDER BY p_name) AS name_id FROM (SELECT DISTINCT p_name FROM part)")
def surrogate_ids(t: Tables):
    return od.global_order(t.part.select("p_name").distinct(), [F.asc("p_name")], "name_id")


@query(
    "W05",
    """SELECT user_id, min(CASE WHEN value > 50 THEN CAST(ts AS DATE) END) AS first_date,
    max(CASE WHEN value > 50 THEN CAST(ts AS DATE) END) AS last_date FROM events GROUP BY 1""",
)
def first_last_large(t: Tables):
    shifted = t.events.select("user_id", F.to_date("ts").alias("date"), (F.col("value") - 50).alias("value"))
    return wn.first_last_positive(shifted, ["user_id"])


@query(
    "W08 D06 A07",
    """WITH x AS (SELECT *, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS deviation FROM events
      WINDOW w AS (PARTITION BY event_type))
    SELECT event_id, event_type, value, round(mean, 6) AS mean, round(deviation, 6) AS deviation FROM x
    WHERE abs(value - mean) > 3 * deviation""",
)
def value_outliers(t: Tables):
    flagged = wn.sigma_flags(t.events, ["event_type"], "value", 3.0).where("outlier")
    return flagged.select(
        "event_id", "event_type", "value", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation")
    )


@query(
    "W10 G06",
    """WITH a AS (SELECT event_id, user_id, ts, CASE WHEN event_type <> 'error' THEN value END AS draught FROM events)
    SELECT event_id, user_id, last_value(draught IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_draught,
      first_value(draught IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_draught FROM a""",
)
def prior_and_next_known(t: Tables):
    calls = t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("draught")
    )
    order = ["ts", "event_id"]
    calls = od.segment_hot(calls, ["user_id"], "ts", ties=["event_id"])
    calls = od.add_prior(calls, ["user_id"], order, {"prior_draught": "draught"}, ignore_nulls=True)
    calls = od.add_prior(calls, ["user_id"], order, {"next_draught": "draught"}, ignore_nulls=True, following=True)
    return calls.select("event_id", "user_id", "prior_draught", "next_draught")


@query(
    "W11",
    """SELECT event_id, user_id, date_diff('hour', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts)::INT AS hour_gap FROM events""",
)
def hour_gaps(t: Tables):
    events = od.segment_hot(t.events.select("event_id", "user_id", "ts"), ["user_id"], "ts", ties=["event_id"])
    prior = od.add_prior(events, ["user_id"], ["ts", "event_id"], {"_before": "ts"})
    return prior.select(
        "event_id", "user_id", dt.boundaries_crossed("hour", F.col("_before"), F.col("ts")).alias("hour_gap")
    )


@query(
    "W12",
    """WITH s AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders GROUP BY 1)
    SELECT o_custkey, spent, tile FROM (SELECT *, CAST(ntile(1000) OVER (ORDER BY spent DESC, o_custkey) AS INT) AS tile FROM s) WHERE tile <= 20""",
)
def top_spenders_by_tile(t: Tables):
    spent = t.orders.groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).cast("double").alias("spent"))
    return od.first_tiles(spent, "spent", [F.asc("o_custkey")], 1000, 20)


@query(
    "W14 G07",
    """WITH m AS (SELECT *, lag(event_type) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(CASE WHEN before <> event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM m)
    SELECT user_id, session, count(*) AS steps, arg_min(event_id, (ts, event_id)) AS first_event_id,
    arg_max(event_id, (ts, event_id)) AS last_event_id, arg_max(value, (ts, event_id)) AS last_value FROM s GROUP BY 1, 2""",
)
def type_change_sessions(t: Tables):
    order = ["ts", "event_id"]
    events = od.segment_hot(t.events.drop("props"), ["user_id"], "ts", ties=["event_id"])
    marked = od.add_prior(events, ["user_id"], order, {"_before": "event_type"})
    numbered = wn.sessions(marked, ["user_id"], order, F.col("_before") != F.col("event_type"))
    return wn.compress_sessions(numbered, ["user_id"], "session", order, ["event_id"], ["event_id", "value"])


@query(
    "W04 W10 W14",
    """WITH a AS (SELECT event_id, event_type, ts, CASE WHEN value > 50 THEN value END AS large FROM events)
    SELECT event_id, event_type, row_number() OVER w AS seq, lag(event_id) OVER w AS before, lead(event_id) OVER w AS after,
    last_value(large IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_large,
    count(large) OVER (w ROWS UNBOUNDED PRECEDING) AS large_so_far FROM a WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
)
def sliced_event_types(t: Tables):
    """The types of events are few, so each is a hot key; slices of 1,000 rows show the cut at any scale."""
    keys, order = ["event_type"], ["ts", "event_id"]
    events = t.events.select("event_id", "event_type", "ts", F.when(F.col("value") > 50, F.col("value")).alias("large"))
    cut = od.segment_hot(events, keys, "ts", 1000, ties=["event_id"])
    out = od.add_sequence(cut, keys, order)
    out = od.add_prior(out, keys, order, {"before": "event_id"})
    out = od.add_prior(out, keys, order, {"after": "event_id"}, following=True)
    out = od.add_prior(out, keys, order, {"last_large": "large"}, ignore_nulls=True)
    out = od.add_running(out, keys, order, {"large_so_far": F.when(F.col("large").isNotNull(), 1).otherwise(0).cast("long")})
    return out.drop("_seg", "ts", "large")


@query(
    "W15 K14",
    f"""WITH {DAILY}, r AS (SELECT *, count(*) OVER w AS c, min(value) OVER w AS lo, max(value) OVER w AS hi FROM s
      WINDOW w AS (PARTITION BY name ORDER BY date ROWS 11 PRECEDING))
    SELECT name, date, value, CASE WHEN c = 12 THEN lo END AS low, CASE WHEN c = 12 THEN hi END AS high,
    round(CASE WHEN c = 12 THEN (value - lo) / nullif(hi - lo, 0) END, 9) AS spread FROM r""",
)
def rolling_spread(t: Tables):
    return wn.rolling_range(daily_revenue(t), 12).withColumn("spread", F.round("spread", 9))


@query(
    "W16 K08",
    f"""WITH {DAILY} SELECT name, date, lag(value) OVER w AS prior, round(value / lag(value) OVER w - 1, 9) AS change,
    round(value / lag(value, 5) OVER w - 1, 9) AS change5 FROM s WINDOW w AS (PARTITION BY name ORDER BY date)""",
)
def percent_changes(t: Tables):
    w = wn.series_window()
    series = daily_revenue(t)
    return series.select(
        "name", "date", F.lag("value").over(w).alias("prior"),
        F.round(F.try_divide("value", F.lag("value").over(w)) - 1, 9).alias("change"),
        F.round(F.try_divide("value", F.lag("value", 5).over(w)) - 1, 9).alias("change5"),
    )


@query(
    "W17 K13",
    f"""WITH {DAILY}, l AS (SELECT *, lead(value, 1) OVER w AS v1, lead(value, 2) OVER w AS v2, lead(value, 3) OVER w AS v3 FROM s
      WINDOW w AS (PARTITION BY name ORDER BY date))
    SELECT name, date, value FROM l WHERE abs(sign(v1 - value) + sign(v2 - v1) + sign(v3 - v2)) = 3 AND abs((v3 - v2) / value) >= 0.05""",
)
def series_turning_points(t: Tables):
    return wn.turning_points(daily_revenue(t), 3, 0.05)


@query(
    "W18",
    f"""WITH {DAILY}, f AS (SELECT *, value < 800000 AS f FROM s),
    i AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY date) - row_number() OVER (PARTITION BY name, f ORDER BY date) AS g FROM f)
    SELECT name, count(*) AS length, min(date) AS run_start, max(date) AS run_end FROM i WHERE f GROUP BY name, g""",
)
def low_value_runs(t: Tables):
    return wn.runs(daily_revenue(t), F.col("value") < 800_000)


@query(
    "W19 K20",
    f"""WITH {DAILY}, b AS (SELECT name, CAST((row_number() OVER (PARTITION BY name ORDER BY date) - 1) // 7 AS INT) AS block, date, value FROM s),
    g AS (SELECT name, block, min(date) AS date, round(avg(value), 4) AS mean, count(*) AS n FROM b GROUP BY ALL)
    SELECT *, lag(mean) OVER (PARTITION BY name ORDER BY block) AS prior_mean FROM g""",
)
def weekly_block_means(t: Tables):
    blocks = wn.weekly_blocks(daily_revenue(t))
    return blocks.withColumns({"mean": F.round("mean", 4), "prior_mean": F.round("prior_mean", 4)})


@query("W20 T06", "SELECT p_partkey, p_name, rank() OVER (ORDER BY p_name) AS display_seq FROM part")
def display_sequence(t: Tables):
    return od.global_rank(t.part.select("p_partkey", "p_name"), "p_name", "display_seq")


@query(
    "W21 V11",
    """SELECT o_custkey, version, o_orderkey FROM (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS version, o_orderkey,
    row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def one_order_per_version(t: Tables):
    rows = t.orders.select(
        "o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("version"), "o_orderkey", "o_totalprice"
    )
    best = od.top_per_key(rows, ["o_custkey", "version"], [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return best.drop("o_totalprice")


@query(
    "W02 W13",
    """WITH v AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS version, o_orderstatus AS status FROM orders
      WHERE o_orderdate <= TIMESTAMP '1999-12-31')
    SELECT o_custkey, o_orderkey, version FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY version DESC, o_orderkey DESC) AS rn FROM v)
    WHERE rn = 1 AND status <> 'P'""",
)
def asof_latest_live(t: Tables):
    rows = t.orders.where(F.col("o_orderdate") <= F.lit("1999-12-31").cast("timestamp_ntz")).select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("version"), F.col("o_orderstatus").alias("status")
    )
    latest = od.top_per_key(rows, ["o_custkey"], [F.desc("version"), F.desc("o_orderkey")])
    return latest.where("status <> 'P'").drop("status")


# ---- set operations


@query(
    "U03 U09",
    """SELECT o_orderkey AS id, o_totalprice AS amount, NULL::VARCHAR AS segment FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer""",
)
def union_with_missing_columns(t: Tables):
    old = t.orders.where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount")
    )
    new = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("segment")
    )
    return so.union_all([old, new])


@query(
    "U04 U08",
    """SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N' EXCEPT
    SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'""",
)
def pairs_never_accepted(t: Tables):
    pairs = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag")
    return pairs.where("l_returnflag = 'N'").drop("l_returnflag").subtract(
        pairs.where("l_returnflag = 'A'").drop("l_returnflag")
    )


@query(
    "U05",
    """SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N' INTERSECT
    SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'""",
)
def pairs_in_both(t: Tables):
    pairs = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag")
    return pairs.where("l_returnflag = 'N'").drop("l_returnflag").intersect(
        pairs.where("l_returnflag = 'A'").drop("l_returnflag")
    )


@query(
    "U06 D08",
    """WITH a AS (SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS d FROM orders WHERE o_orderkey % 10 <> 0),
    b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS d FROM orders)
    SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_left,
      (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_right""",
)
def compare_tables(t: Tables):
    left = t.orders.where("o_orderkey % 10 <> 0")
    changed = F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus"))
    right = t.orders.withColumn("o_orderstatus", changed)
    return so.compare(left, right, exclude=["o_totalprice", "o_custkey", "o_orderpriority"])


@query(
    "U08",
    """SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL
    SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O'""",
)
def multiset_difference(t: Tables):
    pairs = t.orders.select("o_custkey", "o_orderpriority", "o_orderstatus")
    return so.multiset_minus(
        pairs.where("o_orderstatus = 'F'").drop("o_orderstatus"), pairs.where("o_orderstatus = 'O'").drop("o_orderstatus")
    )


@query(
    "U07 D08",
    """SELECT 'orders' AS "table", (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS left_rows, (SELECT count(*) FROM orders) AS right_rows,
      (SELECT count(*) FROM orders) - (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS difference
    UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), -1, -1 - (SELECT count(*) FROM customer)""",
)
def compare_row_counts(t: Tables):
    left = {"orders": t.orders.where("o_orderstatus <> 'P'"), "customer": t.customer}
    return so.compare_counts(left, {"orders": t.orders})
