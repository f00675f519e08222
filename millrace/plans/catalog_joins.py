"""Queries over join operators (survey 2.3) and sorting (2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins as jn
from millrace.operators import ordered as od
from millrace.operators.aggregate import cents
from millrace.plans.registry import Tables, query


def revenue():
    return F.sum(cents("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("double")


REVENUE_SQL = "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE)"


@query(
    "J01 J21 A01 T01",
    f"""SELECT r_name, n_name, c_mktsegment, year(o_orderdate)::INT AS order_year, {REVENUE_SQL} AS revenue, count(*) AS n_lines
    FROM lineitem, orders, customer, nation, region, supplier
    WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey
      AND n_regionkey = r_regionkey AND l_suppkey = s_suppkey AND s_acctbal > 0 GROUP BY ALL""",
)
def star_revenue(t: Tables):
    suppliers = t.supplier.where("s_acctbal > 0").select("s_suppkey")
    joined = jn.star(
        t.lineitem,
        [
            (suppliers, "l_suppkey", "s_suppkey"),
            (t.orders, "l_orderkey", "o_orderkey"),
            (t.customer, "o_custkey", "c_custkey"),
            (t.nation, "c_nationkey", "n_nationkey"),
            (t.region, "n_regionkey", "r_regionkey"),
        ],
    )
    out = joined.groupBy("r_name", "n_name", "c_mktsegment", F.year("o_orderdate").alias("order_year")).agg(
        revenue().alias("revenue"), F.count(F.lit(1)).alias("n_lines")
    )
    return out.orderBy("r_name", "n_name", "c_mktsegment", F.desc("order_year"))


@query(
    "J02",
    """SELECT o_orderkey, o_totalprice, c_mktsegment FROM orders INNER JOIN customer
    ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING' AND c_acctbal > 0""",
)
def orders_of_segment(t: Tables):
    chosen = t.customer.where("c_mktsegment = 'BUILDING' AND c_acctbal > 0")
    return t.orders.join(chosen, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", "c_mktsegment"
    )


@query(
    "J03 J19",
    """WITH b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
    q AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
    a AS (SELECT l_partkey, l_suppkey, max(l_discount) AS top_discount FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
    n AS (SELECT l_partkey, l_suppkey, min(CAST(l_shipdate AS DATE)) AS first_ship FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2)
    SELECT * FROM b LEFT JOIN q USING (l_partkey, l_suppkey) LEFT JOIN a USING (l_partkey, l_suppkey)
    LEFT JOIN n USING (l_partkey, l_suppkey)""",
)
def left_chain_by_flag(t: Tables):
    flag = F.col("l_returnflag")
    lines = t.lineitem.withColumn("shipped", F.to_date("l_shipdate"))
    parts = {"returned": (F.sum, flag == "R", "l_quantity"), "top_discount": (F.max, flag == "A", "l_discount"), "first_ship": (F.min, flag == "N", "shipped")}
    return jn.left_chain_of_parts(lines, ["l_partkey", "l_suppkey"], parts)


@query(
    "J03 J19",
    """WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS spent FROM orders GROUP BY 1),
    e AS (SELECT user_id AS c_custkey, count(*) AS events, max(value) AS top_value FROM events GROUP BY 1)
    SELECT c_custkey, c_mktsegment, orders, spent, events, top_value FROM customer LEFT JOIN o USING (c_custkey) LEFT JOIN e USING (c_custkey)""",
)
def customer_activity(t: Tables):
    """Frames of several tables joined to the customers one after the other."""
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"), F.sum(cents("o_totalprice")).cast("double").alias("spent"))
    events = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("events"), F.max("value").alias("top_value"))
    return jn.left_chain(t.customer.select("c_custkey", "c_mktsegment"), [orders, events], ["c_custkey"])


@query(
    "J04 U02 S32",
    """WITH codes(code, full_name, kind) AS (VALUES ('A','accepted','flag'),('N','new','flag'),('O','open','status'),
      ('F','filled','status'),('R','wrong kind','status'))
    SELECT l_orderkey, l_linenumber, full_name AS label, 'flag' AS kind FROM lineitem
      LEFT JOIN codes ON code = l_returnflag AND codes.kind = 'flag'
    UNION ALL SELECT l_orderkey, l_linenumber, full_name, 'status' FROM lineitem
      LEFT JOIN codes ON code = l_linestatus AND codes.kind = 'status'""",
)
def labelled_codes(t: Tables):
    codes = t.spark.createDataFrame(
        [
            ("A", "accepted", "flag"), ("N", "new", "flag"), ("O", "open", "status"),
            ("F", "filled", "status"), ("R", "wrong kind", "status"),
        ],
        "code string, label string, kind string",
    )

    def side(col, kind):
        wanted = F.broadcast(codes.where(F.col("kind") == kind).drop("kind"))  # five literal rows
        return t.lineitem.join(wanted, F.col(col) == F.col("code"), "left").select(
            "l_orderkey", "l_linenumber", "label", F.lit(kind).alias("kind")
        )

    return side("l_returnflag", "flag").unionByName(side("l_linestatus", "status"))


@query(
    "J05 A01",
    """WITH e AS (SELECT upper(event_type) AS kind, count(*) AS n FROM events GROUP BY 1)
    SELECT event_id, n FROM events JOIN e ON lower(e.kind) = lower(events.event_type)""",
)
def any_case_match(t: Tables):
    kinds = t.events.groupBy(F.upper("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return jn.any_case(t.events, kinds, "event_type", "kind").select("event_id", "n")


@query(
    "J06",
    """WITH a AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag FROM lineitem),
    b AS (SELECT nullif(l_returnflag, 'N') AS flag, l_linestatus, count(*) AS group_rows FROM lineitem GROUP BY 1, 2)
    SELECT a.l_orderkey, a.l_linenumber, a.flag, l_linestatus, group_rows FROM a JOIN b ON coalesce(a.flag, '') = coalesce(b.flag, '')
    """,
)
def null_safe_groups(t: Tables):
    flag = F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", flag)
    groups = t.lineitem.groupBy(flag, "l_linestatus").agg(F.count(F.lit(1)).alias("group_rows"))
    return jn.null_safe(rows, groups, ["flag"])


@query(
    "J07",
    """SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) o
    ON o_custkey = c_custkey WHERE o_custkey IS NULL""",
)
def customers_without_large_orders(t: Tables):
    large = t.orders.where("o_totalprice > 450000").select("o_custkey")
    return t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query(
    "J08",
    """SELECT p_partkey, p_name FROM lineitem RIGHT JOIN part ON l_partkey = p_partkey AND l_quantity > 49
    WHERE l_partkey IS NULL""",
)
def parts_gone_from_source(t: Tables):
    source = t.lineitem.where("l_quantity > 49").select("l_partkey")
    return t.part.join(source, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_name")


@query(
    "J09",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_partkey, l_suppkey) IN
    (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 2)""",
)
def repeated_pairs(t: Tables):
    keys = ["l_partkey", "l_suppkey"]
    repeated = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    return t.lineitem.join(repeated, keys, "left_semi").select("l_orderkey", "l_linenumber", *keys)


@query(
    "J10 W04",
    """WITH s AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events)
    SELECT a.user_id, a.event_id, a.seq, b.event_id AS next_event, b.value - a.value AS step
    FROM s a JOIN s b ON a.user_id = b.user_id AND a.seq = b.seq - 1""",
)
def neighbour_steps(t: Tables):
    events = od.segment_hot(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], "ts", ties=["event_id"])
    numbered = od.add_sequence(events, ["user_id"], ["ts", "event_id"])
    nearby = od.add_prior(
        numbered, ["user_id"], ["ts", "event_id"], {"next_event": "event_id", "next_value": "value"}, following=True
    )
    return nearby.where(F.col("next_event").isNotNull()).select(
        "user_id", "event_id", "seq", "next_event", (F.col("next_value") - F.col("value")).alias("step")
    )


@query(
    "J11 G04",
    """SELECT p.event_id, p.user_id, v.event_id AS view_id, v.value AS view_value FROM
    (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN
    (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def last_view_before_purchase(t: Tables):
    events = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").withColumnRenamed("event_id", "view_id")
    joined = jn.asof(
        purchases, views, ["user_id"], "ts", "ts", {"view_id": "view_id", "view_value": "value"}, tie=F.col("view_id")
    )
    return joined.drop("ts")


@query(
    "J11 G04",
    """WITH p AS (SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prior FROM events WHERE event_type = 'purchase')
    SELECT p.event_id, p.user_id, v.event_id AS view_id, v.value AS view_value FROM p JOIN events v
    ON v.event_type = 'view' AND v.user_id = p.user_id AND v.ts > p.prior AND v.ts <= p.ts""",
)
def views_of_stretches(t: Tables):
    """Every view between a purchase and the user's purchase before it."""
    events = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    purchases = od.segment_hot(events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), ["user_id"], "ts", ties=["event_id"])
    stretches = od.add_prior(purchases, ["user_id"], ["ts", "event_id"], {"prior": "ts"}).drop("_seg")
    views = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("viewed"), F.col("value").alias("view_value"))
    joined = jn.stretch_join(stretches, views, ["user_id"], "prior", "ts", "viewed")
    return joined.select("event_id", "user_id", "view_id", "view_value")


@query(
    "J11",
    """SELECT p.event_id, count(v.event_id) AS earlier_views, max(v.value) AS best_earlier
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p LEFT JOIN
    (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND v.ts <= p.ts GROUP BY p.event_id""",
)
def earlier_views_summary(t: Tables):
    """All earlier rows of the key as a running summary, instead of one output row per pair."""
    events = t.events.where(F.col("event_type").isin("view", "purchase"))
    is_view = F.col("event_type") == "view"
    events = od.segment_hot(events.select("event_id", "user_id", "ts", "event_type", "value"), ["user_id"], "ts", ties=["event_id"])
    order = ["ts", "event_id"]
    counted = od.add_running(events, ["user_id"], order, {"earlier_views": F.when(is_view, 1).otherwise(0).cast("long")})
    best = od.add_running_max(counted, ["user_id"], order, {"best_earlier": F.when(is_view, F.col("value"))})
    return best.where("event_type = 'purchase'").select("event_id", "earlier_views", "best_earlier")


@query(
    "J12",
    """WITH y AS (SELECT DISTINCT year(o_orderdate) AS yr FROM orders),
    d AS (SELECT yr, make_date(CAST(yr AS INT), 3, 10) AS dst_start, make_date(CAST(yr AS INT), 11, 3) AS dst_end FROM y)
    SELECT o_orderkey, CASE WHEN yr IS NOT NULL THEN o_orderdate - INTERVAL 1 HOUR ELSE o_orderdate END AS local_ts
    FROM orders LEFT JOIN d ON o_orderdate >= dst_start AND o_orderdate < dst_end""",
)
def daylight_saving_shift(t: Tables):
    years = t.orders.select(F.year("o_orderdate").alias("yr")).distinct()  # one row per calendar year
    spans = years.select(
        "yr", F.make_date("yr", F.lit(3), F.lit(10)).alias("dst_start"), F.make_date("yr", F.lit(11), F.lit(3)).alias("dst_end")
    )
    joined = jn.in_interval(t.orders, spans, F.col("o_orderdate"), "dst_start", "dst_end", F.year("o_orderdate") == F.col("yr"))
    shifted = F.when(F.col("yr").isNotNull(), F.col("o_orderdate") - F.make_dt_interval(F.lit(0), F.lit(1)))
    return joined.select("o_orderkey", F.coalesce(shifted, F.col("o_orderdate")).alias("local_ts"))


@query(
    "J13 J14 K12",
    """WITH days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM events),
    spine AS (SELECT event_type, day, CAST(h AS INT) AS hour FROM days, generate_series(0, 23) g(h)),
    hourly AS (SELECT event_type, CAST(ts AS DATE) AS day, hour(ts)::INT AS hour, count(*) AS n, sum(CAST(value AS DECIMAL(18,2)))::DOUBLE AS total
      FROM events GROUP BY ALL)
    SELECT event_type, day, hour, n, total FROM spine LEFT JOIN hourly USING (event_type, day, hour)""",
)
def hourly_grid(t: Tables):
    hourly = t.events.groupBy("event_type", F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("value")).cast("double").alias("total")
    )
    spine = jn.hour_spine(hourly.select("event_type", "day").distinct())
    return spine.join(hourly, ["event_type", "day", "hour"], "left")


@query(
    "J15 W02",
    """WITH m AS (SELECT o_custkey, max(o_orderdate) AS latest FROM orders GROUP BY 1)
    SELECT o.o_custkey, max(o.o_orderkey) AS o_orderkey FROM orders o JOIN m ON o.o_custkey = m.o_custkey AND o.o_orderdate = m.latest
    GROUP BY 1""",
)
def latest_order(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey"))


@query(
    "J16 W09",
    """SELECT s_suppkey, s_acctbal, round(avg(s_acctbal) OVER (PARTITION BY s_nationkey), 6) AS nation_mean FROM supplier""",
)
def supplier_with_nation_mean(t: Tables):
    stats = od.add_group_stats(t.supplier, ["s_nationkey"], nation_mean=F.avg("s_acctbal"))
    return stats.select("s_suppkey", "s_acctbal", F.round("nation_mean", 6).alias("nation_mean"))


@query(
    "J17 D03",
    """WITH a AS (SELECT o_custkey AS k, count(*) AS source_rows FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
    b AS (SELECT o_custkey AS k, count(*) AS target_rows FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
    SELECT k, source_rows, target_rows, CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'both' END AS side
    FROM a FULL JOIN b USING (k)""",
)
def counts_by_side(t: Tables):
    def counts(status, name):
        kept = t.orders.where(F.col("o_orderstatus") != status)
        return kept.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias(name))

    return jn.with_side(counts("P", "source_rows"), counts("F", "target_rows"), ["k"])


@query(
    "J18",
    """WITH g AS (SELECT p_size * 2000.0 AS lo, min(p_brand) AS brand FROM part GROUP BY 1)
    SELECT o_orderkey, o_totalprice, brand FROM orders ASOF LEFT JOIN g ON o_totalprice >= lo""",
)
def price_band_lookup(t: Tables):
    grid = t.part.groupBy((F.col("p_size") * 2000.0).alias("lo")).agg(F.min("p_brand").alias("brand"))
    facts = t.orders.select("o_orderkey", "o_totalprice")
    return jn.range_lookup(facts, grid, "o_totalprice", "lo", "brand", "brand")


@query(
    "J18",
    """WITH g AS (SELECT p_size * 2000.0 AS hi, max(p_brand) AS brand FROM part GROUP BY 1)
    SELECT o_orderkey, brand FROM orders ASOF LEFT JOIN g ON o_totalprice <= hi""",
)
def price_band_above(t: Tables):
    grid = t.part.groupBy((F.col("p_size") * 2000.0).alias("hi")).agg(F.max("p_brand").alias("brand"))
    facts = t.orders.select("o_orderkey", "o_totalprice")
    return jn.range_lookup(facts, grid, "o_totalprice", "hi", "brand", "brand", larger=True).drop("o_totalprice")


@query(
    "J20",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F')
    OR o_totalprice > (SELECT avg(o_totalprice) * 1.9 FROM orders)""",
)
def scalar_subquery_filter(t: Tables):
    limits = t.orders.agg(
        F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("_last"),
        (F.avg("o_totalprice") * 1.9).alias("_high"),
    )
    joined = od.attach_row(t.orders, limits)
    return joined.where((F.col("o_orderdate") == F.col("_last")) | (F.col("o_totalprice") > F.col("_high"))).select(
        "o_orderkey", "o_orderdate"
    )


@query(
    "J22 D02",
    """WITH v AS (SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS version, count(*) AS n FROM orders GROUP BY ALL),
    p AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY version DESC) AS rn FROM v
      WHERE version < (SELECT max(version) FROM v))
    SELECT o_custkey, version, n FROM p WHERE rn = 1""",
)
def prior_version_counts(t: Tables):
    version = F.trunc(F.to_date("o_orderdate"), "year")
    counts = t.orders.groupBy("o_custkey", version.alias("version")).agg(F.count(F.lit(1)).alias("n"))
    newest = t.orders.agg(F.max(version).alias("_newest"))
    older = od.attach_row(counts, newest).where(F.col("version") < F.col("_newest")).drop("_newest")
    best = older.groupBy("o_custkey").agg(F.max(F.struct("version", "n")).alias("b"))
    return best.select("o_custkey", "b.version", "b.n")


@query(
    "J23",
    """WITH x AS (SELECT p_name AS alias, min(p_type) AS proper FROM part WHERE p_size > 10 GROUP BY 1)
    SELECT p_partkey, coalesce(proper, p_name) AS proper_name FROM part LEFT JOIN x ON alias = p_name""",
)
def name_with_fallback(t: Tables):
    mapping = t.part.where("p_size > 10").groupBy("p_name").agg(F.min("p_type").alias("proper"))
    return jn.lookup(t.part.select("p_partkey", "p_name"), mapping, "p_name", "p_name", "proper", "proper_name").drop(
        "p_name"
    )


@query(
    "J01",
    """SELECT o_custkey, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS weighted FROM
    (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey, o_orderkey FROM orders) o
    JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def hot_customer_join(t: Tables):
    """One customer holds a third of the orders: the join spreads that key over salts."""
    orders = t.orders.select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderkey",
    )
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    joined = jn.salted(orders, customers, ["o_custkey"], jn.hot_keys(orders, ["o_custkey"], 0.05), salts=16)
    return joined.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("c_acctbal")).cast("double").alias("weighted")
    )


@query(
    "T02 T03 A01",
    """WITH top AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders
      GROUP BY 1 ORDER BY spent DESC, o_custkey LIMIT 10)
    SELECT c_custkey, c_name, spent FROM top JOIN customer ON c_custkey = o_custkey""",
)
def top_customers(t: Tables):
    spent = t.orders.groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).cast("double").alias("spent"))
    top = spent.orderBy(F.desc("spent"), "o_custkey").limit(10)
    # the ten rows are broadcast into the scan of the dimension
    return t.customer.join(F.broadcast(top), F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "c_name", "spent"
    )


@query(
    "T04 T05",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders WHERE o_orderstatus <> 'P') WHERE rn <= 3""",
)
def three_largest_orders(t: Tables):
    done = t.orders.where("o_orderstatus <> 'P'").select("o_custkey", "o_orderkey", "o_totalprice")
    return od.top_per_key(done, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)
