"""Queries over projection, filtering and cleansing operators (survey 2.2, 2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import dates as dt
from millrace.functions import text as tx
from millrace.operators import aggregate as ag
from millrace.operators import cleanse as cl
from millrace.operators.ordered import attach_row
from millrace.plans.registry import Tables, query

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("total", T.DecimalType(18, 2)),
        T.StructField("day", T.DateType()),
    ]
)


@query(
    "P01 P02 S02",
    """SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS total,
    CAST(o_orderdate AS DATE) AS day FROM orders""",
)
def typed_orders(t: Tables):
    text = t.orders.select(
        F.col("o_orderkey").cast("string"),
        F.format_string("%.2f", "o_totalprice"),
        F.to_date("o_orderdate").cast("string"),
    )
    typed = cl.conform(cl.rename_by_position(text, ORDER_SCHEMA), ORDER_SCHEMA)
    return typed.withColumn("total", F.col("total").cast("double"))


@query(
    "P03 P04 P05 P30 P31",
    """SELECT event_id,
      CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS amount,
      CASE event_type WHEN 'click' THEN 'C' WHEN 'view' THEN 'V' ELSE upper(event_type) END AS kind,
      coalesce(nullif(event_type, 'error'), 'none') AS named
    FROM events""",
)
def null_markers(t: Tables):
    raw = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 14 == 0, "NaN")
        .when(F.col("event_id") % 7 == 0, " w ")
        .otherwise(F.col("value").cast("string"))
        .alias("amount"),
        F.upper("event_type").alias("kind"),
        F.col("event_type").alias("named"),
    )
    clean = cl.map_values(cl.nan_text_to_null(raw), {"kind": {"CLICK": "C", "VIEW": "V"}})
    return clean.select(
        "event_id",
        tx.number_or_null(F.col("amount")).alias("amount"),
        "kind",
        F.coalesce(F.nullif(F.col("named"), F.lit("error")), F.lit("none")).alias("named"),
    )


@query(
    "P05 P07 P08 P10",
    """SELECT doc_id, length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS ascii_chars,
      md5(replace(replace(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'), chr(10), ' '), '  ', ' ')) AS text_md5,
      translate(source, '$%&@s', 'dpnaS') AS source_key
    FROM documents""",
)
def ascii_documents(t: Tables):
    plain = t.documents.select("doc_id", "source", tx.strip_non_ascii(F.col("text")).alias("text"))
    return plain.select(
        "doc_id",
        F.length("text").cast("long").alias("ascii_chars"),
        F.md5(tx.replace_in_order(F.col("text"), [("\n", " "), ("  ", " ")])).alias("text_md5"),
        tx.map_symbols(F.col("source"), "$%&@s", "dpnaS").alias("source_key"),
    )


@query("P09", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def repaired_text(t: Tables):
    # the stored text, misread as Latin-1 the way a wrong loader would, then repaired
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return t.documents.select("doc_id", F.md5(tx.repair_utf8(broken)).alias("text_md5"))


@query(
    "P11",
    """SELECT c_custkey, concat_ws('.', replace(c_name, '#', ''), 'N', CAST(c_nationkey AS VARCHAR)) AS series_key,
    right('0000' || CAST(c_nationkey AS VARCHAR), 4) AS nation_code FROM customer""",
)
def synthesised_keys(t: Tables):
    return t.customer.select(
        "c_custkey",
        tx.key_of(F.col("c_name"), F.lit("N"), F.col("c_nationkey").cast("string"), drop="#").alias("series_key"),
        tx.zero_pad(F.col("c_nationkey"), 4).alias("nation_code"),
    )


@query(
    "P14 P33 P15",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag || '.' || l_linestatus AS code FROM lineitem
    WHERE l_quantity > 10 AND l_discount IS NOT NULL AND l_extendedprice <> -999
      AND regexp_matches(l_returnflag, '(A|R)') AND (l_returnflag || '.' || l_linestatus) NOT LIKE '%.O'""",
)
def filtered_lines(t: Tables):
    lines = t.lineitem.where("l_quantity > 10 AND l_discount IS NOT NULL AND l_extendedprice <> -999")
    lines = lines.where(F.col("l_returnflag").rlike("(A|R)"))
    coded = lines.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.concat_ws(".", "l_returnflag", "l_linestatus").alias("code")
    )
    return cl.drop_suffixes(coded, "code", [".O"])


@query(
    "P16 A09",
    """SELECT DISTINCT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount FROM lineitem
    WHERE nullif(l_discount, 0) IS NOT NULL""",
)
def distinct_complete_lines(t: Tables):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount")
    )
    return lines.na.drop("all").na.drop("any").dropDuplicates()


@query(
    "P17",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed_date,
    CAST(o_orderdate AS TIMESTAMP) + INTERVAL 9 HOUR + INTERVAL 30 MINUTE AS parsed_ts FROM orders
    WHERE year(o_orderdate) >= 2000
    UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE),
    CAST(o_orderdate AS TIMESTAMP) + INTERVAL 9 HOUR + INTERVAL 30 MINUTE FROM orders WHERE year(o_orderdate) < 2000""",
)
def dates_by_length(t: Tables):
    day = F.col("o_orderdate")
    late = F.year(day) >= 2000
    text = (
        F.when(late & (F.col("o_orderkey") % 3 == 0), F.date_format(day, "yyMMdd"))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.date_format(day, "yyyyMMdd"), F.lit(".0")))
        .otherwise(F.date_format(day, "yyyyMMdd"))
    )
    stamp = F.concat(F.date_format(day, "yyyyMMdd"), F.lit("0930"))
    return t.orders.select(
        "o_orderkey", dt.date_by_length(text).alias("parsed_date"), dt.timestamp_minutes(stamp).alias("parsed_ts")
    )


@query(
    "P18 P19 P20",
    """SELECT o_orderkey,
      CASE o_orderkey % 6 WHEN 0 THEN 'Q' WHEN 1 THEN 'Q' WHEN 2 THEN 'Y' WHEN 3 THEN 'M' WHEN 4 THEN '' ELSE '' END
        AS kind,
      CAST(CASE o_orderkey % 6 WHEN 0 THEN date_trunc('quarter', o_orderdate) WHEN 1 THEN date_trunc('quarter', o_orderdate)
        WHEN 2 THEN date_trunc('year', o_orderdate) WHEN 3 THEN date_trunc('month', o_orderdate)
        WHEN 4 THEN date_trunc('month', o_orderdate) ELSE date_trunc('month', o_orderdate) END AS DATE) AS period_start
    FROM orders""",
)
def period_codes(t: Tables):
    day = F.col("o_orderdate")
    quarter, year = F.quarter(day).cast("string"), F.year(day).cast("string")
    which = F.col("o_orderkey") % 6
    code = (
        F.when(which == 0, F.concat(F.lit("Q"), quarter, year))
        .when(which == 1, F.concat(year, F.lit("Q"), quarter))
        .when(which == 2, year)
        .when(which == 3, F.upper(F.date_format(day, "MMMyyyy")))
        .when(which == 4, F.date_format(day, "MMM yyyy"))
        .otherwise(F.concat(F.date_format(day, "MMM"), F.lit(" "), year))
    )
    return t.orders.select(
        "o_orderkey", dt.period_type(code).alias("kind"), dt.period_start(code).alias("period_start")
    )


@query(
    "P21 P06 P31",
    """SELECT o_orderkey, 'Q' || quarter(o_orderdate) || ' ' || year(o_orderdate) AS quarter_label,
      CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start,
      strftime(o_orderdate, '%Y-%m-%d') AS iso_day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS iso_ts,
      make_date(CAST(year(o_orderdate) AS INT), CAST(month(o_orderdate) AS INT), 15) AS mid_month
    FROM orders""",
)
def quarter_and_iso(t: Tables):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        dt.quarter_label(day).alias("quarter_label"),
        dt.quarter_start(day).alias("quarter_start"),
        dt.reformat_iso(F.date_format(day, "MM/dd/yyyy"), "MM/dd/yyyy").alias("iso_day"),
        dt.reformat_iso(F.date_format(day, "dd-MM-yyyy HH:mm:ss"), "dd-MM-yyyy HH:mm:ss").alias("iso_ts"),
        dt.mid_month(F.year(day), F.month(day)).alias("mid_month"),
    )


@query(
    "P22",
    """SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance,
      CAST(c_nationkey AS DOUBLE) / 100 AS rate, c_nationkey AS term,
      CASE WHEN c_nationkey % 5 = 0 THEN 0 WHEN c_nationkey % 5 = 1 THEN NULL ELSE c_nationkey END AS tenure
    FROM customer""",
)
def phrase_numbers(t: Tables):
    nation = F.col("c_nationkey").cast("string")
    tenure = (
        F.when(F.col("c_nationkey") % 5 == 0, "< 1 year")
        .when(F.col("c_nationkey") % 5 == 1, "n/a")
        .otherwise(F.concat(nation, F.lit("+ years")))
    )
    raw = t.customer.select(
        "c_custkey",
        F.concat(F.lit("$"), F.format_number("c_acctbal", 2)).alias("balance"),
        F.concat(nation, F.lit("%")).alias("rate"),
        F.concat(nation, F.lit(" months")).alias("term"),
        tenure.alias("tenure"),
    )
    return raw.select(
        "c_custkey",
        tx.money(F.col("balance")).alias("balance"),
        tx.percent(F.col("rate")).alias("rate"),
        tx.first_number(F.col("term")).alias("term"),
        tx.tenure_years(F.col("tenure")).alias("tenure"),
    )


@query("P23", "SELECT event_id, value FROM events WHERE value > 1 AND value < 120 AND user_id > 0")
def plausible_events(t: Tables):
    return cl.in_ranges(t.events, {"value": (1, 120), "user_id": (0, None)}).select("event_id", "value")


@query(
    "P24",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value FROM events)
    SELECT event_id, coalesce(value, (SELECT median(value) FROM e)) AS value, coalesce(value, 0) AS zero_filled FROM e""",
)
def imputed_values(t: Tables):
    holes = t.events.select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))
    both = cl.fill_zero(holes.withColumn("zero_filled", F.col("value")), ["zero_filled"])
    return cl.fill_median(both, ["value"]).select("event_id", "value", "zero_filled")


@query(
    "P25",
    """WITH s AS (SELECT 'P' || l_partkey AS name, CAST(l_shipdate AS DATE) AS date, l_discount AS value FROM lineitem),
    k AS (SELECT name FROM s GROUP BY name HAVING count_if(value = 0) = 0 AND count_if(value IS NULL) = 0
      AND min(value) < max(value))
    SELECT s.name, count(*) AS n, min(date) AS first_date FROM s JOIN k USING (name) GROUP BY s.name""",
)
def pruned_series(t: Tables):
    series = t.lineitem.select(
        F.concat(F.lit("P"), F.col("l_partkey")).alias("name"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_discount").alias("value"),
    )
    kept = cl.prune_series(series)
    return kept.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"))


@query(
    "P25",
    """WITH c AS (SELECT l_suppkey, CASE WHEN l_quantity <= 46 THEN 0 ELSE l_quantity END AS v, count(*) AS c
      FROM lineitem GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY c DESC, v DESC) AS rn FROM c)
    SELECT 'S' || l_suppkey AS name, CAST(sum(c) AS BIGINT) AS n, count(*) AS distinct_values,
      count(*) = 1 OR (coalesce(max(CASE WHEN rn = 1 THEN c END) / max(CASE WHEN rn = 2 THEN c END), 'inf'::DOUBLE) > 19
        AND count(*) * 100.0 / sum(c) <= 10) AS near_zero
    FROM r GROUP BY l_suppkey""",
)
def near_constant_series(t: Tables):
    series = t.lineitem.select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("name"),
        F.when(F.col("l_quantity") <= 46, 0.0).otherwise(F.col("l_quantity")).alias("value"),
    )
    return cl.near_zero_variance(series)


@query(
    "P26",
    """SELECT n_nationkey, n_name AS country, count(c_custkey) AS customers
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def country_from_phrase(t: Tables):
    label = F.concat(F.lit("Imports from "), F.col("n_name"), F.lit(" of all goods"))
    phrases = t.customer.groupBy("c_nationkey").count()
    joined = t.nation.join(phrases, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        "n_nationkey",
        tx.between_words(label).alias("country"),
        F.coalesce(F.col("count"), F.lit(0)).alias("customers"),
    )


@query(
    "P27 J09",
    """SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (
      SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
      WHERE r_name IN ('ASIA', 'EUROPE') OR n_nationkey % 7 = 3)""",
)
def customers_by_geography(t: Tables):
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    nations = nations.where(F.col("r_name").isin("ASIA", "EUROPE") | (F.col("n_nationkey") % 7 == 3))
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select(
        "c_custkey", "c_name"
    )


@query(
    "P28 P29",
    """SELECT l_orderkey, l_linenumber, l_quantity,
      CASE WHEN l_quantity < 0.1 * 40 THEN '< 10%' WHEN l_quantity < 0.2 * 40 THEN '< 20%'
        WHEN l_quantity < 0.3 * 40 THEN '< 30%' WHEN l_quantity < 0.4 * 40 THEN '< 40%'
        WHEN l_quantity < 0.5 * 40 THEN '< 50%' WHEN l_quantity < 0.6 * 40 THEN '< 60%'
        WHEN l_quantity < 0.7 * 40 THEN '< 70%' WHEN l_quantity < 0.8 * 40 THEN '< 80%'
        WHEN l_quantity < 0.9 * 40 THEN '< 90%' WHEN l_quantity <= 40 THEN '<100%' ELSE '>100%' END AS band,
      CASE WHEN l_discount <= 0.02 THEN 1 WHEN l_discount <= 0.05 THEN 2 WHEN l_discount <= 0.08 THEN 3 ELSE 4 END AS bin
    FROM lineitem""",
)
def load_bands(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        cl.decile_band(F.col("l_quantity"), F.lit(40.0)).alias("band"),
        cl.right_closed_cut(F.col("l_discount"), [0.02, 0.05, 0.08]).alias("bin"),
    )


@query(
    "P32 P34",
    """SELECT p_partkey, replace(p_name, 'red ', 'rd ') AS p_name, 'catalogue' AS source, 'N' AS dst_flag,
      coalesce(nullif(p_brand, 'Brand#1'), 'unbranded') AS p_brand FROM part""",
)
def tagged_parts(t: Tables):
    parts = t.part.select("p_partkey", "p_name", F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("p_brand"))
    parts = cl.tag_source(parts, {"source": "catalogue"}, [("red ", "rd ")])
    return cl.add_missing(parts, {"dst_flag": "N", "p_brand": "unbranded"})


@query(
    "P35 A20",
    """SELECT event_id, user_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events
    WHERE event_id % 2000 <> 0""",
)
def drop_rarely_missing(t: Tables):
    holes = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 2000 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"),
    )
    return cl.drop_rare_nulls(holes)


@query(
    "A20",
    """WITH e AS (SELECT CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value,
        CASE WHEN event_id % 9 = 0 THEN NULL ELSE user_id END AS user_id FROM events)
    SELECT 'value' AS "column", count_if(value IS NULL)::BIGINT AS missing, count_if(value IS NULL)::BIGINT / count(*) AS share FROM e
    UNION ALL SELECT 'user_id', count_if(user_id IS NULL)::BIGINT, count_if(user_id IS NULL)::BIGINT / count(*) FROM e""",
)
def missing_report(t: Tables):
    holes = t.events.select(
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 9 != 0, F.col("user_id")).alias("user_id"),
    )
    return cl.null_shares(holes)


@query(
    "D09",
    """WITH s AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi, count(*) AS real_count,
      CASE CAST(o_custkey % 6 AS INT) WHEN 0 THEN 'ANNL' WHEN 1 THEN 'MONT' WHEN 2 THEN 'QUAR' WHEN 3 THEN 'WFR'
        WHEN 4 THEN 'SANN' ELSE 'DAY' END AS frequency FROM orders GROUP BY o_custkey),
    x AS (SELECT *, CAST(CASE frequency WHEN 'ANNL' THEN date_diff('year', lo, hi) + 1 WHEN 'MONT' THEN date_diff('month', lo, hi) + 1
      WHEN 'QUAR' THEN date_diff('quarter', lo, hi) + 1 WHEN 'WFR' THEN date_diff('day', lo, hi) // 7 + 1
      WHEN 'SANN' THEN floor((date_diff('day', lo, hi) + 1) / 365.0::DOUBLE * 2) + 1
      ELSE date_diff('day', lo, hi) + 1 END AS INT) AS expected FROM s)
    SELECT o_custkey, frequency, real_count, expected FROM x WHERE real_count <> expected""",
)
def observation_gaps(t: Tables):
    day = F.to_date("o_orderdate")
    codes = F.array(*[F.lit(c) for c in ("ANNL", "MONT", "QUAR", "WFR", "SANN", "DAY")])
    series = t.orders.groupBy("o_custkey").agg(
        F.min(day).alias("lo"), F.max(day).alias("hi"), F.count(F.lit(1)).alias("real_count")
    )
    series = series.withColumn("frequency", F.get(codes, (F.col("o_custkey") % 6).cast("int")))
    series = series.withColumn("expected", dt.expected_observations(F.col("frequency"), F.col("lo"), F.col("hi")))
    return series.where(F.col("real_count") != F.col("expected")).select(
        "o_custkey", "frequency", "real_count", "expected"
    )


WORKDAY_SQL = """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) AS e FROM orders),
  c AS (SELECT o_orderkey, s, e, unnest(generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM d)
  SELECT o_orderkey, CAST(count_if(day < e AND isodow(day) >= 6) AS INT) AS weekend_days,
    CAST(count_if(day < e AND isodow(day) < 6) AS INT) AS work_days FROM c GROUP BY o_orderkey"""


@query("P21", WORKDAY_SQL)
def work_day_counts(t: Tables):
    start = F.to_date("o_orderdate")
    end = F.date_add(start, (F.col("o_orderkey") % 60).cast("int"))
    return t.orders.select(
        "o_orderkey",
        dt.weekend_days(start, end).alias("weekend_days"),
        dt.work_days(start, end).alias("work_days"),
    )


@query(
    "P17",
    """SELECT event_id, date_trunc('minute', ts) AS stamp, CAST((event_id % 39 + 1) AS INT) AS number
    FROM events""",
)
def chinese_phrases(t: Tables):
    """Localised date phrases built from event times and read back."""
    digits = "零一二三四五六七八九"

    def numeral(value):
        tens, ones = F.floor(value / 10).cast("int"), (value % 10).cast("int")
        head = F.when(tens == 0, "").when(tens == 1, "十").otherwise(
            F.concat(F.substring(F.lit(digits), tens + 1, F.lit(1)), F.lit("十"))
        )
        tail = F.when((ones == 0) & (tens > 0), "").otherwise(F.substring(F.lit(digits), ones + 1, F.lit(1)))
        return F.concat(head, tail)

    ts = F.col("ts")
    hour = F.hour(ts)
    phrase = F.concat(
        F.year(ts).cast("string"), F.lit("年"), numeral(F.month(ts)), F.lit("月"), numeral(F.dayofmonth(ts)),
        F.lit("日"), F.when(hour >= 12, "下午").otherwise("上午"),
        numeral(F.when(hour > 12, hour - 12).otherwise(hour)), F.lit("点"), numeral(F.minute(ts)), F.lit("分"),
    )
    return t.events.select(
        "event_id",
        dt.chinese_timestamp(phrase, F.lit("2000-01-01").cast("date")).alias("stamp"),
        dt.chinese_number(numeral(F.col("event_id") % 39 + 1)).alias("number"),
    )
