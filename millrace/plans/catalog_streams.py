"""Queries over incremental and streaming operators (survey 2.16) and the job runner."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from millrace.operators.ordered import attach_row
from millrace.operators.versioning import RunLog
from millrace.plans.jobs import run_job
from millrace.plans.registry import Tables, query
from millrace.session import scratch_path
from millrace.streaming import incremental as inc
from millrace.streaming import stateful as sf
from millrace.streaming import streams as st


EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def late(t: Tables, path: str) -> str:
    """Files may be listed in any order, so rows can come late by the whole span of the files."""
    return st.lateness(t.spark.read.schema(EVENT_SCHEMA).parquet(path), "ts")


#: Events of a file of the streams that land in more files the more events there are.
FILE_ROWS = 500_000


def landed(t: Tables, name: str, files: int = 3) -> str:
    """Events written as several files, in time order within the folder."""
    path = scratch_path(t.spark, name)
    t.events.drop("props").withColumn("ts", F.col("ts").cast("timestamp")).repartitionByRange(files, "ts").write.parquet(path)
    return path


def event_stream(t: Tables, path: str, files: int = 1):
    return t.spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files).parquet(path)


@query("I01", "SELECT event_id, value FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE event_id % 2 = 0 AND ts < TIMESTAMP '2024-01-20')")
def rows_after_mark(t: Tables):
    target = t.events.where((F.col("event_id") % 2 == 0) & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")))
    return inc.rows_after(t.events.select("event_id", "value"), target, "event_id")


@query("I02 S08", "SELECT l_orderkey // 4000 AS chunk, count(*) AS n, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem GROUP BY 1")
def key_range_chunks(t: Tables):
    """Every chunk of a key range that a job resuming from an empty target would load, from one scan."""
    newest = t.lineitem.agg(F.max("l_orderkey")).first()[0]
    numbered = t.lineitem.select("l_orderkey", inc.chunk_of(F.col("l_orderkey"), None, newest or 0, 4000).alias("chunk"))
    return numbered.where(F.col("chunk").isNotNull()).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"))


@query("I04", "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'")
def dates_to_load(t: Tables):
    days = t.events.select(F.to_date("ts").alias("day"))
    return days.where(inc.next_dates("day", F.lit("2024-01-10").cast("date"), F.lit("2024-01-21").cast("date"))).distinct()


@query("I03 I01", "SELECT event_id, event_type, value FROM events")
def new_files_only(t: Tables):
    """Two arrivals of files, two runs; the second run loads the new files only."""
    source, target, marks = (scratch_path(t.spark, n) for n in ("arrivals", "loaded", "marks"))
    rows = t.events.select("event_id", "event_type", "value")
    schema = "event_id bigint, event_type string, value double"
    rows.where("event_id % 2 = 0").write.parquet(source)
    inc.ingest_new_files(t.spark, schema, source, target, marks)
    rows.where("event_id % 2 = 1").write.mode("append").parquet(source)
    inc.ingest_new_files(t.spark, schema, source, target, marks)
    return t.spark.read.parquet(target)


@query(
    "I03 I01",
    """SELECT event_id, ts < TIMESTAMP '2024-01-16' AND ts < (SELECT max(ts) FROM events) - INTERVAL 1 DAY AS late FROM events""",
)
def late_files_kept(t: Tables):
    """The older half of the events lands last; all rows are kept, those beyond the delay apart."""
    source, target, marks, seen = (scratch_path(t.spark, n) for n in ("late-source", "kept", "newest", "marks"))
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    recent = F.col("ts") >= F.lit("2024-01-16").cast("timestamp")
    for part in (recent, ~recent):
        rows.where(part).write.mode("append").parquet(source)
        inc.ingest_with_late(t.spark, "event_id bigint, ts timestamp", source, target, marks, seen, "ts", "1 day")
    return t.spark.read.schema("event_id bigint, ts timestamp, late boolean, batch int").parquet(target).select("event_id", "late")


@query("I05 I06", "SELECT event_id, CAST(ts AS DATE) AS published FROM events")
def published_batches(t: Tables):
    source, target, marks = (scratch_path(t.spark, n) for n in ("published", "loaded", "marks"))
    rows = t.events.select("event_id", F.to_date("ts").alias("published")).repartitionByRange(4, "published")
    # every date arrives twice, in two loads
    for rest in (0, 1):
        rows.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(source)
        inc.load_by_partition(t.spark, "event_id bigint, published date", source, target, marks, "published")
    return t.spark.read.parquet(target).select("event_id", "published")


@query(
    "I03 K11",
    """SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS n, sum(CAST(value AS DECIMAL(18,2)))::DOUBLE AS total FROM events GROUP BY 1, 2""",
)
def streamed_hourly_totals(t: Tables):
    out, marks, source = scratch_path(t.spark, "hourly"), scratch_path(t.spark, "marks"), landed(t, "landed")
    rows = st.hourly_totals(event_stream(t, source), "ts", ["event_type"], F.col("value").cast("decimal(18,2)"), late(t, source))
    inc.write_updates(rows, out, marks)
    newest = inc.newest_updates(t.spark, out, ["event_type", "hour"])
    return newest.select("event_type", F.col("hour").cast("timestamp_ntz").alias("hour"), "n", F.col("total").cast("double").alias("total"))


@query(
    "I03 K11",
    """SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS n, sum(CAST(value AS DECIMAL(18,2)))::DOUBLE AS total FROM events GROUP BY 1, 2""",
)
def corrected_hourly_totals(t: Tables):
    """Events that arrive in two parts, the older one last, through a stream whose state is the hours of one day."""
    out, marks, source = (scratch_path(t.spark, n) for n in ("corrected", "marks", "parts"))
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    for rest in (0, 1):
        rows.where(F.dayofmonth("ts") % 2 == rest).repartitionByRange(2, "ts").write.mode("append").parquet(source)
    # a last row of each type, two days beyond its events, closes what is open
    ends = rows.groupBy("event_type").agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("bigint").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"), F.lit(None).cast("bigint").alias("user_id"), "event_type", F.lit(None).cast("double").alias("value")
    )
    with sf.state_store(t.spark):
        for part in (None, ends):
            if part is not None:
                part.write.mode("append").parquet(source)
            totals = sf.hour_totals(event_stream(t, source), "ts", "event_type", F.round(F.col("value") * 100), delay=24 * sf.HOUR)
            inc.write_updates(totals, out, marks, mode="append")
    summed = sf.summed_hours(t.spark.read.parquet(out))
    return summed.select(F.col("key").alias("event_type"), "hour", "n", "total")


@query(
    "I03 W14 G07",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 4 HOUR AS session_end, count(*) AS steps FROM s GROUP BY user_id, sid""",
)
def streamed_sessions(t: Tables):
    out, marks, source = scratch_path(t.spark, "sessions"), scratch_path(t.spark, "marks"), landed(t, "landed")
    sessions = st.activity_sessions(event_stream(t, source), "ts", ["user_id"], "4 hours", late(t, source))
    inc.write_updates(sessions, out, marks, mode="complete")
    rows = t.spark.read.parquet(out)
    last = rows.agg(F.max("batch").alias("_last"))  # a complete-mode batch holds the whole result
    final = rows.join(F.broadcast(last), F.col("batch") == F.col("_last"))
    return final.select(
        "user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "steps"
    )


@query(
    "I03 W14 G07",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
    SELECT user_id::VARCHAR AS user_id, date_trunc('millisecond', min(ts)) AS session_start, date_trunc('millisecond', max(ts)) AS last_step, count(*) AS steps FROM s GROUP BY user_id, sid""",
)
def corrected_sessions(t: Tables):
    """Events whose older half lands last; sessions are state for one day, later rows are joined to theirs afterwards."""
    out, marks, source = (scratch_path(t.spark, n) for n in ("stretches", "marks", "halves"))
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    files = max(2, -(-rows.count() // FILE_ROWS))  # of a half
    for rest in (1, 0):
        rows.where(F.dayofmonth("ts") % 2 == rest).repartitionByRange(files, "ts").write.mode("append").parquet(source)
    # a last row of each user, three days beyond all events, closes what is open
    latest = rows.agg(F.max("ts")).first()[0]
    ends = rows.select("user_id").distinct().select(
        F.lit(-1).cast("bigint").alias("event_id"), (F.lit(latest) + F.expr("INTERVAL 3 DAYS")).cast("timestamp").alias("ts"), "user_id", F.lit("end").alias("event_type"), F.lit(None).cast("double").alias("value")
    )
    gap = 4 * sf.HOUR
    with sf.state_store(t.spark):
        for part in (None, ends):
            if part is not None:
                part.write.mode("append").parquet(source)
            # a batch a half, however many files it takes: every batch visits the state of its users
            found = sf.session_stretches(event_stream(t, source, files), "ts", "user_id", gap, 24 * sf.HOUR, F.col("event_id") >= 0)
            inc.write_updates(found, out, marks, mode="append")
    sessions = sf.whole_sessions(t.spark.read.parquet(out), gap)
    start, last = (F.timestamp_millis(c).cast("timestamp_ntz") for c in ("first", "last"))
    return sessions.select(F.col("key").alias("user_id"), start.alias("session_start"), last.alias("last_step"), "steps")


@query("I03 W01", "SELECT DISTINCT event_id, event_type FROM events")
def streamed_first_of_key(t: Tables):
    """Every event lands twice within the watermark and is kept once."""
    source, out, marks = (scratch_path(t.spark, n) for n in ("twice", "once", "marks"))
    rows = t.events.drop("props").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.unionByName(rows).repartitionByRange(3, "ts").write.parquet(source)
    once = st.first_of_key(event_stream(t, source), "ts", ["event_id"], late(t, source))
    inc.write_updates(once.select("event_id", "event_type"), out, marks, mode="append")
    return t.spark.read.parquet(out).select("event_id", "event_type")


@query(
    "I03 W08 D06",
    """WITH p AS (SELECT event_type, avg(value) AS mean, stddev_samp(value) AS deviation FROM events WHERE ts < TIMESTAMP '2024-01-11' GROUP BY 1)
    SELECT event_id, abs(value - mean) > 3 * deviation AS outlier FROM events JOIN p USING (event_type)""",
)
def streamed_outliers(t: Tables):
    out, marks = scratch_path(t.spark, "flags"), scratch_path(t.spark, "marks")
    early = t.events.where(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"))
    profile = early.groupBy("event_type").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("deviation"))
    flagged = st.flag_against_profile(event_stream(t, landed(t, "landed")), profile, "event_type", "value")
    inc.write_updates(flagged.select("event_id", "outlier"), out, marks, mode="append")
    return t.spark.read.parquet(out).select("event_id", "outlier")


@query(
    "I03 W02 V05",
    """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY user_id""",
)
def streamed_latest_state(t: Tables):
    out, marks = scratch_path(t.spark, "latest"), scratch_path(t.spark, "marks")
    newest = event_stream(t, landed(t, "landed")).groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("s"))
    inc.write_updates(newest.select("user_id", "s.event_id", "s.ts"), out, marks)
    return inc.newest_updates(t.spark, out, ["user_id"]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "S29 V14 T05",
    """SELECT 'orders_job' AS appname, 'C' AS status, count(*) AS recsinserted, (SELECT count(*) FROM orders WHERE o_totalprice > 20000 AND o_orderstatus <> 'P') AS stored FROM orders
    WHERE o_totalprice > 20000 AND o_orderstatus <> 'P'""",
)
def logged_job(t: Tables):
    """A declared job from text files to a partitioned table, with its run log."""
    source, target, log_path = (scratch_path(t.spark, n) for n in ("job-in", "job-out", "job-log"))
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "NaN").otherwise(F.col("o_orderstatus")), F.format_string("%.2f", "o_totalprice"), day).write.csv(source)
    config = {
        "name": "orders_job",
        "table": {
            "schemaName": "stage", "table": "orders",
            "fields": [
                {"name": "o_orderkey", "type": "BIGINT"}, {"name": "o_orderstatus", "type": "VARCHAR"}, {"name": "o_totalprice", "type": "DECIMAL", "size": "18,2"},
                {"name": "o_orderdate", "type": "VARCHAR"}, {"name": "year", "type": "INTEGER", "computed": "Y", "isPartitioned": "Y"},
            ],
        },
        "read": {"format": "delimited", "path": source},
        "steps": [
            {"step": "nan_to_null"},
            {"step": "filter", "where": "o_orderstatus IS NOT NULL AND o_totalprice > 20000"},
            {"step": "format_date", "column": "o_orderdate", "pattern": "dd/MM/yyyy"},
            {"step": "add_columns", "columns": {"year": "year(to_date(o_orderdate))"}},
        ],
        "write": {"path": target, "partition_by": ["year"]},
    }
    log = RunLog(t.spark, log_path)
    run_job(t.spark, config, datetime(2024, 1, 2, 3, 4, 5), log)
    stored = t.spark.read.parquet(target).agg(F.count(F.lit(1)).alias("stored"))
    return attach_row(log.last_good().select("appname", "status", "recsinserted"), stored)
