"""Structured Streaming forms of the batch operators. Each takes a streaming frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lateness(rows: DataFrame, ts: str) -> str:
    """Watermark delay that covers landed ``rows`` in any order of arrival: their whole span of time.

    State is then kept over that span. For files that come in order, give a shorter delay instead and
    let ``incremental.ingest_with_late`` put older rows aside.
    """
    at = F.unix_micros(ts)
    span = rows.agg(F.max(at) - F.min(at)).first()[0] or 0
    return f"{span // 1_000_000 + 1} seconds"


def hourly_totals(events: DataFrame, ts: str, keys: Sequence[str], value: Column, late: str = "1 hour") -> DataFrame:
    """K11 as a stream: tumbling hourly count and sum."""
    hours = events.withWatermark(ts, late).groupBy(F.window(ts, "1 hour").alias("_w"), *keys)
    out = hours.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(*keys, F.col("_w.start").alias("hour"), "n", "total")


def activity_sessions(events: DataFrame, ts: str, keys: Sequence[str], gap: str, late: str = "1 hour") -> DataFrame:
    """G07, W14 as a stream: sessions closed by a time gap."""
    grouped = events.withWatermark(ts, late).groupBy(*keys, F.session_window(ts, gap).alias("_w"))
    out = grouped.agg(F.count(F.lit(1)).alias("steps"))
    return out.select(*keys, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), "steps")


def first_of_key(events: DataFrame, ts: str, keys: Sequence[str], late: str = "1 hour") -> DataFrame:
    """W01 as a stream: one row per key while it is within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def flag_against_profile(events: DataFrame, profile: DataFrame, key: str, value: str, m: float = 3.0) -> DataFrame:
    """W08, D06 as a stream: three-sigma flag against a stored profile ``(key, mean, deviation)``."""
    joined = events.join(profile, key, "left")
    return joined.withColumn("outlier", F.coalesce(F.abs(F.col(value) - F.col("mean")) > m * F.col("deviation"), F.lit(False)))
