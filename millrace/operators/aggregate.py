"""Group aggregates, rollups of code prefixes and plant metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.dates import boundaries_crossed
from millrace.operators.ordered import (
    HOT_ROWS,
    add_group_stats,
    add_prior,
    add_running,
    order_statistics,
    segment_hot,
)


def cents(col: str | Column) -> Column:
    """Two-decimal amounts as decimals, so sums do not depend on the order of addition."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """Median of a whole column as a one-row frame, from the sorted value histogram."""
    n = df.agg(F.count(col).alias("_n"))
    ranks = n.select(
        F.explode(F.array(F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2))).alias("rank")
    )
    return order_statistics(df, col, ranks).agg(F.avg("value").alias("median"))


def group_medians(
    df: DataFrame, keys: Sequence[str], col: str, out: str = "median", rows: int = HOT_ROWS
) -> DataFrame:
    """Exact median per group without collecting a group.

    Values are counted per (group, value); running counts find the middle positions, and a group with
    more than ``rows`` distinct values is cut along its value range.
    """
    keys = list(keys)
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_c"))
    running = add_running(segment_hot(counts, keys, F.col(col), rows), keys, [col], {"_through": "_c"})
    sized = add_group_stats(running, keys, _n=F.sum("_c"))
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)
    before = F.col("_through") - F.col("_c")

    def holds(rank: Column) -> Column:
        return (rank > before) & (rank <= F.col("_through"))

    middle = sized.where(holds(low) | holds(high))
    weight = holds(low).cast("int") + holds(high).cast("int")
    return middle.groupBy(*keys).agg((F.sum(F.col(col) * weight) / 2).alias(out))


def prefix_rollup(df: DataFrame, code: str, measure: str, widths: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """Sums per code prefix, each level from the finer one, stacked with its width."""
    level, parts = df.groupBy(*keys, code).agg(F.sum(measure).alias(measure)), []
    for width in sorted(widths, reverse=True):
        level = level.groupBy(*keys, F.substring(code, 1, width).alias(code)).agg(F.sum(measure).alias(measure))
        parts.append(level.select(*keys, code, F.lit(width).alias("width"), measure))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def metric_summary(df: DataFrame, by: str, metrics: Sequence[str]) -> DataFrame:
    """Min, average and max of each metric by type, one pass over unpivoted metrics."""
    long = df.select(by, *metrics).unpivot([by], list(metrics), "metric", "value")
    return long.groupBy("metric", by).agg(
        F.min("value").alias("low"), F.avg("value").alias("mean"), F.max("value").alias("high")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables in one result."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def share_of_total(df: DataFrame, keys: Sequence[str], measure: Column, out: str = "share") -> DataFrame:
    """Group sums with their percent of the grand total; the total is one row."""
    groups = df.groupBy(*keys).agg(measure.alias("amount"))
    return add_group_stats(groups, [], _all=F.sum("amount")).select(
        *keys, "amount", (F.col("amount") * 100.0 / F.col("_all")).alias(out)
    )


def estimated_capacity(nameplate: Column, max_load: Column) -> Column:
    """The greater of the two, where a null or zero nameplate falls back to the observed load."""
    return F.greatest(F.coalesce(F.nullif(nameplate, F.lit(0.0)), max_load), max_load)


def heat_rates(
    df: DataFrame,
    unit: Sequence[str],
    load: str,
    heat: str,
    capacity: str,
    floor: float = 0.9,
    mode: str = "weighted",
) -> DataFrame:
    """Heat rate of the hours at or above ``floor`` of capacity.

    ``weighted`` is Σheat / Σload. ``reference`` adds up rate / Σload, the formula of the source
    queries, whose numerator is not load-weighted.
    """
    running = df.where((F.col(load) >= F.lit(floor) * F.col(capacity)) & (F.col(load) > 0))
    total = F.sum(load)
    if mode == "weighted":
        rate = F.sum(heat) / total
    elif mode == "reference":
        rate = F.sum(F.col(heat) / F.col(load)) / total
    else:
        raise ValueError(f"unknown mode {mode}")
    return running.groupBy(*unit).agg(rate.alias("heat_rate"))


def capacity_factor(df: DataFrame, unit: Sequence[str], load: str, capacity: str, hours: Column) -> DataFrame:
    """Σload / hours / capacity per unit; ``hours`` allows for a partial year."""
    grouped = df.groupBy(*unit).agg(F.sum(load).alias("_load"), F.max(capacity).alias("_capacity"))
    return grouped.select(
        *unit, F.try_divide(F.col("_load") / hours, F.nullif(F.col("_capacity"), F.lit(0.0))).alias("capacity_factor")
    )


def ramp_rates(df: DataFrame, unit: Sequence[str], ts: str, load: str) -> DataFrame:
    """Largest rise and fall per minute between neighbouring hours with load in both.

    ``df`` needs a ``_seg`` column (see ``ordered``); one row per unit and hour.
    """
    prior = add_prior(df, unit, [ts], {"_prev_load": load, "_prev_ts": ts})
    hours = boundaries_crossed("hour", F.col("_prev_ts"), F.col(ts))
    valid = (hours == 1) & (F.col(load) != 0) & (F.col("_prev_load") != 0)
    step = F.when(valid, (F.col(load) - F.col("_prev_load")) / 60)
    up, down = F.max(step), F.min(step)
    return prior.groupBy(*unit).agg(
        F.when(up > 0, up).alias("ramp_up"), F.when(down < 0, -down).alias("ramp_down")
    )


def pivot_counts(df: DataFrame, row: Sequence[str], col: str, values: Sequence[str]) -> DataFrame:
    """Counts per row key and listed column value; absent combinations are zero."""
    return df.groupBy(*row).pivot(col, list(values)).count().na.fill(0)


def load_profile(df: DataFrame, unit: Sequence[str], bucket: str) -> DataFrame:
    """Share of running time per load bucket."""
    counts = df.where(F.col(bucket).isNotNull()).groupBy(*unit, bucket).agg(F.count(F.lit(1)).alias("n"))
    shared = add_group_stats(counts, unit, _total=F.sum("n"))
    return shared.select(*unit, bucket, "n", (F.col("n") * 100.0 / F.col("_total")).alias("share"))


def minimum_stable_load(profile: DataFrame, unit: Sequence[str], bucket: str) -> DataFrame:
    """Lowest bucket that is a local peak of running time.

    A unit has at most eleven buckets, so these windows are small by construction. A peak is above
    both neighbours and above 5 %, or above 10 % outside the first bucket.
    """
    order = Window.partitionBy(*unit).orderBy(bucket)
    ranked = profile.select(
        *unit,
        bucket,
        "share",
        F.rank().over(order).alias("_rank"),
        F.lag("share").over(order).alias("_lag"),
        F.lead("share").over(order).alias("_lead"),
    )
    share = F.col("share")
    peak = ((F.col("_lag") < share) & (F.col("_lead") < share) & (share > 5)) | (
        (share > 10) & (F.col(bucket) != "< 10%")
    )
    lowest = ranked.where(peak).groupBy(*unit).agg(F.min_by(bucket, "_rank").alias("bucket"))
    # bands are labelled by their upper edge; '<100%' starts at 90, '>100%' has its edge at 100
    edge = F.regexp_extract("bucket", r"(\d+)%", 1).cast("int")
    return lowest.select(*unit, "bucket", (edge - 10).alias("minimum_load_pct"))
