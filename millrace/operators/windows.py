"""Sessions, outlier flags, rolling frames and runs.

Windows over raw rows use the segmented forms of ``ordered``. Windows over *series* (one row per
name and date) are plain: such a group is bounded by the calendar, whatever the data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import add_group_stats, add_running


def series_window(order: str = "date", keys: Sequence[str] = ("name",)):
    return Window.partitionBy(*keys).orderBy(order)


def sessions(df: DataFrame, keys: Sequence[str], order: Sequence[str], marker: Column, out: str = "session") -> DataFrame:
    """Session number = running count of rows where ``marker`` is true. Needs a segment column."""
    return add_running(df, keys, order, {out: F.when(marker, 1).otherwise(0).cast("long")})


def compress_sessions(
    df: DataFrame, keys: Sequence[str], session: str, order: Sequence[str], first: Sequence[str], last: Sequence[str]
) -> DataFrame:
    """First and last values per session, by aggregation (no sort of the session)."""
    at = F.struct(*order)
    return df.groupBy(*keys, session).agg(
        F.count(F.lit(1)).alias("steps"),
        *[F.min_by(c, at).alias(f"first_{c}") for c in first],
        *[F.max_by(c, at).alias(f"last_{c}") for c in last],
    )


def sigma_flags(df: DataFrame, keys: Sequence[str], col: str, m: float = 3.0) -> DataFrame:
    """Group mean, sample deviation and a flag for values further than ``m`` deviations."""
    stats = add_group_stats(df, keys, mean=F.avg(col), deviation=F.stddev_samp(col))
    far = F.abs(F.col(col) - F.col("mean")) > F.lit(m) * F.col("deviation")
    return stats.withColumn("outlier", F.coalesce(far, F.lit(False)))


def rolling_range(series: DataFrame, n: int, value: str = "value") -> DataFrame:
    """Rolling low, high and position between them over ``n`` rows, null until the frame is full."""
    frame = series_window().rowsBetween(-(n - 1), 0)
    full = F.count(F.lit(1)).over(frame) == n
    low = F.when(full, F.min(value).over(frame))
    high = F.when(full, F.max(value).over(frame))
    out = series.withColumns({"low": low, "high": high})
    spread = F.try_divide(F.col(value) - F.col("low"), F.col("high") - F.col("low"))
    return out.withColumn("spread", spread)


def turning_points(series: DataFrame, k: int = 3, magnitude: float = 0.05) -> DataFrame:
    """Points followed by ``k`` changes in one direction whose last step is at least
    ``magnitude`` of the starting value."""
    w = series_window()
    ahead = [F.lead("value", i).over(w) for i in range(k + 1)]
    steps = [ahead[i + 1] - ahead[i] for i in range(k)]
    direction = F.lit(0)
    for step in steps:
        direction = direction + F.signum(step)
    last = F.abs(F.try_divide(steps[-1], F.col("value")))
    flagged = series.select("*", direction.alias("_direction"), last.alias("_last"))
    return flagged.where((F.abs("_direction") == k) & (F.col("_last") >= magnitude)).drop("_direction", "_last")


def runs(series: DataFrame, flag: Column, keys: Sequence[str] = ("name",), order: str = "date") -> DataFrame:
    """Lengths of runs of rows where ``flag`` holds, by the difference of two row numbers."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = series.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    both = marked.withColumns(
        {
            "_all": F.row_number().over(w),
            "_same": F.row_number().over(Window.partitionBy(*keys, "_flag").orderBy(order)),
        }
    )
    hit = both.where("_flag").withColumn("_island", F.col("_all") - F.col("_same"))
    return hit.groupBy(*keys, "_island").agg(
        F.count(F.lit(1)).alias("length"), F.min(order).alias("run_start"), F.max(order).alias("run_end")
    ).drop("_island")


def weekly_blocks(series: DataFrame, size: int = 7) -> DataFrame:
    """Mean of each block of ``size`` rows with the mean of the block before."""
    numbered = series.withColumn("block", F.floor((F.row_number().over(series_window()) - 1) / size).cast("int"))
    blocks = numbered.groupBy("name", "block").agg(
        F.min("date").alias("date"), F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n")
    )
    return blocks.withColumn("prior_mean", F.lag("mean").over(series_window("block")))


def first_last_positive(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "value") -> DataFrame:
    """First and last date with a positive value, by conditional aggregation instead of two ranks."""
    positive = F.when(F.col(value) > 0, F.col(date))
    return df.groupBy(*keys).agg(F.min(positive).alias("first_date"), F.max(positive).alias("last_date"))
