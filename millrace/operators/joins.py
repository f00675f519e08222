"""Join shapes: star, semi/anti, null-safe, as-of, interval, spine, lookup with fallback.

Only tables with a size bound of their own (one row per year, per hour, per region) carry a
broadcast hint. Dimensions that grow with the data are left to the optimiser, which compares their
measured size with the broadcast limit at run time and splits skewed sort-merge partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import HOT_ROWS, add_asof, attach_row, segment_hot
from millrace.session import materialise


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner joins of one fact table with ``(dimension, fact key, dimension key)``."""
    for dim, fact_key, dim_key in dims:
        fact = fact.join(dim, F.col(fact_key) == F.col(dim_key))
    return fact


def left_chain_of_parts(rows: DataFrame, keys: Sequence[str], parts: Mapping[str, tuple[Callable[[Column], Column], Column, str]]) -> DataFrame:
    """Left joins of aggregates over parts of one table to all of its keys, read and grouped once.

    ``parts`` maps a column to (aggregate, condition of the part, column); a key without rows in a part has null.
    """
    return rows.groupBy(*keys).agg(*[fold(F.when(part, F.col(column))).alias(name) for name, (fold, part, column) in parts.items()])


def left_chain(base: DataFrame, others: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left joins of many frames on the same key list; the shuffle of ``base`` is reused."""
    return reduce(lambda left, right: left.join(right, list(keys), "left"), others, base)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join where null matches null. Columns of ``right`` other than the keys are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    joined = left.join(renamed, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def any_case(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Join on text keys regardless of case."""
    return left.join(right, F.lower(F.col(left_key)) == F.lower(F.col(right_key)), how)


def with_side(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with an indicator ``both``, ``left_only`` or ``right_only``."""
    a = left.withColumn("_in_left", F.lit(True))
    b = right.withColumn("_in_right", F.lit(True))
    side = (
        F.when(F.col("_in_left").isNull(), "right_only")
        .when(F.col("_in_right").isNull(), "left_only")
        .otherwise("both")
    )
    return a.join(b, list(keys), "full").withColumn("side", side).drop("_in_left", "_in_right")


def asof(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Mapping[str, str],
    *,
    tie: Column | None = None,
    rows: int = HOT_ROWS,
) -> DataFrame:
    """For each left row the values of the last right row of the key at or before its time.

    Both sides are stacked and the last value is carried forward; work is linear in the rows, whereas
    a range join would emit every earlier pair. Keys with more than ``rows`` rows are cut along time.
    ``tie`` orders right rows with equal times (highest wins).
    """
    keys = list(keys)
    tie = F.lit(0).cast("long") if tie is None else tie.cast("long")
    found = F.struct(*[F.col(src).alias(out) for out, src in values.items()])
    data = F.struct(*left.columns)
    a = left.select(
        *keys, F.col(left_ts).alias("_at"), F.lit(1).alias("_side"), F.lit(0).cast("long").alias("_tie"),
        data.alias("_row"), F.xxhash64(data).alias("_mark"),
    )
    b = right.where(F.col(right_ts).isNotNull()).select(
        *keys, F.col(right_ts).alias("_at"), F.lit(0).alias("_side"), tie.alias("_tie"),
        found.alias("_value"), F.lit(0).cast("long").alias("_mark"),
    )
    stacked = segment_hot(a.unionByName(b, allowMissingColumns=True), keys, "_at", rows, ties=["_side", "_tie", "_mark"])
    filled = add_asof(stacked, keys, ["_at", "_side", "_tie", "_mark"], {"_last": "_value"})
    return filled.where(F.col("_side") == 1).select("_row.*", *[F.col(f"_last.{out}").alias(out) for out in values])


def stretch_join(
    spans: DataFrame, points: DataFrame, keys: Sequence[str], start: str, end: str, at: str, *, rows: int = HOT_ROWS
) -> DataFrame:
    """Every point of the key with ``start < at <= end``, one row per span and point.

    A band join by an equi join on the key and a bucket of time. Buckets are as wide as the spans are long on
    average, so the spans touch about two each, whatever their number. Points of a (key, bucket) with more than
    ``rows`` points are dealt over several tasks and its spans repeated for each. Spans without start or end, or with
    an end before the start, hold no point; spans may overlap. The columns of both sides must have different names.
    """
    keys = list(keys)

    def seconds(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp")) / 1e6

    usable = spans.where(F.col(end) > F.col(start))
    mean = usable.agg(F.avg(seconds(end) - seconds(start))).first()[0]  # one number
    width = max(1.0, mean or 1.0)

    def bucket(column: str) -> Column:
        return F.floor(seconds(column) / width)

    dealt = points.where(F.col(at).isNotNull()).withColumn("_bucket", bucket(at))
    laid = usable.withColumn("_bucket", F.explode(F.sequence(bucket(start), bucket(end))))
    laid = laid.withColumnsRenamed({k: f"_s_{k}" for k in keys})
    hot = materialise(dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows), "hot")
    most = hot.agg(F.max("_n")).first()[0]
    same = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    inside = (F.col(start) < F.col(at)) & (F.col(at) <= F.col(end))
    if most is None:
        joined = dealt.join(laid.withColumnRenamed("_bucket", "_s_bucket"), [*same, F.col("_bucket") == F.col("_s_bucket"), inside])
    else:
        renamed = laid.withColumnsRenamed({f"_s_{k}": k for k in keys})
        joined = salted(dealt, renamed, [*keys, "_bucket"], hot, salts=-(-most // rows)).where(inside)
    return joined.drop("_bucket", "_s_bucket", *[f"_s_{k}" for k in keys])


def in_interval(
    facts: DataFrame, intervals: DataFrame, ts: Column, start: str, end: str, same: Column, how: str = "left"
) -> DataFrame:
    """Attach the calendar interval holding a time. ``same`` is an equality that names the
    candidate (the year), so this stays an equi join. ``intervals`` has one row per year or the like
    (bounded by the calendar), which is why it may be broadcast."""
    cond = same & (ts >= F.col(start)) & (ts < F.col(end))
    return facts.join(F.broadcast(intervals), cond, how)


def hour_spine(days: DataFrame, hours: int = 24) -> DataFrame:
    """Each row of ``days`` repeated for every hour, without a cross join."""
    return days.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))))


def lookup(facts: DataFrame, table: DataFrame, key: str, table_key: str, value: str, out: str) -> DataFrame:
    """Mapped value if the table has the key, else the source value."""
    slim = table.select(F.col(table_key).alias("_k"), F.col(value).alias("_v")).dropDuplicates(["_k"])
    joined = facts.join(slim, F.col(key) == F.col("_k"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_v"), F.col(key))).drop("_k", "_v")


def salted(
    big: DataFrame, other: DataFrame, keys: Sequence[str], hot: DataFrame, salts: int = 64, how: str = "inner"
) -> DataFrame:
    """Equi join that spreads known hot keys over ``salts`` tasks.

    ``hot`` lists the hot key values (one column set named as ``keys``). Rows of ``big`` with a hot
    key get a salt from a hash of the whole row; matching rows of ``other`` are repeated per salt.
    Other rows use salt 0 on both sides and are not repeated. ``how`` may be inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted joins are inner or left")
    keys = list(keys)
    flagged = hot.select(*keys).distinct().withColumn("_hot", F.lit(True))
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(*big.columns), F.lit(salts))).otherwise(F.lit(0))
    a = big.join(flagged, keys, "left").withColumn("_salt", spread.cast("int")).drop("_hot")
    slots = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    b = other.join(flagged, keys, "left").withColumn("_salt", F.explode(slots)).drop("_hot")
    return a.join(b, [*keys, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """Keys holding at least ``share`` of all rows: at most ``1/share`` of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_all"))
    return attach_row(counts, total).where(F.col("_n") >= F.col("_all") * share).select(*keys)


def range_lookup(
    facts: DataFrame, table: DataFrame, key: str, table_key: str, value: str, out: str, *,
    larger: bool = False, rows: int = HOT_ROWS,
) -> DataFrame:
    """Value of the greatest table key not above the fact key; with ``larger``, of the exact key
    or else the next greater one.

    The search runs over distinct fact keys, so a value held by many rows is looked up once.
    """
    wanted = facts.select(F.col(key).cast("double").alias("_at")).where(F.col("_at").isNotNull()).distinct()
    a = wanted.select("_at", F.lit(1).alias("_side"))
    b = table.groupBy(F.col(table_key).cast("double").alias("_at")).agg(F.max(value).alias("_value"))
    b = b.select("_at", F.lit(0).alias("_side"), "_value")
    stacked = segment_hot(a.unionByName(b, allowMissingColumns=True), [], F.col("_at"), rows)
    if larger:
        found = add_asof(stacked.withColumn("_side", -F.col("_side")), [], ["_at", "_side"], {out: "_value"}, following=True)
        found = found.where(F.col("_side") == -1)
    else:
        found = add_asof(stacked, [], ["_at", "_side"], {out: "_value"}).where(F.col("_side") == 1)
    return facts.join(found.select("_at", out), F.col(key).cast("double") == F.col("_at"), "left").drop("_at")
