"""Ranges of doc_id as partitions, without computing the rows twice."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Limits that are compared one by one; longer lists are searched in two steps.
STEP = 128


def _reached(limits: list[tuple[int, float]], key: Column, turn: Column) -> Column:
    """How many of the sorted limits (key, turn) are at or below a row's."""

    def counted(some: Column) -> Column:
        return F.size(F.filter(some, lambda x: (x["key"] < key) | (x["key"] == key) & (x["turn"] <= turn)))

    def listed(some: list[tuple[int, float]]) -> Column:
        both = [F.array(*[F.lit(x) for x in c]).cast(f"array<{kind}>") for c, kind in zip(zip(*some, strict=True), ("bigint", "double"), strict=True)]
        return F.arrays_zip(both[0].alias("key"), both[1].alias("turn"))

    if not limits:
        return F.lit(0)
    if len(limits) <= STEP:
        return counted(listed(limits))
    coarse = counted(listed(limits[::STEP]))
    return F.when(coarse > 0, (coarse - 1) * STEP + counted(F.slice(listed(limits), F.greatest((coarse - 1) * STEP + 1, F.lit(1)), F.lit(STEP)))).otherwise(0)


def with_ranges(rows: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """``rows`` with ``part``, the number of the key's range, and ``turn`` added, and the number of ranges.

    Ranges ascend by key, missing keys first, then by ``turn``, a number from 0 to 1 drawn from the text. The limits
    are quantiles of the key, so the ranges are about equal and only the limits pass through the driver. A
    key that many rows share, or that many rows lack, is cut into several ranges by ``turn``. A range
    partitioning by Spark itself would compute the rows a second time to sample them.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    found = rows.agg(F.percentile_approx(key, shares, max(10_000, 20 * parts)), F.count("*"), F.count(key)).first()
    quantiles, total, known = found[0] or [], found[1], found[2]
    nameless = max(1, round(parts * (total - known) / total)) if total > known else 0
    limits: list[tuple[int, float]] = []
    for value, times in sorted(Counter(quantiles).items()):
        limits += [(value, i / times) for i in range(times)]
        if times > 1 and value < (1 << 63) - 1:  # the other keys of the interval have a range of their own
            limits.append((value + 1, 0.0))
    turn = F.shiftrightunsigned(F.xxhash64(text), 11) / F.lit(float(1 << 53))
    named = rows.withColumn("turn", turn)
    part = F.lit(nameless) + _reached(sorted(set(limits)), F.col(key), F.col("turn"))
    missing = F.floor(F.col("turn") * nameless)
    return named.withColumn("part", F.when(F.col(key).isNull(), missing).otherwise(part).cast("int")), nameless + len(set(limits)) + 1
