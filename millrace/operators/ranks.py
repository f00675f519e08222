"""Exact order statistics of columns of any length, without sorting the table.

A mergeable sketch with a certain error bound gives, for every wanted rank, two values that the answer lies
between. One more pass counts the rows below, between and above them exactly; only rows between two such values keep
their value, so that what is ordered afterwards is a small part of the table. If a rank should lie outside its
values, the search is repeated with wider ones, so the answer never rests on the sketch.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import global_running


def _between(low: float | None, high: float | None) -> tuple[float, float]:
    return (-math.inf if low is None else low), (math.inf if high is None else high)


def _joined(spans: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Disjoint spans that cover the given ones."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


def exact_ranks(df: DataFrame, wanted: Mapping[str, Sequence[int]], accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """The values at the given 1-based ranks of each numeric column, ascending, nulls left out.

    Values are compared as doubles. Ranks outside 1…n give None. The result is one number per wanted rank, so it may come to the driver. NaN sorts
    last. All columns share the two passes.
    """
    from pyspark.ml.feature import Bucketizer  # here, so that Python workers need not load Spark ML

    columns = [c for c, ranks in wanted.items() if len(ranks)]
    found: dict[str, list[float | None]] = {c: [None] * len(ranks) for c, ranks in wanted.items()}
    if not columns:
        return found
    known = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns])
    sizes = df.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    numbers = known.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    open_ = {c: sorted({r for r in wanted[c] if 1 <= r <= numbers[c]}) for c in columns}
    answers: dict[tuple[str, int], float] = {(c, r): math.nan for c in columns for r in wanted[c] if numbers[c] < r <= sizes[c]}
    slack = 2
    while any(open_.values()):
        asked = {c: ranks for c, ranks in open_.items() if ranks}
        edges = {c: [min(1.0, max(0.0, (r + s * (slack * numbers[c] / accuracy + 1)) / numbers[c])) for r in ranks for s in (-1, 1)] for c, ranks in asked.items()}
        sketched = known.agg(*[F.percentile_approx(c, e, accuracy).alias(c) for c, e in edges.items()]).first()
        spans, splits = {}, {}
        for c, e in edges.items():
            values = sketched[c]
            # a bound at the end of the scale is no bound
            spans[c] = _joined([_between(values[i] if e[i] > 0 else None, values[i + 1] if e[i + 1] < 1 else None) for i in range(0, len(e), 2)])
            cuts = {-math.inf, math.inf, *(x for low, high in spans[c] for x in (low, float(np.nextafter(high, math.inf))))}
            splits[c] = sorted(cuts)
            if len(splits[c]) == 2:  # all rows are wanted; the model needs three limits
                spans[c], splits[c] = [(-math.inf, 0.0), (0.0, math.inf)], [-math.inf, 0.0, math.inf]
        long = None
        for c in asked:
            rows = known.where(F.col(c).isNotNull()).select(F.lit(c).alias("column"), F.col(c).alias("value"))
            placed = Bucketizer(splits=splits[c], inputCol="value", outputCol="bucket").transform(rows)
            inner = [splits[c].index(low) for low, _ in spans[c]]
            kept = placed.withColumn("value", F.when(F.col("bucket").isin(inner), F.col("value")))
            long = kept if long is None else long.unionByName(kept)
        counts = long.groupBy("column", "bucket", "value").agg(F.count(F.lit(1)).alias("_c"))
        running = global_running(counts, [F.asc("column"), F.asc("bucket"), F.asc("value")], "_c", "_through")
        before, offset = 0, {}
        for c in sorted(asked):
            offset[c], before = before, before + numbers[c]
        ranks = F.create_map(*[x for c, r in asked.items() for x in (F.lit(c), F.array(*[F.lit(offset[c] + k).cast("bigint") for k in r]))])
        hits = running.where(F.col("value").isNotNull()).select(
            "column", "value", F.explode(F.filter(ranks[F.col("column")], lambda k: (k <= F.col("_through")) & (k > F.col("_through") - F.col("_c")))).alias("rank")
        )
        for row in hits.collect():
            answers[row["column"], row["rank"] - offset[row["column"]]] = row["value"]
        open_ = {c: [r for r in ranks if (c, r) not in answers] for c, ranks in asked.items()}
        slack *= 8
    for c, ranks in wanted.items():
        found[c] = [answers.get((c, r)) for r in ranks]
    return found


def exact_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> dict[str, float | None]:
    """The median of each column, the mean of the two middle values for an even count; None without values."""
    sizes = df.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    middle = {c: [(n + 1) // 2, (n + 2) // 2] if n else [] for c, n in sizes.items()}
    found = exact_ranks(df, middle, accuracy)
    return {c: sum(v) / 2 if v else None for c, v in found.items()}
