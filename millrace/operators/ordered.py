"""Ordered computations that keep no whole hot group in one task.

A plain window over ``partitionBy(key)`` sorts every row of a key in a single task, so one hot key
stalls the job. ``segment_hot`` cuts the rows of hot keys, and only those, into *segments* along the
order column. Every ``(key, segment)`` is then a window of its own, and one summary row per segment
carries the state across segment borders. There are about (hot rows / ``HOT_ROWS``) segments, so the
summaries are broadcast and the rows themselves are shuffled once, as for a plain window; operators
chained on the same keys share that shuffle.

For an order over the whole table, ``global_order`` uses the range-partitioned sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialise

SEG = "_seg"
HOT_ROWS = 1_000_000  # rows of one key that a single task sorts comfortably


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, as a scalar subquery (no join); null if empty."""
    fields = [F.col(f"_row.{c}").alias(c) for c in row.columns]
    return df.withColumn("_row", row.select(F.struct("*")).scalar()).select(*df.columns, *fields)


def segment_hot(
    df: DataFrame, keys: Sequence[str], position: str | Column, rows: int = HOT_ROWS, out: str = SEG, ties: Sequence[str] = ()
) -> DataFrame:
    """Cut only keys with more than ``rows`` rows, each into slices of about ``rows`` along ``position``.

    Other keys get the null segment, so for them everything built on top is a plain window. The list
    of hot keys has at most (table rows / ``rows``) entries, which bounds the broadcast. It is
    computed eagerly, by one aggregation over the key.

    Rows of hot keys are dealt into equal ranges of (key, ``position``, ``ties``) and written once with
    the number of their range, the segment. Ranges follow the rows and not the width of the positions,
    so a burst is cut like anything else. ``ties`` are the further columns of the order that is used
    later; without them the rows of one position stay together.
    """
    keys = list(keys)
    at = F.col(position) if isinstance(position, str) else position
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
    # counted once, before the plan is built: without hot keys nothing else is added to it
    hot = materialise(hot, "hot")
    total = hot.agg(F.sum("_n")).first()[0]
    if total is None:
        return df.withColumn(out, F.lit(None))
    marked = _join_back(df, hot, keys, small=True) if keys else attach_row(df, hot)
    order = [F.col(c).asc_nulls_first() for c in keys] + [at.asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in ties]
    dealt = marked.where(F.col("_n").isNotNull()).drop("_n").repartitionByRange(-(-total // rows), *order)
    dealt = materialise(dealt.withColumn(out, F.spark_partition_id()), "hot-rows")
    return dealt.unionByName(marked.where(F.col("_n").isNull()).drop("_n").withColumn(out, F.lit(None).cast("int")))


def _segmented(df: DataFrame, seg: str) -> bool:
    """False when ``segment_hot`` found no hot key and left an untyped null column."""
    return not isinstance(df.schema[seg].dataType, T.NullType)


def _sort(cols: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in cols]


def _join_back(df: DataFrame, summary: DataFrame, on: Sequence[str], small: bool = False) -> DataFrame:
    """Left join on null-safe keys; ``summary`` has one row per key, so rows are not multiplied."""
    renamed = summary.withColumnsRenamed({c: f"_r_{c}" for c in on})
    renamed = F.broadcast(renamed) if small else renamed
    cond = None
    for c in on:
        part = df[c].eqNullSafe(renamed[f"_r_{c}"])
        cond = part if cond is None else cond & part
    return df.join(renamed, cond, "left").drop(*[f"_r_{c}" for c in on])


def add_prior(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Mapping[str, str],
    *,
    seg: str = SEG,
    ignore_nulls: bool = False,
    following: bool = False,
) -> DataFrame:
    """For each ``out: src`` add the value of ``src`` on the previous row of the key.

    ``ignore_nulls`` takes the closest earlier non-null value. ``following`` looks forward instead.
    ``order`` must be unique within a key and non-null.
    """
    keys, order = list(keys), list(order)
    if not _segmented(df, seg):
        window = Window.partitionBy(*keys).orderBy(*_sort(order, following))
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns(
            {o: F.last(F.col(c), True).over(before) if ignore_nulls else F.lag(F.col(c)).over(window) for o, c in cols.items()}
        )
    window = Window.partitionBy(*keys, seg).orderBy(*_sort(order, following))
    across = Window.partitionBy(*keys).orderBy(*_sort([seg], following))
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    pick = F.min_by if following else F.max_by
    position = F.struct(*order)

    local, ends, carried = {}, [], {}
    for out, src in cols.items():
        if ignore_nulls:
            local[f"_l_{out}"] = F.last(F.col(src), True).over(before)
            ends.append(pick(F.col(src), F.when(F.col(src).isNotNull(), position)).alias(f"_e_{out}"))
            carried[f"_c_{out}"] = F.last(F.col(f"_e_{out}"), True).over(
                across.rowsBetween(Window.unboundedPreceding, -1)
            )
        else:
            local[f"_l_{out}"] = F.lag(F.col(src)).over(window)
            ends.append(pick(F.col(src), position).alias(f"_e_{out}"))
            carried[f"_c_{out}"] = F.lag(F.col(f"_e_{out}")).over(across)

    summary = df.where(F.col(seg).isNotNull()).groupBy(*keys, seg).agg(*ends)
    summary = summary.select(*keys, seg, *[expr.alias(name) for name, expr in carried.items()])
    first = F.row_number().over(window) == 1
    body = df.select("*", *[expr.alias(name) for name, expr in local.items()], first.alias("_first"))
    joined = _join_back(body, summary, [*keys, seg], small=True)
    results = {}
    for out in cols:
        here, carry = F.col(f"_l_{out}"), F.col(f"_c_{out}")
        results[out] = F.coalesce(here, carry) if ignore_nulls else F.when(F.col("_first"), carry).otherwise(here)
    helper = [f"_{p}_{out}" for out in cols for p in "lc"]
    return joined.withColumns(results).drop("_first", *helper)


def _add_cumulative(df, keys, order, values, seg, fold, merge) -> DataFrame:
    """Cumulative ``fold`` per key: the segment's own running value merged with that of earlier segments."""
    keys, order = list(keys), list(order)
    value = {out: (F.col(src) if isinstance(src, str) else src) for out, src in values.items()}
    if not _segmented(df, seg):
        plain = Window.partitionBy(*keys).orderBy(*_sort(order, False))
        plain = plain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        none = F.lit(None)
        return df.withColumns({out: merge(none, fold(v).over(plain)) for out, v in value.items()})
    window = Window.partitionBy(*keys, seg).orderBy(*_sort(order, False))
    window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*keys).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.where(F.col(seg).isNotNull()).groupBy(*keys, seg).agg(*[fold(v).alias(f"_t_{out}") for out, v in value.items()])
    totals = totals.select(*keys, seg, *[fold(f"_t_{out}").over(across).alias(f"_c_{out}") for out in value])
    body = df.select("*", *[fold(v).over(window).alias(f"_l_{out}") for out, v in value.items()])
    joined = _join_back(body, totals, [*keys, seg], small=True)
    results = {out: merge(F.col(f"_c_{out}"), F.col(f"_l_{out}")) for out in value}
    return joined.withColumns(results).drop(*[f"_{p}_{out}" for out in value for p in "lc"])


def add_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, str | Column],
    *,
    seg: str = SEG,
) -> DataFrame:
    """Running totals per key."""
    zero = F.lit(0)
    return _add_cumulative(df, keys, order, sums, seg, F.sum, lambda c, x: F.coalesce(c, zero) + F.coalesce(x, zero))


def add_running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, str | Column],
    *,
    seg: str = SEG,
) -> DataFrame:
    """Running maxima per key; null until the first non-null value."""
    return _add_cumulative(df, keys, order, values, seg, F.max, F.greatest)


def add_sequence(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "seq", *, seg: str = SEG
) -> DataFrame:
    """``row_number`` per key (W04), as a running count."""
    return add_running(df, keys, order, {out: F.lit(1).cast("long")}, seg=seg)


def add_asof(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Mapping[str, str],
    *,
    seg: str = SEG,
    following: bool = False,
) -> DataFrame:
    """Latest non-null value at or before each row (J11, J18): the building block of an as-of join.
    ``following`` gives the first one at or after the row."""
    wanted = {f"_p_{out}": src for out, src in cols.items()}
    prior = add_prior(df, keys, order, wanted, seg=seg, ignore_nulls=True, following=following)
    found = {out: F.coalesce(F.col(src), F.col(f"_p_{out}")) for out, src in cols.items()}
    return prior.withColumns(found).drop(*[f"_p_{out}" for out in cols])


_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def _positions(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition and sort, then pin each row's (partition, row) position in a written table."""
    placed = df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id())
    return materialise(placed, "ordered").withColumn("_part", F.shiftright("_pos", _ROW_BITS).cast("int"))


def global_order(df: DataFrame, order: Sequence[Column], out: str = "rn") -> DataFrame:
    """``row_number`` over the whole table without a single-task window.

    The offsets table has one row per sort partition, which is what bounds the broadcast.
    """
    placed = _positions(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranked = placed.join(F.broadcast(offsets), "_part")
    return ranked.withColumn(out, F.col("_offset") + within + 1).drop("_part", "_pos", "_offset")


def global_running(df: DataFrame, order: Sequence[Column], value: str, out: str) -> DataFrame:
    """Running sum of ``value`` over the whole table in ``order``, one range partition per task."""
    placed = _positions(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = placed.groupBy("_part").agg(F.sum(value).alias("_n"))
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    body = placed.withColumn("_local", F.sum(value).over(inside)).join(F.broadcast(offsets), "_part")
    return body.withColumn(out, F.col("_offset") + F.col("_local")).drop("_part", "_pos", "_offset", "_local")


def global_ntile(df: DataFrame, order: Sequence[Column], n: int, out: str = "tile") -> DataFrame:
    """``ntile(n)`` over the whole table: larger tiles first, as in SQL."""
    ranked = global_order(df, order, "_rn")
    total = ranked.agg(F.count(F.lit(1)).alias("_total"))
    small, extra = F.floor(F.col("_total") / n), F.col("_total") % n
    edge = extra * (small + 1)
    tile = F.when(F.col("_rn") <= edge, F.floor((F.col("_rn") - 1) / (small + 1)) + 1).otherwise(
        extra + F.floor((F.col("_rn") - 1 - edge) / F.greatest(small, F.lit(1))) + 1
    )
    return attach_row(ranked, total).withColumn(out, tile.cast("int")).drop("_rn", "_total")


def first_tiles(df: DataFrame, by: str, ties: Sequence[Column], n: int, upto: int, out: str = "tile") -> DataFrame:
    """The first ``upto`` tiles of ``ntile(n)`` in descending order of ``by``, nulls last, without sorting the rest.

    An exact rank selection finds the value that the last wanted row has; only rows from it on are ordered.
    """
    from millrace.operators.ranks import exact_ranks  # which builds on this module

    held = materialise(df, "tiles")
    row = held.agg(F.count(F.lit(1)), F.count(by)).first()
    total, known = row
    small, extra = divmod(total, n)
    wanted = upto * small + min(upto, extra)
    if wanted < known:
        least = exact_ranks(held, {by: [known - wanted + 1]})[by][0] if wanted else None
        held = held.where(F.lit(False)) if least is None else held.where(F.col(by) >= F.lit(least))
    ranked = global_order(held, [F.col(by).desc_nulls_last(), *ties], "_rn").where(F.col("_rn") <= wanted)
    edge = extra * (small + 1)
    later = extra + F.floor((F.col("_rn") - 1 - edge) / max(small, 1)) + 1
    tile = F.when(F.col("_rn") <= edge, F.floor((F.col("_rn") - 1) / (small + 1)) + 1).otherwise(later)
    return ranked.withColumn(out, tile.cast("int")).drop("_rn")


def global_rank(df: DataFrame, col: str, out: str = "rank", *, descending: bool = False) -> DataFrame:
    """``rank`` over the whole table by one column: 1 + number of rows before the value."""
    histogram = df.groupBy(col).agg(F.count(F.lit(1)).alias("_count"))
    ranked = global_running(histogram, _sort([col], descending), "_count", "_through")
    ranked = ranked.select(col, (F.col("_through") - F.col("_count") + 1).alias(out))
    return _join_back(df, ranked, [col])


def order_statistics(df: DataFrame, col: str, ranks: DataFrame, rank_col: str = "rank") -> DataFrame:
    """Exact values at the given 1-based ranks (``ranks`` is a small frame of wanted positions).

    Works on the value histogram, so repeated values cost one row each and no group is collected.
    """
    histogram = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_count"))
    ranked = global_running(histogram, [F.col(col).asc()], "_count", "_through")
    spans = ranked.select(F.col(col).alias("value"), (F.col("_through") - F.col("_count")).alias("_from"), "_through")
    listed = ranks.agg(F.collect_list(rank_col).alias("_ranks"))
    inside = F.filter("_ranks", lambda r: (r > F.col("_from")) & (r <= F.col("_through")))
    held = attach_row(spans, listed).select("value", inside.alias("_hit")).where(F.size("_hit") > 0)
    return held.select(F.explode("_hit").alias(rank_col), "value")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows per key.

    ``row_number() <= k`` becomes a group limit in each map task before the shuffle, so a hot key
    sends at most ``k`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= k).drop("_rn")


def add_group_stats(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Attach whole-group aggregates to each row.

    Partial aggregation first and a join back, instead of a window that holds the whole group.
    """
    keys = list(keys)
    stats = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])
    if not keys:
        return attach_row(df, stats)
    return _join_back(df, stats, keys)
