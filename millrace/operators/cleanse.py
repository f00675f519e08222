"""Projection, filtering and cleansing over whole frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text as tx
from millrace.operators.ordered import top_per_key
from millrace.operators.ranks import exact_medians


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast each column that differs from ``schema`` in one projection; bad values become null."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = [
        F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cols)


def rename_by_position(df: DataFrame, names: Sequence[str] | T.StructType) -> DataFrame:
    """New names in column order."""
    names = names.fieldNames() if isinstance(names, T.StructType) else list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """New names by old name."""
    return df.withColumnsRenamed(dict(mapping))


def nan_text_to_null(df: DataFrame, token: str = "NaN") -> DataFrame:
    """The text ``NaN`` is null in every string column."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(token)) for c in _strings(df)})


def map_values(df: DataFrame, mappings: Mapping[str, Mapping[str, str | None]]) -> DataFrame:
    """Exact symbol → value map per column."""
    return df.withColumns({c: tx.exact_map(F.col(c), m) for c, m in mappings.items()})


def replace_everywhere(df: DataFrame, pattern: str, repl: str) -> DataFrame:
    """Regular-expression replacement over all string columns."""
    return df.withColumns({c: F.regexp_replace(c, pattern, repl) for c in _strings(df)})


def add_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Columns an older file lacks, with a default; existing nulls get the default too."""
    cols = {}
    for name, value in defaults.items():
        cols[name] = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
    return df.withColumns(cols)


def tag_source(df: DataFrame, tags: Mapping[str, str], repairs: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """Constant source columns on each row, after repairing bad tokens in the text columns."""
    repairs = list(repairs)
    fixed = df.withColumns({c: tx.replace_in_order(F.col(c), repairs) for c in _strings(df)}) if repairs else df
    return fixed.withColumns({name: F.lit(value) for name, value in tags.items()})


def drop_suffixes(df: DataFrame, col: str, suffixes: Sequence[str]) -> DataFrame:
    """Drop rows whose key ends in one of the suffixes; a null key stays out, as with NOT LIKE."""
    keep = F.col(col).isNotNull()
    for suffix in suffixes:
        keep = keep & ~F.col(col).endswith(suffix)
    return df.where(keep)


def null_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and share per column, one pass, long form ``(column, missing, share)``."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot(["_n"], columns, "column", "missing")
    return long.select("column", "missing", F.try_divide(F.col("missing"), F.col("_n")).alias("share"))


def drop_rare_nulls(df: DataFrame, max_share: float = 0.001) -> DataFrame:
    """Drop rows null in any column whose share of nulls is at most ``max_share``.

    The shares are one row per column (bounded by the schema), so the list is read on the driver.
    """
    rare = [r["column"] for r in null_shares(df).where((F.col("missing") > 0) & (F.col("share") <= max_share)).collect()]
    return df.na.drop(subset=rare) if rare else df


def in_ranges(df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Keep rows where every listed column lies strictly inside its range (AND of all rules)."""
    for col, (low, high) in ranges.items():
        if low is not None:
            df = df.where(F.col(col) > low)
        if high is not None:
            df = df.where(F.col(col) < high)
    return df


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero for missing numbers."""
    return df.na.fill(0, subset=list(columns))


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median for missing numbers (the mean of the two middle ones for an even count), one number per column.

    A column without values stays missing.
    """
    medians = exact_medians(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items() if m is not None})


def removed_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What keeping one row per key removes: ``(copies, keys, removed)``, a row per number of copies."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counts.groupBy("copies").agg(F.count(F.lit(1)).alias("keys"), F.sum(F.col("copies") - 1).alias("removed"))


def dedup_with_report(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """The first row of each key, and the report of what that removes."""
    return top_per_key(df, list(keys), list(order)), removed_copies(df, keys)


def series_profile(series: DataFrame) -> DataFrame:
    """Per-series facts used for pruning, from long ``(name, date, value)`` rows in one aggregation."""
    return series.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value").isNull()).alias("missing"),
        F.count_if(F.col("value") == 0).alias("zeros"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def prune_series(
    series: DataFrame, *, zeros: bool = True, missing: bool = True, constant: bool = True
) -> DataFrame:
    """P25: drop series that hold zeros, hold nulls, or never change."""
    keep = F.lit(True)
    if zeros:
        keep = keep & (F.col("zeros") == 0)
    if missing:
        keep = keep & (F.col("missing") == 0)
    if constant:
        keep = keep & (F.col("low") < F.col("high"))
    return series.join(series_profile(series).where(keep), "name", "left_semi")


def near_zero_variance(
    series: DataFrame, freq_ratio: float = 19.0, unique_pct: float = 10.0
) -> DataFrame:
    """P25: series whose most common value dominates and that have few distinct values.

    The value histogram is aggregated first, so a series of any length costs its distinct values.
    """
    counts = series.groupBy("name", "value").agg(F.count(F.lit(1)).alias("c"))
    # the two largest counts by two passes of partial aggregation: max, then max of the rest
    top = counts.groupBy("name").agg(
        F.max(F.struct("c", "value")).alias("top"), F.sum("c").alias("n"), F.count(F.lit(1)).alias("distinct_values")
    )
    rest = counts.join(top.select("name", F.col("top.value").alias("top_value")), "name")
    rest = rest.where(~F.col("value").eqNullSafe(F.col("top_value"))).groupBy("name").agg(F.max("c").alias("second"))
    joined = top.join(rest, "name", "left")
    ratio = F.coalesce(F.col("top.c") / F.col("second"), F.lit(float("inf")))
    share = F.col("distinct_values") * 100.0 / F.col("n")
    flag = (F.col("distinct_values") == 1) | ((ratio > freq_ratio) & (share <= unique_pct))
    return joined.select("name", "n", "distinct_values", flag.alias("near_zero"))


def right_closed_cut(col: Column, edges: Sequence[float]) -> Column:
    """1-based bin of ``(edges[i-1], edges[i]]``; values above the last edge get one more."""
    out = F.when(col <= edges[0], 1)
    for i, edge in enumerate(edges[1:], start=2):
        out = out.when(col <= edge, i)
    return out.when(col.isNotNull(), len(edges) + 1)


def decile_band(load: Column, capacity: Column) -> Column:
    """Share of capacity in bands of ten percent, with one band above capacity."""
    out = F.when(load < 0.1 * capacity, "< 10%")
    for tenth in range(2, 10):
        out = out.when(load < F.lit(tenth / 10) * capacity, f"< {tenth}0%")
    return out.when(load <= capacity, "<100%").when(load > capacity, ">100%")
