"""Wide to long and back, arrays to rows, blocks of a cell grid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def melt(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], variable: str = "variable", value: str = "value",
    strip: str = "", not_null: Sequence[str] = (),
) -> DataFrame:
    """Columns to rows in one scan. ``strip`` is a prefix removed from the names."""
    long = df.unpivot(list(ids), list(columns), variable, value)
    if strip:
        long = long.withColumn(variable, F.regexp_replace(variable, f"^{strip}", ""))
    return long.na.drop(subset=list(not_null)) if not_null else long


def melt_measures(df: DataFrame, ids: Sequence[str], groups: Mapping[object, Mapping[str, str]], key: str) -> DataFrame:
    """Several measures per period at once. ``groups`` maps a period to measure → source column."""
    rows = F.array(
        *[
            F.struct(F.lit(period).alias(key), *[F.col(src).alias(name) for name, src in measures.items()])
            for period, measures in groups.items()
        ]
    )
    return df.select(*ids, F.inline(rows))


def widen(df: DataFrame, ids: Sequence[str], column: str, values: Sequence[object], agg: Column) -> DataFrame:
    """Rows to columns for a given list of values (listing them avoids an extra scan)."""
    return df.groupBy(*ids).pivot(column, list(values)).agg(agg)


def dated_array(df: DataFrame, ids: Sequence[str], start: str, values: str, frequency: str) -> DataFrame:
    """An array of values with a start date and frequency (a, q, m) to dated rows; NaN and null skipped."""
    months = F.when(F.col(frequency) == "a", 12).when(F.col(frequency) == "q", 3).when(F.col(frequency) == "m", 1)
    out = df.select(*ids, start, months.alias("_step"), F.posexplode(values).alias("_i", "value"))
    out = out.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return out.select(*ids, F.add_months(start, (F.col("_i") * F.col("_step")).cast("int")).alias("date"), "value")


def one_hot(df: DataFrame, column: str, levels: Sequence[str], prefix: str | None = None) -> DataFrame:
    """0/1 columns for each level but the first."""
    prefix = prefix or column
    return df.withColumns({f"{prefix}_{lv}": F.coalesce((F.col(column) == lv).cast("int"), F.lit(0)) for lv in levels[1:]})


def split_attributes(df: DataFrame, key: Sequence[str], attributes: Sequence[str], series: Sequence[str]):
    """Distinct attribute rows and the series rows."""
    return df.select(*key, *attributes).distinct(), df.select(*key, *series)


def cell_blocks(cells: DataFrame, labels: Sequence[str], stop: str = "Total") -> DataFrame:
    """Labelled blocks of many sheets to long rows ``(sheet, block, item, header, value)``.

    ``cells`` has ``sheet, row, col, value`` (text). A block starts at a label in column 0, has its
    headers in the next row, and item rows until ``stop``. Only column 0 is ordered per sheet, and a
    sheet holds at most 1,048,576 rows, so that window is bounded; values and headers meet by equi joins.
    """
    order = Window.partitionBy("sheet").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    margin = cells.where(F.col("col") == 0)
    is_label = F.col("value").isin(list(labels))
    closes = F.col("value") == stop
    margin = margin.select(
        "sheet", "row", F.col("value").alias("item"), is_label.alias("_label"),
        F.last(F.when(is_label, F.struct(F.col("row").alias("r"), F.col("value").alias("v"))), True).over(order).alias("_at"),
        F.max(F.when(closes, F.col("row"))).over(order).alias("_stop"),
    )
    inside = F.col("_at").isNotNull() & ~F.col("_label") & (F.coalesce(F.col("_stop"), F.lit(-1)) < F.col("_at.r"))
    items = margin.where(inside).select("sheet", "row", "item", F.col("_at.r").alias("_start"), F.col("_at.v").alias("block"))
    starts = margin.where("_label").select("sheet", (F.col("row") + 1).alias("row"), F.col("row").alias("_start"))
    headers = cells.where("col > 0").join(starts, ["sheet", "row"]).select("sheet", "_start", "col", F.col("value").alias("header"))
    values = cells.where("col > 0").join(items, ["sheet", "row"]).select("sheet", "_start", "col", "block", "item", "value")
    return values.join(headers, ["sheet", "_start", "col"]).select("sheet", "block", "item", "header", "value")


def cells_to_rows(cells: DataFrame, names: Sequence[str], skip_top: int = 1, skip_bottom: int = 0) -> DataFrame:
    """A sheet's cell grid to rows with named text columns (null for blank cells).

    ``names`` follow the column order. Cells of a row meet in a pivot over the listed columns.
    """
    last = cells.groupBy("sheet").agg(F.max("row").alias("_last"))
    body = cells.join(last, "sheet").where((F.col("row") >= skip_top) & (F.col("row") <= F.col("_last") - skip_bottom))
    wide = body.groupBy("sheet", "row").pivot("col", list(range(len(names)))).agg(F.max("value"))
    return wide.select("sheet", "row", *[F.col(str(i)).alias(name) for i, name in enumerate(names)])
