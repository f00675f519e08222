"""Unions across schema versions and table comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import attach_row


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def multiset_minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` beyond their number in ``right``.

    Copies are counted before the shuffle and written out again at the end, so a group of equal rows
    moves as one row.
    """
    cols = left.columns
    a = left.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    b = right.select(*cols).groupBy(*cols).agg((-F.count(F.lit(1))).alias("_n"))
    rest = a.unionByName(b).groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n > 0")
    return rest.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select(*cols)


def comparable(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Timestamps as text, so that two systems' types agree."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    stamps = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if isinstance(kinds[c], stamps) else F.col(c)
            for c in columns
        ]
    )


def compare(left: DataFrame, right: DataFrame, exclude: Sequence[str] = (), where: str | None = None) -> DataFrame:
    """Number of rows only in one of two tables, counted as multisets, in one aggregation."""
    columns = [c for c in left.columns if c in right.columns and c not in exclude]
    if where:
        left, right = left.where(where), right.where(where)
    a = comparable(left, columns).withColumn("_sign", F.lit(1))
    b = comparable(right, columns).withColumn("_sign", F.lit(-1))
    net = a.unionByName(b).groupBy(*columns).agg(F.sum("_sign").alias("_net"))
    return net.agg(
        F.coalesce(F.sum(F.greatest("_net", F.lit(0))), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("_net"), F.lit(0))), F.lit(0)).alias("only_right"),
    )


def compare_counts(left: Mapping[str, DataFrame], right: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of same-named tables; a missing table counts as -1."""
    spark = next(iter(left.values())).sparkSession

    def count_of(tables: Mapping[str, DataFrame], name: str, out: str) -> DataFrame:
        if name not in tables:
            return spark.range(1).select(F.lit(-1).cast("long").alias(out))
        return tables[name].agg(F.count(F.lit(1)).alias(out))

    rows = []
    for name in sorted({*left, *right}):
        both = attach_row(count_of(left, name, "left_rows"), count_of(right, name, "right_rows"))
        rows.append(both.select(F.lit(name).alias("table"), "*", (F.col("right_rows") - F.col("left_rows")).alias("difference")))
    return reduce(DataFrame.unionByName, rows)
