"""Row-count snapshots, mismatch against the prior version, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import with_side


def count_snapshot(data: DataFrame, key: str, version: Column) -> DataFrame:
    """Rows per series for one version."""
    return data.groupBy(key).agg(F.count(F.lit(1)).alias("rowcount")).withColumn("version", version)


def mismatch_from_prior(counts: DataFrame, key: str) -> DataFrame:
    """Newest count against the one before, with absolute change and its ratio to the smaller.

    The two newest versions per series are kept by two partial aggregations.
    """
    pair = F.struct("version", "rowcount")
    newest = counts.groupBy(key).agg(F.max(pair).alias("c"))
    older = counts.join(newest, key).where(F.col("version") < F.col("c.version"))
    prior = older.groupBy(key).agg(F.max(pair).alias("p"))
    both = newest.join(prior, key).where(F.col("c.rowcount") != F.col("p.rowcount"))
    change = F.abs(F.col("c.rowcount") - F.col("p.rowcount"))
    return both.select(
        key,
        F.col("p.version").alias("prior_version"),
        F.col("p.rowcount").alias("prior_rowcount"),
        F.col("c.version").alias("current_version"),
        F.col("c.rowcount").alias("current_rowcount"),
        change.alias("change"),
        F.try_divide(change, F.least("c.rowcount", "p.rowcount")).alias("ratio"),
    )


def source_target_counts(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Counts on both sides with the share that differs; a missing side counts zero rows."""
    a = source.groupBy(key).agg(F.count(F.lit(1)).alias("source_rows"))
    b = target.groupBy(key).agg(F.count(F.lit(1)).alias("target_rows"))
    both = with_side(a, b, [key]).na.fill(0, ["source_rows", "target_rows"])
    gap = F.abs(F.col("source_rows") - F.col("target_rows"))
    return both.withColumn("ratio", gap / F.greatest("source_rows", "target_rows"))


def gate(counts: DataFrame, limit: float = 0.5) -> DataFrame:
    """One row that says whether every ratio is below the limit."""
    return counts.agg(
        F.max("ratio").alias("worst"), F.count_if(F.col("ratio") >= limit).alias("failures")
    ).withColumn("passed", F.col("failures") == 0)


def split_corrupt(df: DataFrame, column: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Good rows, and the raw text of rows that failed to parse."""
    good = df.where(F.col(column).isNull()).drop(column)
    return good, df.where(F.col(column).isNotNull()).select(column)
