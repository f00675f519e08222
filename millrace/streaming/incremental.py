"""Incremental loads: high-water marks, key ranges, new files, batches by published date."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import attach_row


def rows_after(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows beyond the greatest value already in the target (all of them for an empty one)."""
    joined = attach_row(source, target.agg(F.max(column).alias("_mark")))
    return joined.where(F.col("_mark").isNull() | (F.col(column) > F.col("_mark"))).drop("_mark")


def next_range(last: int | None, newest: int, size: int) -> tuple[int, int] | None:
    """Half-open key range of the next chunk, clipped to the newest key; none when up to date."""
    start = 0 if last is None else last + 1
    return None if start > newest else (start, min(start + size, newest + 1))


def chunk_of(key: Column, last: int | None, newest: int, size: int) -> Column:
    """Number of the chunk that :func:`next_range` would load a key with, from 0 on; null for loaded or later keys.

    All chunks of a catch-up can so be taken from one scan of the source.
    """
    start = 0 if last is None else last + 1
    return F.when((key >= start) & (key <= newest), F.floor((key - start) / size))


def next_dates(column: str, last: Column | None, run_date: Column) -> Column:
    """Dates after the last loaded one up to yesterday."""
    rule = F.col(column) < run_date
    return rule if last is None else rule & (F.col(column) > last)


def ingest_new_files(
    spark: SparkSession, schema: T.StructType | str, source: str, target: str, checkpoint: str, file_format: str = "parquet",
    options: dict[str, str] | None = None, clean: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int = 1000,
) -> None:
    """Append the files that arrived since the last call; the checkpoint remembers them.

    The file sink's log makes a repeated batch harmless.
    """
    stream = spark.readStream.format(file_format).schema(schema).options(**(options or {}))
    rows = stream.option("maxFilesPerTrigger", files_per_batch).load(source)
    rows = clean(rows) if clean else rows
    query = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()


def ingest_with_late(
    spark: SparkSession, schema: T.StructType | str, source: str, target: str, marks: str, checkpoint: str, ts: str, late: str,
    file_format: str = "parquet",
) -> None:
    """Append new files, with rows older than the newest earlier row less ``late`` in parts of their own.

    The table is partitioned by ``late`` and ``batch`` and holds every row. A stateful stream over the part
    ``late=false`` with a watermark of ``late`` drops nothing; the other part is for a batch correction.
    ``marks`` has the newest time of each batch. A batch that is run again sees the same earlier marks and
    replaces its own parts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows, behind = batch, F.lit(False)
        if batch_id:
            earlier = spark.read.schema("high timestamp, batch int").parquet(marks).where(F.col("batch") < batch_id)
            rows = attach_row(batch, earlier.agg(F.max("high").alias("_high")))
            behind = F.coalesce(F.col(ts) < F.col("_high") - F.expr(f"INTERVAL {late}"), F.lit(False))
        dealt = rows.withColumn("late", behind).withColumn("batch", F.lit(batch_id)).drop("_high")
        newest = batch.agg(F.max(ts).alias("high")).withColumn("batch", F.lit(batch_id))
        for part, path, by in ((dealt, target, ["late", "batch"]), (newest, marks, ["batch"])):
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    rows = spark.readStream.format(file_format).schema(schema).load(source)
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def load_by_partition(
    spark: SparkSession, schema: T.StructType | str, source: str, target: str, checkpoint: str, key: str, file_format: str = "parquet"
) -> None:
    """Add each batch to the partitions (for instance published dates) it brings.

    The table is partitioned by the key and by the number of the batch, column ``batch``. A batch that is
    run again after a failure replaces its own part only, and a key that arrives again keeps both arrivals.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch", F.lit(batch_id))
        numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key, "batch").parquet(target)

    rows = spark.readStream.format(file_format).schema(schema).load(source)
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def write_updates(rows: DataFrame, path: str, checkpoint: str, mode: str = "update") -> None:
    """Store the changed rows of every batch with its number; a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("batch", F.lit(batch_id))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    query = rows.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def newest_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current state from stored updates: the row of the last batch per key."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return best.select(*keys, "_r.*")


def run_numbers(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Number of each published batch per key; one row per batch, so the window is small."""
    batches = df.select(*keys, order).distinct()
    return batches.withColumn("run", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
