"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE with skew joins, no web page)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    (tests, laptop runs) gets a folder of its own; anywhere else a missing setting is an error,
    because a machine-local folder is lost with its executor.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("spark.millrace.work.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.millrace.work.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses, below the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage", by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder, in folders ``by`` column if asked, and read it back.

    Cuts lineage in a way that survives lost executors, and pins values that must not change
    between two uses (positions in a range-sorted frame). Later readers still get column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*by).parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    held.millrace_path = path
    return held


def discard(*frames: DataFrame) -> None:
    """Delete the tables behind frames of :func:`materialise` when nothing will read them again.

    The caller knows that: whatever was made from them is written by then, so that a lost executor needs
    nothing of them. Other frames are left alone.
    """
    for df in frames:
        path = getattr(df, "millrace_path", None)
        if path:
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def input_bytes(df: DataFrame) -> int | None:
    """Size of what a plan reads, as the optimiser knows it; None where it does not."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 55 else None


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a table that is read in fewer parts than there are cores, by key.

    Meant for work that is heavy per row (splitting whole texts): a handful of parts would leave most
    cores idle. Tables of many parts are returned as they are, without a shuffle. Only the number of parts of
    the plan is asked for, no list of files; the rows are the same either way.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def in_parts(df: DataFrame, rows: int) -> DataFrame:
    """Deal a table to more tasks where its parts hold more than ``rows`` rows on average.

    For models that keep their rows in memory: what a task holds and reads again is then bounded by rows, however large the
    files are read. Other tables are returned as they are.
    """
    parts = -(-df.count() // rows)
    return df.repartition(parts) if parts > df.rdd.getNumPartitions() else df
