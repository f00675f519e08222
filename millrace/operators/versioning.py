"""Change capture, as-of reads, slowly changing dimensions, upserts and the run log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import attach_row


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def changes(snapshot: DataFrame, live: DataFrame, keys: Sequence[str], values: Sequence[str], version: Column) -> DataFrame:
    """Rows inserted (I), modified (M) and deleted (D) between the live view and a snapshot.

    One full outer join on the key replaces separate EXCEPT and INTERSECT passes. Null values compare
    equal. Deleted rows carry null values. ``keys`` identify one row on each side.
    """
    new = snapshot.select(*keys, F.struct(*values).alias("_new"))
    old = live.select(*keys, F.struct(*values).alias("_old"))
    status = (
        F.when(F.col("_old").isNull(), "I").when(F.col("_new").isNull(), "D").when(~F.col("_new").eqNullSafe(F.col("_old")), "M")
    )
    joined = new.join(old, list(keys), "full").withColumn("status", status).where(F.col("status").isNotNull())
    return joined.select(*keys, *[F.col(f"_new.{v}").alias(v) for v in values], version.alias("version"), "status")


def latest(
    history: DataFrame,
    keys: Sequence[str],
    asof: Column | None = None,
    *,
    deleted_first: bool = False,
) -> DataFrame:
    """Newest row per key at or before ``asof``, without deleted keys.

    The status is tested after the newest row is chosen. ``deleted_first`` drops D rows before, so a
    deleted key shows its last value again. The newest row comes from a partial aggregation, not a
    window, so long histories of one key combine before the shuffle.
    """
    if asof is not None:
        history = history.where(F.col("version") <= asof)
    if deleted_first:
        history = history.where(F.col("status") != "D")
    rest = [c for c in history.columns if c not in keys and c != "version"]
    newest = history.groupBy(*keys).agg(F.max_by(F.struct("version", *rest), "version").alias("_r"))
    live = newest.select(*keys, "_r.*").select(*history.columns)
    return live.where(F.col("status") != "D")


def attribute_changes(attributes: DataFrame, live: DataFrame, version: Column) -> DataFrame:
    """Attribute rows that are new or differ in any column."""
    return attributes.subtract(live.select(*attributes.columns)).withColumn("version", version)


def append_version(rows: DataFrame, path: str) -> None:
    """Write the rows into their ``version`` partitions; a rerun of a version replaces it."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)


def refresh(rows: DataFrame, path: str) -> None:
    """Replace the whole table."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def row_digest(columns: Sequence[str]) -> Column:
    """Change hash of a row; null and empty text differ."""
    return F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]))


def scd2_merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], run_date: Column
) -> DataFrame:
    """The new full SCD-2 table after merging ``source``.

    ``target`` has ``keys``, ``tracked``, ``recstatus``, ``recfromdate`` and ``recexpirydate`` (null for
    current rows). Expired rows pass through. A current row whose digest changed, or whose key is gone,
    is expired at ``run_date``; changed and new rows are added with status M and I, a vanished key is
    marked D. Keys match null-safe over the whole key.
    """
    columns = [*keys, *tracked, "recstatus", "recfromdate", "recexpirydate"]
    target = target.select(*columns)
    expired = target.where(F.col("recexpirydate").isNotNull())
    current = target.where(F.col("recexpirydate").isNull())
    old = current.select(F.struct(*columns).alias("o"), row_digest(tracked).alias("od"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    new = source.select(F.struct(*keys, *tracked).alias("n"), row_digest(tracked).alias("nd"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    both = old.join(new, _all(F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}")) for k in keys), "full")

    gone = F.col("n").isNull()
    fresh = F.col("o").isNull()
    changed = ~gone & ~fresh & (F.col("od") != F.col("nd"))
    none = F.lit(None).cast("date")

    def record(side: str, status: Column, start: Column, end: Column) -> Column:
        data = [F.col(f"{side}.{c}").alias(c) for c in (*keys, *tracked)]
        return F.struct(*data, status.alias("recstatus"), start.alias("recfromdate"), end.alias("recexpirydate"))

    kept = record("o", F.when(gone, "D").otherwise(F.col("o.recstatus")), F.col("o.recfromdate"), F.when(gone | changed, run_date).otherwise(none))
    added = record("n", F.when(fresh, "I").otherwise("M"), run_date, none)
    rows = F.when(fresh, F.array(added)).when(changed, F.array(kept, added)).otherwise(F.array(kept))
    return both.select(F.inline(rows)).unionByName(expired)


def scd2_counts(table: DataFrame, run_date: Column) -> DataFrame:
    """Inserted, modified and deleted counts of one run, in one pass."""
    started = F.col("recfromdate") == run_date
    return table.agg(
        F.count_if(started & (F.col("recstatus") == "I")).alias("recsinserted"),
        F.count_if(started & (F.col("recstatus") == "M")).alias("recsmodified"),
        F.count_if((F.col("recexpirydate") == run_date) & (F.col("recstatus") == "D")).alias("recsdeleted"),
    )


def change_counts(rows: DataFrame) -> DataFrame:
    """Counts by status of a change set."""
    return rows.groupBy("version").agg(
        F.count_if(F.col("status") == "I").alias("recsinserted"),
        F.count_if(F.col("status") == "M").alias("recsmodified"),
        F.count_if(F.col("status") == "D").alias("recsdeleted"),
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with the same key."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key ``target`` lacks (to be appended)."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def split_oldest(df: DataFrame, published: str) -> tuple[DataFrame, DataFrame]:
    """The oldest published batch and the rest. The scalar minimum is one row."""
    marked = attach_row(df, df.agg(F.min(published).alias("_oldest")))
    return (
        marked.where(F.col(published) == F.col("_oldest")).drop("_oldest"),
        marked.where(F.col(published) > F.col("_oldest")).drop("_oldest"),
    )


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set columns from another table where the key matches and the value is present.
    ``source`` has one row per key."""
    slim = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in columns])
    joined = target.join(slim, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(f"_s_{c}"), F.col(c)) for c in columns}).drop(*[f"_s_{c}" for c in columns])


def not_loaded(source: DataFrame, target: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Source rows absent from the target, leaving load dates out of the comparison."""
    columns = [c for c in source.columns if c not in ignore]
    return source.select(*columns).subtract(target.select(*columns))


def replace_where(df: DataFrame, condition: str, rows: DataFrame) -> DataFrame:
    """Delete rows matching a condition and insert others; a null condition keeps the row."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False))).unionByName(rows)


RUN_LOG = (
    "runid string, appname string, params string, status string, at timestamp_ntz, "
    "recsinserted bigint, recsmodified bigint, recsdeleted bigint"
)


class RunLog:
    """Append-only log of job runs; each state change is a row and views pick the newest.

    An open run holds a file of its app's name beside the log, made by an exclusive create: of two starts
    at one time only one succeeds.
    """

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def _append(self, runid, app, params, status, at, counts=(None, None, None)) -> None:
        row = self.spark.createDataFrame([(runid, app, params, status, at, *counts)], RUN_LOG)
        row.write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG).parquet(self.path)

    def states(self) -> DataFrame:
        """Newest state per run; on equal times a closing state wins over the opening one."""
        closing = (F.col("status") != "S").cast("int")
        return latest_by(self.rows(), ["runid"], F.struct("at", closing))

    def _lock(self, app: str):
        """The file system and the file that an open run of the app holds."""
        java = self.spark._jvm
        name = "".join(c if c.isalnum() else f"_{ord(c):x}_" for c in app)
        path = java.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}-open/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def start(self, runid: str, app: str, at, params: str = "") -> bool:
        """Open a run unless the app has one open; false when it has."""
        from py4j.protocol import Py4JJavaError

        if self._exists() and self.states().where((F.col("appname") == app) & (F.col("status") == "S")).limit(1).count():
            return False
        system, path = self._lock(app)
        try:
            system.create(path, False).close()
        except Py4JJavaError:
            if system.exists(path):
                return False
            raise
        self._append(runid, app, params, "S", at)
        return True

    def complete(self, runid: str, app: str, at, ok: bool = True, counts=(None, None, None), params: str = "") -> None:
        self._append(runid, app, params, "C" if ok else "F", at, counts)
        system, path = self._lock(app)
        system.delete(path, False)

    def last_good(self) -> DataFrame:
        """Newest completed run per app."""
        return latest_by(self.rows().where(F.col("status") == "C"), ["appname"], F.col("at"))

    def _exists(self) -> bool:
        from pyspark.errors import AnalysisException

        try:
            self.spark.read.parquet(self.path)
            return True
        except AnalysisException:
            return False


def latest_by(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Row with the greatest ``order`` per key, by partial aggregation."""
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), order).alias("_r"))
    return best.select(*keys, "_r.*").select(*df.columns)
