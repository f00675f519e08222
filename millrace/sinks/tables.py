"""Parquet tables, partition replacement, typed inserts, unload and restore."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.spec import TableSpec, spark_type, statements


def save(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Replace a Parquet folder. Files are bounded by rows; the writers stay parallel."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def append(frames: Sequence[DataFrame], path: str) -> None:
    """Several sources into one table: one union, one write."""
    reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).write.mode("append").parquet(path)


def save_partitions(df: DataFrame, path: str, keys: Sequence[str], spread: int | None = None) -> None:
    """Replace only the partitions present in ``df``.

    Rows are not shuffled by the partition key, so a hot value keeps all its writers; ``spread`` groups
    rows into that many tasks per key when many small files would come out instead.
    """
    if spread:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
        df = df.repartition(*[F.col(k) for k in keys], salt)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def new_partitions(df: DataFrame, key: str, last: object | None, today: object) -> DataFrame:
    """Rows of values after the last loaded one and before today, in one filter."""
    rows = df.where(F.col(key) < F.lit(today))
    return rows if last is None else rows.where(F.col(key) > F.lit(last))


def create_table(spark: SparkSession, spec: TableSpec, location: str, name: str | None = None) -> str:
    """Create (or, for a ``new`` table, re-create) the external table."""
    name = name or spec.full_name
    if spec.new:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(spec.ddl(location, name))
    return name


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Staged text to the declared types, in table column order; each column exactly once."""
    cols = []
    for f in spec.table_schema().fields:
        declared = next(x for x in spec.fields if x.name == f.name)
        source = F.col(f.name)
        kind = declared.type.upper()
        if kind == "DATE":
            source = F.to_date(F.try_to_timestamp(source.cast("string")))
        elif kind in ("TIMESTAMP", "DATETIME"):
            source = F.try_to_timestamp(source.cast("string")).cast("timestamp_ntz")
        elif kind == "BOOLEAN":
            source = F.when(source.cast("string").isin("1", "true", "True"), True).when(source.isNotNull(), False)
        else:
            source = source.try_cast(spark_type(declared.type, declared.size))
        cols.append(source.alias(f.name))
    return df.select(*cols)


def insert_typed(df: DataFrame, spec: TableSpec, table: str, where: Column | None = None) -> None:
    """Typed insert into a table with an optional predicate on the staged rows."""
    typed(df if where is None else df.where(where), spec).write.insertInto(table)


def unload(df: DataFrame, path: str, order: Sequence[str] = (), sep: str = "|") -> None:
    """Delimited gzip text, sorted across files when asked (a range sort, not one file)."""
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").options(sep=sep, compression="gzip", nullValue="NULL").csv(path)


def restore(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|") -> DataFrame:
    """Read an unloaded copy."""
    return spark.read.schema(schema).options(sep=sep, nullValue="NULL").csv(path)


def save_as_table(df: DataFrame, name: str, path: str) -> None:
    """Create or replace a table from a frame."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def table_frame(spark: SparkSession, name: str, where: str | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """Table to frame with optional predicate and columns, both pushed into the scan."""
    df = spark.table(name)
    df = df.where(where) if where else df
    return df.select(*columns) if columns else df


def run_script(spark: SparkSession, script: str, tokens: dict[str, str] | None = None, **args) -> DataFrame | None:
    """Run the statements of a script in order; the last result is returned.

    Names go through ``{token}`` or ``IDENTIFIER(:name)``, values through ``:name`` arguments.
    """
    result = None
    for statement in statements(script, tokens):
        used = {k: v for k, v in args.items() if f":{k}" in statement}
        result = spark.sql(statement, args=used) if used else spark.sql(statement)
    return result
