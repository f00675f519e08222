"""JDBC scans. Connection settings come from the session configuration, never from code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.cleanse import conform, rename_by_position
from millrace.spec import TableSpec


def select_statement(
    table: str, columns: Sequence[str] = (), ranges: Mapping[str, tuple[object | None, object | None]] | None = None
) -> str:
    """Extract query with a column list instead of ``*`` and half-open key ranges."""

    def literal(value: object) -> str:
        return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"

    rules = []
    for column, (low, high) in (ranges or {}).items():
        if low is not None:
            rules.append(f"{column} >= {literal(low)}")
        if high is not None:
            rules.append(f"{column} < {literal(high)}")
    where = f" WHERE {' AND '.join(rules)}" if rules else ""
    return f"SELECT {', '.join(columns) or '*'} FROM {table}{where}"


def read_options(
    spark: SparkSession, connection: str, query: str, split: tuple[str, int, int, int] | None = None
) -> dict[str, str]:
    """Reader options for a named connection. ``split`` is (column, low, high, partitions): I02."""
    prefix = f"spark.millrace.jdbc.{connection}."
    options = {k: spark.conf.get(prefix + k) for k in ("url", "driver") if spark.conf.get(prefix + k, None)}
    if "url" not in options:
        raise ValueError(f"set {prefix}url")
    for key in ("user", "password"):
        if spark.conf.get(prefix + key, None):
            options[key] = spark.conf.get(prefix + key)
    if split is None:
        return {**options, "query": query}
    column, low, high, parts = split
    return {
        **options, "dbtable": f"({query}) src", "partitionColumn": column, "lowerBound": str(low),
        "upperBound": str(high), "numPartitions": str(parts),
    }


def read_table(
    spark: SparkSession, connection: str, spec: TableSpec, query: str, split: tuple[str, int, int, int] | None = None
) -> DataFrame:
    """Parallel scan, names set by position, types cast to the declared schema."""
    df = spark.read.format("jdbc").options(**read_options(spark, connection, query, split)).load()
    return conform(rename_by_position(df, spec.read_schema()), spec.read_schema())
