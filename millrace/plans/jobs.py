"""Declarative jobs: read, clean, reshape, write and log, from one configuration."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates as dt
from millrace.operators import cleanse as cl
from millrace.operators import reshape as rs
from millrace.operators.versioning import RunLog
from millrace.session import materialise
from millrace.sinks import tables as sk
from millrace.sources import delimited as dl
from millrace.spec import TableSpec

# one entry per step name: frame and options in, frame out
STEPS = {
    "nan_to_null": lambda df, **o: cl.nan_text_to_null(df, **o),
    "replace_all": lambda df, pattern, value: cl.replace_everywhere(df, pattern, value),
    "map_values": lambda df, maps: cl.map_values(df, maps),
    "rename": lambda df, names: cl.rename(df, names),
    "filter": lambda df, where: df.where(where),
    "drop_empty": lambda df, how="all": df.na.drop(how),
    "distinct": lambda df: df.dropDuplicates(),
    "add_columns": lambda df, columns: df.withColumns({k: F.expr(v) for k, v in columns.items()}),
    "format_date": lambda df, column, pattern: df.withColumn(column, dt.reformat_iso(column, pattern)),
    "period_start": lambda df, column, out: df.withColumn(out, dt.period_start(F.col(column))),
    "defaults": lambda df, values: cl.add_missing(df, values),
    "melt": lambda df, **o: rs.melt(df, **o),
    "select": lambda df, columns: df.selectExpr(*columns),
}


def read(spark: SparkSession, config: Mapping, spec: TableSpec | None) -> DataFrame:
    """The source of a job: delimited text by declared table, or any Spark format."""
    kind = config["format"]
    if kind == "delimited":
        return dl.read_delimited(spark, spec, config["path"], config.get("sep", ","), config.get("header", False))
    reader = spark.read.format(kind).options(**config.get("options", {}))
    return (reader.schema(spec.read_schema()) if spec else reader).load(config["path"])


def transform(df: DataFrame, steps) -> DataFrame:
    for step in steps:
        options = dict(step)
        name = options.pop("step")
        if name not in STEPS:
            raise ValueError(f"unknown step {name!r}")
        df = STEPS[name](df, **options)
    return df


def run_job(spark: SparkSession, config: str | Mapping, at: datetime, log: RunLog | None = None) -> dict[str, object]:
    """Run one job and return its id, status and written row count.

    The rows are staged once in the shared folder: the count then comes from file footers, and the
    publishing write can be repeated without reading the source again. A failing job is logged as
    ``F`` and raised again.
    """
    job = json.loads(config) if isinstance(config, str) else config
    spec = TableSpec.from_json(job["table"]) if "table" in job else None
    run_id = uuid.uuid4().hex
    if log and not log.start(run_id, job["name"], at, json.dumps(job.get("params", {}))):
        return {"runid": run_id, "status": "already running", "rows": 0}
    try:
        rows = transform(read(spark, job["read"], spec), job.get("steps", []))
        if spec:
            rows = sk.typed(rows, spec)
        rows = materialise(rows, "job")
        written = rows.count()
        target = job["write"]
        if target.get("partition_by"):
            sk.save_partitions(rows, target["path"], target["partition_by"])
        elif target.get("mode") == "append":
            sk.append([rows], target["path"])
        else:
            sk.save(rows, target["path"])
    except Exception:
        if log:
            log.complete(run_id, job["name"], at, ok=False)
        raise
    if log:
        log.complete(run_id, job["name"], at, counts=(written, 0, 0))
    return {"runid": run_id, "status": "C", "rows": written}
