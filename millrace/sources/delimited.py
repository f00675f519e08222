"""Delimited, fixed-width and plain-text sources, and their cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.cleanse import conform, map_values
from millrace.spec import TableSpec


def read_delimited(
    spark: SparkSession, spec: TableSpec, path: str | list[str], sep: str = ",", header: bool = False, **options: str
) -> DataFrame:
    """Typed scan with a declared schema; both sides trimmed, then special symbols replaced.

    Tables with symbol maps are read as text, mapped and cast, since a symbol is no number.
    """
    maps = spec.symbol_maps()
    reader = spark.read.options(
        sep=sep, header=header, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, **options
    )
    if not maps:
        return reader.schema(spec.read_schema()).csv(path)
    return conform(map_values(reader.schema(spec.read_schema(as_text=True)).csv(path), maps), spec.read_schema())


def read_as_text(spark: SparkSession, spec: TableSpec, path: str, sep: str = ",", header: bool = False, clean=None) -> DataFrame:
    """Scan everything as text, apply ``clean`` (frame → frame), then cast to the declared types."""
    df = spark.read.schema(spec.read_schema(as_text=True)).options(sep=sep, header=header).csv(path)
    return conform(clean(df) if clean else df, spec.read_schema())


def read_bulk(
    spark: SparkSession, schema: T.StructType, path: str, sep: str = "|", null_token: str = "NULL", date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """Bulk-load rules: a null token, blank text is null, trimmed, bad rows kept aside in
    ``_corrupt_record`` instead of failing the load."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {
        "sep": sep, "nullValue": null_token, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record",
        "dateFormat": date_format, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
    }
    lines = spark.read.text(path).where(F.trim("value") != "")
    df = lines.select(F.from_csv("value", _ddl(full), options).alias("r")).select("r.*")
    text = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in text})


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_fixed_width(spark: SparkSession, path: str, columns: Sequence[tuple[str, int, str]]) -> DataFrame:
    """Lines cut into ``(name, width, type)`` columns; blank is null."""
    lines, cols, start = spark.read.text(path), [], 1
    for name, width, kind in columns:
        piece = F.trim(F.substring("value", start, width))
        cols.append(F.nullif(piece, F.lit("")).try_cast(kind).alias(name))
        start += width
    return lines.select(*cols)


def read_terminated(
    spark: SparkSession, path: str, row_end: str, field_end: str, names: Sequence[str]
) -> DataFrame:
    """Rows and fields ended by multi-character marks; NUL characters removed, one-field rows dropped."""
    rows = spark.read.text(path, lineSep=row_end).select(F.replace(F.col("value"), F.lit("\0"), F.lit("")).alias("value"))
    literal = "".join("\\" + c if not c.isalnum() else c for c in field_end)
    cells = rows.select(F.split("value", literal).alias("c")).where(F.size("c") > 1)
    return cells.select(*[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_lines(
    spark: SparkSession, path: str, skip_top: int = 0, skip_bottom: int = 0, drop_lines: Sequence[str] = (),
    trailing_delimiter: str | None = None, keep_blank: bool = False,
) -> DataFrame:
    """``(file, line)`` without header, footer, listed and blank lines; a trailing delimiter is cut.

    Only the first block of each file is numbered from the top and only its last two blocks from the
    bottom, so no task sorts a whole file. Lines keep their order inside a block through the scan
    position, taken before any shuffle.
    """
    df = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("line"),
    )
    if skip_top or skip_bottom:
        blocks = df.groupBy("file").agg(F.sort_array(F.collect_set("_block"), False).alias("_blocks"))
        # one row per file with its block starts (file size / block size entries)
        blocks = blocks.select("file", F.coalesce(F.get("_blocks", F.lit(1)), F.get("_blocks", F.lit(0))).alias("_tail"))
        df = df.join(blocks, "file")
        edge = (F.col("_block") == 0) | (F.col("_block") >= F.col("_tail"))
        by_file = Window.partitionBy("file", (F.col("_block") == 0) & (F.col("_block") < F.col("_tail")))
        top = F.row_number().over(by_file.orderBy("_block", "_at"))
        bottom = F.row_number().over(by_file.orderBy(F.desc("_block"), F.desc("_at")))
        ends = df.where(edge).select("*", top.alias("_top"), bottom.alias("_bottom"))
        header = (F.col("_block") == 0) & (F.col("_top") <= skip_top)
        footer = (F.col("_block") >= F.col("_tail")) & (F.col("_bottom") <= skip_bottom)
        df = ends.where(~header & ~footer).drop("_top", "_bottom").unionByName(df.where(~edge))
    line = F.col("line")
    if not keep_blank:
        df = df.where(F.trim(line) != "")
    if drop_lines:
        df = df.where(~line.isin(list(drop_lines)))
    if trailing_delimiter:
        df = df.withColumn("line", F.when(line.endswith(trailing_delimiter), line.substr(F.lit(1), F.length(line) - len(trailing_delimiter))).otherwise(line))
    return df.select("file", "line")


def lines_to_columns(lines: DataFrame, schema: T.StructType, sep: str = ",", keep: Sequence[str] = ()) -> DataFrame:
    """Delimited lines (as from ``read_lines``) to typed columns, quotes respected."""
    options = {"sep": sep}
    parsed = lines.select(*keep, F.from_csv("line", _ddl(schema), options).alias("r"))
    return parsed.select(*keep, "r.*")


def with_file_parts(df: DataFrame, patterns: Mapping[str, tuple[str, int, str]]) -> DataFrame:
    """Columns derived from the file name by ``(pattern, group, type)``; needs a file source."""
    name = F.col("_metadata.file_path")
    cols = {c: F.nullif(F.regexp_extract(name, p, g), F.lit("")).try_cast(kind) for c, (p, g, kind) in patterns.items()}
    return df.select("*", name.alias("file_path"), *[v.alias(k) for k, v in cols.items()])


def extract_predicate(ranges: Mapping[str, tuple[object | None, object | None]]) -> Column:
    """Half-open key ranges as one predicate; pushed into the extract by the optimiser."""
    rules = []
    for column, (low, high) in ranges.items():
        if low is not None:
            rules.append(F.col(column) >= F.lit(low))
        if high is not None:
            rules.append(F.col(column) < F.lit(high))
    return reduce(lambda a, b: a & b, rules, F.lit(True))
