"""Declared tables and mappings: the configuration that drives reads, writes and projections."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type names and the Spark types they stand for.
SIMPLE_TYPES = {
    "VARCHAR": T.StringType(),
    "CHAR": T.StringType(),
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "IDENTITY": T.LongType(),
    "REAL": T.DoubleType(),
    "FLOAT4": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "FLOAT8": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DATETIME": T.TimestampNTZType(),
    "BOOLEAN": T.BooleanType(),
}


def spark_type(name: str, size: str | None = None, *, text_dates: bool = False, narrow_real: bool = False) -> T.DataType:
    """Declared type to Spark type. ``text_dates`` keeps dates and timestamps as text,
    ``narrow_real`` gives REAL four bytes. An unknown name raises ValueError."""
    kind = name.strip().upper()
    if kind == "DECIMAL":
        precision, _, scale = (size or "18,2").replace(" ", "").partition(",")
        return T.DecimalType(int(precision), int(scale or 0))
    if kind not in SIMPLE_TYPES:
        raise ValueError(f"unknown type {name!r}")
    if text_dates and kind in ("DATE", "TIMESTAMP", "DATETIME"):
        return T.StringType()
    if narrow_real and kind in ("REAL", "FLOAT4"):
        return T.FloatType()
    return SIMPLE_TYPES[kind]


@dataclass(frozen=True)
class Field:
    """One declared column.

    ``table_only`` columns exist in the table but not in source files; ``computed`` ones are derived
    after the read; ``source`` is the column's name (or expression) in the source; ``symbols`` maps
    special source values to replacements.
    """

    name: str
    type: str
    size: str | None = None
    table_only: bool = False
    computed: bool = False
    source: str | None = None
    partitioned: bool = False
    symbols: Mapping[str, str | None] = field(default_factory=dict)


@dataclass(frozen=True)
class TableSpec:
    """Declared table: name, columns and whether a load starts it afresh."""

    schema: str
    table: str
    fields: tuple[Field, ...]
    new: bool = False

    @classmethod
    def from_json(cls, config: str | Mapping) -> TableSpec:
        data = json.loads(config) if isinstance(config, str) else config

        def flag(entry: Mapping, key: str) -> bool:
            return str(entry.get(key, "")).strip().upper() in ("Y", "YES", "TRUE", "1")

        fields = tuple(
            Field(
                name=f["name"].lower(),
                type=f["type"],
                size=f.get("size"),
                table_only=flag(f, "tableOnly"),
                computed=flag(f, "computed"),
                source=f.get("validation"),
                partitioned=flag(f, "isPartitioned"),
                symbols={s["symbol"]: s.get("value") for s in f.get("specialcharacters", [])},
            )
            for f in data["fields"]
        )
        return cls(data["schemaName"], data["table"], fields, flag(data, "new"))

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.table}".lower()

    def read_fields(self) -> list[Field]:
        return [f for f in self.fields if not f.table_only and not f.computed]

    def read_schema(self, *, as_text: bool = False, source_names: bool = False, **options) -> T.StructType:
        """Schema of a source file; ``as_text`` types everything as a string, to be cast
        after cleaning. All fields are nullable; names are lower case."""
        return T.StructType(
            [
                T.StructField(
                    (f.source if source_names and f.source else f.name).lower(),
                    T.StringType() if as_text else spark_type(f.type, f.size, **options),
                    True,
                    {"type": f.type, "size": f.size or ""},
                )
                for f in self.read_fields()
            ]
        )

    def table_schema(self, **options) -> T.StructType:
        """Schema of the stored table, with partition columns last."""
        ordered = [f for f in self.fields if not f.partitioned] + [f for f in self.fields if f.partitioned]
        return T.StructType([T.StructField(f.name, spark_type(f.type, f.size, **options)) for f in ordered])

    def partition_columns(self) -> list[str]:
        return [f.name for f in self.fields if f.partitioned]

    def symbol_maps(self) -> dict[str, Mapping[str, str | None]]:
        return {f.name: f.symbols for f in self.read_fields() if f.symbols}

    def too_long(self, df: DataFrame) -> DataFrame:
        """Rows with a text longer than its declared size."""
        limits = [(f.name, int(f.size)) for f in self.fields if f.type.upper() in ("VARCHAR", "CHAR") and f.size]
        checks = [F.length(name) > size for name, size in limits if name in df.columns]
        return df.where(reduce(lambda a, b: a | b, checks, F.lit(False)))

    def ddl(self, location: str, name: str | None = None) -> str:
        """Statement that creates the external Parquet table."""
        schema = self.table_schema()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = self.partition_columns()
        parts = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
        return f"CREATE TABLE IF NOT EXISTS {name or self.full_name} ({columns}) USING parquet{parts} LOCATION '{location}'"


@dataclass(frozen=True)
class Part:
    """One piece of a mapped column: a source ``field``, a ``constant``, an ``expression`` or a
    ``lookup`` named in the mapping."""

    kind: str
    value: str

    def column(self) -> Column:
        if self.kind == "field":
            return F.col(self.value)
        if self.kind == "constant":
            return F.lit(self.value)
        if self.kind == "expression":
            return F.expr(self.value)
        if self.kind == "lookup":
            return F.col(f"_lk_{self.value}")
        raise ValueError(f"unknown part {self.kind!r}")


@dataclass(frozen=True)
class Lookup:
    """Joined lookup: the ``value`` of ``table`` where its ``key`` equals the source column ``on``."""

    table: str
    key: str
    on: str
    value: str


@dataclass(frozen=True)
class ColumnMapping:
    """Target columns as lists of parts, with lookups, filters and an optional distinct."""

    columns: Mapping[str, Sequence[Part]]
    lookups: Mapping[str, Lookup] = field(default_factory=dict)
    where: str | None = None
    distinct: bool = False
    delimiter: str = "."
    drop_characters: str = ""

    def apply(self, source: DataFrame, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """Project ``source`` into the common columns. Lookup tables are joined once each; whether
        they are broadcast is left to their measured size."""
        for name, lk in self.lookups.items():
            slim = (tables or {})[lk.table].select(F.col(lk.key).alias("_k"), F.col(lk.value).alias(f"_lk_{name}"))
            source = source.join(slim.dropDuplicates(["_k"]), F.col(lk.on) == F.col("_k"), "left").drop("_k")
        if self.where:
            source = source.where(self.where)
        out = []
        for name, parts in self.columns.items():
            cols = [p.column() for p in parts]
            value = cols[0] if len(cols) == 1 else F.concat_ws(self.delimiter, *[c.cast("string") for c in cols])
            if len(cols) > 1 and self.drop_characters:
                value = F.translate(value, self.drop_characters, "")
            out.append(value.alias(name))
        projected = source.select(*out)
        return projected.distinct() if self.distinct else projected


def statements(script: str, tokens: Mapping[str, str] | None = None) -> list[str]:
    """Statements of a SQL script, comments removed and ``{token}`` values put in.

    Semicolons, dashes and comment marks inside quotes are kept. Block comments may hold semicolons; an open one
    runs to the end of the script.
    """
    for key, value in (tokens or {}).items():
        script = script.replace("{" + key + "}", value)
    pieces = re.findall(r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|--[^\n]*|/\*.*?(?:\*/|\Z)|;|[^'";/-]+|.""", script, re.DOTALL)
    text = "".join("\0" if p == ";" else " " if p.startswith(("--", "/*")) else p for p in pieces)
    return [s.strip() for s in text.split("\0") if s.strip()]
