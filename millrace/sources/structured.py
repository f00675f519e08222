"""JSON, XML and KML sources and their flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; a given schema saves the inference pass."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def flatten_pairs(df: DataFrame, key: str, pairs: str, names: Sequence[str] = ("period", "value")) -> DataFrame:
    """``(key, [[a, b], …])`` to one row per pair; records without key or data are left out."""
    full = df.where(F.col(key).isNotNull() & (F.size(pairs) > 0))
    rows = full.select(key, F.explode(pairs).alias("_p"))
    return rows.select(key, *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)])


def split_observations(df: DataFrame, key: str, attributes: Sequence[str], observations: str) -> tuple[DataFrame, DataFrame]:
    """One nested record as an attribute table and an observation table (array of structs)."""
    return df.select(key, *attributes), df.select(key, F.inline(observations))


def read_xml_levels(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType, levels: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Nested XML to one row per innermost element with the parents' fields repeated.

    ``levels`` are the repeated child names from the outside in; each is exploded in turn, and
    missing text is ''. A parent without the child gives no row.
    """
    df = spark.read.format("xml").schema(schema).option("rowTag", row_tag).load(path)
    for level in levels:
        name = level.split(".")[-1]
        df = df.select("*", F.explode(level).alias(f"_{name}"))
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c.split(".")[-1]) for c in columns])


PLACEMARK = "name string, description string, Point struct<coordinates: string>"


def read_placemarks(spark: SparkSession, path: str) -> DataFrame:
    """KML placemarks with cleaned description and coordinates as numbers."""
    df = spark.read.format("xml").schema(PLACEMARK).option("rowTag", "Placemark").load(path)
    place = F.split(F.col("Point.coordinates"), ",")
    return df.select(
        "name",
        clean_description(F.col("description")).alias("description"),
        F.trim(F.get(place, F.lit(1))).try_cast("double").alias("latitude"),
        F.trim(F.get(place, F.lit(0))).try_cast("double").alias("longitude"),
    )


def clean_description(col: Column) -> Column:
    """Line breaks and quotes out, runs of blanks to one."""
    return F.regexp_replace(F.translate(col, "\n'", ""), r"\s{2,}", " ")


def labelled_field(col: Column, label: str, until: str = "<br") -> Column:
    """Text after ``label:`` up to the next mark, null when absent."""
    found = F.trim(F.regexp_extract(col, rf"{label}\s*:?\s*(.*?)\s*(?:{until}|$)", 1))
    return F.when(found != "", found)
