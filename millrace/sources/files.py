"""Folder listings, archives and workbooks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.members import read_archive_lines, read_sheet_cells


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``(path, modificationTime, length)`` of matching files; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", recursive).load(folder).drop("content")


def newest_file(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The most recently changed file of a folder, one row; equal times go to the greatest path."""
    files = list_files(spark, folder, pattern)
    return files.agg(F.max(F.struct("modificationTime", "path", "length")).alias("f")).select("f.path", "f.modificationTime", "f.length")


def read_zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of every member of the zip archives under ``path``, a task per member."""
    return read_archive_lines(spark, path)


def unzip_lines(archives: DataFrame) -> DataFrame:
    """``(path, content)`` archives to ``(archive, member, line)`` rows.

    For archives held in a column: an archive is the unit of work, its members are streamed line by line. Archives in
    files are read by member, see :func:`read_zip_lines`.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        with archive.open(member) as handle:
                            chunk = []
                            for raw in handle:
                                chunk.append(raw.decode("utf-8", "replace").rstrip("\r\n"))
                                if len(chunk) == 10_000:
                                    yield pd.DataFrame({"archive": name, "member": member, "line": chunk})
                                    chunk = []
                            if chunk:
                                yield pd.DataFrame({"archive": name, "member": member, "line": chunk})

    return archives.select("path", "content").mapInPandas(unpack, "archive string, member string, line string")


def read_workbook_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells ``(file, sheet, row, col, value)`` of many ``.xlsx`` workbooks, a task per sheet.

    Rows and columns count from zero, values are text. ``reshape.cells_to_rows`` and
    ``reshape.cell_blocks`` turn the cells into tables.
    """
    return read_sheet_cells(spark, path)


def excel_date(col):
    """Workbook serial day number to a date."""
    return F.date_add(F.lit("1899-12-30").cast("date"), F.floor(col.try_cast("double")).cast("int"))
