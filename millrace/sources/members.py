"""Archive members and workbook sheets as a partitioned data source.

Planning reads only the directories of the archives; every member, or every sheet, is a partition of its own that
a task streams, so a large member needs no memory in proportion to its size. Columns that a query does not ask for
are not built. Paths go through Arrow's file systems, so executors need no local copy.
"""

from __future__ import annotations

import fnmatch
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree as ET

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Rows of a record batch.
ROWS = 10_000
# fixed value: the attribute that links a sheet to its part of the workbook
SHEET_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


@dataclass
class Member(InputPartition):
    """A member of an archive, or a sheet of a workbook."""

    file: str
    name: str
    part: str


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path, re.I) else (pafs.LocalFileSystem(), path)


def _listed(path: str, ending: str) -> list[str]:
    """The file, the files that match a pattern in the last part of the path, or those of a folder whose names end so."""
    system, inner = _system(path)
    folder, _, pattern = inner.rpartition("/")
    if any(c in pattern for c in "*?["):
        found = system.get_file_info(pafs.FileSelector(folder))
        return sorted(x.path for x in found if x.type == pafs.FileType.File and fnmatch.fnmatch(x.base_name, pattern))
    info = system.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type != pafs.FileType.Directory:
        return [inner]
    found = system.get_file_info(pafs.FileSelector(inner, recursive=True))
    return sorted(x.path for x in found if x.type == pafs.FileType.File and x.path.endswith(ending))


def _open(path: str, inner: str) -> zipfile.ZipFile:
    system, _ = _system(path)
    return zipfile.ZipFile(system.open_input_file(inner))


def _local(node: ET.Element) -> str:
    return node.tag.rsplit("}", 1)[-1]


class _Reader(DataSourceReader):
    ending = ".zip"

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]

    def partitions(self) -> list[Member]:
        return [m for file in _listed(self.path, self.ending) for m in self.members(file)]

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"int": pa.int32(), "string": pa.string()}
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, self.schema.fields, strict=True)], names=self.schema.names)

    def read(self, member: Member) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in self.rows(member):
            rows.append(row)
            if len(rows) == ROWS:
                yield self.batch(rows)
                rows = []
        if rows:
            yield self.batch(rows)


class _LineReader(_Reader):
    def members(self, file: str) -> list[Member]:
        with _open(self.path, file) as archive:
            return [Member(file, x.filename, x.filename) for x in archive.infolist() if not x.is_dir()]

    def rows(self, member: Member) -> Iterator[tuple]:
        with _open(self.path, member.file) as archive, archive.open(member.part) as handle:
            for raw in handle:
                yield member.file, member.name, raw.decode("utf-8", "replace").rstrip("\r\n")


class _CellReader(_Reader):
    ending = ".xlsx"

    def members(self, file: str) -> list[Member]:
        with _open(self.path, file) as book:
            # a sheet's file is named by its relationship, not by its place in the list
            links = {n.get("Id"): n.get("Target") for n in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
            sheets = [n for n in ET.fromstring(book.read("xl/workbook.xml")).iter() if _local(n) == "sheet"]
            parts = [(n.get("name"), links[n.get(SHEET_LINK)]) for n in sheets]
            return [Member(file, name, part[1:] if part.startswith("/") else f"xl/{part}") for name, part in parts]

    @staticmethod
    def _shared(book: zipfile.ZipFile) -> list[str]:
        """The workbook's distinct texts, which its cells name by number."""
        if "xl/sharedStrings.xml" not in book.namelist():
            return []
        texts = []
        with book.open("xl/sharedStrings.xml") as handle:
            for _, node in ET.iterparse(handle):
                if _local(node) == "si":
                    texts.append("".join(t.text or "" for t in node.iter() if _local(t) == "t"))
                    node.clear()
        return texts

    def rows(self, member: Member) -> Iterator[tuple]:
        with _open(self.path, member.file) as book:
            shared = self._shared(book)
            with book.open(member.part) as handle:
                for _, node in ET.iterparse(handle):
                    kind = _local(node)
                    if kind == "row":
                        node.clear()
                    if kind != "c":
                        continue
                    raw = next((v.text for v in node if _local(v) == "v"), None)
                    if node.get("t") == "s" and raw is not None:
                        raw = shared[int(raw)]
                    elif node.get("t") == "inlineStr":
                        raw = "".join(t.text or "" for t in node.iter() if _local(t) == "t")
                    if raw is not None:
                        letters, digits = re.match(r"([A-Z]+)(\d+)", node.get("r")).groups()
                        column = 0
                        for letter in letters:
                            column = column * 26 + ord(letter) - 64
                        yield member.file, member.name, int(digits) - 1, column - 1, raw


class ArchiveLines(DataSource):
    """Lines of every member of the zip archives under a path."""

    @classmethod
    def name(cls) -> str:
        return "archive_lines"

    def schema(self) -> str:
        return "archive string, member string, line string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _LineReader(schema, self.options)


class WorkbookCells(DataSource):
    """Cells of every sheet of the workbooks under a path; rows and columns count from zero, values are text."""

    @classmethod
    def name(cls) -> str:
        return "workbook_cells"

    def schema(self) -> str:
        return "file string, sheet string, row int, col int, value string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _CellReader(schema, self.options)


def read_archive_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(archive, member, line)``, a partition per member."""
    spark.dataSource.register(ArchiveLines)
    return spark.read.format("archive_lines").option("path", path).load()


def read_sheet_cells(spark: SparkSession, path: str) -> DataFrame:
    """``(file, sheet, row, col, value)``, a partition per sheet."""
    spark.dataSource.register(WorkbookCells)
    return spark.read.format("workbook_cells").option("path", path).load()


def workbook(sheets: dict[str, list[list[str | None]]]) -> bytes:
    """A small workbook with inline texts, one list of rows per sheet."""

    def letters(column: int) -> str:
        out = ""
        while column >= 0:
            out, column = chr(65 + column % 26) + out, column // 26 - 1
        return out

    space = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        listed, links = ET.Element("workbook", xmlns=space), ET.Element("Relationships", xmlns="http://schemas.openxmlformats.org/package/2006/relationships")
        names = ET.SubElement(listed, "sheets")
        for i, (name, rows) in enumerate(sheets.items(), 1):
            ET.SubElement(names, "sheet", {"name": name, "sheetId": str(i), SHEET_LINK: f"r{i}"})
            ET.SubElement(links, "Relationship", Id=f"r{i}", Target=f"worksheets/sheet{i}.xml")
            sheet = ET.Element("worksheet", xmlns=space)
            data = ET.SubElement(sheet, "sheetData")
            for r, values in enumerate(rows, 1):
                row = ET.SubElement(data, "row", r=str(r))
                for c, value in enumerate(values):
                    if value is not None:
                        cell = ET.SubElement(row, "c", r=f"{letters(c)}{r}", t="inlineStr")
                        ET.SubElement(ET.SubElement(cell, "is"), "t").text = value
            book.writestr(f"xl/worksheets/sheet{i}.xml", ET.tostring(sheet))
        book.writestr("xl/workbook.xml", ET.tostring(listed))
        book.writestr("xl/_rels/workbook.xml.rels", ET.tostring(links))
    return buffer.getvalue()
