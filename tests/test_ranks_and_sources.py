"""Exact ranks, medians, dedup reports, archives and workbooks, run log, scripts, exponential averages."""

import io
import math
import random
import zipfile
from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import cleanse as cl
from millrace.operators import ordered as od
from millrace.operators import ranks as rk
from millrace.operators import series as sr
from millrace.operators import textmining as tm
from millrace.operators.versioning import RunLog
from millrace.sources import members
from millrace.spec import statements
from millrace.streaming import incremental as inc


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_exact_ranks(spark, accuracy):
    rng = random.Random(1)
    columns = {
        "spread": [rng.gauss(0, 1e6) for _ in range(3000)],
        "tied": [float(rng.randint(0, 3)) for _ in range(3000)],
        "holes": [rng.choice([None, None, rng.random()]) for _ in range(3000)],
        "skew": [0.0] * 2990 + [float(i) for i in range(10)],
        "empty": [None] * 3000,
        "odd": [rng.choice([math.nan, -math.inf, math.inf, 1.0, -0.5]) for _ in range(3000)],
    }
    frame = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    wanted = {c: [0, 1, 2, 700, 1500, 1501, 2999, 3000, 3001, 700] for c in columns}
    got = rk.exact_ranks(frame, wanted, accuracy)
    for c, values in columns.items():
        known = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        for rank, value in zip(wanted[c], got[c]):
            expected = known[rank - 1] if 1 <= rank <= len(known) else None
            assert value == expected or math.isnan(value) and math.isnan(expected), (c, rank)
    assert rk.exact_ranks(frame.limit(0), {"spread": [1]}) == {"spread": [None]} and rk.exact_ranks(frame, {}) == {}


def test_medians_and_filling(spark):
    frame = spark.createDataFrame([(1.0, None), (None, None), (4.0, None), (2.0, None), (9.0, None)], "x double, y double")
    assert rk.exact_medians(frame, ["x", "y"]) == {"x": 3.0, "y": None}
    assert sorted(r["x"] for r in cl.fill_median(frame, ["x", "y"]).collect()) == [1.0, 2.0, 3.0, 4.0, 9.0]


def test_first_tiles(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, float(rng.randint(0, 20))])) for i in range(143)]
    frame = spark.createDataFrame(rows, "id int, v double").repartition(4)
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    for n, upto in ((10, 3), (7, 7), (200, 5), (1000, 2), (5, 0)):
        small, extra = divmod(len(rows), n)
        tiles = [i for i in range(n) for _ in range(small + (i < extra))]
        expected = [(r[0], tile + 1) for r, tile in zip(order, tiles) if tile < upto]
        assert sorted((r["id"], r["tile"]) for r in od.first_tiles(frame, "v", [F.asc("id")], n, upto).collect()) == sorted(expected)


def test_dedup_report(spark):
    frame = spark.createDataFrame([(1, 5), (1, 3), (2, 1), (None, 2), (None, 1), (None, 3)], "k int, v int")
    kept, report = cl.dedup_with_report(frame, ["k"], [F.asc("v")])
    assert sorted((r["k"] or 0, r["v"]) for r in kept.collect()) == [(0, 1), (1, 3), (2, 1)]
    assert sorted(tuple(r) for r in report.collect()) == [(1, 1, 0), (2, 1, 1), (3, 1, 2)]


def test_archive_members_are_partitions(spark, tmp_path):
    lines = {"a.csv": [f"a{i}" for i in range(25_000)], "deep/b.csv": ["é", "", "x,y"], "none.csv": []}
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in lines.items():
            archive.writestr(name, "\r\n".join(content))
    frame = members.read_archive_lines(spark, str(tmp_path))
    assert frame.rdd.getNumPartitions() == 3
    got = Counter((r["member"], r["line"]) for r in frame.collect())
    assert got == Counter((name, line) for name, content in lines.items() for line in content)


def test_workbook_sheets_are_partitions(spark, tmp_path):
    sheets = {"One": [["a", None, "c"], [None, "é & <b>"]], "Two": [["1"] * 30]}
    (tmp_path / "book.xlsx").write_bytes(members.workbook(sheets))
    frame = members.read_sheet_cells(spark, f"file://{tmp_path}/book.xlsx")
    assert frame.rdd.getNumPartitions() == 2
    got = sorted((r["sheet"], r["row"], r["col"], r["value"]) for r in frame.collect())
    assert got == sorted((s, i, j, v) for s, rows in sheets.items() for i, row in enumerate(rows) for j, v in enumerate(row) if v is not None)


def test_shared_strings(spark, tmp_path):
    buffer = io.BytesIO(members.workbook({"S": [["plain"]]}))
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(buffer) as old, zipfile.ZipFile(tmp_path / "b.xlsx", "w") as new:
        for name in old.namelist():
            if not name.startswith("xl/worksheets"):
                new.writestr(name, old.read(name))
        new.writestr("xl/sharedStrings.xml", f"<sst {space}><si><t>zero</t></si><si><r><t>o</t></r><r><t>ne</t></r></si></sst>")
        new.writestr("xl/worksheets/sheet1.xml", f'<worksheet {space}><sheetData><row r="2"><c r="AB2" t="s"><v>1</v></c><c r="AC2"><v>4.5</v></c></row></sheetData></worksheet>')
    got = [(r["row"], r["col"], r["value"]) for r in members.read_sheet_cells(spark, str(tmp_path)).collect()]
    assert sorted(got) == [(1, 27, "one"), (1, 28, "4.5")]


def test_only_one_start_opens_a_run(spark, tmp_path):
    log, at = RunLog(spark, str(tmp_path / "log")), datetime(2024, 1, 1)
    assert log.start("r1", "app one", at) and not log.start("r2", "app one", at) and log.start("r3", "other", at)
    log.complete("r1", "app one", at + timedelta(seconds=1))
    assert log.start("r4", "app one", at + timedelta(seconds=2))
    # a start that has seen no open run still loses against the file that another start has made
    rival = RunLog(spark, str(tmp_path / "second"))
    assert rival.start("a", "app", at)
    rival._exists = lambda: False
    assert not rival.start("b", "app", at)


def test_comments_of_scripts():
    script = """/* first; with 'quote */ SELECT 1; -- a; b
    SELECT ';' AS "x;y", '/* no */' /* in; side */ FROM t; SELECT 4 / 2 - 1 /* open; end"""
    assert statements(script) == ["SELECT 1", """SELECT ';' AS "x;y", '/* no */'   FROM t""", "SELECT 4 / 2 - 1"]


def test_chunks_of_one_scan(spark):
    for last, newest, size in ((None, 25, 10), (4, 25, 10), (25, 25, 10)):
        ranges, at = [], last
        while (span := inc.next_range(at, newest, size)) is not None:
            ranges.append(span)
            at = span[1] - 1
        rows = spark.range(40).select("id", inc.chunk_of(F.col("id"), last, newest, size).alias("chunk")).collect()
        expected = {k: i for i, (a, b) in enumerate(ranges) for k in range(a, b)}
        assert {r["id"]: r["chunk"] for r in rows if r["chunk"] is not None} == expected


def test_exponential_average_of_long_series(spark):
    rng = np.random.default_rng(3)
    start = date(1990, 1, 1)
    columns = {"long": list(rng.normal(size=2000)), "late": [None] * 7 + list(rng.normal(size=600)), "hole": [1.0] * 300 + [None] + [2.0] * 300, "short": [1.0, 2.0], "early": [1.0, None, 3.0, 4.0, 5.0, 6.0]}
    rows = [(n, start + timedelta(days=i), None if v is None else float(v)) for n, values in columns.items() for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "name string, date date, value double").repartition(4)
    for n in (3, 26):
        got = {}
        for r in sr.add_ema(frame, "value", n, "e").orderBy("name", "date").collect():
            got.setdefault(r["name"], []).append(r["e"])
        for name, values in columns.items():
            expected, held = [], None
            known = [i for i, v in enumerate(values) if v is not None]
            for i, v in enumerate(values):
                first = known[0] + n - 1
                if i == first:
                    seed = values[known[0] : first + 1]
                    held = None if None in seed else sum(seed) / n
                elif i > first:
                    held = None if held is None or v is None else 2 / (n + 1) * v + (1 - 2 / (n + 1)) * held
                expected.append(held)
            assert all(a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)) for a, b in zip(got[name], expected)), (name, n)


def test_vocabulary_first_equals_the_bag(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["a", "b", "c1", "dé", "the", "22"]) for _ in range(rng.randint(0, 30))) or None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for n in (1, 2):
        bag = tm.tf_idf(tm.bag_of_words(docs, "doc_id", n=n, stop=["the"]), "doc_id", max_df=0.9, max_features=12)
        new = tm.tf_idf_of_texts(docs, "doc_id", n=n, stop=["the"], max_df=0.9, max_features=12)
        one, two = ({(r["doc_id"], r["token"]): r["weight"] for r in x.collect()} for x in (bag, new))
        assert one.keys() == two.keys() and all(math.isclose(v, two[k]) for k, v in one.items()) and one
