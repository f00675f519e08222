import datetime
import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import dates as dt
from millrace.functions import geo
from millrace.functions import text as tx
from millrace.operators import cleanse as cl
from millrace.operators import reshape as rs
from millrace.plans.jobs import run_job
from millrace.operators.versioning import RunLog
from millrace.sinks import tables as sk
from millrace.sources import delimited as dl
from millrace.sources import files as fl
from millrace.sources import jdbc
from millrace.sources import structured as st
from millrace.spec import Field, TableSpec, spark_type, statements

D = datetime.date


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_period_codes(spark):
    codes = ["Q12017", "2017Q4", "2017", "cy2010", "MAY2017", "Jan10", "Jan 2015", "XYZ2017", "", None, "ANF2017"]
    want = [D(2017, 1, 1), D(2017, 10, 1), D(2017, 1, 1), D(2010, 1, 1), D(2017, 5, 1), D(2010, 1, 1), D(2015, 1, 1), None, None, None, None]
    assert column(spark, codes, dt.period_start) == want
    assert column(spark, ["MAY2017", "Q12017", "2017", "x"], dt.period_type) == ["M", "Q", "Y", ""]


def test_dates_by_length(spark):
    got = column(spark, ["20170131", " 20170131.0", "170131", "2017", "20171399", None], dt.date_by_length)
    assert got == [D(2017, 1, 31)] * 2 + [D(2017, 1, 31), None, None, None]
    assert column(spark, ["201701312359", "bad"], dt.timestamp_minutes) == [datetime.datetime(2017, 1, 31, 23, 59), None]


def test_reformat(spark):
    assert column(spark, ["31/01/2017", "x"], lambda c: dt.reformat_iso(c, "dd/MM/yyyy")) == ["2017-01-31", None]
    assert column(spark, ["31/01/2017 05:06"], lambda c: dt.reformat_iso(c, "dd/MM/yyyy HH:mm")) == ["2017-01-31 05:06:00"]


def test_weekends_match_counting(spark):
    pairs = [(D(2017, 1, 1) + datetime.timedelta(a), D(2017, 1, 1) + datetime.timedelta(a + n)) for a in range(8) for n in range(0, 17)]
    df = spark.createDataFrame(pairs, "s date, e date")
    for r in df.select("s", "e", dt.weekend_days(F.col("s"), F.col("e")).alias("w"), dt.work_days(F.col("s"), F.col("e")).alias("d")).collect():
        days = [r["s"] + datetime.timedelta(i) for i in range((r["e"] - r["s"]).days)]
        assert (r["w"], r["d"]) == (sum(x.weekday() >= 5 for x in days), sum(x.weekday() < 5 for x in days))


def test_boundaries(spark):
    df = spark.createDataFrame([(datetime.datetime(2016, 12, 31, 23, 59), datetime.datetime(2017, 1, 1, 0, 1))], "a timestamp_ntz, b timestamp_ntz")
    units = ("year", "quarter", "month", "day", "hour", "week")
    row = df.select(*[dt.boundaries_crossed(u, F.col("a"), F.col("b")) for u in units]).first()
    assert tuple(row) == (1, 1, 1, 1, 1, 0)
    with pytest.raises(ValueError):
        dt.boundaries_crossed("decade", F.col("a"), F.col("b"))


def test_chinese(spark):
    assert column(spark, ["二十三", "十", "十五", "两", "12", "", "一百零五", None], dt.chinese_number) == [23, 10, 15, 2, 12, None, 105, None]
    got = column(spark, ["两点30分", "三月五日下午四点", "2017年1月2日23点"], lambda c: dt.chinese_timestamp(c, F.lit("2016-05-06").cast("date")))
    assert got == [datetime.datetime(2016, 5, 6, 2, 30), datetime.datetime(2016, 3, 5, 16), datetime.datetime(2017, 1, 2, 23)]


def test_text_values(spark):
    assert column(spark, ["$1,234.50", "12", "n/a"], tx.money) == [1234.5, 12.0, None]
    assert column(spark, [" 13.5%"], tx.percent) == [0.135]
    assert column(spark, ["10+ years", "< 1 year", "n/a"], tx.tenure_years) == [10, 0, None]
    assert column(spark, [".", "w", " W ", "", "3.5", "abc"], tx.number_or_null) == [None, None, None, None, 3.5, None]
    assert column(spark, ["a from Iraq of b", "x"], tx.between_words) == ["Iraq", None]
    assert column(spark, ["a$b%c&d@"], tx.map_symbols) == ["adbpcnda"]
    assert column(spark, ["aab"], lambda c: tx.replace_in_order(c, [("aa", "b"), ("bb", "c")])) == ["c"]
    assert column(spark, ["cafÃ©", "café", "plain", "日本"], tx.repair_utf8) == ["café", "café", "plain", "日本"]
    assert column(spark, ["né"], tx.strip_non_ascii) == ["n"]


def test_cut_edges(spark):
    got = column(spark, [-1.0, 0.0, 0.1, 1.0, 2.0, None], lambda c: cl.right_closed_cut(c, [0.0, 1.0]), "double")
    assert got == [1, 1, 2, 2, 3, None]


def test_frame_cleaning(spark):
    df = spark.createDataFrame([("NaN", "a", 1), ("x", None, None), (None, None, None)], "a string, b string, c int")
    assert [tuple(r) for r in cl.nan_text_to_null(df).collect()] == [(None, "a", 1), ("x", None, None), (None, None, None)]
    shares = {r["column"]: (r["missing"], r["share"]) for r in cl.null_shares(df).collect()}
    assert shares == {"a": (1, 1 / 3), "b": (2, 2 / 3), "c": (2, 2 / 3)}
    assert cl.drop_rare_nulls(df, 0.4).count() == 2
    assert cl.drop_suffixes(spark.createDataFrame([("a.W",), ("b.M",), (None,)], "k string"), "k", [".W"]).count() == 1
    filled = cl.add_missing(df, {"c": 5, "d": "N"}).collect()
    assert [(r["c"], r["d"]) for r in filled] == [(1, "N"), (5, "N"), (5, "N")]
    with pytest.raises(ValueError):
        cl.rename_by_position(df, ["x"])


def test_median_fill(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (9.0,), (None,)], "x double")
    assert sorted(r["x"] for r in cl.fill_median(df, ["x"]).collect()) == [1.0, 3.0, 3.0, 9.0]


def test_types():
    assert spark_type("decimal", "10, 3") == T.DecimalType(10, 3)
    assert spark_type("REAL") == T.DoubleType() and spark_type("REAL", narrow_real=True) == T.FloatType()
    assert spark_type("DATE", text_dates=True) == T.StringType()
    with pytest.raises(ValueError):
        spark_type("GEOMETRY")


def test_spec():
    spec = TableSpec("S", "T", (Field("a", "INT"), Field("p", "VARCHAR", partitioned=True), Field("b", "DATE", table_only=True), Field("c", "INT", computed=True)))
    assert spec.read_schema().fieldNames() == ["a", "p"]
    assert spec.table_schema().fieldNames() == ["a", "b", "c", "p"]
    assert spec.ddl("/x") == "CREATE TABLE IF NOT EXISTS s.t (`a` int, `b` date, `c` int, `p` string) USING parquet PARTITIONED BY (`p`) LOCATION '/x'"


def test_declared_sizes(spark):
    spec = TableSpec("s", "t", (Field("a", "VARCHAR", "3"), Field("b", "INT")))
    df = spark.createDataFrame([("abc", 1), ("abcd", 2), (None, 3)], "a string, b int")
    assert [r["b"] for r in spec.too_long(df).collect()] == [2]


def test_statements():
    script = "-- head\nSELECT ';' AS a; -- tail; more\nSELECT '--' || 'it''s' - 1 FROM {t};\n ;"
    assert statements(script, {"t": "x"}) == ["SELECT ';' AS a", "SELECT '--' || 'it''s' - 1 FROM x"]


def test_typed_insert_columns(spark):
    spec = TableSpec("s", "t", (Field("a", "DATE"), Field("b", "BOOLEAN"), Field("c", "TIMESTAMP"), Field("d", "REAL")))
    df = spark.createDataFrame([("2017-01-02", "1", "2017-01-02 03:04:05", "x"), (None, "0", "bad", "2.5")], "a string, b string, c string, d string")
    assert [tuple(r) for r in sk.typed(df, spec).collect()] == [
        (D(2017, 1, 2), True, datetime.datetime(2017, 1, 2, 3, 4, 5), None), (None, False, None, 2.5)
    ]


def test_jdbc_options(spark):
    assert jdbc.select_statement("t", ["a", "b"], {"k": (5, None), "d": ("2017-01-01", "o'x")}) == "SELECT a, b FROM t WHERE k >= 5 AND d >= '2017-01-01' AND d < 'o''x'"
    with pytest.raises(ValueError):
        jdbc.read_options(spark, "nowhere", "SELECT 1")
    spark.conf.set("spark.millrace.jdbc.dw.url", "jdbc:x")
    options = jdbc.read_options(spark, "dw", "SELECT 1", ("k", 0, 10, 4))
    assert options["numPartitions"] == "4" and options["dbtable"] == "(SELECT 1) src" and "query" not in options


def workbook(**sheets) -> bytes:
    """Sheets are stored in parts numbered backwards, as a workbook may do."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    link = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {name: f"worksheets/sheet{len(sheets) - i}.xml" for i, name in enumerate(sheets)}
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        listed = "".join(f'<sheet name="{name}" sheetId="{i}" r:id="r{name}"/>' for i, name in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{link}"><sheets>{listed}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="r{name}" Target="{part}"/>' for name, part in parts.items())
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>name</t></si><si><r><t>ri</t></r><r><t>g</t></r></si></sst>")
        for name, rows in sheets.items():
            cells = "".join(
                f'<row r="{r + 1}">' + "".join(
                    f'<c r="{chr(65 + c)}{r + 1}" t="s"><v>{v[1:]}</v></c>' if v.startswith("#") else f'<c r="{chr(65 + c)}{r + 1}"><v>{v}</v></c>'
                    for c, v in row
                ) + "</row>"
                for r, row in rows
            )
            book.writestr(f"xl/{parts[name]}", f"<worksheet {ns}><sheetData>{cells}</sheetData></worksheet>")
    return buffer.getvalue()


def test_workbook_sheets_follow_their_links(spark, tmp_path):
    (tmp_path / "two.xlsx").write_bytes(workbook(First=[(0, [(0, "1")])], Second=[(0, [(0, "2")])]))
    cells = fl.read_workbook_cells(spark, str(tmp_path / "*.xlsx")).collect()
    assert sorted((r["sheet"], r["value"]) for r in cells) == [("First", "1"), ("Second", "2")]


def test_workbook(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook(Data=[(0, [(0, "#0"), (1, "1")]), (1, [(0, "#1"), (1, "42736.5")]), (3, [(1, "7")])]))
    cells = fl.read_workbook_cells(spark, str(tmp_path / "*.xlsx"))
    got = sorted((r["sheet"], r["row"], r["col"], r["value"]) for r in cells.collect())
    assert got == [("Data", 0, 0, "name"), ("Data", 0, 1, "1"), ("Data", 1, 0, "rig"), ("Data", 1, 1, "42736.5"), ("Data", 3, 1, "7")]
    rows = rs.cells_to_rows(cells, ["name", "day"], skip_top=1, skip_bottom=1).select("name", fl.excel_date(F.col("day")).alias("day"))
    assert [tuple(r) for r in rows.collect()] == [("rig", D(2017, 1, 1))]


def test_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("a.txt", "1\n2\n")
        z.writestr("b.txt", "")
    rows = fl.read_zip_lines(spark, str(tmp_path / "*.zip")).select("member", "line").collect()
    assert sorted(map(tuple, rows)) == [("a.txt", "1"), ("a.txt", "2")]


def test_lines_over_many_blocks(spark, tmp_path):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        for name in ("a", "b"):
            (tmp_path / f"{name}.txt").write_text("head\nhead2\n" + "".join(f"{name}{i}|\n" for i in range(60)) + "\nfoot\n")
        (tmp_path / "c.txt").write_text("head\nhead2\nfoot\n")
        lines = dl.read_lines(spark, str(tmp_path), skip_top=2, skip_bottom=1, drop_lines=["a3|"], trailing_delimiter="|")
        got = sorted(r["line"] for r in lines.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted([f"a{i}" for i in range(60) if i != 3] + [f"b{i}" for i in range(60)])


def test_nested_records(spark):
    df = spark.createDataFrame([("a", [["2017", "1"], ["2018"]]), (None, [["x", "1"]]), ("b", []), ("c", None)], "k string, data array<array<string>>")
    assert [tuple(r) for r in st.flatten_pairs(df, "k", "data").collect()] == [("a", "2017", "1"), ("a", "2018", None)]


def test_sheet_blocks(spark):
    grid = [("s", 0, 0, "Oil"), ("s", 1, 1, "Jan"), ("s", 1, 2, "Feb"), ("s", 2, 0, "rigs"), ("s", 2, 1, "5"), ("s", 2, 2, "6"),
            ("s", 3, 0, "Total"), ("s", 3, 1, "5"), ("s", 4, 0, "note"), ("s", 4, 1, "x"), ("s", 5, 0, "Gas"), ("s", 6, 1, "Mar"), ("s", 7, 0, "rigs"), ("s", 7, 1, "9")]
    cells = spark.createDataFrame(grid, "sheet string, row int, col int, value string")
    got = sorted(tuple(r) for r in rs.cell_blocks(cells, ["Oil", "Gas"]).collect())
    assert got == [("s", "Gas", "rigs", "Mar", "9"), ("s", "Oil", "rigs", "Feb", "6"), ("s", "Oil", "rigs", "Jan", "5")]


def test_partition_replacement(spark, tmp_path):
    path = str(tmp_path / "t")
    sk.save_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, ["p"])
    sk.save_partitions(spark.createDataFrame([(3, "b")], "x int, p string"), path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]


def test_distance_and_rings(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 90.0), (10.0, 20.0, 10.0, 20.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geo.distance_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert abs(got[0] - 111.111 * 90) < 1e-6 and got[1] < 1e-3
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]])
    points = spark.createDataFrame([(0.5, 2.0), (2.0, 3.0), (5.0, 1.0), (3.5, 3.0)], "x double, y double")
    assert [r[0] for r in points.select(geo.inside_ring(F.col("x"), F.col("y"), ring)).collect()] == [True, False, False, True]


def test_job_failure_is_logged(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    at = datetime.datetime(2024, 1, 1)
    with pytest.raises(ValueError):
        run_job(spark, {"name": "j", "read": {"format": "parquet", "path": "/root/testdata/sf0.001/region.parquet"}, "steps": [{"step": "nope"}], "write": {"path": "x"}}, at, log)
    assert [r["status"] for r in log.states().collect()] == ["F"]
    assert log.start("r2", "j", at) and not log.start("r3", "j", at)
    log.complete("r2", "j", at, counts=(1, 2, 3))
    assert [(r["runid"], r["recsmodified"]) for r in log.last_good().collect()] == [("r2", 2)]
