"""Queries over sources and sinks (survey 2.1).

Each one lets Spark write files from the given tables into the shared work folder and reads them
back through the operator, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import attach_row
from millrace.operators.versioning import append_version, refresh
from millrace.operators import quality as ql
from millrace.plans.registry import Tables, query
from millrace.session import scratch_path
from millrace.sinks import tables as sk
from millrace.sources import delimited as dl
from millrace.sources import files as fl
from millrace.sources import structured as st
from millrace.spec import ColumnMapping, Lookup, Part, TableSpec

ORDER_SPEC = TableSpec.from_json(
    {
        "schemaName": "stage",
        "table": "Orders",
        "new": "Y",
        "fields": [
            {"name": "O_ORDERKEY", "type": "BIGINT"},
            {"name": "o_orderstatus", "type": "VARCHAR", "size": "1"},
            {"name": "o_totalprice", "type": "DECIMAL", "size": "18,2",
             "specialcharacters": [{"symbol": "x", "value": None}, {"symbol": "--", "value": "0"}]},
            {"name": "o_orderdate", "type": "DATE"},
            {"name": "loaded_on", "type": "DATE", "tableOnly": "Y"},
            {"name": "year", "type": "INTEGER", "computed": "Y", "isPartitioned": "Y"},
        ],
    }
)


def order_text(t: Tables):
    price = (
        F.when(F.col("o_orderkey") % 9 == 0, "x").when(F.col("o_orderkey") % 9 == 1, "--").otherwise(F.format_string("%.2f", "o_totalprice"))
    )
    return t.orders.select("o_orderkey", "o_orderstatus", price.alias("o_totalprice"), F.to_date("o_orderdate").cast("string").alias("o_orderdate"))


ORDER_SQL = """SELECT o_orderkey, o_orderstatus, CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"""


@query("S01 S03 S04", ORDER_SQL)
def delimited_orders(t: Tables):
    path = scratch_path(t.spark, "csv")
    order_text(t).select(*[F.concat(F.lit(" "), F.col(c).cast("string"), F.lit(" ")).alias(c) for c in order_text(t).columns]).write.options(
        sep="|", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    df = dl.read_delimited(t.spark, ORDER_SPEC, path, sep="|", header=True)
    return df.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("S02", ORDER_SQL)
def text_then_cast(t: Tables):
    path = scratch_path(t.spark, "csv")
    order_text(t).write.option("sep", ";").csv(path)

    def clean(df):
        return df.withColumn("o_totalprice", F.when(F.col("o_totalprice") == "--", "0").otherwise(F.nullif(F.col("o_totalprice"), F.lit("x"))))

    df = dl.read_as_text(t.spark, ORDER_SPEC, path, sep=";", clean=clean)
    return df.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("S04 S30", "SELECT event_id, event_type, value FROM events WHERE ts > TIMESTAMP '2024-01-15'")
def json_events(t: Tables):
    path = scratch_path(t.spark, "json")
    t.events.select("event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("published")).write.json(path)
    schema = "event_id bigint, event_type string, value double, published string"
    docs = st.read_json(t.spark, path, schema)
    return docs.where(F.col("published") > "2024-01-15").drop("published").orderBy("event_id")


@query(
    "S05",
    """SELECT 'N' || c_nationkey AS series_id, period, value FROM (SELECT c_nationkey, c_custkey::VARCHAR AS period, c_mktsegment AS value FROM customer
      WHERE c_nationkey <> 3)""",
)
def nested_pairs(t: Tables):
    """Records of up to 100 ``[period, value]`` pairs written as JSON lines and flattened again."""
    path = scratch_path(t.spark, "json")
    pair = F.array(F.col("c_custkey").cast("string"), "c_mktsegment")
    nation = F.when(F.col("c_nationkey") != 3, F.concat(F.lit("N"), F.col("c_nationkey")))
    chunk = F.floor(F.col("c_custkey") / 100)  # bounds the pairs of one record
    records = t.customer.groupBy(nation.alias("series_id"), chunk.alias("chunk")).agg(F.collect_list(pair).alias("data"))
    records.drop("chunk").write.json(path)
    return st.flatten_pairs(st.read_json(t.spark, path, "series_id string, data array<array<string>>"), "series_id", "data")


@query(
    "S05 S04",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def event_properties(t: Tables):
    parsed = t.events.select("event_id", F.from_json("props", "k bigint").alias("p"))
    return parsed.select("event_id", "p.k")


@query(
    "S06",
    """SELECT o_orderkey, o_orderstatus, l.l_linenumber, l.l_quantity FROM orders JOIN lineitem l ON l_orderkey = o_orderkey""",
)
def attributes_and_observations(t: Tables):
    """Nested order records (an order has at most seven line numbers) split into two tables and rejoined."""
    path = scratch_path(t.spark, "json")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("observations"))
    nested = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderstatus", "observations")
    nested.write.json(path)
    schema = "o_orderkey bigint, o_orderstatus string, observations array<struct<l_linenumber: int, l_quantity: double>>"
    attributes, series = st.split_observations(st.read_json(t.spark, path, schema), "o_orderkey", ["o_orderstatus"], "observations")
    return attributes.join(series, "o_orderkey")


@query("S08 P14", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey >= 500 AND l_orderkey < 9000")
def key_range_extract(t: Tables):
    return t.lineitem.where(dl.extract_predicate({"l_orderkey": (500, 9000)})).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "S09",
    """SELECT n_name AS market, r_name AS zone, c_custkey::VARCHAR AS id, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def nested_xml(t: Tables):
    """Three-level XML (market → zone → instrument) written by Spark, at most 100 instruments per element."""
    path = scratch_path(t.spark, "xml")
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    leaf = F.struct(F.col("c_custkey").alias("id"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    inner = joined.groupBy("n_name", "r_name", F.floor(F.col("c_custkey") / 100).alias("b")).agg(F.collect_list(leaf).alias("instrument"))
    outer = inner.select(F.col("n_name").alias("market"), F.array(F.struct(F.col("r_name").alias("zone"), "instrument")).alias("underlier"))
    outer.write.format("xml").options(rowTag="results", rootTag="prices").save(path)
    schema = T._parse_datatype_string(
        "market string, underlier array<struct<zone: string, instrument: array<struct<id: string, segment: string>>>>"
    )
    return st.read_xml_levels(
        t.spark, path, "results", schema, ["underlier", "_underlier.instrument"],
        ["market", "_underlier.zone", "_instrument.id", "_instrument.segment"],
    )


@query(
    "S10",
    """SELECT s_name AS name, 'Owner: ' || s_name || '<br>Zone: Z' || s_nationkey AS description, s_name AS owner, 'Z' || s_nationkey AS zone,
      CAST(s_suppkey % 90 AS DOUBLE) AS latitude, -CAST(s_suppkey % 180 AS DOUBLE) AS longitude FROM supplier""",
)
def placemarks(t: Tables):
    path = scratch_path(t.spark, "kml")
    key = F.col("s_suppkey")
    t.supplier.select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("Owner: "), F.col("s_name"), F.lit("'<br>\nZone:    Z"), F.col("s_nationkey")).alias("description"),
        F.struct(F.concat_ws(",", (-(key % 180)).cast("string"), (key % 90).cast("string"), F.lit("0")).alias("coordinates")).alias("Point"),
    ).write.format("xml").options(rowTag="Placemark", rootTag="Document").save(path)
    marks = st.read_placemarks(t.spark, path)
    return marks.select(
        "*", st.labelled_field(F.col("description"), "Owner").alias("owner"), st.labelled_field(F.col("description"), "Zone").alias("zone")
    )


@query("S12", "SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer")
def fixed_width_customers(t: Tables):
    path = scratch_path(t.spark, "fixed")
    balance = F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_acctbal").cast("string"))
    line = F.concat(F.lpad(F.col("c_custkey").cast("string"), 10, " "), F.rpad("c_mktsegment", 12, " "), F.rpad(balance, 14, " "))
    t.customer.select(line.alias("value")).write.text(path)
    return dl.read_fixed_width(t.spark, path, [("c_custkey", 10, "bigint"), ("c_mktsegment", 12, "string"), ("c_acctbal", 14, "double")])


@query(
    "S13 S14 S20",
    """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, year(o_orderdate)::INT AS year_derived, o_orderstatus AS type_derived FROM orders""",
)
def file_name_columns(t: Tables):
    path = scratch_path(t.spark, "many")
    t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("type")).write.partitionBy(
        "year", "type"
    ).csv(path)
    reader = t.spark.read.schema("o_orderkey bigint, o_totalprice double").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    parts = {"year_derived": (r"year=(\d{4})", 1, "int"), "type_derived": (r"type=(\w)", 1, "string")}
    return dl.with_file_parts(reader.csv(path), parts).drop("file_path")


@query(
    "S13 S15 S16",
    """SELECT count(DISTINCT year(o_orderdate)) AS folders, max(year(o_orderdate))::VARCHAR AS newest_year, count(DISTINCT year(o_orderdate)) AS gz_folders FROM orders""",
)
def folder_listing(t: Tables):
    """Files of a folder for each year; those of the last year are written last and must be found as the newest."""
    path = scratch_path(t.spark, "listing")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    last = rows.agg(F.max("year")).first()[0] or 0
    for part in (rows.where(F.col("year") < last), rows.where(F.col("year") == last)):
        part.write.mode("append").partitionBy("year").option("compression", "gzip").csv(path)
    files = fl.list_files(t.spark, path, "*.csv.gz")
    of = F.regexp_extract("path", r"year=(\d+)", 1)
    facts = files.agg(F.count_distinct(of).alias("folders"), F.count_distinct(F.when(F.col("path").endswith(".gz"), of)).alias("gz_folders"))
    return attach_row(facts, fl.newest_file(t.spark, path, "*.csv.gz").select(of.alias("newest_year")))


@query("S16", "SELECT p_partkey, p_name FROM part")
def zipped_parts(t: Tables):
    """Zip archives made in the executors (a part range each) and read back line by line."""
    import io
    import zipfile

    import pandas as pd

    rows = t.part.select(F.floor(F.col("p_partkey") / 500).alias("chunk"), F.concat_ws(",", "p_partkey", "p_name").alias("line"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("parts.csv", "\n".join(pdf["line"]))
        return pd.DataFrame({"path": ["parts.zip"], "content": [buffer.getvalue()]})

    archives = rows.groupBy("chunk").applyInPandas(pack, "path string, content binary")  # at most 500 rows a group
    lines = fl.unzip_lines(archives)
    return dl.lines_to_columns(lines, T.StructType().add("p_partkey", "long").add("p_name", "string"))


@query("S16 S13", "SELECT p_partkey, p_name, CAST(p_partkey // 500 AS INT) AS chunk FROM part")
def archive_members(t: Tables):
    """Archives of several members written by the executors to a folder, and read with a partition per member."""
    import io
    import zipfile

    import pandas as pd
    import pyarrow.fs as pafs

    from millrace.sources.members import read_archive_lines

    folder = scratch_path(t.spark, "archives")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        system, inner = pafs.FileSystem.from_uri(folder) if folder.startswith("file:") or "://" in folder else (pafs.LocalFileSystem(), folder)
        system.create_dir(inner)
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for chunk, rows in pdf.groupby("chunk"):
                archive.writestr(f"parts/chunk-{chunk}.csv", "\n".join(rows["line"]))
        name = f"{inner}/parts-{pdf['archive'].iloc[0]}.zip"
        with system.open_output_stream(name) as out:
            out.write(buffer.getvalue())
        return pd.DataFrame({"file": [name]})

    chunk = F.floor(F.col("p_partkey") / 500).cast("int")
    rows = t.part.select(chunk.alias("chunk"), F.floor(F.col("p_partkey") / 2000).alias("archive"), F.concat_ws(",", "p_partkey", "p_name").alias("line"))
    rows.groupBy("archive").applyInPandas(pack, "file string").write.format("noop").mode("overwrite").save()  # at most 2,000 rows an archive
    lines = read_archive_lines(t.spark, folder)
    parts = F.split("line", ",", 2)
    return lines.select(parts[0].cast("long").alias("p_partkey"), parts[1].alias("p_name"), F.regexp_extract("member", r"chunk-(\d+)", 1).cast("int").alias("chunk"))


@query("S27 S28", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def frame_to_table(t: Tables):
    """A frame stored as a table, stored again over itself, and read with a predicate and some of its columns."""
    import uuid

    name = f"frame_{uuid.uuid4().hex[:12]}"
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    sk.save_as_table(rows.limit(0), name, scratch_path(t.spark, "frame"))
    sk.save_as_table(rows, name, scratch_path(t.spark, "frame"))
    return sk.table_frame(t.spark, name, "o_orderstatus = 'F'", ["o_orderkey", "o_totalprice"])


@query(
    "S31",
    """SELECT n_name, n_regionkey * 10 AS code, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def local_frame(t: Tables):
    """The nations (a fixed few) changed as a pandas frame, made a Spark frame with a declared schema, and joined."""
    nations = t.nation.toPandas()
    nations["code"] = nations["n_regionkey"] * 10
    made = t.spark.createDataFrame(nations[["n_nationkey", "n_name", "code"]], "n_nationkey int, n_name string, code int")
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    joined = made.join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return joined.select("n_name", "code", F.coalesce("customers", F.lit(0)).alias("customers"))


@query("V07 S19", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0")
def refreshed_table(t: Tables):
    """A table whose whole content, partitions included, is replaced."""
    path = scratch_path(t.spark, "refreshed")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    refresh(rows, path)
    refresh(rows.where("o_orderkey % 2 = 0"), path)
    return t.spark.read.schema(rows.schema).parquet(path)


@query("S17", "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents WHERE lang IS NOT NULL")
def marked_documents(t: Tables):
    """Documents with line breaks, stored with multi-character row and field marks."""
    path = scratch_path(t.spark, "marked")
    line = F.concat_ws("{|}", F.col("doc_id").cast("string"), "lang", "text")
    t.documents.select(F.concat(line, F.lit("{~*]")).alias("value")).write.text(path, lineSep="\0")
    rows = dl.read_terminated(t.spark, path, "{~*]", "{|}", ["doc_id", "lang", "text"])
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.md5("text").alias("text_md5"))


@query("S18", "SELECT c_custkey, c_name FROM customer")
def trimmed_lines(t: Tables):
    """Files with two header lines, a footer, blank and marker lines and trailing commas."""
    path = scratch_path(t.spark, "lines")
    body = F.concat(F.col("c_custkey").cast("string"), F.lit(","), F.col("c_name"), F.lit(","))
    data = t.customer.select("c_nationkey", F.col("c_custkey").alias("at"), F.explode(F.array(body, F.lit(""), F.lit("#sep"))).alias("value"))
    ends = t.customer.groupBy("c_nationkey").agg(F.max("c_custkey").alias("hi"))
    head = ends.select("c_nationkey", F.explode(F.array(F.lit(-2).cast("long"), F.lit(-1).cast("long"))).alias("at"), F.lit("title").alias("value"))
    foot = ends.select("c_nationkey", (F.col("hi") + 1).alias("at"), F.lit("end of file").alias("value"))
    rows = data.unionByName(head).unionByName(foot).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "at")
    rows.drop("at").write.partitionBy("c_nationkey").text(path)
    lines = dl.read_lines(t.spark, path, skip_top=2, skip_bottom=1, drop_lines=["#sep"], trailing_delimiter=",")
    return dl.lines_to_columns(lines, T.StructType().add("c_custkey", "long").add("c_name", "string"))


@query("S19 S31 S33", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderstatus = 'P'")
def saved_and_appended(t: Tables):
    path = scratch_path(t.spark, "table")
    sk.save(t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), path)
    others = t.orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice")
    sk.append([others, t.orders.where("o_orderstatus = 'P'").select("o_orderkey")], path)
    return t.spark.read.parquet(path)


@query(
    "S20 S21 V06 V07",
    """SELECT o_orderkey, year(o_orderdate)::INT AS year, CASE WHEN year(o_orderdate) = 1998 THEN 2 ELSE 1 END AS load FROM orders
    WHERE o_orderdate < TIMESTAMP '2001-01-01'""",
)
def replaced_partition(t: Tables):
    path = scratch_path(t.spark, "parts")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.lit(1).alias("load"))
    sk.save_partitions(sk.new_partitions(rows, "year", None, 2001), path, ["year"])
    again = rows.where("year = 1998").withColumn("load", F.lit(2))
    sk.save_partitions(again, path, ["year"], spread=4)
    return t.spark.read.parquet(path)


@query("V06 I06", "SELECT o_orderkey, o_totalprice, DATE '2024-01-02' AS version FROM orders UNION ALL SELECT o_orderkey, o_totalprice, DATE '2024-01-01' FROM orders WHERE o_orderkey % 2 = 0")
def rerun_same_version(t: Tables):
    path = scratch_path(t.spark, "history")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    day = F.to_date(F.lit("2024-01-01")), F.to_date(F.lit("2024-01-02"))
    append_version(rows.where("o_orderkey % 2 = 0").withColumn("version", day[0]), path)
    append_version(rows.where("o_orderkey % 5 = 0").withColumn("version", day[1]), path)
    append_version(rows.withColumn("version", day[1]), path)
    return t.spark.read.parquet(path)


@query(
    "S22 S23 S27 S28 S29",
    """SELECT o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
    year(o_orderdate)::INT AS year FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 1000""",
)
def table_through_script(t: Tables):
    """Create a declared table, insert staged text typed, and read it back through a script."""
    import uuid

    name = f"orders_{uuid.uuid4().hex[:12]}"
    sk.create_table(t.spark, ORDER_SPEC, scratch_path(t.spark, "table"), name)
    staged = t.orders.select(
        F.col("o_orderkey").cast("string"), "o_orderstatus", F.format_string("%.2f", "o_totalprice").alias("o_totalprice"),
        F.to_date("o_orderdate").cast("string").alias("o_orderdate"), F.lit("2024-01-02").alias("loaded_on"), F.year("o_orderdate").alias("year"),
    )
    sk.insert_typed(staged, ORDER_SPEC, name, F.col("o_orderstatus") != "P")
    script = """-- count first; then the rows
    SELECT count(*) FROM {table};
    SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderdate, year
    FROM IDENTIFIER(:name) WHERE o_totalprice > :low -- cheap ones stay out;
    """
    sk.run_script(t.spark, "SELECT 1; SELECT ';' AS quoted", None)
    return sk.run_script(t.spark, script, {"table": name}, name=name, low=1000)


@query(
    "S24 D04",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 50 <> 0
    UNION ALL SELECT -1, 'bad', count(*)::DOUBLE FROM orders WHERE o_orderkey % 50 = 0""",
)
def bulk_load_with_errors(t: Tables):
    path = scratch_path(t.spark, "bulk")
    bad = F.col("o_orderkey") % 50 == 0
    key = F.when(bad, F.lit("not a number")).otherwise(F.col("o_orderkey").cast("string"))
    status = F.when(F.col("o_orderkey") % 12 == 0, "NULL").when(F.col("o_orderkey") % 6 == 0, "  ").otherwise(F.col("o_orderstatus"))
    t.orders.select(F.concat_ws("|", key, status, F.col("o_totalprice").cast("string")).alias("value")).write.text(path)
    schema = T.StructType().add("o_orderkey", "long").add("o_orderstatus", "string").add("o_totalprice", "double")
    good, failed = ql.split_corrupt(dl.read_bulk(t.spark, schema, path))
    failures = failed.agg(F.count(F.lit(1)).cast("double").alias("o_totalprice"))
    return good.unionByName(failures.select(F.lit(-1).cast("long").alias("o_orderkey"), F.lit("bad").alias("o_orderstatus"), "o_totalprice"))


@query("S25 S26", "SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS l_returnflag, l_extendedprice FROM lineitem")
def unload_and_restore(t: Tables):
    path = scratch_path(t.spark, "unloaded")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"), "l_extendedprice")
    sk.unload(rows, path, order=["l_orderkey", "l_linenumber"])
    return sk.restore(t.spark, path, rows.schema)


@query(
    "P12 P13 J23",
    """SELECT DISTINCT 'CUST.' || replace(c_name, '#', '') || '.' || n_name AS name, c_mktsegment AS concept, 'desk' AS source, upper(c_mktsegment) AS label
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal > 0""",
)
def mapped_attributes(t: Tables):
    mapping = ColumnMapping(
        columns={
            "name": [Part("constant", "CUST"), Part("field", "c_name"), Part("lookup", "country")],
            "concept": [Part("field", "c_mktsegment")],
            "source": [Part("constant", "desk")],
            "label": [Part("expression", "upper(c_mktsegment)")],
        },
        lookups={"country": Lookup("nation", "n_nationkey", "c_nationkey", "n_name")},
        where="c_acctbal > 0",
        distinct=True,
        drop_characters="#",
    )
    return mapping.apply(t.customer, {"nation": t.nation})
