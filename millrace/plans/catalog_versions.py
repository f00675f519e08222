"""Queries over change capture (survey 2.8), reshape (2.9) and data quality (2.15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import quality as ql
from millrace.operators import reshape as rs
from millrace.operators import versioning as vs
from millrace.operators.aggregate import cents
from millrace.operators.ordered import attach_row
from millrace.plans.registry import Tables, query
from millrace.session import scratch_path



def v1():
    return F.lit("2024-01-01").cast("date")


def v2():
    return F.lit("2024-01-02").cast("date")


KEY, VALUE = ["o_orderkey"], ["o_totalprice"]


def first_snapshot(t: Tables):
    """Orders before a cut date, some with an older price."""
    old_price = F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice"))
    before = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    return t.orders.where(before).select("o_orderkey", old_price.alias("o_totalprice"))


def second_snapshot(t: Tables):
    """All orders but a deleted set, with the present price (null for some)."""
    price = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_totalprice"))
    return t.orders.where("o_orderkey % 11 <> 0").select("o_orderkey", price.alias("o_totalprice"))


def captured_history(t: Tables):
    first = first_snapshot(t).select("*", v1().alias("version"), F.lit("I").alias("status"))
    second = vs.changes(second_snapshot(t), vs.latest(first, KEY), KEY, VALUE, v2())
    return first.unionByName(second)


SNAPS = """s1 AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
s2 AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 11 <> 0),
ins AS (SELECT * FROM s2 WHERE o_orderkey IN (SELECT o_orderkey FROM s2 EXCEPT SELECT o_orderkey FROM s1)),
mod AS (SELECT s2.* FROM s2 WHERE o_orderkey IN (SELECT o_orderkey FROM (SELECT * FROM s2 EXCEPT SELECT * FROM s1)
  INTERSECT SELECT o_orderkey FROM (SELECT o_orderkey FROM s2 INTERSECT SELECT o_orderkey FROM s1))),
del AS (SELECT o_orderkey FROM s1 EXCEPT SELECT o_orderkey FROM s2),
chg AS (SELECT o_orderkey, o_totalprice, DATE '2024-01-02' AS version, 'I' AS status FROM ins
  UNION ALL SELECT o_orderkey, o_totalprice, DATE '2024-01-02', 'M' FROM mod
  UNION ALL SELECT o_orderkey, NULL, DATE '2024-01-02', 'D' FROM del),
hist AS (SELECT o_orderkey, o_totalprice, DATE '2024-01-01' AS version, 'I' AS status FROM s1 UNION ALL SELECT * FROM chg)"""


@query("V01 V02 V03", f"WITH {SNAPS} SELECT * FROM chg")
def change_capture(t: Tables):
    return captured_history(t).where(F.col("version") == v2())


@query(
    "V05 W02 V01 V02 V03",
    f"""WITH {SNAPS} SELECT o_orderkey, o_totalprice, version, status FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn
    FROM hist) WHERE rn = 1 AND status <> 'D'""",
)
def latest_after_capture(t: Tables):
    return vs.latest(captured_history(t), KEY)


@query(
    "V05",
    f"""WITH {SNAPS} SELECT o_orderkey, o_totalprice, version, status FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn
    FROM hist WHERE status <> 'D') WHERE rn = 1""",
)
def latest_with_deleted_first(t: Tables):
    return vs.latest(captured_history(t), KEY, deleted_first=True)


@query("W02", f"WITH {SNAPS} SELECT * FROM hist WHERE version <= DATE '2024-01-01'")
def asof_first_version(t: Tables):
    return vs.latest(captured_history(t), KEY, asof=v1())


@query(
    "D07",
    f"""WITH {SNAPS} SELECT version, count_if(status = 'I')::BIGINT AS recsinserted, count_if(status = 'M')::BIGINT AS recsmodified,
    count_if(status = 'D')::BIGINT AS recsdeleted FROM hist GROUP BY version""",
)
def capture_counts(t: Tables):
    return vs.change_counts(captured_history(t))


@query(
    "V04",
    """SELECT c_custkey, c_name, c_mktsegment, DATE '2024-01-02' AS version FROM (
    SELECT c_custkey, c_name, c_mktsegment FROM customer EXCEPT
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN 'OLD' ELSE c_mktsegment END FROM customer WHERE c_custkey % 9 <> 0)""",
)
def attribute_change_rows(t: Tables):
    now = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    old = F.when(F.col("c_custkey") % 5 == 0, "OLD").otherwise(F.col("c_mktsegment"))
    return vs.attribute_changes(now, now.where("c_custkey % 9 <> 0").withColumn("c_mktsegment", old), v2())


def scd_target(t: Tables):
    """Current and expired customer rows before the run."""
    old = F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal") + 10).otherwise(F.col("c_acctbal"))
    base = t.customer.where("c_custkey % 9 <> 0").select(
        "c_custkey", "c_mktsegment", old.alias("c_acctbal"), F.lit("I").alias("recstatus"), v1().alias("recfromdate"),
        F.lit(None).cast("date").alias("recexpirydate"),
    )
    earlier = base.where("c_custkey % 4 = 0").withColumns(
        {
            "c_acctbal": F.col("c_acctbal") - 5,
            "recfromdate": F.lit("2023-01-01").cast("date"),
            "recexpirydate": v1(),
        }
    )
    return base.unionByName(earlier)


def scd_source(t: Tables):
    return t.customer.where("c_custkey % 8 <> 0").select("c_custkey", "c_mktsegment", "c_acctbal")


SCD = """tgt AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 10 ELSE c_acctbal END AS c_acctbal,
  'I' AS recstatus, DATE '2024-01-01' AS recfromdate, NULL::DATE AS recexpirydate FROM customer WHERE c_custkey % 9 <> 0),
old AS (SELECT c_custkey, c_mktsegment, c_acctbal - 5 AS c_acctbal, recstatus, DATE '2023-01-01' AS recfromdate, DATE '2024-01-01' AS recexpirydate
  FROM tgt WHERE c_custkey % 4 = 0),
src AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 8 <> 0),
ch AS (SELECT s.* FROM src s JOIN tgt t ON s.c_custkey = t.c_custkey WHERE s.c_mktsegment IS DISTINCT FROM t.c_mktsegment OR s.c_acctbal IS DISTINCT FROM t.c_acctbal),
res AS (SELECT * FROM old
  UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal, 'I', DATE '2024-01-02', NULL FROM src WHERE c_custkey NOT IN (SELECT c_custkey FROM tgt)
  UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal, 'M', DATE '2024-01-02', NULL FROM ch
  UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal, CASE WHEN c_custkey NOT IN (SELECT c_custkey FROM src) THEN 'D' ELSE recstatus END, recfromdate,
    CASE WHEN c_custkey NOT IN (SELECT c_custkey FROM src) OR c_custkey IN (SELECT c_custkey FROM ch) THEN DATE '2024-01-02' END FROM tgt)"""


@query("V08", f"WITH {SCD} SELECT * FROM res")
def scd2_customers(t: Tables):
    return vs.scd2_merge(scd_target(t), scd_source(t), ["c_custkey"], ["c_mktsegment", "c_acctbal"], v2())


@query(
    "V08 D07",
    f"""WITH {SCD} SELECT count_if(recfromdate = DATE '2024-01-02' AND recstatus = 'I')::BIGINT AS recsinserted,
    count_if(recfromdate = DATE '2024-01-02' AND recstatus = 'M')::BIGINT AS recsmodified,
    count_if(recexpirydate = DATE '2024-01-02' AND recstatus = 'D')::BIGINT AS recsdeleted FROM res""",
)
def scd2_run_counts(t: Tables):
    merged = vs.scd2_merge(scd_target(t), scd_source(t), ["c_custkey"], ["c_mktsegment", "c_acctbal"], v2())
    return vs.scd2_counts(merged, v2())


@query(
    "V09",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'new' ELSE p_brand END AS p_brand FROM part WHERE p_size > 25 OR p_partkey % 2 = 0""",
)
def upserted_parts(t: Tables):
    target = t.part.where("p_partkey % 2 = 0").select("p_partkey", "p_brand")
    source = t.part.where("p_size > 25").select("p_partkey", F.lit("new").alias("p_brand"))
    return vs.upsert(target, source, ["p_partkey"])


@query("V10", "SELECT p_partkey, p_name FROM part WHERE p_size > 25 AND p_partkey % 2 <> 0")
def insert_only_parts(t: Tables):
    target = t.part.where("p_partkey % 2 = 0").select("p_partkey", "p_name")
    return vs.insert_only(target, t.part.where("p_size > 25").select("p_partkey", "p_name"), ["p_partkey"])


@query(
    "V11",
    """WITH b AS (SELECT o_orderkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS published FROM orders)
    SELECT o_orderkey, published, 'history' AS place FROM b WHERE published = (SELECT min(published) FROM b)
    UNION ALL SELECT o_orderkey, published, 'source' FROM b WHERE published > (SELECT min(published) FROM b)""",
)
def oldest_batch_to_history(t: Tables):
    batches = t.orders.select("o_orderkey", F.trunc(F.to_date("o_orderdate"), "year").alias("published"))
    oldest, rest = vs.split_oldest(batches, "published")
    return oldest.withColumn("place", F.lit("history")).unionByName(rest.withColumn("place", F.lit("source")))


@query(
    "V12",
    """WITH m AS (SELECT o_custkey, max(o_totalprice) AS best FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT c_custkey, coalesce(best, c_acctbal) AS c_acctbal FROM customer LEFT JOIN m ON o_custkey = c_custkey""",
)
def balance_from_orders(t: Tables):
    best = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal")
    )
    return vs.update_from(t.customer.select("c_custkey", "c_acctbal"), best, ["c_custkey"], ["c_acctbal"])


@query("V13 I06", "SELECT DISTINCT event_id, event_type FROM events WHERE event_id % 3 = 0")
def rows_not_loaded(t: Tables):
    source = t.events.select("event_id", "event_type", F.lit("2024-02-02").alias("load_date"))
    target = t.events.where("event_id % 3 <> 0").select("event_id", "event_type", F.lit("2024-02-01").alias("load_date"))
    return vs.not_loaded(source, target, ignore=["load_date"])


@query(
    "V15",
    """SELECT n_nationkey, n_name, count(c_custkey) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey <> 1 GROUP BY ALL
    UNION ALL SELECT n_nationkey, 'merged', count(c_custkey) FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey = 1 GROUP BY ALL""",
)
def replaced_nations(t: Tables):
    counts = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    rows = t.nation.join(counts, F.col("c_nationkey") == F.col("n_nationkey")).select("n_nationkey", "n_name", "customers", "n_regionkey")
    merged = rows.where("n_regionkey = 1").withColumn("n_name", F.lit("merged"))
    return vs.replace_where(rows, "n_regionkey = 1", merged).drop("n_regionkey")


# ---- reshape


@query(
    "R01 R02 R03 U01",
    """SELECT l_orderkey, l_linenumber, l_partkey, 'quantity' AS measure, l_quantity AS value FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'discount', l_discount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'tax', l_tax FROM lineitem""",
)
def melted_lines(t: Tables):
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    return rs.melt(t.lineitem, ids, ["l_quantity", "l_discount", "l_tax"], "measure", "value", strip="l_")


MONTH_SQL = ", ".join(
    f"CAST(coalesce(sum(CASE WHEN month(o_orderdate) = {m} THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS m{m:02d}" for m in range(1, 13)
)


@query(
    "R06 A04",
    f"SELECT o_custkey, year(o_orderdate)::INT AS yr, {MONTH_SQL} FROM orders GROUP BY ALL",
)
def months_as_columns(t: Tables):
    wide = rs.widen(
        t.orders.select("o_custkey", F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("m"), "o_totalprice"),
        ["o_custkey", "yr"], "m", list(range(1, 13)), F.sum(cents("o_totalprice")).cast("double"),
    )
    return wide.select("o_custkey", "yr", *[F.coalesce(F.col(str(m)), F.lit(0.0)).alias(f"m{m:02d}") for m in range(1, 13)])


def melted_months(orders):
    """A row a year with month columns, melted, dated by header text such as ``Jan 1997`` and summed once."""
    from millrace.functions.dates import period_start

    names = [m.title() for m in ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")]
    wide = orders.select(
        "o_orderpriority", F.year("o_orderdate").cast("string").alias("yr"),
        *[F.when(F.month("o_orderdate") == i, cents("o_totalprice")).alias(n) for i, n in enumerate(names, start=1)],
    )
    long = rs.melt(wide, ["o_orderpriority", "yr"], names, "name", "value", not_null=["value"])
    headed = long.withColumn("header", F.concat_ws(" ", "name", "yr"))
    sums = headed.groupBy("o_orderpriority", "header").agg(F.sum("value").cast("double").alias("value"))
    return sums.select("o_orderpriority", period_start(F.col("header")).alias("month"), "value")


@query(
    "A04 R05 P20",
    """SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
    FROM orders GROUP BY ALL""",
)
def wide_months_of_all_years(t: Tables):
    return melted_months(t.orders)


@query(
    "R04",
    """SELECT l_orderkey, l_linenumber, l_partkey, 1 AS slot, l_quantity AS amount, l_discount AS rate FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 2, l_extendedprice, l_tax FROM lineitem""",
)
def paired_measures(t: Tables):
    groups = {1: {"amount": "l_quantity", "rate": "l_discount"}, 2: {"amount": "l_extendedprice", "rate": "l_tax"}}
    return rs.melt_measures(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey"], groups, "slot")


@query(
    "R08",
    """WITH v AS (SELECT vec_id, i, embedding[i] AS value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))
    SELECT vec_id, CAST(DATE '2000-01-01' + to_months(CAST((i - 1) * CASE WHEN vec_id % 3 = 0 THEN 12 WHEN vec_id % 3 = 1 THEN 3 ELSE 1 END AS INT)) AS DATE) AS date,
      CAST(value AS DOUBLE) AS value FROM v WHERE value IS NOT NULL""",
)
def dated_vectors(t: Tables):
    vectors = t.embeddings.select(
        "vec_id",
        F.lit("2000-01-01").cast("date").alias("start"),
        F.col("embedding").cast("array<double>").alias("data"),
        F.get(F.array(F.lit("a"), F.lit("q"), F.lit("m")), (F.col("vec_id") % 3).cast("int")).alias("freq"),
    )
    return rs.dated_array(vectors, ["vec_id"], "start", "data", "freq")


@query(
    "R09",
    """SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INT) AS seg_BUILDING, CAST(c_mktsegment = 'HOUSEHOLD' AS INT) AS seg_HOUSEHOLD,
    CAST(c_acctbal > 0 AS INT) AS in_credit FROM customer""",
)
def one_hot_segments(t: Tables):
    encoded = rs.one_hot(t.customer, "c_mktsegment", ["AUTOMOBILE", "BUILDING", "HOUSEHOLD"], "seg")
    return encoded.select("c_custkey", "seg_BUILDING", "seg_HOUSEHOLD", (F.col("c_acctbal") > 0).cast("int").alias("in_credit"))


@query(
    "R10",
    """SELECT c_mktsegment AS name, count(*) AS observations, CAST(min(o_orderdate) AS DATE) AS first_date
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def attributes_with_series(t: Tables):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("name"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value")
    )
    attributes, series = rs.split_attributes(joined, ["name"], [], ["date", "value"])
    facts = series.groupBy("name").agg(F.count(F.lit(1)).alias("observations"), F.min("date").alias("first_date"))
    return attributes.join(facts, "name")


def sheet_cells(t: Tables):
    """Order counts laid out as workbook cells: a sheet per nation, a block per order status, a line per year.

    Statuses, first year and height of the blocks come from the orders.
    """
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    year = F.year("o_orderdate")
    first, last = F.min(year).alias("first"), F.max(year).alias("last")
    layout = t.orders.agg(first, last, F.array_sort(F.collect_set("o_orderstatus")).alias("statuses"))  # one row
    lines = F.col("last") - F.col("first") + 1
    cells = joined.groupBy(F.col("c_nationkey").alias("sheet"), "o_orderstatus", F.month("o_orderdate").alias("col"), year.alias("yr"))
    counts = (
        attach_row(cells.agg(F.count(F.lit(1)).alias("n")), layout)
        # a label, the headers, the lines, the stop row and an empty row
        .withColumn("start", ((F.array_position("statuses", F.col("o_orderstatus")) - 1) * (lines + 4)).cast("int"))
        .withColumn("row", F.col("start") + 2 + F.col("yr") - F.col("first"))
        .withColumn("stop", F.col("start") + 2 + lines)
    )
    data = counts.select("sheet", "row", "col", F.col("n").cast("string").alias("value"))
    frame = counts.select("sheet", "start", "stop", "o_orderstatus").distinct()
    label = frame.select("sheet", F.col("start").alias("row"), F.lit(0).alias("col"), F.concat(F.lit("Status "), "o_orderstatus").alias("value"))
    stop = frame.select("sheet", F.col("stop").alias("row"), F.lit(0).alias("col"), F.lit("Total").alias("value"))
    head = counts.select("sheet", (F.col("start") + 1).alias("row"), "col", F.concat(F.lit("M"), F.col("col").cast("string")).alias("value")).distinct()
    items = counts.select("sheet", "row", F.lit(0).alias("col"), F.col("yr").cast("string").alias("value")).distinct()
    return data.unionByName(label).unionByName(stop).unionByName(head).unionByName(items)


@query(
    "R07",
    """SELECT c_nationkey AS sheet, 'Status ' || o_orderstatus AS block, year(o_orderdate)::VARCHAR AS item, 'M' || month(o_orderdate) AS header, count(*)::VARCHAR AS value
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def sheet_blocks_of_all_statuses(t: Tables):
    statuses = t.orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()  # a few values
    return rs.cell_blocks(sheet_cells(t), [f"Status {r[0]}" for r in statuses])


@query(
    "S11",
    """SELECT n_nationkey AS sheet, p.c_custkey::VARCHAR AS customer, p.c_mktsegment AS segment FROM nation JOIN customer p ON c_nationkey = n_nationkey""",
)
def sheet_rows(t: Tables):
    """Customers laid out as sheets (a header row on top, a footer below) and read back as rows."""
    body = t.customer.select(
        F.col("c_nationkey").alias("sheet"), (F.col("c_custkey") + 1).cast("int").alias("row"),
        F.posexplode(F.array(F.col("c_custkey").cast("string"), "c_mktsegment")).alias("col", "value"),
    )
    edges = body.groupBy("sheet").agg((F.max("row") + 1).alias("last"))
    header = edges.select("sheet", F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit("customer").alias("value"))
    footer = edges.select("sheet", F.col("last").alias("row"), F.lit(0).alias("col"), F.lit("source: desk").alias("value"))
    rows = rs.cells_to_rows(body.unionByName(header).unionByName(footer), ["customer", "segment"], 1, 1)
    return rows.drop("row")


@query("S11 S14", "SELECT c_nationkey AS nation, c_custkey::VARCHAR AS customer, c_mktsegment AS segment FROM customer")
def workbook_rows(t: Tables):
    """Customers written by the executors as workbooks, a book per nation and a sheet per segment, and read back by sheet."""
    import pandas as pd
    import pyarrow.fs as pafs

    from millrace.sources.members import read_sheet_cells, workbook

    folder = scratch_path(t.spark, "books")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        system, inner = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
        system.create_dir(inner)
        name = f"{inner}/nation-{pdf['c_nationkey'].iloc[0]}-{pdf['part'].iloc[0]}.xlsx"
        sheets = {s: [["customer", "segment"], *rows[["customer", "c_mktsegment"]].to_numpy().tolist()] for s, rows in pdf.groupby("c_mktsegment")}
        with system.open_output_stream(name) as out:
            out.write(workbook(sheets))
        return pd.DataFrame({"file": [name]})

    # a book holds at most about 5,000 customers of a nation
    customers = t.customer.select("c_nationkey", (F.floor(F.col("c_custkey") / 100_000)).alias("part"), F.col("c_custkey").cast("string").alias("customer"), "c_mktsegment")
    customers.groupBy("c_nationkey", "part").applyInPandas(write, "file string").write.format("noop").mode("overwrite").save()
    cells = read_sheet_cells(t.spark, folder).withColumn("sheet", F.concat_ws("|", "file", "sheet"))
    rows = rs.cells_to_rows(cells, ["customer", "segment"], 1, 0)
    return rows.select(F.regexp_extract("sheet", r"nation-(\d+)-", 1).cast("int").alias("nation"), "customer", "segment")


# ---- quality

COUNTS = """c AS (SELECT o_custkey, DATE '2024-01-01' AS version, count(*) AS n FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1
  UNION ALL SELECT o_custkey, DATE '2024-01-02', count(*) FROM orders GROUP BY 1)"""


@query(
    "D01 D02",
    f"""WITH {COUNTS}, l AS (SELECT o_custkey, version AS current_version, n AS current_rowcount, lag(version) OVER w AS prior_version, lag(n) OVER w AS prior_rowcount
      FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY version))
    SELECT *, abs(current_rowcount - prior_rowcount) AS change, abs(current_rowcount - prior_rowcount) / least(current_rowcount, prior_rowcount) AS ratio
    FROM l WHERE prior_rowcount <> current_rowcount""",
)
def rowcount_mismatch(t: Tables):
    before = ql.count_snapshot(t.orders.where("o_orderkey % 3 <> 0"), "o_custkey", v1())
    return ql.mismatch_from_prior(before.unionByName(ql.count_snapshot(t.orders, "o_custkey", v2())), "o_custkey")


@query(
    "D03",
    """WITH a AS (SELECT c_nationkey AS k, count(*) AS x FROM customer GROUP BY 1),
    b AS (SELECT s_nationkey AS k, count(*) AS y FROM supplier GROUP BY 1),
    r AS (SELECT abs(coalesce(x, 0) - coalesce(y, 0)) / greatest(coalesce(x, 0), coalesce(y, 0)) AS ratio FROM a FULL JOIN b USING (k))
    SELECT max(ratio) AS worst, count_if(ratio >= 0.9)::BIGINT AS failures, count_if(ratio >= 0.9) = 0 AS passed FROM r""",
)
def load_gate(t: Tables):
    a = t.customer.select(F.col("c_nationkey").alias("k"))
    b = t.supplier.select(F.col("s_nationkey").alias("k"))
    return ql.gate(ql.source_target_counts(a, b, "k"), 0.9)
