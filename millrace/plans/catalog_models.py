"""Queries over feature selection and models (survey 2.12)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import cleanse as cl
from millrace.operators import models as md
from millrace.operators import selection as sl
from millrace.operators import series as sr
from millrace.operators import wide as wd
from millrace.operators import windows as wn
from millrace.plans.catalog_series import MONTHLY, monthly_revenue
from millrace.plans.catalog_windows import DAILY, daily_revenue
from millrace.plans.registry import Tables, query
from millrace.session import materialise

FEATURES = ["l_quantity", "l_discount", "l_tax"]


def bin_sql(columns, bins):
    return ", ".join(
        f"CAST(1 + least({bins} - 1, floor((rank() OVER (ORDER BY {c}) - 1) * {bins} / (SELECT count(*) FROM lineitem))) AS INT) AS {c}" for c in columns
    )


def mi_sql(pairs, columns, bins):
    parts = " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, sum(c / n * ln(c * n / (cx * cy))) AS mi FROM (SELECT c::DOUBLE AS c, sum(c) OVER ()::DOUBLE AS n, sum(c) OVER (PARTITION BY x)::DOUBLE AS cx,
        sum(c) OVER (PARTITION BY y)::DOUBLE AS cy FROM (SELECT {a} AS x, {b} AS y, count(*) AS c FROM b GROUP BY 1, 2))"""
        for a, b in pairs
    )
    return f"WITH b AS (SELECT {bin_sql(columns, bins)} FROM lineitem), m AS ({parts})"


MI_PAIRS = [(f, "l_extendedprice") for f in FEATURES]


@query(
    "M01",
    f"""{mi_sql(MI_PAIRS, [*FEATURES, 'l_extendedprice'], 12)}
    SELECT a AS name, round(mi, 9) AS mi, round((mi - min(mi) OVER ()) / (max(mi) OVER () - min(mi) OVER ()), 6) AS mi_scaled FROM m""",
)
def feature_information(t: Tables):
    out = sl.mutual_information(t.lineitem, "l_extendedprice", FEATURES, 12)
    return out.select("name", F.round("mi", 9).alias("mi"), F.round("mi_scaled", 6).alias("mi_scaled"))


NET = ["l_discount", "l_extendedprice", "l_quantity", "l_tax"]
NET_PAIRS = [(a, b) for i, a in enumerate(NET) for b in NET[i + 1 :]]


@query(
    "M12",
    f"""{mi_sql(NET_PAIRS, NET, 8)}, e AS (SELECT * FROM m WHERE mi > 0.0003)
    SELECT name, count(*) AS degree, round(sum(mi), 9) AS strength FROM (SELECT a AS name, mi FROM e UNION ALL SELECT b, mi FROM e) GROUP BY name""",
)
def information_graph(t: Tables):
    edges = sl.information_network(t.lineitem, NET, 0.0003, 8)
    nodes = sl.network_nodes(edges)
    return nodes.withColumn("strength", F.round("strength", 9))


@query(
    "M22",
    """SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 9) AS r FROM lineitem
    UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 9) FROM lineitem
    UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 9) FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 9) FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 9) FROM lineitem
    UNION ALL SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 9) FROM lineitem""",
)
def column_correlations(t: Tables):
    out = sl.correlation_pairs(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.withColumn("r", F.round("r", 9))


@query("M22")
def column_redundancy(t: Tables):
    lines = t.lineitem.withColumn("net", F.col("l_extendedprice") * 0.95)
    columns = ["l_quantity", "l_extendedprice", "l_discount", "net"]
    dropped = sl.redundant_columns(lines, columns)
    values = sl.collinearity(lines, columns)
    rows = [(c, c in dropped, v) for c, v in zip(columns, values)]
    return t.spark.createDataFrame(rows, "name string, dropped boolean, eigenvalue double")


@query(
    "M22",
    """SELECT 'l_quantity' AS name, false AS dropped UNION ALL SELECT 'l_extendedprice', abs(corr(l_quantity, l_extendedprice)) > 0.9 FROM lineitem
    UNION ALL SELECT 'l_discount', greatest(abs(corr(l_quantity, l_discount)), abs(corr(l_extendedprice, l_discount))) > 0.9 FROM lineitem
    UNION ALL SELECT 'net', greatest(abs(corr(l_quantity, l_extendedprice * 0.95)), abs(corr(l_extendedprice, l_extendedprice * 0.95)), abs(corr(l_discount, l_extendedprice * 0.95))) > 0.9 FROM lineitem""",
)
def dropped_columns(t: Tables):
    lines = t.lineitem.withColumn("net", F.col("l_extendedprice") * 0.95)
    columns = ["l_quantity", "l_extendedprice", "l_discount", "net"]
    dropped = sl.redundant_columns(lines, columns)
    return t.spark.createDataFrame([(c, c in dropped) for c in columns], "name string, dropped boolean")


@query("M02")
def lasso_scores(t: Tables):
    return sl.lasso(t.lineitem, "l_extendedprice", FEATURES)


@query("M03")
def stable_features(t: Tables):
    return sl.stability_selection(t.lineitem, "l_extendedprice", FEATURES)


@query("M04")
def chunk_inclusion(t: Tables):
    series = monthly_revenue(t, "c_nationkey")
    return wd.wide_chunks(series, "0", rounds=1000, chunk_size=8)


@query("M02")
def series_lasso(t: Tables):
    """Every customer's months as a column, the first customer's as the target."""
    series = monthly_revenue(t, "c_custkey")
    return wd.wide_lasso(series, "1", one_se=True)


@query("M03")
def stable_series(t: Tables):
    return wd.wide_stability(monthly_revenue(t, "c_nationkey"), "0", rounds=200)


@query("M05")
def forest_ranking(t: Tables):
    return md.forest_importance(t.lineitem, "l_extendedprice", FEATURES)


@query("M05")
def shuffled_importance(t: Tables):
    return md.permutation_importance(t.lineitem, "l_extendedprice", FEATURES)


@query("M06 T06")
def blended_ranking(t: Tables):
    lines = t.lineitem
    mi = sl.mutual_information(lines, "l_extendedprice", FEATURES, 12)
    chosen = sl.lasso(lines, "l_extendedprice", FEATURES).select("name", F.col("score").alias("lasso_scaled"))
    forest = md.forest_importance(lines, "l_extendedprice", FEATURES).select("name", "importance_scaled")
    return sl.blend([chosen, mi, forest], ["lasso_scaled", "mi_scaled", "importance_scaled"])


@query(
    "M06 T06",
    f"""{mi_sql(MI_PAIRS, [*FEATURES, 'l_extendedprice'], 12)}, i AS (SELECT a AS name, mi, (mi - min(mi) OVER ()) / (max(mi) OVER () - min(mi) OVER ()) AS mi_scaled FROM m),
    c AS (SELECT 'l_quantity' AS name, abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem UNION ALL SELECT 'l_discount', abs(corr(l_discount, l_extendedprice)) FROM lineitem)
    SELECT name, round(mi_scaled, 6) AS mi_scaled, round(r, 6) AS r, round(mi_scaled + coalesce(r, 0), 6) AS blended, row_number() OVER (ORDER BY mi_scaled + coalesce(r, 0) DESC, name)::INT AS place
    FROM i LEFT JOIN c USING (name)""",
)
def blended_information(t: Tables):
    """Scores of two kinds, one of them for some columns only, blended and ranked."""
    mi = sl.mutual_information(t.lineitem, "l_extendedprice", FEATURES, 12).select("name", "mi_scaled")
    pairs = sl.correlation_pairs(t.lineitem, ["l_quantity", "l_discount", "l_extendedprice"]).where("b = 'l_extendedprice'")
    ranked = sl.blend([mi, pairs.select(F.col("a").alias("name"), F.abs("r").alias("r"))], ["mi_scaled", "r"])
    place = F.row_number().over(Window.orderBy(F.desc("blended"), "name"))  # one row per column
    return ranked.select("name", *[F.round(c, 6).alias(c) for c in ("mi_scaled", "r", "blended")], place.alias("place"))


def granger_sql(effect: str, cause: str) -> str:
    """F statistic of one lag of a cause beside one lag of an effect, from moments."""
    e, e1, c1 = effect, f"{effect}1", f"{cause}1"
    small = f"var_pop({e}) - covar_pop({e}, {e1}) ** 2 / var_pop({e1})"
    det = f"(var_pop({e1}) * var_pop({c1}) - covar_pop({e1}, {c1}) ** 2)"
    fitted = f"(covar_pop({e}, {e1}) ** 2 * var_pop({c1}) + covar_pop({e}, {c1}) ** 2 * var_pop({e1}) - 2 * covar_pop({e}, {e1}) * covar_pop({e}, {c1}) * covar_pop({e1}, {c1})) / {det}"
    return f"CASE WHEN count(*) > 3 THEN round((({small}) - (var_pop({e}) - {fitted})) / ((var_pop({e}) - {fitted}) / (count(*) - 3)), 6) END"


@query(
    "M08",
    f"""WITH mo AS (SELECT c_nationkey::VARCHAR AS name, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS value
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
    j AS (SELECT a.name, a.date, a.value AS x, b.value AS y FROM mo a JOIN mo b ON a.date = b.date AND b.name = '0' WHERE a.name <> '0'),
    d AS (SELECT name, date, x - lag(x) OVER w AS x, y - lag(y) OVER w AS y, row_number() OVER w AS i FROM j WINDOW w AS (PARTITION BY name ORDER BY date)),
    g AS (SELECT name, x, y, lag(x) OVER w AS x1, lag(y) OVER w AS y1, i FROM d WHERE i > 1 WINDOW w AS (PARTITION BY name ORDER BY date))
    SELECT name, {granger_sql('y', 'x')} AS causes_target, {granger_sql('x', 'y')} AS caused_by_target FROM g WHERE i > 2 GROUP BY name""",
)
def granger_of_one_lag(t: Tables):
    out = sl.granger_statistics(monthly_revenue(t, "c_nationkey"), "0")
    return out.select("name", *[F.round(c, 6).alias(c) for c in ("causes_target", "caused_by_target")])


@query("M07 M08")
def granger_tests(t: Tables):
    return sl.granger(monthly_revenue(t, "c_nationkey"), "0")


@query("M09")
def toda_yamamoto_tests(t: Tables):
    return sl.toda_yamamoto(monthly_revenue(t, "c_nationkey"), "0", most=12)


@query("M10")
def oblique_series_clusters(t: Tables):
    """Nations around principal components of their monthly revenue, with own and next R²."""
    return wd.oblique_clusters(monthly_revenue(t, "c_nationkey"), most=6)


@query("M10 T04")
def correlation_clusters(t: Tables):
    return md.variable_clusters(monthly_revenue(t, "c_custkey"), k=6, top=4)


@query("M11")
def size_bounded_clusters(t: Tables):
    return md.bounded_clusters(monthly_revenue(t, "c_nationkey"), most=6)


@query("M11")
def silhouettes(t: Tables):
    return md.cluster_quality(monthly_revenue(t, "c_nationkey"), [2, 4])


def labelled_orders(t: Tables):
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"), F.count(F.lit(1)).cast("double").alias("lines")
    )
    joined = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select("o_orderkey", "quantity", "discount", "lines", "o_totalprice", (F.col("quantity") > 100).cast("int").alias("large"))


ORDER_FEATURES = ["discount", "lines", "o_totalprice"]


def parts(t: Tables):
    """Train and test rows, staged once: every fit and every evaluation reads them."""
    split = materialise(sr.split_by_hash(labelled_orders(t), ["o_orderkey"], 0.8, 3), "parts")
    return split.where("part = 'train'"), split.where("part = 'test'")


SPLIT_SQL = """l AS (SELECT l_orderkey, sum(l_quantity) AS quantity, avg(l_discount) AS discount, count(*)::DOUBLE AS lines FROM lineitem GROUP BY 1),
    rows_ AS (SELECT o_orderkey, quantity, discount, lines, CAST(quantity > 100 AS INT) AS large,
      ('0x' || substr(md5('3|' || o_orderkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.8 AS train FROM orders JOIN l ON o_orderkey = l_orderkey)"""


@query(
    "M13 K18",
    f"""WITH {SPLIT_SQL}, m AS (SELECT avg(quantity) AS my, avg(discount) AS m1, avg(lines) AS m2, var_pop(discount) AS v1, var_pop(lines) AS v2, covar_pop(discount, lines) AS c,
      covar_pop(discount, quantity) AS c1, covar_pop(lines, quantity) AS c2 FROM rows_ WHERE train),
    b AS (SELECT *, (c1 * v2 - c2 * c) / (v1 * v2 - c * c) AS b1, (c2 * v1 - c1 * c) / (v1 * v2 - c * c) AS b2 FROM m),
    r AS (SELECT quantity, quantity - my - b1 * (discount - m1) - b2 * (lines - m2) AS e FROM rows_, b WHERE NOT train)
    SELECT 'linear' AS model, round(1 - sum(e * e) / (count(*) * var_pop(quantity)), 6) AS r2, round(sqrt(avg(e * e)), 6) AS rmse FROM r""",
)
def linear_fit(t: Tables):
    """Least squares on the training rows by the normal equations, scored on the others."""
    train, test = parts(t)
    out = md.regression_report(train, test, ["discount", "lines"], "quantity", ["linear"])
    return out.select("model", F.round("r2", 6).alias("r2"), F.round("rmse", 6).alias("rmse"))


@query(
    "M13 M14 K18",
    f"""WITH {SPLIT_SQL} SELECT model, count_if(large = 1) AS positives, count_if(large = 0) AS negatives FROM rows_, (SELECT unnest(['logistic', 'forest', 'boosting', 'bayes']) AS model)
    WHERE NOT train GROUP BY model""",
)
def classified_rows(t: Tables):
    """The four cells of each model's confusion table make up the test rows of both classes."""
    train, test = parts(t)
    out = md.classification_report(train, test, ORDER_FEATURES, "large", ["logistic", "forest", "boosting", "bayes"])
    return out.select("model", (F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives"))


@query("M13 K18")
def regression_fits(t: Tables):
    train, test = parts(t)
    return md.regression_report(train, test, ["discount", "lines"], "quantity")


@query("M13 M14")
def classifier_fits(t: Tables):
    train, test = parts(t)
    return md.classification_report(train, test, ORDER_FEATURES, "large", ["logistic", "forest", "boosting", "bayes"])


@query("M14")
def forest_settings(t: Tables):
    return md.forest_grid(parts(t)[0], ORDER_FEATURES, "large", depths=[2, 5], trees=[20])


LEVEL_SQL = """WITH c AS (SELECT CAST(o_orderkey % 10 = 0 AS INT) AS rare, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1)
    SELECT rare, {}(n) OVER () AS n FROM c"""


@query("M15", LEVEL_SQL.format("max"))
def balanced_up(t: Tables):
    rows = labelled_orders(t).withColumn("rare", (F.col("o_orderkey") % 10 == 0).cast("int"))
    return md.balance(rows, "rare", ["o_orderkey"]).groupBy("rare").agg(F.count(F.lit(1)).alias("n"))


@query("M15", LEVEL_SQL.format("min"))
def balanced_down(t: Tables):
    rows = labelled_orders(t).withColumn("rare", (F.col("o_orderkey") % 10 == 0).cast("int"))
    return md.balance(rows, "rare", ["o_orderkey"], "down").groupBy("rare").agg(F.count(F.lit(1)).alias("n"))


@query(
    "M16",
    """WITH m AS (SELECT p_brand, avg(p_retailprice) AS m FROM part GROUP BY 1),
    b AS (SELECT p_brand, CAST(least(greatest(ceil((m - min(m) OVER ()) / (max(m) OVER () - min(m) OVER ()) * 4), 1), 4) AS INT) AS p_brand_bin FROM m)
    SELECT p_partkey, p_brand, p_brand_bin FROM part JOIN b USING (p_brand)""",
)
def brand_price_bins(t: Tables):
    return md.target_mean_bins(t.part, "p_brand", "p_retailprice").select("p_partkey", "p_brand", "p_brand_bin")


@query(
    "M17",
    """SELECT event_id, value, abs(value - (SELECT avg(value) FROM events)) > 3 * (SELECT stddev_pop(value) FROM events) AS outlier FROM events""",
)
def event_sigma_split(t: Tables):
    return md.sigma_split(t.events.select("event_id", "value"), "value")


@query(
    "M18",
    """WITH z AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER () AS a,
      (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_samp(l_extendedprice) OVER () AS b, corr(l_quantity, l_extendedprice) OVER () AS r FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, round((a * a - 2 * r * a * b + b * b) / (1 - r * r), 6) AS score FROM z""",
)
def component_scores(t: Tables):
    out = md.pca_scores(t.lineitem, ["l_quantity", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("score", 6).alias("score"))


@query(
    "M19",
    """WITH e AS (SELECT event_id, value AS x, hour(ts)::DOUBLE AS y FROM events),
    m AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS c FROM e)
    SELECT event_id, round(exp(-0.5 * (vy * (x - mx) * (x - mx) - 2 * c * (x - mx) * (y - my) + vx * (y - my) * (y - my)) / (vx * vy - c * c)) / (2 * pi() * sqrt(vx * vy - c * c)), 12) AS density FROM e, m""",
)
def event_density(t: Tables):
    rows = t.events.select("event_id", F.col("value").alias("x"), F.hour("ts").cast("double").alias("y"))
    return md.gaussian_density(rows, ["x", "y"]).select("event_id", F.round("density", 12).alias("density"))


@query(
    "M19",
    """WITH e AS (SELECT value AS x, hour(ts)::DOUBLE AS y, CAST(value > 150 AS INT) AS odd FROM events),
    m AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS c FROM e),
    d AS (SELECT odd, exp(-0.5 * (vy * (x - mx) * (x - mx) - 2 * c * (x - mx) * (y - my) + vx * (y - my) * (y - my)) / (vx * vy - c * c)) / (2 * pi() * sqrt(vx * vy - c * c)) AS p FROM e, m),
    s AS (SELECT odd, least(floor((p - lo) / ((hi - lo) / 1000)) + 1, 1000) AS step FROM d, (SELECT min(p) AS lo, max(p) AS hi FROM d)),
    g AS (SELECT step, sum(count(*)) OVER (ORDER BY step) AS marked, sum(sum(odd)) OVER (ORDER BY step) AS tp, sum(sum(odd)) OVER () AS positives FROM s GROUP BY step)
    SELECT step::INT AS step, round(2 * tp / (marked + positives), 6) AS f1 FROM g WHERE step < 1000 ORDER BY f1 DESC, step LIMIT 1""",
)
def density_cut(t: Tables):
    rows = t.events.select(F.col("value").alias("x"), F.hour("ts").cast("double").alias("y"), (F.col("value") > 150).cast("int").alias("odd"))
    best = md.best_threshold(md.gaussian_density(rows, ["x", "y"]), "density", "odd")
    return best.select("step", F.round("f1", 6).alias("f1"))


@query("M19")
def density_threshold(t: Tables):
    rows = t.events.select(F.col("value").alias("x"), F.hour("ts").cast("double").alias("y"), (F.col("value") > 150).cast("int").alias("odd"))
    return md.best_threshold(md.gaussian_density(rows, ["x", "y"]), "density", "odd")


@query(
    "M20 P29 W16",
    f"""WITH {DAILY}, r AS (SELECT name, date, value / lag(value) OVER (PARTITION BY name ORDER BY date) - 1 AS ret FROM s)
    SELECT name, date, CASE WHEN ret <= -0.5 THEN 1 WHEN ret <= 0 THEN 2 WHEN ret <= 0.5 THEN 3 ELSE 4 END AS label FROM r WHERE ret IS NOT NULL""",
)
def return_classes(t: Tables):
    series = daily_revenue(t)
    ret = F.try_divide("value", F.lag("value").over(wn.series_window())) - 1
    returns = series.select("name", "date", ret.alias("ret")).where(F.col("ret").isNotNull())
    return returns.select("name", "date", cl.right_closed_cut(F.col("ret"), [-0.5, 0.0, 0.5]).alias("label"))


@query(
    "M21",
    """WITH mo AS (SELECT c_nationkey::VARCHAR AS name, date_trunc('month', o_orderdate) AS date FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
    n AS (SELECT name, count(*) AS periods, row_number() OVER (ORDER BY name) AS rank, count(*) OVER () AS names FROM mo GROUP BY name),
    d AS (SELECT ('0x' || substr(md5('11|' || id), 1, 8))::BIGINT AS draw, row_number() OVER () AS k FROM range(30) AS t(id)),
    p AS (SELECT name, periods, count(*) AS times FROM d JOIN n ON rank = draw % names + 1 GROUP BY ALL)
    SELECT name, unnest(range(1, times + 1))::BIGINT AS copy, periods FROM p""",
)
def resampled_columns(t: Tables):
    series = monthly_revenue(t, "c_nationkey")
    picks = sl.sample_names(series, 30, 11)
    repeated = series.join(picks, "name").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return repeated.groupBy("name", "copy").agg(F.count(F.lit(1)).alias("periods"))


@query(
    "M23",
    """WITH w AS (SELECT DISTINCT x FROM (SELECT l_returnflag AS x FROM lineitem UNION ALL SELECT l_linestatus FROM lineitem)),
    c AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS id FROM w)
    SELECT l_orderkey, l_linenumber, l_partkey, a.id AS l_returnflag_id, b.id AS l_linestatus_id FROM lineitem JOIN c a ON a.x = l_returnflag JOIN c b ON b.x = l_linestatus""",
)
def shared_vocabulary(t: Tables):
    out = md.shared_codes(t.lineitem, "l_returnflag", "l_linestatus")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag_id", "l_linestatus_id")


@query(
    "M04",
    f"""WITH {MONTHLY} SELECT name, count(*) AS periods, max(value) AS top, 'ok' AS chunk_status, NULL AS chunk_error FROM mo GROUP BY name""",
)
def grouped_function(t: Tables):
    """A user function per chunk with its status (survey 2.17)."""

    def summarise(pdf):
        import pandas as pd

        return pd.DataFrame({"name": [pdf["name"].iloc[0]], "periods": [len(pdf)], "top": [pdf["value"].max()]})

    return sl.run_chunks(monthly_revenue(t), "name", summarise, "name string, periods long, top double")
