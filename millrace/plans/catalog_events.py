"""Queries over voyages, trips, zones (survey 2.13) and text (2.14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import textmining as tm
from millrace.operators import voyages as vg
from millrace.plans.registry import Tables, query
from millrace.session import discard

# ---- pings: ships are users, positions come from the keys


def pings(t: Tables, source: int):
    e = t.events.where(F.col("event_id") % 3 != source)
    key = F.col("event_id")
    return e.select(
        F.col("user_id").alias("imo"),
        key.alias("ais_id"),
        F.to_date("ts").alias("change_date"),
        (F.hour("ts") * 60 + F.minute("ts") + 0.5).alias("ageminutes"),
        ((key * 37 % 1201) / 10.0 - 60).alias("latitude"),
        ((key * 91 % 3001) / 10.0 - 150).alias("longitude"),
        (F.col("value") % 4).alias("sog"),
        F.when(key % 11 != 0, F.col("value")).otherwise(0.0).alias("draught"),
        (F.lit(50.0) + F.col("user_id") % 100).alias("vessellength"),
        (F.lit(10.0) + key % 20).alias("width"),
    )


def ships(t: Tables):
    return t.events.select(F.col("user_id").alias("imo")).where("imo % 4 <> 0").distinct()


def merged(t: Tables):
    return vg.merge_pings(vg.clean_pings(pings(t, 0), ships(t)), vg.clean_pings(pings(t, 1), ships(t)))


PING_SQL = """p AS (SELECT user_id AS imo, event_id AS ais_id, date_trunc('minute', ts)::TIMESTAMP AS pingtime, (event_id * 37 % 1201) / 10.0::DOUBLE - 60 AS latitude,
  (event_id * 91 % 3001) / 10.0::DOUBLE - 150 AS longitude, value % 4 AS sog, CASE WHEN event_id % 11 <> 0 THEN value ELSE 0.0 END AS draught,
  50.0::DOUBLE + user_id % 100 AS vessellength, 10.0::DOUBLE + event_id % 20 AS width FROM events),
c AS (SELECT * FROM p WHERE imo % 4 <> 0 AND sog < 2 AND draught > 0),
m AS (SELECT * FROM c WHERE ais_id % 3 <> 0 UNION SELECT * FROM c WHERE ais_id % 3 <> 1)"""


@query("G01 G02", f"WITH {PING_SQL} SELECT imo, ais_id, pingtime, draught FROM m")
def merged_pings(t: Tables):
    return merged(t).select("imo", "ais_id", "pingtime", "draught")


@query(
    "G03",
    f"""WITH {PING_SQL}, n AS (SELECT *, lead(latitude) OVER w AS lat2, lead(longitude) OVER w AS lon2 FROM m WINDOW w AS (PARTITION BY imo ORDER BY pingtime, ais_id)),
    d AS (SELECT imo, ais_id, 111.111 * degrees(acos(greatest(-1, least(1, cos(radians(latitude)) * cos(radians(lat2)) * cos(radians(longitude - lon2)) + sin(radians(latitude)) * sin(radians(lat2)))))) AS km FROM n WHERE lat2 IS NOT NULL)
    SELECT imo, ais_id, round(km, 3) AS km FROM d WHERE km > 0.1""",
)
def neighbour_distances(t: Tables):
    return vg.moved_pings(merged(t)).select("imo", "ais_id", F.round("distance_in_km", 3).alias("km"))


@query("G05", f"WITH {PING_SQL} SELECT imo, max(vessellength) AS vessellength, max(width) AS width, max(draught) AS max_draught_seen, min(draught) AS min_draught_seen FROM m GROUP BY imo")
def ship_sizes(t: Tables):
    return vg.ship_dimensions(merged(t))


# ---- calls and journeys


def calls(t: Tables):
    key = F.col("event_id")
    return t.events.select(
        key.alias("call_id"),
        F.col("user_id").alias("imo"),
        (F.col("user_id") % 2).alias("mmsi"),
        F.col("ts").alias("arrdate"),
        F.when(key % 5 != 0, F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(20))).alias("saildate"),
        F.when(key % 4 != 0, F.round(F.col("value") % 20, 0)).alias("draught"),
        F.concat(F.lit("C"), key % 7).alias("priorcountryname"),
        F.concat(F.lit("C"), key % 5).alias("countryname"),
    )


def vessels(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("imo"), (F.col("c_custkey") % 2).alias("mmsi"), F.lit(18.0).alias("maxdraft"),
        (F.lit(1000.0) + F.col("c_custkey") * 10).alias("dwt"), (F.lit(900.0) + F.col("c_custkey") * 5).alias("gross_m3"),
        (F.lit(20.0) + F.col("c_custkey") % 10).alias("width"), (F.lit(100.0) + F.col("c_custkey") % 50).alias("vessellength"),
    )


CALLS_SQL = """k AS (SELECT event_id AS call_id, user_id AS imo, user_id % 2 AS mmsi, ts AS arrdate, CASE WHEN event_id % 5 <> 0 THEN ts + INTERVAL 20 HOUR END AS saildate,
  CASE WHEN event_id % 4 <> 0 THEN round(value % 20, 0) END AS draught, 'C' || (event_id % 7) AS priorcountryname, 'C' || (event_id % 5) AS countryname FROM events),
ve AS (SELECT c_custkey AS imo, c_custkey % 2 AS mmsi, 18.0::DOUBLE AS maxdraft, 1000.0::DOUBLE + c_custkey * 10 AS dwt, 900.0::DOUBLE + c_custkey * 5 AS gross_m3,
  20.0::DOUBLE + c_custkey % 10 AS width, 100.0::DOUBLE + c_custkey % 50 AS vessellength FROM customer),
a AS (SELECT *, last_value(saildate IGNORE NULLS) OVER (PARTITION BY imo, mmsi ORDER BY arrdate, call_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS priorsaildate FROM k),
b AS (SELECT *, first_value(draught IGNORE NULLS) OVER (PARTITION BY imo, mmsi ORDER BY arrdate, call_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS departuredraught
  FROM a WHERE priorsaildate IS NOT NULL),
j AS (SELECT b.*, b.draught AS arrivaldraught, maxdraft, epoch_us(arrdate) - epoch_us(priorsaildate) AS us FROM b JOIN ve USING (imo, mmsi)
  WHERE draught > 0 AND departuredraught > 0 AND draught <> departuredraught AND priorcountryname <> countryname AND arrdate > TIMESTAMP '2024-01-03')"""


def journey_rows(t: Tables):
    return vg.journeys(calls(t), vessels(t), F.lit("2024-01-03").cast("timestamp_ntz"))


@query("G06 W10", f"WITH {CALLS_SQL} SELECT call_id, imo, priorsaildate, arrivaldraught, departuredraught, us / 3.6e9::DOUBLE AS duration_hours, maxdraft FROM j")
def international_journeys(t: Tables):
    return journey_rows(t).select("call_id", "imo", "priorsaildate", "arrivaldraught", "departuredraught", "duration_hours", "maxdraft")


SESSION_SQL = f"""{CALLS_SQL}, s AS (SELECT call_id, imo, mmsi, arrdate, priorcountryname, countryname, draught AS arrivaldraught, departuredraught, 18.0::DOUBLE AS maxdraft FROM b
    WHERE draught IS NOT NULL AND departuredraught IS NOT NULL),
  s1 AS (SELECT *, sum(CASE WHEN priorcountryname <> countryname THEN 1 ELSE 0 END) OVER (PARTITION BY imo, mmsi ORDER BY arrdate, call_id ROWS UNBOUNDED PRECEDING) AS trip FROM s),
  t1 AS (SELECT imo, mmsi, trip, min(arrdate) AS arrdate, max(arrdate) AS saildate, arg_min(priorcountryname, (arrdate, call_id)) AS priorcountryname, arg_max(countryname, (arrdate, call_id)) AS countryname,
    arg_min(arrivaldraught, (arrdate, call_id)) AS arrivaldraught, arg_max(departuredraught, (arrdate, call_id)) AS departuredraught FROM s1 GROUP BY 1, 2, 3),
  s2 AS (SELECT *, sum(CASE WHEN arrivaldraught <> departuredraught THEN 1 ELSE 0 END) OVER (PARTITION BY imo, mmsi ORDER BY arrdate, trip ROWS UNBOUNDED PRECEDING) AS voyage FROM t1),
  t2 AS (SELECT imo, voyage::BIGINT AS voyage, count(*) AS steps, min(arrdate) AS arrdate, arg_max(saildate, (arrdate, trip)) AS saildate, arg_min(priorcountryname, (arrdate, trip)) AS priorcountryname,
    arg_max(countryname, (arrdate, trip)) AS countryname, arg_min(arrivaldraught, (arrdate, trip)) AS arrivaldraught, arg_max(departuredraught, (arrdate, trip)) AS departuredraught FROM s2 GROUP BY imo, mmsi, voyage)
  SELECT * FROM t2 WHERE priorcountryname <> countryname"""


@query("G07 W14", f"WITH {SESSION_SQL}")
def compressed_voyages(t: Tables):
    from millrace.operators.ordered import add_prior, segment_hot

    keys, order = ["imo", "mmsi"], ["arrdate", "call_id"]
    known = add_prior(segment_hot(calls(t), keys, "arrdate"), keys, order, {"priorsaildate": "saildate"}, ignore_nulls=True).where(F.col("priorsaildate").isNotNull())
    known = add_prior(known, keys, order, {"departuredraught": "draught"}, ignore_nulls=True, following=True).drop("_seg")
    ready = known.withColumnRenamed("draught", "arrivaldraught").na.drop(subset=["arrivaldraught", "departuredraught"]).withColumn("maxdraft", F.lit(18.0))
    out = vg.compress_calls(ready)
    return out.select(
        "imo", "voyage", "steps", F.col("first_arrdate").alias("arrdate"), F.col("last_saildate").alias("saildate"), F.col("first_priorcountryname").alias("priorcountryname"),
        F.col("last_countryname").alias("countryname"), F.col("first_arrivaldraught").alias("arrivaldraught"), F.col("last_departuredraught").alias("departuredraught"),
    )


VOLUME_SQL = f"""{CALLS_SQL}, v AS (SELECT j.*, least(arrivaldraught, ve.maxdraft) - least(departuredraught, ve.maxdraft) AS dd, dwt, gross_m3, width, vessellength FROM j JOIN ve ON j.imo = ve.imo
    WHERE dwt > 0 AND arrivaldraught <= ve.maxdraft),
  w AS (SELECT *, dd AS draught_diff, 0.8::DOUBLE * width * vessellength * abs(dd) * 6.29::DOUBLE AS bbl_size, dwt * (1000.0::DOUBLE / 835 * 6.29::DOUBLE) * (abs(dd) / maxdraft) AS bbl_dwt,
    gross_m3 * (1000.0::DOUBLE / 835 * 6.29::DOUBLE) * (abs(dd) / maxdraft) AS bbl_gt FROM v)"""


def volumes(t: Tables):
    return vg.cargo_volumes(journey_rows(t).drop("maxdraft"), vessels(t).drop("mmsi"))


@query(
    "G08",
    f"""WITH {VOLUME_SQL} SELECT year(arrdate)::INT AS year, month(arrdate)::INT AS month, priorcountryname, countryname, round(sum(bbl_size) / 1000, 0) AS est_size,
    round(sum(bbl_dwt) / 1000, 0) AS est_dwt, round(sum(bbl_gt) / 1000, 0) AS est_gt FROM w GROUP BY ALL""",
)
def monthly_country_flows(t: Tables):
    return vg.monthly_flows(volumes(t))


@query(
    "G09 A11",
    f"""WITH {VOLUME_SQL}, r AS (SELECT 'received' AS side, countryname AS country, bbl_dwt FROM w WHERE draught_diff > 0 UNION ALL SELECT 'sent', priorcountryname, bbl_dwt FROM w WHERE draught_diff < 0)
    SELECT side, country, count(*) AS n, round(sum(bbl_dwt), 3) AS total, round(sum(bbl_dwt) / sum(sum(bbl_dwt)) OVER (PARTITION BY side), 9) AS share FROM r GROUP BY side, country""",
)
def country_rankings(t: Tables):
    out = vg.country_rankings(volumes(t))
    return out.select("side", "country", "n", F.round("total", 3).alias("total"), F.round("share", 9).alias("share"))


@query(
    "G10 R05",
    f"""WITH {VOLUME_SQL}, e AS (SELECT countryname, month(arrdate)::INT AS month, round(sum(bbl_dwt) / 1000, 0) AS estimate FROM w GROUP BY ALL),
    r AS (SELECT 'C' || (n_nationkey % 5) AS countryname, 1 AS month, sum(n_nationkey % 3 * 1000.0::DOUBLE) AS reported FROM nation GROUP BY 1)
    SELECT countryname, month, estimate, reported, round(CASE WHEN reported = 0 AND estimate <> 0 THEN 0 ELSE estimate / nullif(reported, 0) * 100 END, 6) AS accuracy FROM e LEFT JOIN r USING (countryname, month)""",
)
def estimate_against_reported(t: Tables):
    estimates = volumes(t).groupBy("countryname", F.month("arrdate").alias("month")).agg(F.round(F.sum("bbl_dwt") / 1000, 0).alias("estimate"))
    reported = t.nation.groupBy(F.concat(F.lit("C"), F.col("n_nationkey") % 5).alias("countryname")).agg(
        F.sum(F.col("n_nationkey") % 3 * 1000.0).alias("reported")
    ).withColumn("month", F.lit(1))
    out = vg.against_reported(estimates, reported, ["countryname", "month"])
    return out.select("countryname", "month", "estimate", "reported", F.round("accuracy", 6).alias("accuracy"))


@query(
    "G11 A05",
    """SELECT p_name, count(DISTINCT p_brand) AS "values", count(*) AS rows FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""",
)
def ambiguous_names(t: Tables):
    return vg.uniqueness(t.part, "p_name", "p_brand")


@query(
    "G12",
    """WITH z AS (SELECT 'Z' || n_nationkey AS zone, (n_nationkey % 5) * 20 + 10.03::DOUBLE AS cx, (n_nationkey // 5) * 20 + 10.04::DOUBLE AS cy FROM nation),
    p AS (SELECT event_id, (event_id * 13 % 1000) / 10.0::DOUBLE AS x, (event_id * 29 % 1000) / 10.0::DOUBLE AS y FROM events)
    SELECT event_id, zone FROM p LEFT JOIN z ON abs(x - cx) + abs(y - cy) < 9.9""",
)
def point_zones(t: Tables):
    cx = F.col("n_nationkey") % 5 * 20 + F.lit(10.03)
    cy = F.floor(F.col("n_nationkey") / 5) * 20 + F.lit(10.04)
    corner = [(cx - 9.9, cy), (cx, cy + 9.9), (cx + 9.9, cy), (cx, cy - 9.9)]
    ring = F.array(*[F.struct(a.cast("double").alias("x"), b.cast("double").alias("y")) for a, b in corner])
    zones = t.nation.select(F.concat(F.lit("Z"), F.col("n_nationkey")).alias("zone"), ring.alias("ring"))
    points = t.events.select(
        "event_id", (F.col("event_id") * 13 % 1000 / F.lit(10.0)).alias("x"), (F.col("event_id") * 29 % 1000 / F.lit(10.0)).alias("y")
    )
    return vg.assign_zones(points, zones, "x", "y", 5.0).select("event_id", "zone")


def trips(t: Tables):
    key = F.col("event_id")
    return t.events.select(
        "event_id", F.col("ts").alias("start"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (key % 1800).cast("decimal(18,6)"))).alias("finish"),
        (F.col("value") / 10).alias("distance"), F.col("value").alias("fare"), (key % 5).cast("double").alias("tip"),
        (F.col("user_id") % 10).alias("zone"),
    )


TRIP_SQL = """tr AS (SELECT event_id, ts AS start, (event_id % 1800)::DOUBLE AS seconds, value / 10 AS distance, value AS fare, (event_id % 5)::DOUBLE AS tip, user_id % 10 AS zone FROM events),
tm AS (SELECT *, distance / (seconds / 3600) AS speed, tip / fare * 100 AS tip_pct FROM tr WHERE seconds > 10),
tk AS (SELECT * FROM tm WHERE speed <= 120)"""


@query("G13 P23", f"WITH {TRIP_SQL} SELECT event_id, seconds, round(speed, 9) AS speed, round(tip_pct, 9) AS tip_pct FROM tk")
def trip_speeds(t: Tables):
    out = vg.trip_metrics(trips(t))
    return out.select("event_id", "seconds", F.round("speed", 9).alias("speed"), F.round("tip_pct", 9).alias("tip_pct"))


SPEED_COLUMNS = ", ".join(f"coalesce(round(avg(CASE WHEN hour(start) = {h} THEN speed END), 6), 0.0) AS h{h}" for h in range(24))


@query("G14 R06", f"WITH {TRIP_SQL} SELECT zone, {SPEED_COLUMNS} FROM tk GROUP BY zone")
def zone_hour_speeds(t: Tables):
    return vg.zone_hour_matrix(vg.trip_metrics(trips(t)), "zone", "start", F.round(F.avg("speed"), 6))


@query(
    "G15",
    """WITH mv AS (SELECT 'N' || c_nationkey AS country, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 20 AS INT) AS saildate, CAST(o_orderdate AS DATE) AS arrdate, CAST(o_totalprice AS DECIMAL(18,2)) AS volume
      FROM orders JOIN customer ON o_custkey = c_custkey),
    f AS (SELECT *, year(arrdate) = year(saildate) AND month(arrdate) = month(saildate) AS same FROM mv),
    mo AS (SELECT country, CAST(date_trunc('month', arrdate) AS DATE) AS month, sum(CASE WHEN same AND day(arrdate) < 20 THEN volume END)::DOUBLE AS partial,
      sum(CASE WHEN same THEN volume END)::DOUBLE AS baseline, sum(volume)::DOUBLE AS "full" FROM f GROUP BY ALL),
    k AS (SELECT * FROM mo WHERE partial IS NOT NULL AND baseline IS NOT NULL),
    r AS (SELECT *, sum(partial) OVER w / sum("full") OVER w AS rp, sum(baseline) OVER w / sum("full") OVER w AS rb FROM k WINDOW w AS (PARTITION BY country ORDER BY month ROWS UNBOUNDED PRECEDING)),
    p AS (SELECT *, partial / lag(rp) OVER w AS prediction, baseline / lag(rb) OVER w AS baseline_prediction FROM r WINDOW w AS (PARTITION BY country ORDER BY month))
    SELECT country, month, round(partial, 2) AS partial, round(baseline, 2) AS baseline, round("full", 2) AS "full", round(prediction, 3) AS prediction, round(baseline_prediction, 3) AS baseline_prediction,
      round(abs("full" - prediction) / "full", 9) AS ape, round(abs("full" - baseline_prediction) / "full", 9) AS ape_baseline,
      round(least("full", prediction) / greatest("full", prediction), 9) AS minmax, round(least("full", baseline_prediction) / greatest("full", baseline_prediction), 9) AS minmax_baseline
    FROM p WHERE prediction IS NOT NULL AND baseline_prediction IS NOT NULL""",
)
def month_nowcast(t: Tables):
    day = F.to_date("o_orderdate")
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    moves = joined.select(
        F.concat(F.lit("N"), "c_nationkey").alias("country"), F.date_sub(day, (F.col("o_orderkey") % 20).cast("int")).alias("saildate"),
        day.alias("arrdate"), F.col("o_totalprice").alias("volume"),
    )
    out = vg.month_to_date_nowcast(moves, 20)
    digits = {"partial": 2, "baseline": 2, "full": 2, "prediction": 3, "baseline_prediction": 3, "ape": 9, "ape_baseline": 9, "minmax": 9, "minmax_baseline": 9}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


# ---- text

STOP = ["the", "and", "of", "to", "in", "is", "on", "for", "by", "de", "la", "le", "les", "der", "die", "und", "el", "los"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
WORDS_SQL = r"""w AS (SELECT doc_id, [x for x in regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') if regexp_matches(x, '\p{L}')] AS words FROM documents)"""


@query("X01 I07", f"WITH {WORDS_SQL} SELECT doc_id, len(words)::INT AS n_tokens, md5(array_to_string(words, ' ')) AS tokens_md5 FROM w")
def document_tokens(t: Tables):
    out = tm.tokens(t.documents.select("doc_id", "text"))
    return out.select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("X05", f"WITH {WORDS_SQL}, x AS (SELECT doc_id, unnest(words) AS token FROM w) SELECT doc_id, token, count(*) AS n FROM x GROUP BY ALL")
def word_counts(t: Tables):
    return tm.bag_of_words(t.documents, "doc_id")


@query(
    "X01",
    r"""WITH w AS (SELECT unnest([x for x in regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') if regexp_matches(x, '\p{L}')]) AS token FROM benchmark),
    s AS (SELECT CASE WHEN regexp_matches(token, '(^|[^ea])ies$') THEN regexp_replace(token, 'ies$', 'y') WHEN regexp_matches(token, '(^|[^aeo])es$') THEN regexp_replace(token, 'es$', 'e')
      WHEN regexp_matches(token, '(^|[^us])s$') THEN regexp_replace(token, 's$', '') ELSE token END AS token FROM w)
    SELECT token, count(*)::BIGINT AS n FROM s GROUP BY token""",
)
def stemmed_words(t: Tables):
    bag = tm.bag_of_words(t.benchmark, "item_id", stem=True)
    return bag.groupBy("token").agg(F.sum("n").alias("n"))


TFIDF_SQL = rf"""{WORDS_SQL}, k AS (SELECT doc_id, [x for x in words if x NOT IN ({STOP_SQL})] AS words FROM w),
g AS (SELECT doc_id, unnest(words) AS token FROM k UNION ALL SELECT doc_id, unnest([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) FROM k),
bag AS (SELECT doc_id, token, count(*) AS n FROM g GROUP BY ALL),
nd AS (SELECT count(DISTINCT doc_id) AS docs FROM bag),
tt AS (SELECT token, count(*) AS df, sum(n) AS cf FROM bag GROUP BY token),
voc AS (SELECT token, ln((1 + docs) / (1 + df)) + 1 AS idf FROM tt, nd WHERE df >= docs * 0.02 AND df <= docs * 0.7 ORDER BY cf DESC, token LIMIT 2000),
wt AS (SELECT doc_id, token, n * idf AS w FROM bag JOIN voc USING (token)),
tf AS (SELECT doc_id, token, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM wt)"""


def weights(t: Tables):
    bag = tm.bag_of_words(t.documents, "doc_id", n=2, stop=STOP)
    weighted = tm.tf_idf(bag, "doc_id")
    discard(bag)  # the weights are stored
    return weighted


@query("X02 X05", f"WITH {TFIDF_SQL} SELECT token, count(*) AS documents, round(max(weight), 9) AS largest FROM tf GROUP BY token")
def term_weights(t: Tables):
    """Weights by the form that never writes the bag of the corpus."""
    out = tm.tf_idf_of_texts(t.documents, "doc_id", n=2, stop=STOP)
    return out.groupBy("token").agg(F.count(F.lit(1)).alias("documents"), F.round(F.max("weight"), 9).alias("largest"))


@query("X02", f"WITH {TFIDF_SQL} SELECT doc_id, token, round(weight, 9) AS weight FROM tf")
def document_tf_idf(t: Tables):
    return weights(t).withColumn("weight", F.round("weight", 9))


@query(
    "X03",
    f"""WITH {TFIDF_SQL}, d AS (SELECT source, doc_id, lead(doc_id) OVER (PARTITION BY source ORDER BY doc_id) AS other FROM documents),
    pr AS (SELECT doc_id, other FROM d WHERE other IS NOT NULL),
    dots AS (SELECT pr.doc_id, pr.other, sum(a.weight * b.weight) AS c FROM pr JOIN tf a ON a.doc_id = pr.doc_id JOIN tf b ON b.doc_id = pr.other AND a.token = b.token GROUP BY ALL)
    SELECT pr.doc_id, pr.other, round(coalesce(c, 0), 7) AS cosine FROM pr LEFT JOIN dots USING (doc_id, other)""",
)
def neighbour_cosines(t: Tables):
    from millrace.operators.ordered import add_prior, segment_hot

    # the next document of a source, by number
    docs = segment_hot(t.documents.select("source", "doc_id"), ["source"], F.col("doc_id"))
    pairs = add_prior(docs, ["source"], ["doc_id"], {"other": "doc_id"}, following=True).where(F.col("other").isNotNull())
    out = tm.cosine_of_pairs(weights(t), pairs.select("doc_id", "other"), "doc_id", "doc_id", "other")
    return out.withColumn("cosine", F.round("cosine", 7))


@query(
    "X03",
    f"""WITH {TFIDF_SQL}, me AS (SELECT source, doc_id, token, weight FROM tf JOIN documents USING (doc_id)),
    ce AS (SELECT source, token, sum(weight) AS c FROM me GROUP BY ALL), cn AS (SELECT source, token, c / sqrt(sum(c * c) OVER (PARTITION BY source)) AS c FROM ce)
    SELECT doc_id, me.source, round(sum(weight * c), 7) AS cosine FROM me JOIN cn ON me.source = cn.source AND me.token = cn.token GROUP BY ALL""",
)
def source_centroid_cosines(t: Tables):
    out = tm.cosine_to_group(weights(t), t.documents, "doc_id", "source")
    return out.withColumn("cosine", F.round("cosine", 7))


@query(
    "X03",
    f"""WITH {TFIDF_SQL}, pr AS (SELECT a.doc_id, b.doc_id AS other, round(sum(a.weight * b.weight), 7) AS cosine FROM tf a JOIN tf b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY ALL)
    SELECT doc_id, other, cosine FROM pr WHERE cosine >= 0.9 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, other) <= 5""",
)
def nearest_documents(t: Tables):
    return tm.nearest_texts(weights(t), "doc_id", threshold=0.9, n=5, release=True)


@query("X04 X02")
def text_cluster_terms(t: Tables):
    return tm.text_clusters(t.documents, "doc_id", k=20, top=10, stop=STOP)[1]
