"""Vessel pings, voyages and trips: cleaning, distances, sessions, volumes, zones, nowcasts."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import date_plus_minutes
from millrace.functions.geo import cell, distance_km, inside_ring, ring_cells
from millrace.operators.ordered import add_prior, segment_hot
from millrace.operators.windows import compress_sessions, sessions
from millrace.session import materialise

# Medium crude density (kg per m³) and barrels per m³.
CRUDE_DENSITY = 835
BARRELS_PER_M3 = 6.29


def clean_pings(pings: DataFrame, ships: DataFrame) -> DataFrame:
    """Pings of listed ships that are nearly still and loaded; time = day + whole minutes.

    ``pings``: imo, change_date, ageminutes, sog, draught, …; ``ships``: imo.
    """
    kept = pings.where((F.col("sog") < 2) & (F.col("draught") > 0)).join(ships.select("imo"), "imo", "left_semi")
    return kept.withColumn("pingtime", date_plus_minutes(F.col("change_date"), F.col("ageminutes")))


def merge_pings(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both sources, equal rows once."""
    return first.unionByName(second).distinct()


def moved_pings(pings: DataFrame, order: Sequence[str] = ("pingtime", "ais_id"), min_km: float = 0.1) -> DataFrame:
    """Pings further than ``min_km`` from the next ping of the ship, numbered after the merge."""
    cut = segment_hot(pings, ["imo"], order[0], ties=order[1:])
    nearby = add_prior(cut, ["imo"], order, {"_lat": "latitude", "_lon": "longitude"}, following=True)
    km = distance_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon"))
    return nearby.withColumn("distance_in_km", km).where(F.col("distance_in_km") > min_km).drop("_lat", "_lon", "_seg")


def ship_dimensions(pings: DataFrame) -> DataFrame:
    """Largest length and width, draught range per ship."""
    return pings.groupBy("imo").agg(
        F.max("vessellength").alias("vessellength"), F.max("width").alias("width"),
        F.max("draught").alias("max_draught_seen"), F.min("draught").alias("min_draught_seen"),
    )


def journeys(calls: DataFrame, vessels: DataFrame, since: Column) -> DataFrame:
    """Calls with prior sail date, duration and the draught at the following call; international
    moves whose draught changed. ``calls``: call_id, imo, mmsi, saildate, arrdate, draught, countries."""
    keys, order = ["imo", "mmsi"], ["arrdate", "call_id"]
    cut = segment_hot(calls, keys, "arrdate", ties=["call_id"])
    known = add_prior(cut, keys, order, {"priorsaildate": "saildate"}, ignore_nulls=True).where(F.col("priorsaildate").isNotNull())
    known = add_prior(known, keys, order, {"departuredraught": "draught"}, ignore_nulls=True, following=True)
    hours = (F.unix_micros(F.col("arrdate").cast("timestamp")) - F.unix_micros(F.col("priorsaildate").cast("timestamp"))) / 3.6e9
    moved = known.where(
        (F.col("draught") > 0) & (F.col("departuredraught") > 0) & (F.col("draught") != F.col("departuredraught"))
        & (F.col("priorcountryname") != F.col("countryname")) & (F.col("arrdate") > since)
    )
    out = moved.withColumn("duration_hours", hours).withColumnRenamed("draught", "arrivaldraught").drop("_seg")
    return out.join(vessels.select(*keys, "maxdraft"), keys)


def compress_calls(calls: DataFrame) -> DataFrame:
    """Calls of a ship merged while the country does not change, then while the draught does not.

    ``calls``: call_id, imo, mmsi, arrdate, countries, arrival and departure draught, maxdraft.
    """
    keys = ["imo", "mmsi"]
    cut = segment_hot(calls, keys, "arrdate", ties=["call_id"])
    abroad = sessions(cut, keys, ["arrdate", "call_id"], F.col("priorcountryname") != F.col("countryname"), "trip")
    trips = compress_sessions(
        abroad, keys, "trip", ["arrdate", "call_id"], ["arrdate", "priorcountryname", "arrivaldraught"],
        ["arrdate", "countryname", "departuredraught", "maxdraft"],
    )
    trips = trips.select(
        *keys, "trip", F.col("first_arrdate").alias("arrdate"), F.col("last_arrdate").alias("saildate"),
        F.col("first_priorcountryname").alias("priorcountryname"), F.col("last_countryname").alias("countryname"),
        F.col("first_arrivaldraught").alias("arrivaldraught"), F.col("last_departuredraught").alias("departuredraught"),
        F.col("last_maxdraft").alias("maxdraft"),
    )
    loaded = sessions(segment_hot(trips, keys, "arrdate", ties=["trip"]), keys, ["arrdate", "trip"], F.col("arrivaldraught") != F.col("departuredraught"), "voyage")
    out = compress_sessions(
        loaded, keys, "voyage", ["arrdate", "trip"], ["arrdate", "priorcountryname", "arrivaldraught"],
        ["saildate", "countryname", "departuredraught", "maxdraft"],
    )
    return out.where(F.col("first_priorcountryname") != F.col("last_countryname"))


def cargo_volumes(journeys_df: DataFrame, vessels: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Barrels moved by hull size, deadweight and gross-tonnage volume.

    Draughts are capped at the ship's maximum. ``vessels``: imo, dwt, gross_m3 (volume already solved
    from gross tonnage), width, vessellength, maxdraft.
    """
    joined = journeys_df.join(vessels, "imo").where((F.col("dwt") > 0) & (F.col("arrivaldraught") <= F.col("maxdraft")))
    change = F.least("arrivaldraught", "maxdraft") - F.least("departuredraught", "maxdraft")
    share = F.abs("draught_diff") / F.col("maxdraft")
    per_tonne = 1000.0 / CRUDE_DENSITY * BARRELS_PER_M3
    return joined.withColumn("draught_diff", change).withColumns(
        {
            "bbl_size": F.lit(ratio) * F.col("width") * F.col("vessellength") * F.abs("draught_diff") * BARRELS_PER_M3,
            "bbl_dwt": F.col("dwt") * per_tonne * share,
            "bbl_gt": F.col("gross_m3") * per_tonne * share,
        }
    )


def monthly_flows(volumes: DataFrame) -> DataFrame:
    """Thousand barrels per month and country pair."""
    sums = [F.round(F.sum(f"bbl_{m}") / 1000, 0).alias(f"est_{m}") for m in ("size", "dwt", "gt")]
    return volumes.groupBy(F.year("arrdate").alias("year"), F.month("arrdate").alias("month"), "priorcountryname", "countryname").agg(*sums)


def country_rankings(volumes: DataFrame) -> DataFrame:
    """Count, volume and share of every country, received and sent, from one pass: ``(side, country, n, total, share)``."""
    sides = F.array(
        F.struct(F.lit("received").alias("side"), F.col("countryname").alias("country"), (F.col("draught_diff") > 0).alias("moved")),
        F.struct(F.lit("sent").alias("side"), F.col("priorcountryname").alias("country"), (F.col("draught_diff") < 0).alias("moved")),
    )
    rows = volumes.select("bbl_dwt", F.inline(sides)).where("moved")
    groups = rows.groupBy("side", "country").agg(F.count(F.lit(1)).alias("n"), F.sum("bbl_dwt").alias("total"))
    return groups.withColumn("share", F.col("total") / F.sum("total").over(Window.partitionBy("side")))  # one row per country


def against_reported(estimates: DataFrame, reported: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimate as a percentage of the reported figure; zero when nothing was reported."""
    joined = estimates.join(reported, list(keys), "left")
    none = (F.col("reported") == 0) & (F.col("estimate") != 0)
    return joined.withColumn("accuracy", F.when(none, 0.0).otherwise(F.try_divide(F.col("estimate"), F.col("reported")) * 100))


def uniqueness(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("values"), F.count(F.lit(1)).alias("rows")).where(F.col("values") > 1)


# ---- zones


def zone_cover(zones: DataFrame, size: float, most: int = 64) -> DataFrame:
    """At most ``most`` cells for each zone: ``(zone, level, _cx, _cy, ring)``, ring null for cells inside the zone."""

    def cover(batches):
        for pdf in batches:
            out = []
            for zone, ring in zip(pdf["zone"], pdf["ring"]):
                points = [(p["x"], p["y"]) for p in ring] if ring is not None else []
                out += [(zone, level, column, row, None if inner else ring) for level, column, row, inner in ring_cells(points, size, most)]
            yield pd.DataFrame(out, columns=["zone", "level", "_cx", "_cy", "ring"])

    kinds = {f.name: f.dataType for f in zones.schema}
    schema = T.StructType().add("zone", kinds["zone"]).add("level", T.IntegerType()).add("_cx", T.LongType()).add("_cy", T.LongType()).add("ring", kinds["ring"])
    return zones.select("zone", "ring").mapInPandas(cover, schema)


def assign_zones(points: DataFrame, zones: DataFrame, x: str, y: str, size: float, most: int = 64) -> DataFrame:
    """Zones of each point, a row per zone; one row with null outside every zone.

    ``zones``: zone, ring (array of struct x, y). Every zone is covered by cells of several widths: few wide ones inside, where
    no test is needed, and finer ones along the border, at most ``most`` in all whatever the zone's size. A point has one cell
    of each width in use and meets the zones of it by an equi join on the cell; only border cells test the ring.
    """
    cover = materialise(zone_cover(zones, size, most), "zone-cells")
    levels = sorted(r[0] for r in cover.select("level").distinct().collect())  # a few widths
    met, found = points, []
    for level in levels:
        width = size * 2.0**level
        offered = cover.where(F.col("level") == level).groupBy("_cx", "_cy").agg(F.collect_list(F.struct("zone", "ring")).alias(f"_z{len(found)}"))
        same = (F.col("_cx") == cell(F.col(x), width)) & (F.col("_cy") == cell(F.col(y), width))
        met = met.join(offered, same, "left").drop("_cx", "_cy")
        found.append(f"_z{len(found)}")
    if not found:
        return points.withColumn("zone", F.lit(None).cast(zones.schema["zone"].dataType))
    none = F.array().cast(met.schema[found[0]].dataType)
    every = F.concat(*[F.coalesce(F.col(c), none) for c in found])
    hits = F.filter(every, lambda z: z["ring"].isNull() | inside_ring(F.col(x), F.col(y), z["ring"]))
    return met.withColumn("_hits", hits).select(*points.columns, F.explode_outer(F.transform("_hits", lambda z: z["zone"])).alias("zone"))


def trip_metrics(trips: DataFrame) -> DataFrame:
    """Duration, speed and tip share of trips; impossible trips are left out.

    ``trips``: start, finish, distance, fare, tip.
    """
    seconds = (F.unix_micros(F.col("finish").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))) / 1e6
    timed = trips.withColumn("seconds", seconds).where(F.col("seconds") > 10)
    speed = F.col("distance") / (F.col("seconds") / 3600)
    tip = F.try_divide(F.col("tip"), F.col("fare")) * 100
    return timed.withColumns({"speed": speed, "tip_pct": tip}).where(F.col("speed") <= 120)


def zone_hour_matrix(df: DataFrame, zone: str, ts: str, agg: Column, fill: float = 0.0) -> DataFrame:
    """One row per zone, one column per hour."""
    wide = df.groupBy(zone).pivot("_hour", list(range(24))) if "_hour" in df.columns else (
        df.withColumn("_hour", F.hour(ts)).groupBy(zone).pivot("_hour", list(range(24)))
    )
    out = wide.agg(agg)
    return out.select(zone, *[F.coalesce(F.col(str(h)), F.lit(fill)).alias(f"h{h}") for h in range(24)])


def month_to_date_nowcast(moves: DataFrame, day: int) -> DataFrame:
    """Full-month volume predicted from the arrivals before a day of the month.

    ``moves``: country, saildate, arrdate, volume. Three conditional sums come from one aggregation;
    the cumulative windows run over one row per country and month. The baseline uses all days.
    """
    same = (F.year("arrdate") == F.year("saildate")) & (F.month("arrdate") == F.month("saildate"))
    early = same & (F.dayofmonth("arrdate") < day)
    monthly = moves.groupBy("country", F.trunc(F.col("arrdate").cast("date"), "month").alias("month")).agg(
        F.sum(F.when(early, F.col("volume"))).alias("partial"),
        F.sum(F.when(same, F.col("volume"))).alias("baseline"),
        F.sum("volume").alias("full"),
    )
    known = monthly.where(F.col("partial").isNotNull() & F.col("baseline").isNotNull())
    w = Window.partitionBy("country").orderBy("month")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = known.select(
        "*",
        (F.sum("partial").over(upto) / F.sum("full").over(upto)).alias("_rp"),
        (F.sum("baseline").over(upto) / F.sum("full").over(upto)).alias("_rb"),
    )
    predicted = shares.select(
        "country", "month", "partial", "baseline", "full",
        F.try_divide(F.col("partial"), F.lag("_rp").over(w)).alias("prediction"),
        F.try_divide(F.col("baseline"), F.lag("_rb").over(w)).alias("baseline_prediction"),
    ).na.drop("any")

    def minmax(col: str) -> Column:
        return F.least("full", col) / F.greatest("full", col)

    return predicted.withColumns(
        {
            "ape": F.abs(F.col("full") - F.col("prediction")) / F.col("full"),
            "ape_baseline": F.abs(F.col("full") - F.col("baseline_prediction")) / F.col("full"),
            "minmax": minmax("prediction"),
            "minmax_baseline": minmax("baseline_prediction"),
        }
    )
