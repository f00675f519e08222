"""Zones by cells of several widths, and streams with state of their own."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions.geo import ring_cells
from millrace.operators import voyages as vg
from millrace.streaming import incremental as inc
from millrace.streaming import stateful as sf


def crosses(x, y, ring):
    odd = False
    for (px, py), (qx, qy) in zip(ring, ring[1:] + ring[:1]):
        if (py > y) != (qy > y) and x < px + (y - py) / (qy - py) * (qx - px):
            odd = not odd
    return odd


def rings(rng):
    star = [(50 + r * math.cos(a), 40 + r * math.sin(a)) for a, r in ((i * math.pi / 20, rng.uniform(5, 60)) for i in range(40))]
    knot = [(rng.uniform(-30, 30), rng.uniform(-30, 30)) for _ in range(9)]
    return {
        "star": star, "knot": knot, "square": [(0, 0), (8, 0), (8, 8), (0, 8)], "sliver": [(-90.0, 3.001), (400.0, 3.002), (400.0, 3.003)], "dot": [(5.5, 5.5)] * 3,
        "huge": [(-5000.0, -5000.0), (5000.0, -4000.0), (4500.0, 5000.0), (-5000.0, 4000.0)],
    }


@pytest.mark.parametrize("most", [4, 64, 400])
def test_cells_cover_the_ring(most):
    rng = random.Random(1)
    for name, ring in rings(rng).items():
        cells = ring_cells(ring, 5.0, most)
        assert 0 < len(cells) <= most, name
        for _ in range(400):
            x, y = rng.uniform(-120, 120), rng.uniform(-120, 120)
            own = [inner for level, cx, cy, inner in cells if math.floor(x / (5.0 * 2.0**level)) == cx and math.floor(y / (5.0 * 2.0**level)) == cy]
            assert len(own) <= 1
            if crosses(x, y, ring):
                assert own, (name, x, y)
            if own and own[0]:
                assert crosses(x, y, ring)
    assert any(inner for *_, inner in ring_cells(rings(rng)["huge"], 5.0, 64)) and ring_cells([], 5.0) == []


def test_zones_against_every_pair(spark):
    rng = random.Random(2)
    zones = rings(rng)
    points = [(i, float(rng.randint(-20, 20)), float(rng.randint(-20, 20))) for i in range(150)] + [(150 + i, rng.uniform(-6000, 6000), rng.uniform(-6000, 6000)) for i in range(50)]
    points += [(200, None, 1.0), (201, 1e9, 1e9), (0, points[0][1], points[0][2])]
    frame = spark.createDataFrame(points, "id int, x double, y double").repartition(3)
    table = spark.createDataFrame([(n, [(float(a), float(b)) for a, b in r]) for n, r in zones.items()] + [("none", None), ("empty", [])], "zone string, ring array<struct<x:double,y:double>>")
    got = Counter((r["id"], r["zone"]) for r in vg.assign_zones(frame, table, "x", "y", 5.0).collect())
    expected = Counter()
    for i, x, y in points:
        own = [n for n, r in zones.items() if x is not None and crosses(x, y, r)]
        expected.update((i, n) for n in own or [None])
    assert got == expected
    assert Counter(r["zone"] for r in vg.assign_zones(frame, table.limit(0), "x", "y", 5.0).collect()) == {None: len(points)}


EVENTS = "event_id bigint, ts timestamp, kind string, cents bigint"


def test_late_events_are_corrections(spark, tmp_path):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=rng.randint(0, 60 * 72)), rng.choice("ab"), rng.randint(-500, 500)) for i in range(600)]
    rows += [(600 + i, start + timedelta(minutes=5), "late only", 1) for i in range(3)]
    order = rows[:]
    rng.shuffle(order)
    end = [(-1, start + timedelta(days=9), k, None) for k in ("a", "b", "late only")]
    with sf.state_store(spark):
        for part in (order[:200], order[200:420], order[420:], end):
            spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            inc.write_updates(sf.hour_totals(stream, "ts", "kind", F.col("cents"), delay=2 * sf.HOUR), str(tmp_path / "out"), str(tmp_path / "marks"), mode="append")
    stored = spark.read.parquet(str(tmp_path / "out"))
    got = {(r["key"], r["hour"]): (r["n"], round(r["total"] * 100)) for r in sf.summed_hours(stored).collect()}
    expected = {}
    for _, ts, kind, cents in rows:
        key = kind, ts.replace(minute=0)
        n, total = expected.get(key, (0, 0))
        expected[key] = n + 1, total + cents
    assert got == expected
    kinds = {r["kind"]: r["n"] for r in stored.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    assert kinds["late"] > 100 and sum(kinds.values()) == len(rows)
    assert stored.where("kind = 'closed'").groupBy("key", "hour").count().where("count > 1").count() == 0


def test_sessions_with_late_rows(spark, tmp_path):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=rng.randint(0, 60 * 24 * 8)), rng.choice(["u", "v"]), 1) for i in range(250)]
    order = rows[:]
    rng.shuffle(order)
    end = [(-1, start + timedelta(days=30), k, None) for k in ("u", "v")]
    gap = 2 * sf.HOUR
    with sf.state_store(spark):
        for part in (order[:100], order[100:], end):
            spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            found = sf.session_stretches(stream, "ts", "kind", gap, 5 * sf.HOUR, F.col("event_id") >= 0)
            inc.write_updates(found, str(tmp_path / "out"), str(tmp_path / "marks"), mode="append")
    stored = spark.read.parquet(str(tmp_path / "out"))
    got = sorted((r["key"], r["first"], r["last"], r["steps"]) for r in sf.whole_sessions(stored, gap).collect())
    expected = []
    for key in ("u", "v"):
        times = [int((ts - datetime(1970, 1, 1)).total_seconds() * 1000) for _, ts, k, _ in rows if k == key]
        expected += [(key, *s) for s in sf.joined_stretches([(t, t, 1) for t in times], gap)]
    assert got == sorted(expected) and stored.count() > len(expected)


def test_open_sessions_are_bounded():
    processor, state, newest = sf.GapSessions(gap=10, delay=30), _State(), _State()
    handle = type("Handle", (), {"getMapState": lambda self, *_: state, "getValueState": lambda self, *_: newest})()
    processor.init(handle)
    for at in range(0, 3000, 15):
        next(processor.handleInputRows(("k",), iter([pd.DataFrame({"at": [at], "counts": [True]})]), None))
        assert len(state.map) <= 4


class _State:
    """What the processor asks of its state, in memory."""

    def __init__(self):
        self.map, self.value, self.timers = {}, None, set()

    getMapState = getValueState = lambda self, *_: self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def containsKey(self, key):
        return key in self.map

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.map[key] = value

    def removeKey(self, key):
        del self.map[key]

    def iterator(self):
        return iter(list(self.map.items()))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class _Clock:
    def getCurrentProcessingTimeInMs(self):
        return 1_000


def test_state_is_bounded_and_timers_close_idle_keys():
    processor, state = sf.HourTotals(delay=3 * sf.HOUR, idle=50), _State()
    processor.init(state)
    emitted = []
    for hour in range(500):
        rows = pd.DataFrame({"at": [hour * sf.HOUR + 5, hour * sf.HOUR + 9], "cents": [1.0, 2.0]})
        emitted += [r for out in processor.handleInputRows(("k",), iter([rows]), _Clock()) for r in out.itertuples(index=False)]
        assert len(state.map) <= 5 and state.timers == {1_050}
    assert len(emitted) == 500 - len(state.map) and {r.kind for r in emitted} == {"closed"}
    rest = [r for out in processor.handleExpiredTimer(("k",), _Clock(), None) for r in out.itertuples(index=False)]
    assert not state.map and sorted(r.hour for r in emitted + rest) == [h * sf.HOUR for h in range(500)]
    again = next(processor.handleInputRows(("k",), iter([pd.DataFrame({"at": [499 * sf.HOUR], "cents": [7.0]})]), _Clock()))
    assert again["kind"].tolist() == ["late"] and again["cents"].tolist() == [7]
