"""Hot-key forms against plain pandas, with a hot key holding a third of the rows."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import joins as jn
from millrace.operators import ordered as od
from millrace.operators.aggregate import exact_median, group_medians

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def frame():
    rng = random.Random(5)
    rows = []
    for i in range(900):
        key = 1 if i % 3 == 0 else rng.randint(2, 40)
        key = None if i % 97 == 0 else key
        value = None if rng.random() < 0.3 else float(rng.randint(-50, 50))
        rows.append((key, START + datetime.timedelta(minutes=rng.randint(0, 4000)), i, value))
    return pd.DataFrame(rows, columns=["k", "ts", "id", "v"])


@pytest.fixture(scope="module")
def df(spark, frame):
    rows = [(None if pd.isna(r.k) else int(r.k), r.ts.to_pydatetime(), r.id, None if pd.isna(r.v) else r.v) for r in frame.itertuples()]
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long, v double").cache()


def expected(frame, fn):
    out = {}
    for _, g in frame.groupby("k", dropna=False):
        g = g.sort_values(["ts", "id"])
        for i, value in zip(g["id"], fn(g)):
            out[i] = None if pd.isna(value) else value
    return out


def check(result, column, want):
    got = {r["id"]: r[column] for r in result.select("id", column).collect()}
    assert got == want


@pytest.mark.parametrize("rows", [7, 60, 10**6])
class TestSegments:
    def test_marks_only_hot_keys(self, df, frame, rows):
        cut = od.segment_hot(df, ["k"], "ts", rows)
        sizes = frame.groupby("k", dropna=False).size()
        cold = {None if pd.isna(k) else int(k) for k, n in sizes.items() if n <= rows}
        for r in cut.collect():
            assert (r["_seg"] is None) == (r["k"] in cold)

    def test_prior(self, df, frame, rows):
        out = od.add_prior(od.segment_hot(df, ["k"], "ts", rows), ["k"], ["ts", "id"], {"p": "v"})
        check(out, "p", expected(frame, lambda g: g["v"].shift(1)))

    def test_prior_known(self, df, frame, rows):
        out = od.add_prior(od.segment_hot(df, ["k"], "ts", rows), ["k"], ["ts", "id"], {"p": "v"}, ignore_nulls=True)
        check(out, "p", expected(frame, lambda g: g["v"].ffill().shift(1)))

    def test_following(self, df, frame, rows):
        out = od.add_prior(od.segment_hot(df, ["k"], "ts", rows), ["k"], ["ts", "id"], {"p": "v"}, following=True)
        check(out, "p", expected(frame, lambda g: g["v"].shift(-1)))

    def test_following_known(self, df, frame, rows):
        out = od.add_prior(
            od.segment_hot(df, ["k"], "ts", rows), ["k"], ["ts", "id"], {"p": "v"}, ignore_nulls=True, following=True
        )
        check(out, "p", expected(frame, lambda g: g["v"].bfill().shift(-1)))

    def test_sequence(self, df, frame, rows):
        out = od.add_sequence(od.segment_hot(df, ["k"], "ts", rows), ["k"], ["ts", "id"])
        check(out, "seq", expected(frame, lambda g: range(1, len(g) + 1)))

    def test_running(self, df, frame, rows):
        cut = od.segment_hot(df, ["k"], "ts", rows)
        out = od.add_running(cut, ["k"], ["ts", "id"], {"s": "v"})
        check(out, "s", expected(frame, lambda g: g["v"].fillna(0).cumsum()))
        best = od.add_running_max(cut, ["k"], ["ts", "id"], {"m": "v"})
        check(best, "m", expected(frame, lambda g: g["v"].cummax().ffill()))

    def test_chained(self, df, frame, rows):
        cut = od.segment_hot(df, ["k"], "ts", rows)
        once = od.add_prior(cut, ["k"], ["ts", "id"], {"p": "v"})
        twice = od.add_running(once, ["k"], ["ts", "id"], {"n": F.when(F.col("p").isNull(), 1).otherwise(0)})
        check(twice, "n", expected(frame, lambda g: g["v"].shift(1).isna().cumsum()))

    def test_medians(self, df, frame, rows):
        got = {r["k"]: r["median"] for r in group_medians(df, ["k"], "v", rows=min(rows, 3)).collect()}
        want = frame.dropna(subset=["v"]).groupby("k", dropna=False)["v"].median()
        assert got == {None if pd.isna(k) else int(k): v for k, v in want.items()}

    def test_asof(self, df, frame, rows):
        left = df.where("id % 2 = 0 and k is not null").select("k", "ts", "id")
        right = df.where("id % 2 = 1").select("k", "ts", F.col("id").alias("rid"), "v")
        out = jn.asof(left, right, ["k"], "ts", "ts", {"rid": "rid"}, tie=F.col("rid"), rows=rows)
        got = {r["id"]: r["rid"] for r in out.collect()}
        odd = frame[frame["id"] % 2 == 1]
        for r in frame[(frame["id"] % 2 == 0) & frame["k"].notna()].itertuples():
            earlier = odd[(odd["k"] == r.k) & (odd["ts"] <= r.ts)].sort_values(["ts", "id"])
            assert got[r.id] == (None if earlier.empty else earlier["id"].iloc[-1])


def test_segments_of_a_single_instant(spark):
    rows = [(1, START, i) for i in range(50)]
    for ties in ([], ["id"]):
        df = od.segment_hot(spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long"), ["k"], "ts", 10, ties=ties)
        got = {r["id"]: r["seq"] for r in od.add_sequence(df, ["k"], ["ts", "id"]).collect()}
        assert got == {i: i + 1 for i in range(50)}


def test_slices_of_a_burst(spark):
    """Nearly all rows in one minute, half of them at one instant: no slice is much larger than asked for."""
    moment = F.when(F.col("id") % 100 == 0, F.col("id") * 60).when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 60)
    rows = spark.range(20_000).select(F.lit(1).alias("k"), F.timestamp_seconds(moment).alias("ts"), "id")
    cut = od.segment_hot(rows, ["k"], "ts", 500, ties=["id"])
    sizes = [r["count"] for r in cut.groupBy("_seg").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 1000
    numbered = od.add_sequence(cut, ["k"], ["ts", "id"])
    want = [r["id"] for r in rows.orderBy("ts", "id").collect()]
    assert [r["id"] for r in numbered.orderBy("seq").collect()] == want


def test_whole_table_order(df, frame):
    ranked = od.global_order(df, [F.asc_nulls_first("v"), F.asc("id")], "rn").select("id", "rn").collect()
    want = frame.sort_values(["v", "id"], na_position="first")["id"].tolist()
    assert [r["id"] for r in sorted(ranked, key=lambda r: r["rn"])] == want
    assert sorted(r["rn"] for r in ranked) == list(range(1, len(want) + 1))


@pytest.mark.parametrize("n", [1, 4, 7, 900, 2000])
def test_ntile(df, frame, n):
    got = {r["id"]: r["tile"] for r in od.global_ntile(df, [F.asc("id")], n).collect()}
    size, extra = divmod(len(frame), n)
    want, at = {}, 0
    for tile in range(1, n + 1):
        for _ in range(size + (tile <= extra)):
            want[at] = tile
            at += 1
    assert got == want


def test_rank(df, frame):
    known = df.where("v is not null")
    got = {r["id"]: r["rank"] for r in od.global_rank(known, "v").collect()}
    want = frame.dropna(subset=["v"]).set_index("id")["v"].rank(method="min").astype(int).to_dict()
    assert got == want


def test_median_of_column(df, frame):
    assert exact_median(df, "v").first()["median"] == frame["v"].median()


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "k long, ts timestamp_ntz, id long, v double")
    cut = od.segment_hot(empty, ["k"], "ts", 5)
    assert od.add_prior(cut, ["k"], ["ts", "id"], {"p": "v"}).count() == 0
    assert od.global_order(empty, [F.asc("id")]).count() == 0
    assert exact_median(empty, "v").first()["median"] is None


def test_salted_join(spark):
    big = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k long, i long")
    other = spark.createDataFrame([(k, k * 10) for k in range(0, 300, 2)] + [(1, 10), (1, 11)], "k long, w long")
    hot = jn.hot_keys(big, ["k"], 0.1)
    assert [r["k"] for r in hot.collect()] == [1]
    for how in ("inner", "left"):
        want = sorted(map(tuple, big.join(other, "k", how).select("k", "i", "w").collect()), key=repr)
        got = sorted(map(tuple, jn.salted(big, other, ["k"], hot, 8, how).select("k", "i", "w").collect()), key=repr)
        assert got == want


def test_range_lookup_edges(spark):
    facts = spark.createDataFrame([(1, 5.0), (2, 10.0), (3, 99.0), (4, 10.0), (5, None)], "id long, x double")
    table = spark.createDataFrame([(10.0, "a"), (20.0, "b")], "lo double, name string")
    below = {r["id"]: r["n"] for r in jn.range_lookup(facts, table, "x", "lo", "name", "n").collect()}
    assert below == {1: None, 2: "a", 3: "b", 4: "a", 5: None}
    above = {r["id"]: r["n"] for r in jn.range_lookup(facts, table, "x", "lo", "name", "n", larger=True).collect()}
    assert above == {1: "a", 2: "a", 3: None, 4: "a", 5: None}


def test_lineage_is_cut_in_the_named_folder(spark, tmp_path):
    from millrace.session import materialise, work_dir

    kept = materialise(spark.range(5), "t")
    assert kept.inputFiles() and all(work_dir(spark) in f for f in kept.inputFiles())


def test_plan_has_one_shuffle_for_chained_windows(df):
    cut = od.segment_hot(df, ["k"], "ts")
    out = od.add_running(od.add_prior(cut, ["k"], ["ts", "id"], {"p": "v"}), ["k"], ["ts", "id"], {"s": "v"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_top_per_key_limits_before_the_shuffle(df):
    plan = od.top_per_key(df, ["k"], [F.desc("v"), F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
