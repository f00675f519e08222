import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import stats
from millrace.operators import models as md
from millrace.operators import quality as ql
from millrace.operators import selection as sl
from millrace.operators import series as sr
from millrace.operators import setops as so
from millrace.operators import textmining as tm
from millrace.operators import versioning as vs
from millrace.operators import voyages as vg
from millrace.operators import windows as wn
from millrace.streaming import incremental as inc

DAY = datetime.date(2020, 1, 1)


def day(n):
    return DAY + datetime.timedelta(n)


def series(spark, **values):
    rows = [(name, day(i), None if v is None else float(v)) for name, vals in values.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "name string, date date, value double")


def lit(n):
    return F.lit(day(n).isoformat()).cast("date")


# ---- versions


def test_capture_reaches_the_snapshot(spark):
    s1 = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "k int, v double")
    s2 = spark.createDataFrame([(1, 1.0), (2, 2.0), (4, None)], "k int, v double")
    s3 = spark.createDataFrame([(1, None), (3, 3.0), (4, None)], "k int, v double")
    history = s1.select("k", "v", lit(0).alias("version"), F.lit("I").alias("status"))
    for n, snap in enumerate((s2, s3, s3), start=1):
        history = history.unionByName(vs.changes(snap, vs.latest(history, ["k"]), ["k"], ["v"], lit(n)))
        got = sorted((r["k"], r["v"]) for r in vs.latest(history, ["k"]).collect())
        assert got == sorted((r["k"], r["v"]) for r in snap.collect())
    marks = sorted((r["k"], r["version"], r["status"]) for r in history.where("version > '2020-01-01'").collect())
    assert marks == [(1, day(2), "M"), (2, day(1), "M"), (2, day(2), "D"), (3, day(1), "D"), (3, day(2), "I"), (4, day(1), "I")]
    assert sorted(r["k"] for r in vs.latest(history, ["k"], asof=lit(1)).collect()) == [1, 2, 4]
    assert sorted(r["k"] for r in vs.latest(history, ["k"], deleted_first=True).collect()) == [1, 2, 3, 4]


def test_scd2_null_keys_and_values(spark):
    schema = "a string, b int, price double, recstatus string, recfromdate date, recexpirydate date"
    target = spark.createDataFrame([("x", None, 1.0, "I", day(0), None), ("y", 1, None, "I", day(0), None), ("z", 1, 5.0, "I", day(0), None)], schema)
    source = spark.createDataFrame([("x", None, 2.0), ("y", 1, None), ("w", 1, 9.0)], "a string, b int, price double")
    out = vs.scd2_merge(target, source, ["a", "b"], ["price"], lit(5))
    got = sorted((r["a"], r["price"] or 0, r["recstatus"], r["recexpirydate"] is None) for r in out.collect())
    assert got == [("w", 9.0, "I", True), ("x", 1.0, "I", False), ("x", 2.0, "M", True), ("y", 0, "I", True), ("z", 5.0, "D", False)]
    again = vs.scd2_merge(out, source, ["a", "b"], ["price"], lit(6))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, out.collect()), key=repr)
    assert tuple(vs.scd2_counts(out, lit(5)).first()) == (1, 1, 1)


def test_digest_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", ""), ("a", None)], "x string, y string")
    assert len({r[0] for r in df.select(vs.row_digest(["x", "y"])).collect()}) == 4


def test_replace_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    out = vs.replace_where(df, "x > 1", spark.createDataFrame([(9,)], "x int"))
    assert sorted((r["x"] or 0) for r in out.collect()) == [0, 1, 9]


def test_compare(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "y")], "k int, v string")
    assert tuple(so.compare(a, b).first()) == (2, 1)
    assert sorted(map(tuple, so.multiset_minus(a, b).collect()), key=repr) == [(1, None), (2, "x")]


def test_mismatch(spark):
    rows = [("a", day(0), 4), ("a", day(1), 6), ("b", day(0), 4), ("b", day(1), 4), ("c", day(1), 1)]
    got = ql.mismatch_from_prior(spark.createDataFrame(rows, "k string, version date, rowcount long"), "k").collect()
    assert [(r["k"], r["change"], r["ratio"]) for r in got] == [("a", 2, 0.5)]


def test_key_ranges():
    assert inc.next_range(None, 9, 4) == (0, 4)
    assert inc.next_range(7, 9, 4) == (8, 10)
    assert inc.next_range(9, 9, 4) is None


# ---- series


def test_porosity_example(spark):
    values = [1, 2, None, 3, None, None, 4, 5, 6, 7, 8, None, 9, 10, None, None]
    df = series(spark, a=values, full=[1, 2], none=[None, None])
    got = {r["name"]: r for r in sr.porosity(df).collect()}
    assert (got["a"]["total"], got["a"]["adjusted"], got["a"]["penalty"]) == (0.375, 0.375, 10)
    assert (got["full"]["total"], got["full"]["penalty"], got["none"]["adjusted"]) == (0, 0, 1)
    strict = {r["name"]: r["adjusted"] for r in sr.porosity(df, 2).collect()}
    assert strict["a"] == 0


def test_runs_and_turning_points(spark):
    df = series(spark, a=[1, 2, 3, 4, 6, 1], b=[5])
    assert [r["date"] for r in wn.turning_points(df, 3, 0.05).orderBy("date").collect()] == [day(0), day(1)]
    assert [r["length"] for r in wn.runs(df, F.col("value") > 1).where("name = 'a'").collect()] == [4]


def test_logmod(spark):
    df = spark.createDataFrame([(0.0,), (-9.0,), (None,)], "x double")
    assert [r[0] for r in df.select(sr.logmod(F.col("x"), base=10)).collect()] == [0.0, -1.0, None]


def test_kpss_and_order():
    rng = np.random.default_rng(1)
    noise = rng.normal(size=300)
    assert sr.difference_order(noise) == 0
    assert sr.difference_order(np.cumsum(noise)) == 1
    assert sr.difference_order(np.cumsum(np.cumsum(noise))) == 2


def test_period():
    t = np.arange(240)
    rng = np.random.default_rng(2)
    assert sr.spectral_period(10 * np.sin(2 * np.pi * t / 12) + rng.normal(size=240)) == 12
    assert sr.spectral_period(np.ones(50)) == 1


def test_unit_roots(spark):
    rng = np.random.default_rng(3)
    df = series(spark, walk=np.cumsum(rng.normal(size=300)), noise=rng.normal(size=300), short=[1, 2, 3])
    got = {r["name"]: (r["level_verdict"], r["diff_verdict"]) for r in sr.unit_roots(df, 4).collect()}
    assert got == {"walk": ("Unit Root", "Stationary"), "noise": ("Stationary", "Stationary"), "short": ("too short", "too short")}


def test_ema_and_macd(spark):
    got = [r["e"] for r in sr.add_ema(series(spark, a=[1.0, 2, 3, 4, 5]), "value", 3, "e").orderBy("date").collect()]
    assert got[:2] == [None, None] and np.allclose(got[2:], [2, 3, 4])
    assert sr.macd(series(spark, a=range(40))).where("signal is not null and not isnan(signal)").count() == 40 - 26 + 1 - 9 + 1


def test_window_trading(spark):
    out = sr.window_trading(series(spark, a=[1, 3, 2], short=[1]), 3, 2).orderBy("step").collect()
    # 1, 3, 2: half way, so 0.6 of the range; then 3, 2, 2.2: 0.2 of the range from 2 to 3, so 0.3
    assert [(r["step"], round(r["position"], 6), round(r["forecast"], 6)) for r in out] == [(1, 0.6, 2.2), (2, 0.3, 2.3)]


def test_grid(spark):
    df = series(spark, a=[1, 2]).unionByName(spark.createDataFrame([("a", day(4), 5.0)], "name string, date date, value double"))
    assert [r["value"] for r in sr.fill_grid(df, fill=0.0).orderBy("date").collect()] == [1, 2, 0, 0, 5]


# ---- statistics, selection, models


def test_tail_probabilities():
    assert abs(stats.f_tail(4.9646, 1, 10) - 0.05) < 1e-4
    assert abs(stats.f_tail(3.3258, 5, 10) - 0.05) < 1e-4
    assert abs(stats.chi2_tail(18.307, 10) - 0.05) < 1e-4
    assert abs(stats.chi2_tail(0.5, 1) - math.erfc(0.5)) < 1e-9
    assert stats.f_tail(0, 2, 3) == 1.0 and math.isnan(stats.f_tail(float("nan"), 1, 1))


def test_even_chi_square(spark):
    got = spark.range(1).select(sr.chi2_tail_even(F.lit(18.307), 10)).first()[0]
    assert abs(got - stats.chi2_tail(18.307, 10)) < 1e-9
    with pytest.raises(ValueError):
        sr.chi2_tail_even(F.lit(1.0), 3)


def regression_frame(spark, n=400, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.1 * rng.normal(size=n)
    return spark.createDataFrame([tuple(map(float, [b, *a])) for a, b in zip(x, y)], "y double, x0 double, x1 double, x2 double, x3 double"), x, y


def test_lasso_matches_subgradient_conditions(spark):
    df, x, y = regression_frame(spark)
    sums = sl.block_sums(df, "y", ["x0", "x1", "x2", "x3"], 1).first()["sums"]
    mat = sl.unpack_sums(np.array(sums), 6)
    data = np.column_stack([np.ones(len(y)), y, x])
    assert np.allclose(mat, data.T @ data)
    penalty = 0.2
    coef = sl.lasso_fit(mat, np.array([penalty]), np.ones(4))[0][0]
    sd, sy = x.std(axis=0), y.std()
    beta = coef[1:] * sd / sy
    gradient = ((x - x.mean(axis=0)) / sd).T @ ((y - y.mean()) / sy - (x - x.mean(axis=0)) / sd @ beta) / len(y)
    for b, g in zip(beta, gradient):
        assert math.isclose(g, math.copysign(penalty, b), abs_tol=1e-6) if b else abs(g) <= penalty + 1e-6


def test_lasso_and_stability_find_the_columns(spark):
    df, _, _ = regression_frame(spark)
    coef = {r["name"]: r for r in sl.lasso(df, "y", ["x0", "x1", "x2", "x3"], one_se=True).collect()}
    assert coef["x0"]["coefficient"] > 2.5 and coef["x1"]["coefficient"] < -1.5 and abs(coef["x2"]["coefficient"]) < 0.1
    assert coef["x0"]["score"] == 1.0 and coef["x1"]["score"] == 0.0
    first = sl.stability_selection(df, "y", ["x0", "x1", "x2", "x3"], rounds=6, blocks=20, folds=4)
    freq = {r["name"]: r["frequency"] for r in first.collect()}
    assert freq["x0"] == freq["x1"] == 1.0 and all(0 <= v <= 1 for v in freq.values())
    again = sl.stability_selection(df.repartition(7), "y", ["x0", "x1", "x2", "x3"], rounds=6, blocks=20, folds=4)
    assert {r["name"]: r["frequency"] for r in again.collect()} == freq


def test_information_bounds(spark):
    rows = [(float(i), float(i % 7), float(i)) for i in range(210)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    mi = {(r["a"], r["b"]): r["mi"] for r in sl.pair_information(sl.equal_frequency_bins(df, ["a", "b", "c"], 5), [("a", "c"), ("c", "a"), ("a", "b")]).collect()}
    assert math.isclose(mi["a", "c"], math.log(5)) and math.isclose(mi["a", "c"], mi["c", "a"])
    assert 0 <= mi["a", "b"] < 0.1


def test_bins_of_a_dominant_value(spark):
    df = spark.createDataFrame([(0.0,)] * 70 + [(float(i),) for i in range(1, 31)], "a double")
    got = {r["a"]: r["a_bin"] for r in sl.equal_frequency_bins(df, ["a"], 10).distinct().collect()}
    assert got[0.0] == 0 and got[30.0] == max(got.values()) and len(set(got.values())) == 4


def test_granger_direction(spark):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=300), np.zeros(300)
    for t in range(2, 300):
        y[t] = 0.8 * x[t - 2] + 0.3 * rng.normal()
    df = series(spark, y=y, x=x, noise=rng.normal(size=300), flat=np.ones(300))
    got = {r["name"]: r for r in sl.granger(df, "y", 4).collect()}
    assert got["x"]["causes_target"] < 1e-6 < got["x"]["caused_by_target"] and got["noise"]["causes_target"] > 0.01
    assert got["x"]["lag_bic"] == 2 and got["flat"]["causes_target"] is None
    wald = {r["name"]: r for r in sl.toda_yamamoto(df, "y", 4).collect()}
    assert wald["x"]["causes_target"] < 1e-6 and wald["noise"]["causes_target"] > 0.01


def test_chunks_cover_every_predictor(spark):
    rng = np.random.default_rng(8)
    values = {f"x{i}": rng.normal(size=80) for i in range(9)}
    df = series(spark, y=3 * values["x0"] + 0.1 * rng.normal(size=80), **values)
    got = {r["name"]: r for r in sl.chunked_inclusion(df, "y", rounds=4, chunk_size=3).collect()}
    assert len(got) == 9 and all(r["rounds"] == 4 for r in got.values())
    assert got["x0"]["inclusion"] == 1.0 and got["x0"]["keep"]


def test_chunk_failure_is_a_row(spark):
    def fn(pdf):
        if pdf["k"].iloc[0] == 2:
            raise RuntimeError("boom")
        return pdf[["k"]]

    out = sl.run_chunks(spark.createDataFrame([(1,), (2,)], "k long"), "k", fn, "k long").collect()
    assert sorted((r["chunk_status"], r["chunk_error"]) for r in out) == [("failed", "boom"), ("ok", None)]


def test_clusters_respect_the_limit(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(2, 30))
    values = {f"s{i}": base[i % 2] * (1 + i) + 0.01 * rng.normal(size=30) for i in range(12)}
    values |= {f"same{i}": base[0] for i in range(8)}
    got = md.bounded_clusters(series(spark, **values), 5).groupBy("cluster").count().collect()
    assert sum(r["count"] for r in got) == 20 and max(r["count"] for r in got) <= 5
    members = md.variable_clusters(series(spark, **values), 2, 3).collect()
    assert len(members) == 6 and all(r["own"] > 0.9 for r in members)


def test_threshold_matches_brute_force(spark):
    rng = np.random.default_rng(10)
    p = rng.uniform(size=300)
    label = (p + 0.2 * rng.normal(size=300) < 0.3).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, label)], "p double, y int")
    best = 0.0
    for e in np.arange(p.min(), p.max(), (p.max() - p.min()) / 100):
        tp = ((p < e) & (label == 1)).sum()
        best = max(best, 2 * tp / ((p < e).sum() + label.sum()))
    assert math.isclose(md.best_threshold(df, "p", "y", 100).first()["f1"], best, rel_tol=1e-9)


def test_balance(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)], "id long, y int")
    up = {r["y"]: r["count"] for r in md.balance(df, "y", ["id"]).groupBy("y").count().collect()}
    down = {r["y"]: r["count"] for r in md.balance(df, "y", ["id"], "down").groupBy("y").count().collect()}
    assert up == {0: 900, 1: 900} and down == {0: 100, 1: 100}
    odd = spark.createDataFrame([(i, "a" if i < 10 else "b" if i < 17 else None) for i in range(20)], "id long, y string")
    copies = {r["id"]: r["count"] for r in md.balance(odd, "y", ["id"]).groupBy("id").count().collect()}
    assert sorted(copies.values()) == [1] * 14 + [2] * 3 and set(copies) == set(range(17))


# ---- voyages and text


def test_zones_of_a_crowded_cell(spark):
    points = spark.createDataFrame([(i, 1.0 if i % 3 else 50.0, 1.0) for i in range(60)], "id long, x double, y double")
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    zones = spark.createDataFrame([("z", [{"x": a, "y": b} for a, b in ring])], "zone string, ring array<struct<x: double, y: double>>")
    got = vg.assign_zones(points, zones, "x", "y", 1.5).groupBy("zone").count().collect()
    assert {r["zone"]: r["count"] for r in got} == {"z": 40, None: 20}


def test_tokens_and_cosine(spark):
    df = spark.createDataFrame([(1, "The cat, the 42 CATS!"), (2, "cat cats"), (3, ""), (4, "dog dog")], "id long, text string")
    assert [r["tokens"] for r in tm.tokens(df).orderBy("id").collect()] == [["the", "cat", "the", "cats"], ["cat", "cats"], [], ["dog", "dog"]]
    bag = tm.bag_of_words(df, "id", n=2)
    assert {(r["token"], r["n"]) for r in bag.where("id = 1").collect()} == {("the", 2), ("cat", 1), ("cats", 1), ("the cat", 1), ("cat the", 1), ("the cats", 1)}
    weights = tm.tf_idf(tm.bag_of_words(df, "id"), "id", 0.0, 1.0)
    for r in weights.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect():
        assert math.isclose(r["s"], 1.0)
    pairs = spark.createDataFrame([(1, 2), (1, 4), (2, 2)], "a long, b long")
    got = {(r["a"], r["b"]): r["cosine"] for r in tm.cosine_of_pairs(weights, pairs, "id", "a", "b").collect()}
    assert got[1, 4] == 0 and math.isclose(got[2, 2], 1.0) and 0 < got[1, 2] < 1
    stems = tm.stem_counts(tm.bag_of_words(df, "id"), lambda w: w.rstrip("s"), "id")
    assert {(r["token"], r["n"]) for r in stems.where("id = 1").collect()} == {("the", 2), ("cat", 2)}
