"""Selection and clusters over many columns, joint counts, stretches and nearest texts, against plain computations."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.stats import descend
from millrace.operators import joins as jn
from millrace.operators import selection as sl
from millrace.operators import textmining as tm
from millrace.operators import wide as wd


def series(spark, values):
    start = datetime(2000, 1, 1).date()
    rows = [(name, start + timedelta(days=i), float(v)) for name, column in values.items() for i, v in enumerate(column)]
    return spark.createDataFrame(rows, "name string, date date, value double")


def full_lasso(x, y, penalty):
    """Coefficients of a plain coordinate descent over all columns, in the units of x and y."""
    z = (x - x.mean(axis=1, keepdims=True)) / x.std(axis=1, keepdims=True)
    t = (y - y.mean()) / y.std()
    beta = np.zeros(len(x))
    for _ in range(3000):
        old = beta.copy()
        for j in range(len(x)):
            part = z[j] @ (t - beta @ z + beta[j] * z[j]) / len(y)
            beta[j] = math.copysign(max(abs(part) - penalty, 0.0), part)
        if np.abs(beta - old).max() < 1e-11:
            break
    return beta * y.std() / x.std(axis=1)


# clusters


def test_planted_groups_are_found(spark):
    rng = np.random.default_rng(1)
    groups = rng.normal(size=(4, 120))
    values = {f"g{i % 4}_{i:02d}": groups[i % 4] * (-1) ** (i // 4) * (1 + i) + 0.4 * (1 + i) * rng.normal(size=120) for i in range(32)}
    out = wd.oblique_clusters(series(spark, values | {"flat": np.ones(120)}), most=10).collect()
    assert {r["name"] for r in out} == set(values)
    assert len({(r["name"][:2], r["cluster"]) for r in out}) == len({r["cluster"] for r in out}) == 4
    # the ratio by plain numpy: squared correlations with the first component of every cluster
    z = {n: (v - v.mean()) / v.std() for n, v in values.items()}
    axes = {}
    for c in {r["cluster"] for r in out}:
        axes[c] = np.linalg.svd(np.stack([z[r["name"]] for r in out if r["cluster"] == c]))[2][0]
    for r in out:
        squared = {c: np.corrcoef(values[r["name"]], a)[0, 1] ** 2 for c, a in axes.items()}
        own, other = squared.pop(r["cluster"]), max(squared.values())
        assert math.isclose(r["own"], own, abs_tol=1e-6) and math.isclose(r["next"], other, abs_tol=1e-6)
        assert math.isclose(r["ratio"], (1 - own) / (1 - other), abs_tol=1e-6) and own > other


def test_clusters_of_few_series(spark):
    rng = np.random.default_rng(2)
    one = wd.oblique_clusters(series(spark, {"a": rng.normal(size=30)}), most=5).collect()
    assert [(r["name"], r["cluster"], r["next"]) for r in one] == [("a", 0, 0.0)] and math.isclose(one[0]["own"], 1.0)
    bounded = wd.oblique_clusters(series(spark, {f"s{i}": rng.normal(size=40) for i in range(12)}), most=3).collect()
    assert len({r["cluster"] for r in bounded}) <= 3 and len(bounded) == 12
    assert wd.oblique_clusters(series(spark, {}), most=3).count() == 0


# LASSO at width


def test_screened_path_equals_the_full_fit():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 50))
    x[10] = x[11] + 0.01 * rng.normal(size=50)  # nearly equal columns
    x[12] = 5.0
    y = 3 * x[0] - 2 * x[10] + x[20] + 0.3 * rng.normal(size=50)
    penalties = wd.penalty_path(x, y, count=12)
    fits, converged, most = wd.lasso_path_fit(x, y, penalties)
    assert converged.all() and most < 60
    live = np.delete(np.arange(60), 12)
    for (columns, slopes), penalty in zip(fits, penalties):
        got = np.zeros(60)
        got[columns] = slopes
        assert np.allclose(got[live], full_lasso(x[live], y, penalty), atol=1e-5) and got[12] == 0


def test_five_thousand_columns(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(5000, 100))
    y = 4 * x[17] - 3 * x[4000] + 0.2 * rng.normal(size=100)
    fits, converged, most = wd.lasso_path_fit(x, y, wd.penalty_path(x, y, count=20, least=0.05))
    assert converged.all() and most < 1000 and {17, 4000} <= set(fits[-1][0].tolist())
    frame = spark.createDataFrame([(f"x{i:04d}", [float(v) for v in row]) for i, row in enumerate(x)] + [("y", [float(v) for v in y])], "name string, v array<double>")
    long = frame.select("name", F.posexplode("v").alias("pos", "value")).select("name", F.date_add(F.lit(datetime(2000, 1, 1).date()), F.col("pos")).alias("date"), "value")
    got = {r["name"]: r for r in wd.wide_lasso(long, "y", folds=4, one_se=True).collect()}
    assert len(got) == 5000 and all(r["converged"] for r in got.values())
    strong = sorted(got, key=lambda n: -abs(got[n]["coefficient"]))[:2]
    assert set(strong) == {"x0017", "x4000"} and got["x0017"]["score"] == 1.0 and got["x4000"]["score"] == 0.0
    assert sum(r["coefficient"] != 0 for r in got.values()) < 100


def test_wide_forms_on_small_tables(spark):
    rng = np.random.default_rng(5)
    values = {f"x{i}": rng.normal(size=80) for i in range(9)}
    data = series(spark, values | {"y": 3 * values["x0"] + 0.1 * rng.normal(size=80)})
    stable = {r["name"]: r for r in wd.wide_stability(data, "y", rounds=5).collect()}
    assert stable["x0"]["frequency"] == 1.0 and all(r["fits"] == 10 and r["converged"] == 1.0 for r in stable.values()) and min(r["frequency"] for r in stable.values()) < 0.5
    again = {r["name"]: r["frequency"] for r in wd.wide_stability(data.repartition(5), "y", rounds=5).collect()}
    assert again == {n: r["frequency"] for n, r in stable.items()}
    with pytest.raises(ValueError, match="exceed"):
        wd.wide_lasso(data, "y", most=100)
    assert wd.wide_lasso(data.where("name = 'y'"), "y").count() == 0


def test_unfinished_descent_says_so():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(4, 30))
    mix = np.concatenate([base, base + 1e-3 * rng.normal(size=(4, 30))])
    link, rel = mix @ mix.T / 30, mix @ (base[0] - base[1]) / 30
    beta = np.zeros(8)
    assert not descend(link, rel, 1e-4, beta, sweeps=2)
    assert descend(link, rel, 1e-4, beta)
    gradient = rel - link @ beta
    assert (np.abs(gradient) <= 1e-4 + 1e-7).all() and np.allclose(gradient[beta != 0], 1e-4 * np.sign(beta[beta != 0]), atol=1e-7)


# joint counts


def test_joint_counts_and_information(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 3), rng.choice([None, 0, 1]), rng.randint(0, 2)) for _ in range(500)]
    binned = spark.createDataFrame(rows, "a_bin int, b_bin int, c_bin int").repartition(4)
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "a")]
    place = {"a": 0, "b": 1, "c": 2}
    got = {(r["a"], r["b"]): r["mi"] for r in sl.pair_information(binned, pairs).collect()}
    held, sl.HELD = sl.HELD, 40  # the pairs in several parts
    try:
        parts = {(r["a"], r["b"]): r["mi"] for r in sl.pair_information(binned, pairs).collect()}
    finally:
        sl.HELD = held
    for a, b in pairs:
        both = Counter((r[place[a]], r[place[b]]) for r in rows)
        one, two = Counter(r[place[a]] for r in rows), Counter(r[place[b]] for r in rows)
        expected = sum(c / 500 * math.log(c * 500 / (one[x] * two[y])) for (x, y), c in both.items())
        assert math.isclose(got[a, b], expected, abs_tol=1e-12) and math.isclose(parts[a, b], expected, abs_tol=1e-12)


# stretches


def test_stretch_join_against_all_pairs(spark):
    rng = random.Random(8)
    start = datetime(2020, 1, 1)

    def moment():
        return rng.choice([None, start + timedelta(seconds=rng.randint(0, 40_000))]) if rng.random() < 0.1 else start + timedelta(seconds=rng.randint(0, 40_000))

    spans = [(i, rng.choice(["hot", "hot", "hot", "b", None]), moment(), moment()) for i in range(120)]
    points = [(i, rng.choice(["hot", "hot", "hot", "b", "c", None]), moment()) for i in range(600)]
    a = spark.createDataFrame(spans, "span int, ship string, prior timestamp_ntz, arrival timestamp_ntz")
    b = spark.createDataFrame(points, "ping int, ship string, at timestamp_ntz")
    expected = sorted(
        (s, p) for s, ship, x, y in spans for p, other, at in points if ship is not None and ship == other and x and y and at and x < at <= y
    )
    for rows in (1_000_000, 20):
        out = jn.stretch_join(a, b, ["ship"], "prior", "arrival", "at", rows=rows)
        assert sorted(out.columns) == ["arrival", "at", "ping", "prior", "ship", "span"]
        assert sorted((r["span"], r["ping"]) for r in out.collect()) == expected and expected
    assert jn.stretch_join(a.limit(0), b, ["ship"], "prior", "arrival", "at").count() == 0


# nearest texts


@pytest.mark.parametrize(("threshold", "cell"), [(0.3, 2000), (0.3, 4), (0.8, 3)])
def test_nearest_texts_against_all_pairs(spark, threshold, cell):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 40, (12, 15))
    rows, vectors = [], {}
    for doc in range(80):
        words = base[doc % 12].copy()
        words[rng.integers(0, 15, 3)] = rng.integers(0, 40, 3)
        if doc % 5 == 0:
            words = base[0]  # equal vectors
        counts = Counter(words.tolist())
        length = math.sqrt(sum(c * c for c in counts.values()))
        vectors[doc] = {f"t{w}": c / length for w, c in counts.items()}
        rows += [(doc, t, w) for t, w in sorted(vectors[doc].items())]
    got = {}
    for r in tm.nearest_texts(spark.createDataFrame(rows, "doc int, token string, weight double").repartition(3), "doc", threshold, 4, cell=cell).collect():
        got.setdefault(r["doc"], []).append((-r["cosine"], r["other"]))
    for doc, own in vectors.items():
        every = [(-round(sum(w * other.get(t, 0.0) for t, w in own.items()), 7), j) for j, other in vectors.items() if j != doc]
        expected = sorted(x for x in every if -x[0] >= threshold)[:4]
        assert [(round(c, 6), j) for c, j in sorted(got.get(doc, []))] == [(round(c, 6), j) for c, j in expected]


def test_lasso_paths_as_tasks_equal_those_on_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(4, 400))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in zip(2 * x[0] - x[1] + 0.2 * rng.normal(size=400), *x)], "y double, a double, b double, c double, d double")
    plain = {r["name"]: r for r in sl.lasso(frame, "y", ["a", "b", "c", "d"]).collect()}
    monkeypatch.setattr(sl, "FEW", 2)
    tasks = {r["name"]: r for r in sl.lasso(frame, "y", ["a", "b", "c", "d"]).collect()}
    for name, r in plain.items():
        assert math.isclose(r["coefficient"], tasks[name]["coefficient"], abs_tol=1e-9) and r["converged"] and tasks[name]["converged"]
    assert plain["a"]["score"] == 1.0 and plain["b"]["score"] == 0.0
    monkeypatch.setattr(sl, "SHARED", 10)
    with pytest.raises(ValueError, match="exceed"):
        sl.lasso(frame, "y", ["a", "b", "c", "d"])
    assert sl.lasso(frame.limit(0), "y", ["a", "b"]).count() == 0
