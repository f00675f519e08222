"""Models against facts that plain numpy can check: normal equations, confusion sums, importances, silhouettes, clusters."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import models as md
from millrace.operators import selection as sl
from millrace.operators import series as sr
from millrace.operators import textmining as tm


def table(spark, columns):
    names = list(columns)
    rows = [tuple(float(v) for v in row) for row in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(4)


def series(spark, values):
    start = datetime(2000, 1, 1).date()
    rows = [(n, start + timedelta(days=i), float(v)) for n, column in values.items() for i, v in enumerate(column)]
    return spark.createDataFrame(rows, "name string, date date, value double")


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3, 1200))
    return {"a": x[0], "b": x[1], "noise": x[2], "y": 3 * x[0] - x[1] + 0.5 * rng.normal(size=1200), "label": (x[0] + 0.3 * rng.normal(size=1200) > 0).astype(float)}


def test_linear_models_solve_their_equations(spark, sample):
    train, test = ({k: v[s] for k, v in sample.items()} for s in (slice(0, 900), slice(900, None)))
    got = {r["model"]: r for r in md.regression_report(table(spark, train), table(spark, test), ["a", "b"], "y").collect()}
    design = np.column_stack([np.ones(900), train["a"], train["b"]])
    solved = np.linalg.lstsq(design, train["y"], rcond=None)[0]
    rest = test["y"] - np.column_stack([np.ones(300), test["a"], test["b"]]) @ solved
    assert math.isclose(got["linear"]["rmse"], math.sqrt((rest**2).mean()), rel_tol=1e-6)
    assert math.isclose(got["linear"]["r2"], 1 - (rest**2).sum() / ((test["y"] - test["y"].mean()) ** 2).sum(), rel_tol=1e-6)
    assert got["linear"]["rmse"] < got["ridge"]["rmse"] < test["y"].std() and got["elastic_net"]["r2"] > 0.8
    assert [r["model"] for r in md.regression_report(table(spark, train), table(spark, test), ["a"], "y", ["linear"]).collect()] == ["linear"]


def test_confusion_sums_and_scores(spark, sample):
    train, test = ({k: v[s] for k, v in sample.items()} for s in (slice(0, 900), slice(900, None)))
    out = md.classification_report(table(spark, train), table(spark, test), ["a", "b", "noise"], "label", trees=10, rounds=5, depth=3).collect()
    assert {r["model"] for r in out} == {"logistic", "forest", "boosting", "bayes"}
    for r in out:
        assert r["tp"] + r["fn"] == test["label"].sum() and r["fp"] + r["tn"] == 300 - test["label"].sum()
        assert math.isclose(r["precision"], r["tp"] / (r["tp"] + r["fp"])) and math.isclose(r["f1"], 2 * r["tp"] / (2 * r["tp"] + r["fp"] + r["fn"]))
        assert r["auc"] > 0.9 and math.isclose(r["accuracy"], (r["tp"] + r["tn"]) / 300)


def test_library_defaults_are_used():
    made = md.classifiers(["forest", "boosting"])
    assert made["forest"].getNumTrees() == 50 and made["boosting"].getMaxIter() == 20 and made["boosting"].getMaxDepth() == 5


def test_importances_follow_the_model(spark, sample):
    frame = table(spark, {k: sample[k] for k in ("a", "b", "noise", "y")})
    forest = {r["name"]: r for r in md.forest_importance(frame, "y", ["noise", "a", "b"], trees=20).collect()}
    assert [n for n, _ in sorted(forest.items(), key=lambda kv: kv[1]["rank"])] == ["a", "b", "noise"] and forest["a"]["importance_scaled"] == 1.0
    assert math.isclose(sum(r["importance"] for r in forest.values()), 1.0, rel_tol=1e-9)
    shuffled = {r["name"]: r["importance"] for r in md.permutation_importance(frame, "y", ["noise", "a", "b"]).collect()}
    assert shuffled["a"] > shuffled["b"] > abs(shuffled["noise"]) and shuffled["a"] > 5
    again = {r["name"]: r["importance"] for r in md.permutation_importance(frame, "y", ["noise", "a", "b"]).collect()}
    assert all(math.isclose(again[n], v, rel_tol=1e-9, abs_tol=1e-9) for n, v in shuffled.items())


def test_grid_lists_every_setting(spark, sample):
    frame = table(spark, {k: sample[k][:400] for k in ("a", "b", "label")})
    got = {(r["depth"], r["trees"]): r["auc"] for r in md.forest_grid(frame, ["a", "b"], "label", [1, 3], [3, 5], folds=2).collect()}
    assert set(got) == {(1, 3), (1, 5), (3, 3), (3, 5)} and all(0.8 < v <= 1 for v in got.values())


def test_silhouettes_by_hand(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(2, 40))
    values = {f"s{i}": base[i % 2] + 0.3 * rng.normal(size=40) for i in range(10)}
    z = np.stack([(v - v.mean()) / v.std() for v in values.values()])
    distance = ((z[:, None] - z[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(10):
        own = [j for j in range(10) if j % 2 == i % 2 and j != i]
        other = [j for j in range(10) if j % 2 != i % 2]
        a, b = distance[i, own].mean(), distance[i, other].mean()
        scores.append((b - a) / max(a, b))
    got = {r["k"]: r["silhouette"] for r in md.cluster_quality(series(spark, values), [2, 3]).collect()}
    assert math.isclose(got[2], np.mean(scores), rel_tol=1e-6) and got[3] < got[2]


def test_bounded_clusters_keep_groups_together(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 60))
    values = {f"g{i % 6}_{i:02d}": base[i % 6] * (1 + i) + 0.05 * (1 + i) * rng.normal(size=60) for i in range(48)}
    out = md.bounded_clusters(series(spark, values), 8).collect()
    members = {}
    for r in out:
        members.setdefault(r["cluster"], []).append(r["name"])
    assert sorted(r["name"] for r in out) == sorted(values) and max(map(len, members.values())) <= 8
    assert all(len({n[:2] for n in names}) == 1 for names in members.values())
    equal = md.bounded_clusters(series(spark, {f"s{i}": base[0] for i in range(30)}), 7).groupBy("cluster").count().collect()
    assert sum(r["count"] for r in equal) == 30 and max(r["count"] for r in equal) <= 7
    assert md.bounded_clusters(series(spark, {}), 3).count() == 0


def test_text_clusters_follow_the_vocabulary(spark):
    rng = np.random.default_rng(3)
    words = [[f"{p}{i}" for i in range(12)] for p in ("red", "green", "blue")]
    rows = [(i, " ".join(rng.choice(words[i % 3], 30))) for i in range(60)]
    clusters, terms = tm.text_clusters(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", k=3, top=5)
    placed = {}
    for r in clusters.collect():
        placed.setdefault(r["cluster"], set()).add(r["doc_id"] % 3)
    assert len(placed) == 3 and all(len(v) == 1 for v in placed.values())
    listed = terms.collect()
    assert len(listed) == 15 and all(r["weight"] > 0 for r in listed)
    for r in listed:
        assert r["term"].startswith(("red", "green", "blue")[next(iter(placed[r["cluster"]]))])


def test_blend_ranks_missing_scores_as_zero(spark):
    one = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.1)], "name string, s double")
    two = spark.createDataFrame([("c", 1.0), ("a", None)], "name string, t double")
    assert [(r["name"], r["blended"]) for r in sl.blend([one, two], ["s", "t"]).collect()] == [("c", 1.1), ("a", 0.5), ("b", 0.5)]


def test_collinear_columns(spark, sample):
    frame = table(spark, {"a": sample["a"], "b": sample["b"], "twice": 2 * sample["a"]})
    values = sl.collinearity(frame, ["a", "b", "twice"])
    assert abs(values[0]) < 1e-9 and math.isclose(sum(values), 3.0) and sl.redundant_columns(frame, ["a", "b", "twice"]) == ["twice"]


def test_split_and_draws_are_digests(spark):
    import hashlib

    def draw(*parts):
        return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)

    out = sr.split_by_hash(spark.range(500), ["id"], 0.7, 3).collect()
    assert all((r["part"] == "train") == (draw(3, r["id"]) / 2**32 < 0.7) for r in out)
    names = spark.createDataFrame([(f"n{i}",) for i in range(7)], "name string")
    expected = {}
    for i in range(20):
        name = f"n{draw(5, i) % 7}"
        expected[name] = expected.get(name, 0) + 1
    assert {r["name"]: r["times"] for r in sl.sample_names(names, 20, 5).collect()} == expected


def test_periods_and_orders_of_known_series(spark):
    rng = np.random.default_rng(6)
    t = np.arange(240)
    values = {"yearly": 10 * np.sin(2 * np.pi * t / 12) + rng.normal(size=240), "walk": np.cumsum(rng.normal(size=240)), "flat": rng.normal(size=240)}
    assert {r["name"]: r["period"] for r in sr.dominant_period(series(spark, values)).collect()}["yearly"] == 12
    orders = {r["name"]: r["order"] for r in sr.stationarity(series(spark, values)).collect()}
    assert orders["walk"] == 1 and orders["flat"] == 0 and orders["yearly"] == 0
