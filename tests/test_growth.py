"""Memory of fits and calls of streams stay bounded where tables grow."""

import numpy as np

from millrace.operators import textmining as tm
from millrace.operators import wide as wd
from millrace.session import in_parts
from millrace.streaming import stateful as sf


def test_few_columns_are_in_play_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    x = np.zeros((600, 10))
    x[np.arange(600), np.arange(600) % 10] = rng.integers(1, 9, 600)  # each column has one date, so many are alike
    x[:40] += rng.normal(size=(40, 10))
    y = rng.normal(size=10)
    penalties = wd.penalty_path(x, y, count=20)
    every, good, most = wd.lasso_path_fit(x, y, penalties)
    monkeypatch.setattr(wd, "PLAY", 8, raising=False)
    few, converged, played = wd.lasso_path_fit(x, y, penalties)
    assert played < most / 4 and converged.all()
    for (a, b), (c, d) in (fits for fits, done in zip(zip(every, few), good) if done):
        assert np.allclose(b @ (x[a] - x[a].mean(axis=1, keepdims=True)), d @ (x[c] - x[c].mean(axis=1, keepdims=True)), atol=1e-6)


def test_parts_are_bounded_by_rows(spark):
    one = spark.range(1000).coalesce(1)
    assert in_parts(one, 100).rdd.getNumPartitions() == 10 and in_parts(one, 100).count() == 1000
    assert in_parts(one, 1000).rdd.getNumPartitions() == 1


def test_forests_keep_rows_in_bounded_parts(spark, monkeypatch):
    from millrace.operators import models as md

    seen = []
    monkeypatch.setattr(md, "TREE_ROWS", 50, raising=False)
    fit = md.RandomForestRegressor.fit
    monkeypatch.setattr(md.RandomForestRegressor, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    frame = spark.range(400).selectExpr("double(id) y", "double(id * 2) a", "double(id % 7) b").coalesce(1)
    first = md.forest_importance(frame, "y", ["a", "b"], trees=3).orderBy("rank").first()
    assert first["name"] == "a" and seen == [8]


def test_clusters_hold_no_terms_in_memory(spark, monkeypatch):
    monkeypatch.setattr(tm, "CLUSTER_ROWS", 10, raising=False)
    parts = []
    fit = tm.KMeans.fit
    monkeypatch.setattr(tm.KMeans, "fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or fit(self, df))
    docs = spark.createDataFrame([(i, f"{'red' if i % 2 else 'blue'} w{i} {'red' if i % 2 else 'blue'} sky") for i in range(200)], "doc_id int, text string")
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet().toArray())
    clusters, terms = tm.text_clusters(docs, "doc_id", k=2, top=2, max_df=0.9)
    assert parts[0] >= 20 and clusters.count() == 200 and {r["term"] for r in terms.collect()} >= {"red", "blue"}
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet().toArray()) == before


def test_a_batch_of_a_key_is_one_read_and_one_write_of_state():
    calls = []

    class Held:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

    held = Held()
    processor = sf.GapSessions(gap=10, delay=30)
    processor.init(type("Handle", (), {"getValueState": lambda self, *_: held})())
    assert processor.ended([(0, True), (5, True), (30, True)]) == []
    assert processor.ended([(40, True), (41, False), (1000, False)]) == [(0, 5, 2), (30, 30, 1), (40, 40, 1)]
    assert processor.ended([(3, True)]) == [(3, 3, 1)] and calls == ["get", "update"] * 3
