"""Selection and clusters over very many series: the columns are rows of a table, their length is the calendar's.

A table of series (name, date, value) becomes one row per series with its standardised values at every date.
What grows is the number of series; nothing here holds numbers for every pair of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.stats import chosen_penalty, descend
from millrace.operators.models import series_vectors
from millrace.session import materialise

#: Numbers of the series' matrix that a task may hold; a larger matrix is refused before anything is read.
MATRIX = 1 << 26
#: Columns whose gradient is computed together.
BLOCK = 4096
#: Columns that come into play at a time; bounds the cross-product matrix of a fit, never results.
PLAY = 1024


# ---- oblique clusters


def _matrix(column: pa.Array) -> np.ndarray:
    size = len(column)
    return column.flatten().to_numpy().reshape(size, -1) if size else np.zeros((0, 0))


def _vectors(series: DataFrame) -> DataFrame:
    """``name, z``: standardised values at every date; constant series are left out."""
    from pyspark.ml.functions import vector_to_array

    held = series_vectors(series).select("name", vector_to_array("features").alias("z"))
    return held.where(F.exists("z", lambda v: v != 0))


def _correlations(z: np.ndarray, components: np.ndarray) -> np.ndarray:
    return z @ components.T / np.sqrt(np.maximum((z * z).sum(axis=1), 1e-300))[:, None]


def _reassigned(vectors: DataFrame, components: np.ndarray) -> tuple[pd.DataFrame, float]:
    """Each series to its closest component, and the two leading components of every cluster that this gives.

    One pass: partitions add up z zᵀ over the dates for each cluster; the sums of a cluster meet in one task, which
    has calendar × calendar numbers whatever the number of series.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(components)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            z = _matrix(batch.column(0))
            squared = _correlations(z, shared.value) ** 2 if len(z) else np.zeros((0, 1))
            own = squared.argmax(axis=1)
            for c in np.unique(own).tolist():
                part = z[own == c]
                scaled = part / np.sqrt((part * part).sum(axis=1))[:, None]
                total = held.setdefault(c, [0, 0.0, 0.0])
                total[0] += len(part)
                total[1] += float(squared[own == c, c].sum())
                total[2] = total[2] + scaled.T @ scaled
        for c, (count, explained, total) in held.items():
            yield pa.RecordBatch.from_pydict({"cluster": pa.array([c], pa.int32()), "count": pa.array([count]), "explained": pa.array([explained]), "sums": pa.array([total.ravel()], pa.list_(pa.float64()))})

    def leading(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(pdf["sums"].to_numpy()), axis=0)
        size = math.isqrt(len(total))
        values, axes = np.linalg.eigh(total.reshape(size, size))
        first, second = axes[:, -1], axes[:, -2] if size > 1 else np.zeros(size)
        row = [pdf["cluster"].iloc[0], pdf["count"].sum(), pdf["explained"].sum(), values[-2] if size > 1 else 0.0, first, second]
        return pd.DataFrame([row], columns=["cluster", "count", "explained", "second_value", "first", "second"])

    partial = vectors.select("z").mapInArrow(sums, "cluster int, count bigint, explained double, sums array<double>")
    schema = "cluster int, count bigint, explained double, second_value double, first array<double>, second array<double>"
    found = partial.groupBy("cluster").applyInPandas(leading, schema).toPandas().sort_values("cluster")  # two vectors per cluster
    return found, float(found["explained"].sum())


def _rotated(vectors: DataFrame, components: np.ndarray, split: pd.DataFrame) -> dict[int, np.ndarray]:
    """The two components of each split cluster turned so that every series loads on one of them (quartimax)."""
    shared = vectors.sparkSession.sparkContext.broadcast((components, {int(r.cluster): np.stack([r.first_, r.second]) for r in split.rename(columns={"first": "first_"}).itertuples()}))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, pairs = shared.value
        held = {c: np.zeros(2) for c in pairs}
        for batch in batches:
            z = _matrix(batch.column(0))
            if not len(z):
                continue
            own = (_correlations(z, every) ** 2).argmax(axis=1)
            for c, pair in pairs.items():
                a, b = _correlations(z[own == c], pair).T
                u, v = a * a - b * b, 2 * a * b
                held[c] += (2 * u * v).sum(), (u * u - v * v).sum()
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(list(held), pa.int32()), "up": pa.array([x[0] for x in held.values()]), "along": pa.array([x[1] for x in held.values()])})

    added = vectors.select("z").mapInArrow(sums, "cluster int, up double, along double").groupBy("cluster").agg(F.sum("up").alias("up"), F.sum("along").alias("along"))
    out = {}
    for row in added.collect():
        angle = math.atan2(row["up"], row["along"]) / 4
        turn = np.array([[math.cos(angle), math.sin(angle)], [-math.sin(angle), math.cos(angle)]])
        out[row["cluster"]] = turn @ shared.value[1][row["cluster"]]
    return out


def oblique_clusters(series: DataFrame, most: int, second_value: float = 1.0, rounds: int = 50) -> DataFrame:
    """Clusters of series around their first principal components: ``(name, cluster, own, next, ratio)``.

    All series start in one cluster. While a cluster's correlation matrix has a second eigenvalue above
    ``second_value`` and there are fewer than ``most`` clusters, such clusters (largest first) are split along their two
    rotated components. Then every series goes to the component that it has the highest squared correlation
    with, and the components are computed anew, until nothing improves (``rounds`` times at most). ``own`` and ``next``
    are the squared correlations with the own and the closest other component, ``ratio`` is
    (1 − own) / (1 − next). With one cluster, next is 0. Clusters are numbered by their smallest name; constant
    series are left out, and an empty table gives none.
    """
    vectors = materialise(_vectors(series), "wide-vectors")
    length = vectors.select(F.size("z").alias("n")).first()
    if length is None:
        return vectors.select("name", F.lit(0).alias("cluster"), *[F.lit(0.0).alias(c) for c in ("own", "next", "ratio")])
    components = np.eye(1, length["n"])
    found, explained = _reassigned(vectors, components)
    while True:
        components = np.stack(found["first"].to_numpy())
        for _ in range(rounds):
            again, better = _reassigned(vectors, components)
            settled = better <= explained + 1e-9 * max(1.0, explained) and len(again) == len(components)
            found, explained = again, better
            components = np.stack(found["first"].to_numpy())
            if settled:
                break
        found = found.assign(cluster=range(len(found)))
        split = found[(found["second_value"] > second_value) & (found["count"] > 1)].sort_values("second_value", ascending=False).head(max(0, most - len(found)))
        if not len(split):
            break
        turned = _rotated(vectors, components, split)
        kept = [c for i, c in enumerate(components) if i not in turned]
        found, explained = _reassigned(vectors, np.stack([*kept, *[c for pair in turned.values() for c in pair]]))
    shared = series.sparkSession.sparkContext.broadcast(components)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _matrix(batch.column(1))
            squared = _correlations(z, shared.value) ** 2 if len(z) else np.zeros((0, 1))
            own = squared.argmax(axis=1)
            at = np.arange(len(z))
            best = squared[at, own]
            squared[at, own] = 0.0
            other = squared.max(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.astype(np.int32)), pa.array(best), pa.array(other)], ["name", "number", "own", "next"])

    rows = vectors.mapInArrow(placed, "name string, number int, own double, next double")
    first = rows.groupBy("number").agg(F.min("name").alias("first")).orderBy("first").collect()  # one row per cluster
    numbers = F.create_map(*[F.lit(x) for i, r in enumerate(first) for x in (r["number"], i)]) if first else F.create_map(F.lit(0), F.lit(0))
    ratio = F.try_divide(1 - F.col("own"), 1 - F.col("next"))
    return rows.select("name", F.try_element_at(numbers, "number").alias("cluster"), "own", "next", ratio.alias("ratio"))


# ---- LASSO over very many columns


def _strongest(columns: np.ndarray, slopes: np.ndarray) -> np.ndarray:
    """The listed columns, or if they are many those of largest gradient, only the first of several with the same one."""
    if len(columns) <= PLAY:
        return columns
    _, first = np.unique(-np.round(np.abs(slopes[columns]), 9), return_index=True)
    return np.sort(columns[first[:PLAY]])


def lasso_path_fit(
    x: np.ndarray, y: np.ndarray, penalties: Sequence[float], weights: np.ndarray | None = None, sweeps: int = 1000
) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, int]:
    """LASSO of ``y`` on the rows of ``x`` (columns of the model) for falling penalties.

    The sequential strong rule leaves out columns whose gradient at the last fit is below 2 λ − λ_last; the fit runs on the
    others; then the optimality conditions of all columns are checked, block by block, and violators come back, the
    strongest first and ``PLAY`` at a time, until there is none. Only the columns in play have a cross-product matrix. Returns per penalty (columns, slopes in the
    units of x and y), whether each fit converged, and the most columns in play.
    """
    size = x.shape[1]
    mean, sd = x.mean(axis=1), x.std(axis=1)
    live = sd > 1e-9 * np.maximum(1.0, np.abs(mean))
    scale = np.where(live, (1.0 if weights is None else weights) / np.where(live, sd, 1.0), 0.0)
    centre, spread = y.mean(), y.std()
    target = (y - centre) / spread if spread > 0 else np.zeros(size)

    def rows(some: np.ndarray) -> np.ndarray:
        return (x[some] - mean[some, None]) * scale[some, None]

    def gradient(rest: np.ndarray) -> np.ndarray:
        # constant parts of a column vanish, because the residuals sum to zero
        parts = [x[i : i + BLOCK] @ rest for i in range(0, len(x), BLOCK)]
        return np.concatenate([*parts, np.empty(0)]) * scale / size

    held, beta = np.empty(0, np.int64), np.empty(0)
    slopes = gradient(target)
    last, most, out, converged = max(float(np.abs(slopes).max(initial=0.0)), 1e-300), 0, [], []
    for penalty in penalties:
        wanted = _strongest(np.flatnonzero(np.abs(slopes) >= 2 * penalty - last), slopes)
        while True:
            old = dict(zip(held.tolist(), beta.tolist()))
            held = np.union1d(np.union1d(wanted, held[beta != 0]), np.empty(0, np.int64)).astype(np.int64)
            beta = np.array([old.get(j, 0.0) for j in held.tolist()])
            z = rows(held)
            done = descend(z @ z.T / size, z @ target / size, penalty, beta, sweeps)
            slopes = gradient(target - beta @ z)
            missing = np.abs(slopes) > penalty * (1 + 1e-7) + 1e-9
            missing[held] = False
            most = max(most, len(held))
            if not missing.any():
                break
            wanted = np.union1d(held, _strongest(np.flatnonzero(missing), slopes))
        on = beta != 0
        out.append((held[on], beta[on] * scale[held[on]] * spread))
        converged.append(done)
        last = penalty
    return out, np.array(converged, bool), most


def penalty_path(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, count: int = 60, least: float = 1e-2) -> np.ndarray:
    """Penalties from the one that empties the model down to ``least`` of it."""
    sd = x.std(axis=1)
    scale = np.divide(1.0 if weights is None else weights, sd, out=np.zeros(len(sd)), where=sd > 1e-9)
    spread = y.std() or 1.0
    top = float(np.abs(x @ (y - y.mean()) * scale).max(initial=0.0)) / len(y) / spread
    return np.geomspace(max(top, 1e-12), max(top, 1e-12) * least, count)


def _missed(x: np.ndarray, y: np.ndarray, train: np.ndarray, fits: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Mean squared error on the dates left out, for each fit."""
    out = []
    for columns, slopes in fits:
        level = y[train].mean() - slopes @ x[columns][:, train].mean(axis=1)
        out.append(float(np.mean((y[~train] - level - slopes @ x[columns][:, ~train]) ** 2)))
    return np.array(out)


class Matrix:
    """The predictors' values by date and the target's, shared with all tasks; its size is checked first."""

    def __init__(self, series: DataFrame, target: str, most: int = MATRIX):
        known = series.where(F.col("value").isNotNull())
        y = known.where(F.col("name") == target).select("date", F.col("value").cast("double").alias("y"))
        rows = known.where(F.col("name") != target).join(y, "date")
        counts = rows.agg(F.count_distinct("name").alias("names"), F.count_distinct("date").alias("dates")).first()
        if counts["names"] * counts["dates"] > most:
            raise ValueError(f"{counts['names']} series of {counts['dates']} dates exceed {most} numbers: raise `most`, or select in parts first")
        held = rows.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("date", F.col("value").cast("double")))).alias("m"))
        dates = y.join(rows.select("date").distinct(), "date").groupBy("date").agg(F.max("y").alias("y")).orderBy("date").collect()
        order = F.array(*[F.lit(r["date"]) for r in dates]) if dates else F.array()
        filled = held.select("name", F.transform(order, lambda d: F.coalesce(F.try_element_at("m", d), F.lit(0.0))).alias("values"))
        table = filled.orderBy("name").toArrow()
        self.names = table.column("name").to_pylist()
        x = _matrix(table.column("values").combine_chunks()) if self.names else np.zeros((0, len(dates)))
        self.values = np.ascontiguousarray(x), np.array([r["y"] for r in dates])
        self.spark = series.sparkSession

    @property
    def shared(self):
        return self.spark.sparkContext.broadcast((self.names, *self.values))

    @property
    def unnamed(self):
        return self.spark.sparkContext.broadcast(self.values)


def wide_lasso(series: DataFrame, target: str, folds: int = 10, one_se: bool = False, most: int = MATRIX) -> DataFrame:
    """M02 over very many series: ``(name, coefficient, score, converged)`` of a cross-validated LASSO on the target.

    Dates without the target are left out, missing values are 0. The folds deal the dates in turn; every fold, and
    the fit on all dates, is a task of its own with the whole path of penalties. ``score`` is the coefficient
    clipped at zero and scaled. Every predictor is listed.
    """
    spark, matrix = series.sparkSession, Matrix(series, target, most)
    if not matrix.names:
        return spark.createDataFrame([], "name string, coefficient double, score double, converged boolean")
    shared = matrix.unnamed

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, y = shared.value
        penalties = penalty_path(x, y)
        for pdf in batches:
            for fold in pdf["id"].tolist():
                train = np.arange(len(y)) % folds != fold
                if train.sum() < 2 or (fold < folds and train.all()):
                    continue
                fits, converged, _ = lasso_path_fit(x[:, train], y[train], penalties)
                errors = _missed(x, y, train, fits) if fold < folds else np.full(len(fits), np.nan)
                yield pd.DataFrame({"fold": fold, "place": range(len(fits)), "error": errors, "converged": converged, "columns": [c.tolist() for c, _ in fits], "slopes": [s.tolist() for _, s in fits]})

    schema = "fold int, place int, error double, converged boolean, columns array<int>, slopes array<double>"
    tasks = spark.range(0, folds + 1, 1, folds + 1)
    found = materialise(tasks.mapInPandas(fit, schema), "wide-lasso")
    errors = found.where(F.col("fold") < folds).select("fold", "place", "error", "converged").toPandas()  # folds × penalties
    table = errors.pivot(index="fold", columns="place", values="error").to_numpy()
    place = chosen_penalty(table, one_se) if len(table) else 0
    final = found.where((F.col("fold") == folds) & (F.col("place") == place)).first()
    coefficient = np.zeros(len(matrix.names))
    coefficient[final["columns"]] = final["slopes"]
    clipped = np.maximum(coefficient, 0)
    span = clipped.max() - clipped.min()
    score = (clipped - clipped.min()) / span if span else np.zeros(len(clipped))
    converged = bool(final["converged"] and errors.loc[errors["place"] == place, "converged"].all())
    return spark.createDataFrame(pd.DataFrame({"name": matrix.names, "coefficient": coefficient, "score": score, "converged": converged}), "name string, coefficient double, score double, converged boolean")


def _selected(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None, folds: int) -> tuple[np.ndarray, bool]:
    """Columns of a LASSO at the largest penalty within one standard error of the best."""
    penalties = penalty_path(x, y, weights)
    errors, converged = [], True
    for fold in range(min(folds, len(y) // 2)):
        train = np.arange(len(y)) % folds != fold
        fits, good, _ = lasso_path_fit(x[:, train], y[train], penalties, weights)
        errors.append(_missed(x, y, train, fits))
        converged &= bool(good.all())
    if not errors:
        return np.empty(0, np.int64), False
    place = chosen_penalty(np.array(errors), True)
    fits, good, _ = lasso_path_fit(x, y, penalties[: place + 1], weights)
    return fits[place][0], converged and bool(good.all())


def wide_stability(series: DataFrame, target: str, rounds: int = 200, alpha: float = 0.2, seed: int = 0, folds: int = 5, most: int = MATRIX) -> DataFrame:
    """M03 over very many series: ``(name, frequency, fits, converged)`` over random half splits and column weights.

    Each round splits the dates at random, weights the columns uniformly from ``alpha`` to 1 and fits both halves.
    ``converged`` is the share of fits whose whole paths did.
    """
    spark, matrix = series.sparkSession, Matrix(series, target, most)
    shared = matrix.shared

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, x, y = shared.value
        for pdf in batches:
            for number in pdf["id"].tolist():
                rng = np.random.default_rng([seed, number])
                weights, order = rng.uniform(alpha, 1.0, len(names)), rng.permutation(len(y))
                for half in (order[: len(y) // 2], order[len(y) // 2 :]):
                    columns, converged = _selected(x[:, half], y[half], weights, folds)
                    selected = np.zeros(len(names))
                    selected[columns] = 1.0
                    yield pd.DataFrame({"name": names, "selected": selected, "converged": float(converged)})

    fits = spark.range(rounds).repartition(min(rounds, 256), "id").mapInPandas(fit, "name string, selected double, converged double")
    return fits.groupBy("name").agg(F.avg("selected").alias("frequency"), F.count(F.lit(1)).alias("fits"), F.avg("converged").alias("converged"))


def wide_chunks(series: DataFrame, target: str, rounds: int, chunk_size: int, seed: int = 0, flag_at: float = 0.6, folds: int = 5, most: int = MATRIX) -> DataFrame:
    """Predictors dealt into random disjoint chunks per round, a LASSO per chunk: ``(name, inclusion, rounds, keep, converged)``.

    A round is one row of a table of rounds; its task deals the columns of the shared matrix and fits the chunks one
    after the other, so nothing but one number per name and round is ever shuffled, after a sum in the task.
    """
    spark, matrix = series.sparkSession, Matrix(series, target, most)
    shared = matrix.shared

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, x, y = shared.value
        included, fitted, good = np.zeros(len(names)), np.zeros(len(names), np.int64), np.zeros(len(names))
        for pdf in batches:
            for number in pdf["id"].tolist():
                order = np.random.default_rng([seed, number]).permutation(len(names))
                for chunk in np.array_split(order, max(1, -(-len(names) // chunk_size))):
                    columns, converged = _selected(x[chunk], y, None, folds)
                    included[chunk[columns]] += 1
                    fitted[chunk] += 1
                    good[chunk] += converged
        yield pd.DataFrame({"name": names, "included": included, "fitted": fitted, "good": good})

    fits = spark.range(rounds).repartition(min(rounds, 256), "id").mapInPandas(fit, "name string, included double, fitted bigint, good double")
    summed = fits.groupBy("name").agg(F.sum("included").alias("i"), F.sum("fitted").alias("rounds"), F.sum("good").alias("g"))
    inclusion = F.try_divide(F.col("i"), F.col("rounds"))
    return summed.select("name", inclusion.alias("inclusion"), "rounds", (inclusion >= flag_at).alias("keep"), F.try_divide(F.col("g"), F.col("rounds")).alias("converged"))
