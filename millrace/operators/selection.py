"""Feature selection: mutual information, LASSO, stability, causality tests, clusters, blended ranking.

Tables with many rows are reduced to counts or cross-product sums by Spark aggregation; numpy then
works on those summaries, whose size depends on the number of bins and columns, never on the rows.
Series (bounded by the calendar) go to numpy one series, or one chunk of series, at a time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.stats import chi2_tail, chosen_penalty, descend, f_tail, lag_matrix, ols
from millrace.operators.ordered import add_group_stats, attach_row, global_order
from millrace.operators.ranks import exact_ranks
from millrace.operators.series import difference_order, md5_draw
from millrace.session import materialise

#: Columns, the target among them, up to which products are plain aggregates.
FEW = 12
#: Numbers of block sums that may be gathered and shared with all tasks.
SHARED = 1 << 26
#: Numbers of block matrices that a task holds before it hands them on; bounds memory, never results.
HELD = 1 << 25

# ---- mutual information


def equal_frequency_cuts(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Values at ranks ⌈i·n/bins⌉ of each column: at most bins − 1 numbers per column, so they may
    come to the driver. The table is not sorted."""
    sizes = df.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()  # one number per column
    ranks = {c: sorted({-(-i * n // bins) for i in range(1, bins)} - {0}) if n else [] for c, n in sizes.items()}
    return {c: sorted(set(v)) for c, v in exact_ranks(df, ranks).items()}


def equal_frequency_bins(df: DataFrame, columns: Sequence[str], bins: int | None = None, suffix: str = "_bin") -> DataFrame:
    """Add the equal-frequency bin of each column; equal values share a bin.

    The default number of bins is the cube root of the row count. Bins are found by binary search in
    the scan, without a shuffle of the rows.
    """
    from pyspark.ml.feature import Bucketizer  # here, so that Python workers need not load Spark ML

    bins = bins or max(1, int(round(df.count() ** (1 / 3), 9)))
    cuts = equal_frequency_cuts(df, columns, bins)
    # right-closed bins: x <= cut is x < the next float after cut
    splits = [sorted({-math.inf, math.inf, *(float(np.nextafter(v, math.inf)) for v in cuts[c])}) for c in columns]
    outputs = [f"{c}{suffix}" for c in columns]
    out = Bucketizer(splitsArray=splits, inputCols=list(columns), outputCols=outputs).transform(df)
    return out.withColumns({c: F.col(c).cast("int") for c in outputs})


def joint_counts(binned: DataFrame, pairs: Sequence[tuple[str, str]], suffix: str = "_bin") -> tuple[DataFrame, int]:
    """Dense two-way counts of binned column pairs: ``(pair, sums)`` with states × states numbers, and the states.

    One pass over the rows: every partition counts into one matrix per pair and hands on each as one row; a list of pairs
    whose matrices exceed what a task may hold is counted in parts. A missing bin is a state of its own.
    """
    columns = sorted({c for pair in pairs for c in pair})
    highest = binned.agg(*[F.max(f"{c}{suffix}") for c in columns]).first()  # one number per column
    states = 2 + max((h for h in highest if h is not None), default=-1)
    codes = binned.select(*[F.coalesce(F.col(f"{c}{suffix}"), F.lit(states - 1)).cast("int").alias(f"v{i}") for i, c in enumerate(columns)])
    place = {c: i for i, c in enumerate(columns)}
    of = [(place[a], place[b]) for a, b in pairs]
    step = max(1, HELD // (states * states))

    def counts(batches):
        held: dict[int, np.ndarray] = {}

        def handed_on():
            for pair, cells in held.items():
                yield pa.RecordBatch.from_pydict({"pair": pa.array([pair], pa.int32()), "sums": pa.array([cells.astype(float)], pa.list_(pa.float64()))})
            held.clear()

        for batch in batches:
            x = [c.to_numpy().astype(np.int64) for c in batch.columns]
            for first in range(0, len(of), step):
                for pair in range(first, min(first + step, len(of))):
                    a, b = of[pair]
                    cells = np.bincount(x[a] * states + x[b], minlength=states * states)
                    held[pair] = held.get(pair, 0) + cells
                if len(of) > step:
                    yield from handed_on()
        yield from handed_on()

    return summed_arrays(codes.mapInArrow(counts, "pair int, sums array<double>"), "pair"), states


def pair_information(binned: DataFrame, pairs: Sequence[tuple[str, str]], suffix: str = "_bin") -> DataFrame:
    """Mutual information (natural log) of binned column pairs, from one pass of joint counts; never negative."""
    pairs = list(pairs)
    summed, states = joint_counts(binned, pairs, suffix)

    def information(batches):
        for pdf in batches:
            out = []
            for pair, sums in zip(pdf["pair"].tolist(), pdf["sums"]):
                c = np.asarray(sums).reshape(states, states)
                n, rows, columns = c.sum(), c.sum(axis=1, keepdims=True), c.sum(axis=0, keepdims=True)
                on = c > 0
                out.append((*pairs[pair], max(0.0, float((c[on] / n * np.log(c[on] * n / (rows * columns)[on])).sum()))))
            yield pd.DataFrame(out, columns=["a", "b", "mi"])

    return summed.mapInPandas(information, "a string, b string, mi double")


def mutual_information(df: DataFrame, target: str, features: Sequence[str], bins: int | None = None) -> DataFrame:
    """Information of each feature about the target, and the same scaled to [0, 1]."""
    binned = equal_frequency_bins(df.select(target, *features), [target, *features], bins)
    scores = pair_information(binned, [(f, target) for f in features]).select(F.col("a").alias("name"), "mi")
    return scaled_score(scores, "mi", "mi_scaled")


def information_network(df: DataFrame, columns: Sequence[str], threshold: float, bins: int | None = None) -> DataFrame:
    """Undirected edges between columns whose mutual information exceeds the threshold."""
    binned = equal_frequency_bins(df.select(*columns), columns, bins)
    edges = pair_information(binned, list(combinations(sorted(columns), 2)))
    return edges.where(F.col("mi") > threshold).select(F.col("a").alias("source"), F.col("b").alias("target"), "mi")


def network_nodes(edges: DataFrame) -> DataFrame:
    """Degree and strength of each node of an edge list."""
    ends = F.explode(F.array("source", "target")).alias("name")
    return edges.select(ends, "mi").groupBy("name").agg(F.count(F.lit(1)).alias("degree"), F.sum("mi").alias("strength"))


def scaled_score(scores: DataFrame, column: str, out: str) -> DataFrame:
    """Score scaled to [0, 1]; the table has one row per feature."""
    every = Window.partitionBy(F.lit(1))
    low, high = F.min(column).over(every), F.max(column).over(every)
    return scores.select("*", F.try_divide(F.col(column) - low, high - low).alias(out))


# ---- correlation


def summed_arrays(parts: DataFrame, *keys: str) -> DataFrame:
    """Element-wise sums of the arrays ``sums`` per integer keys.

    Arrays of a share of the partitions are added first, then those of the shares, so that no task holds
    the arrays of all partitions.
    """

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1].assign(sums=[np.sum(np.stack(pdf["sums"].to_numpy()), axis=0)])

    named = ", ".join(f"{k} int" for k in keys)
    shares = parts.withColumn("share", F.spark_partition_id() % 256)
    halfway = shares.groupBy(*keys, "share").applyInPandas(add, f"{named}, sums array<double>, share int")
    return halfway.drop("share").groupBy(*keys).applyInPandas(add, f"{named}, sums array<double>")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every pair of listed columns, over the rows that have both.

    Every partition multiplies its rows as matrices and gives one row per column, so neither the plan nor
    any row grows with the number of pairs. Values are measured from the column's mean, which keeps the
    digits of the sums. NaN counts as missing; an empty table gives no pairs.
    """
    columns = list(columns)
    size = len(columns)
    means = df.agg(*[F.avg(c) for c in columns]).first()  # one number per column
    centred = df.select(*[(F.col(c).cast("double") - F.lit(float(means[i] or 0.0))).alias(f"v{i}") for i, c in enumerate(columns)])

    def products(batches):
        total = np.zeros((size, size, 6))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            known = (~np.isnan(x)).astype(float)
            x = np.where(known > 0, x, 0.0)
            first, second = x.T @ known, (x * x).T @ known
            total += np.stack([known.T @ known, first, first.T, second, second.T, x.T @ x], axis=2)
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(size), pa.int32()), "sums": pa.array([row.ravel() for row in total], pa.list_(pa.float64()))})

    summed = summed_arrays(centred.mapInArrow(products, "place int, sums array<double>"), "place")
    pairs = summed.where(F.col("place") < size - 1).withColumn("other", F.explode(F.sequence(F.col("place") + 1, F.lit(size - 1))))
    n, sx, sy, sxx, syy, sxy = (F.get("sums", F.col("other") * 6 + i) for i in range(6))
    r = F.try_divide(n * sxy - sx * sy, F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)))
    names = F.array(*[F.lit(c) for c in columns])
    return pairs.select(F.get(names, F.col("place")).alias("a"), F.get(names, F.col("other")).alias("b"), r.alias("r"))


def redundant_columns(df: DataFrame, columns: Sequence[str], limit: float = 0.9) -> list[str]:
    """Later column of each pair correlated beyond the limit (a list bounded by the columns)."""
    high = correlation_pairs(df, columns).where(F.abs("r") > limit).select("b").distinct().collect()
    return sorted(r["b"] for r in high)


def collinearity(df: DataFrame, columns: Sequence[str]) -> list[float]:
    """Eigenvalues of the correlation matrix, ascending; a value near zero means collinear columns."""
    matrix = np.eye(len(columns))
    place = {c: i for i, c in enumerate(columns)}
    for r in correlation_pairs(df, columns).collect():
        matrix[place[r["a"]], place[r["b"]]] = matrix[place[r["b"]], place[r["a"]]] = r["r"]
    return [float(v) for v in np.linalg.eigvalsh(matrix)]


# ---- LASSO on cross-product sums


def block_sums(df: DataFrame, target: str, features: Sequence[str], blocks: int, seed: int = 0) -> DataFrame:
    """Sums of products of (1, target, features) per hash block of rows: ``(block, sums array)``.

    One pass. With few columns the products are plain aggregates; with many every partition multiplies its rows as
    matrices and gives one row per block and column. Later resampling and cross-validation add blocks up, so rows are
    read once whatever the number of rounds.
    """
    names = [target, *features]
    size = len(names) + 1
    block = F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(blocks)).cast("int").alias("block")
    rows = df.select(block, *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)]).na.drop("any")
    if len(names) <= FEW:
        factors = [F.lit(1.0), *[F.col(f"v{i}") for i in range(len(names))]]
        products = [F.sum(factors[i] * factors[j]) for i in range(size) for j in range(i, size)]
        return rows.groupBy("block").agg(F.array(*products).alias("sums"))

    def handed_on(held):
        for b, matrix in held.items():
            lists = pa.array([matrix[i, i:] for i in range(size)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict({"block": pa.array([b] * size, pa.int32()), "place": pa.array(range(size), pa.int32()), "sums": lists})
        held.clear()

    def products(batches):
        held = {}
        for batch in batches:
            of, *values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            x = np.column_stack([np.ones(len(of)), *values])
            for b in np.unique(of).tolist():
                part = x[of == b]
                held[b] = held.get(b, 0.0) + part.T @ part
                if len(held) * size * size > HELD:
                    yield from handed_on(held)
        yield from handed_on(held)

    summed = summed_arrays(rows.mapInArrow(products, "block int, place int, sums array<double>"), "block", "place")
    ordered = F.sort_array(F.collect_list(F.struct("place", "sums")))
    return summed.groupBy("block").agg(F.flatten(F.transform(ordered, lambda row: row["sums"])).alias("sums"))


def shared_sums(sums: DataFrame, size: int):
    """The block sums, ordered by block, as a broadcast list of arrays; their number is checked before they are gathered."""
    count = sums.count()
    if count * size * (size + 1) // 2 > SHARED:
        raise ValueError(f"{count} blocks of {size} columns exceed {SHARED} numbers: take fewer blocks, or the forms of `wide`")
    table = sums.orderBy("block").select("sums").toArrow()
    arrays = [np.asarray(row.values.to_numpy()) for row in table.column("sums").combine_chunks()] if count else []
    return sums.sparkSession.sparkContext.broadcast(arrays)


def unpack_sums(flat: np.ndarray, size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = flat
    return full + np.triu(full, 1).T


def lasso_fit(sums: np.ndarray, penalties: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (intercept first) for each penalty, and whether each fit converged.

    Coordinate descent on standardised moments; ``weights`` scale the columns before the fit: a smaller weight is
    penalised more.
    """
    n = sums[0, 0]
    mean = sums[0, 1:] / n
    cov = sums[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-300))
    live = np.diag(cov)[1:] > 1e-12 * np.maximum(1.0, mean[1:] ** 2)
    corr = cov / np.outer(sd, sd)
    link, rel = corr[1:, 1:] * np.outer(weights, weights), corr[1:, 0] * weights
    link, rel = np.where(np.outer(live, live), link, 0.0), np.where(live, rel, 0.0)
    beta, out, converged = np.zeros(len(rel)), [], []
    for penalty in penalties:
        converged.append(descend(link, rel, penalty, beta))
        slope = beta * weights * sd[0] / sd[1:]
        out.append(np.concatenate([[mean[0] - slope @ mean[1:]], slope]))
    return np.array(out), np.array(converged, bool)


def lasso_path(sums: np.ndarray, count: int = 60) -> np.ndarray:
    """Penalties from the one that empties the model down to a thousandth of it."""
    n = sums[0, 0]
    mean = sums[0, 1:] / n
    cov = sums[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-300))
    top = float(np.max(np.abs(cov[1:, 0] / (sd[1:] * sd[0])))) or 1e-12
    return np.geomspace(top, top * 1e-3, count)


def squared_error(sums: np.ndarray, coef: np.ndarray) -> float:
    """Mean squared error of a linear model, from cross-product sums."""
    v = np.concatenate([[-coef[0], 1.0], -coef[1:]])
    return float(v @ sums @ v / sums[0, 0])


def lasso_cv(folds: Sequence[np.ndarray], weights: np.ndarray | None = None, one_se: bool = False) -> tuple[np.ndarray, bool]:
    """Coefficients at the penalty of least cross-validated error, or the largest within one standard error.

    Also tells whether every fit that the choice rests on converged.
    """
    total = np.sum(folds, axis=0)
    weights = np.ones(total.shape[0] - 2) if weights is None else weights
    penalties = lasso_path(total)
    errors, good = [], True
    for held in folds:
        if held[0, 0] == 0:
            continue
        coefs, converged = lasso_fit(total - held, penalties, weights)
        good &= bool(converged.all())
        errors.append([squared_error(held, c) for c in coefs])
    best = chosen_penalty(np.array(errors), one_se)
    coefs, converged = lasso_fit(total, penalties[: best + 1], weights)
    return coefs[best], good and bool(converged.all())


def clipped_score(coef: np.ndarray) -> np.ndarray:
    """Coefficients clipped at zero and scaled to [0, 1]."""
    clipped = np.maximum(coef, 0)
    span = clipped.max() - clipped.min() if len(clipped) else 0.0
    return (clipped - clipped.min()) / span if span else np.zeros(len(clipped))


def lasso(df: DataFrame, target: str, features: Sequence[str], folds: int = 10, seed: int = 0, one_se: bool = False,
          nonzero: bool = False) -> DataFrame:
    """Cross-validated LASSO coefficients; ``score`` is the coefficient clipped at zero and scaled.

    A fit needs one (columns + 2)² matrix per fold; the paths of the folds are tasks of their own unless the columns are
    few. ``wide.wide_lasso`` is for very many columns. ``nonzero`` keeps only selected columns. ``converged`` is false if
    a fit of a path was ended before its optimum.
    """
    spark, names, size = df.sparkSession, list(features), len(features) + 2
    schema = "name string, coefficient double, score double, converged boolean"
    by_block = materialise(block_sums(df, target, features, folds, seed), "block-sums")
    shared = shared_sums(by_block, size)
    if not shared.value:
        return spark.createDataFrame([], schema)

    def path(fold: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
        mats = [unpack_sums(a, size) for a in shared.value]
        total = np.sum(mats, axis=0)
        held = mats[fold] if fold < len(mats) else np.zeros_like(total)
        coefs, converged = lasso_fit(total - held, lasso_path(total), np.ones(len(names)))
        return coefs, converged, [squared_error(held, c) if held[0, 0] else math.nan for c in coefs]

    ids = range(len(shared.value) + 1)
    if len(names) < FEW:
        found = [path(fold) for fold in ids]
    else:

        def fit(batches):
            for pdf in batches:
                for fold in pdf["id"].tolist():
                    coefs, converged, errors = path(fold)
                    yield pd.DataFrame({"fold": fold, "place": range(len(coefs)), "coef": [c.tolist() for c in coefs], "converged": converged, "error": errors})

        rows = spark.range(0, len(ids), 1, len(ids)).mapInPandas(fit, "fold int, place int, coef array<double>, converged boolean, error double")
        rows = materialise(rows, "lasso-paths").orderBy("fold", "place").toPandas()  # penalties × folds paths
        found = [(np.stack(g["coef"].to_numpy()), g["converged"].to_numpy(), g["error"].tolist()) for _, g in rows.groupby("fold")]
    errors = np.array([errors for _, _, errors in found[:-1] if not math.isnan(errors[0])])
    best = chosen_penalty(errors, one_se)
    coefs, converged, _ = found[-1]
    good = all(c.all() for _, c, _ in found[:-1]) and bool(converged[: best + 1].all())
    coef = coefs[best][1:]
    rows = [(n, float(c), float(s), good) for n, c, s in zip(names, coef, clipped_score(coef))]
    out = spark.createDataFrame(rows, schema)
    return out.where(F.col("coefficient") != 0) if nonzero else out


def stability_selection(df: DataFrame, target: str, features: Sequence[str], rounds: int = 200, alpha: float = 0.2,
                        seed: int = 0, blocks: int = 200, folds: int = 10) -> DataFrame:
    """Share of fits that select each column, over random half splits with random column weights.

    Rows fall into ``blocks`` hash blocks whose sums are computed once. Each round deals the blocks
    into two halves and fits both; a round is a row of a rounds frame, so rounds run in parallel on
    a table of ``blocks`` rows. ``converged`` is the share of fits whose whole paths did.
    """
    names, size = list(features), len(features) + 2
    shared = shared_sums(materialise(block_sums(df, target, features, blocks, seed), "block-sums"), size)

    def fit(batches):
        mats = shared.value
        for pdf in batches:
            out = []
            for round_id in pdf["round"].tolist():
                rng = np.random.default_rng([seed, int(round_id)])
                weights = rng.uniform(alpha, 1.0, len(names))
                order = rng.permutation(len(mats))
                for half in (order[: len(order) // 2], order[len(order) // 2 :]):
                    if len(half) < 2:
                        continue
                    parts = [p for p in np.array_split(half, min(folds, len(half))) if len(p)]
                    held = [unpack_sums(np.sum([mats[i] for i in p], axis=0), size) for p in parts]
                    coef, converged = lasso_cv(held, weights, one_se=True)
                    out += [(int(round_id), name, float(c != 0), float(converged)) for name, c in zip(names, coef[1:])]
            yield pd.DataFrame(out, columns=["round", "name", "selected", "converged"])

    spark = df.sparkSession
    todo = spark.range(rounds).withColumnRenamed("id", "round").repartition(min(rounds, 256))
    fits = todo.mapInPandas(fit, "round long, name string, selected double, converged double")
    return fits.groupBy("name").agg(F.avg("selected").alias("frequency"), F.count(F.lit(1)).alias("fits"), F.avg("converged").alias("converged"))


def chunked_inclusion(series: DataFrame, target: str, rounds: int, chunk_size: int, seed: int = 0, flag_at: float = 0.6) -> DataFrame:
    """Inclusion shares over random disjoint chunks of predictors; see :func:`millrace.operators.wide.wide_chunks`."""
    from millrace.operators.wide import wide_chunks  # which builds on the models

    return wide_chunks(series, target, rounds, chunk_size, seed, flag_at)


def sample_names(names: DataFrame, draws: int, seed: int = 0) -> DataFrame:
    """``draws`` names with replacement, as ``(name, times)``; joining it repeats the columns."""
    ranked = add_group_stats(global_order(names.select("name").distinct(), [F.asc("name")], "_rank"), [], _n=F.count(F.lit(1)))
    total = ranked.agg(F.max("_n").alias("_n"))
    picks = attach_row(names.sparkSession.range(draws), total)
    picks = picks.select((F.pmod(md5_draw(F.lit(seed), F.col("id")), F.col("_n")) + 1).alias("_rank"))
    picks = picks.groupBy("_rank").agg(F.count(F.lit(1)).alias("times"))
    return picks.join(ranked.select("_rank", "name"), "_rank").select("name", "times")


# ---- causality between a target series and each predictor


def with_target(series: DataFrame, target: str) -> DataFrame:
    """Predictor rows with the target's value on the same date (x, y); the target has one row per period."""
    y = series.where(F.col("name") == target).select("date", F.col("value").alias("y"))
    return series.where(F.col("name") != target).join(y, "date").select("name", "date", F.col("value").alias("x"), "y")


def lag_criteria(x: np.ndarray, y: np.ndarray, most: int) -> tuple[int, int]:
    """Lag orders 1…most with least AIC and BIC for y on lags of y and x, on a common sample."""
    target = y[most:]
    n = len(target)
    scores = []
    for lags in range(1, most + 1):
        m = np.column_stack([np.ones(n), lag_matrix(y, lags, most), lag_matrix(x, lags, most)])
        fit = n * math.log(max(ols(target, m)[1] / n, 1e-300))
        scores.append((fit + 2 * (m.shape[1] + 1), fit + math.log(n) * (m.shape[1] + 1)))
    aic, bic = zip(*scores)
    return int(np.argmin(aic)) + 1, int(np.argmin(bic)) + 1


def granger_f(cause: np.ndarray, effect: np.ndarray, lags: int) -> tuple[float, int]:
    """F statistic, and its spare degrees, of the test that lags of ``cause`` add nothing to lags of ``effect``."""
    target = effect[lags:]
    n = len(target)
    small = np.column_stack([np.ones(n), lag_matrix(effect, lags, lags)])
    large = np.column_stack([small, lag_matrix(cause, lags, lags)])
    spare = n - large.shape[1]
    if spare <= 0:
        return float("nan"), spare
    rss0, rss1 = ols(target, small)[1], ols(target, large)[1]
    return ((rss0 - rss1) / lags / (rss1 / spare) if rss1 > 0 else float("nan")), spare


def granger_p(cause: np.ndarray, effect: np.ndarray, lags: int) -> float:
    """p-value of the F test that lags of ``cause`` add nothing to lags of ``effect``."""
    statistic, spare = granger_f(cause, effect, lags)
    return float("nan") if math.isnan(statistic) else f_tail(statistic, lags, spare)


def granger_statistics(series: DataFrame, target: str, lags: int = 1, differences: int = 1) -> DataFrame:
    """F statistics in both directions per predictor, for given lags and differences."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date").dropna()
        x, y = (np.diff(pdf[c].to_numpy(float), differences) for c in "xy")
        names = ["name", "causes_target", "caused_by_target"]
        if len(y) <= 3 * lags + 1:  # no spare degrees
            return pd.DataFrame([(pdf["name"].iloc[0] if len(pdf) else None, None, None)], columns=names)
        return pd.DataFrame([(pdf["name"].iloc[0], granger_f(x, y, lags)[0], granger_f(y, x, lags)[0])], columns=names)

    return with_target(series, target).groupBy("name").applyInPandas(one, "name string, causes_target double, caused_by_target double")


def granger(series: DataFrame, target: str, most: int = 12) -> DataFrame:
    """Lag orders and p-values in both directions per predictor, on differenced series."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date").dropna()
        x, y = pdf["x"].to_numpy(float), pdf["y"].to_numpy(float)
        row = [pdf["name"].iloc[0] if len(pdf) else None, None, None, None, None]
        order = difference_order(y) if len(y) > 3 else 0
        x, y = np.diff(x, order), np.diff(y, order)
        if len(y) > 3 * most + 3 and np.ptp(x) > 0 and np.ptp(y) > 0:
            aic, bic = lag_criteria(x, y, most)
            row[1:] = [aic, bic, granger_p(x, y, aic), granger_p(y, x, aic)]
        return pd.DataFrame([row], columns=["name", "lag_aic", "lag_bic", "causes_target", "caused_by_target"])

    schema = "name string, lag_aic int, lag_bic int, causes_target double, caused_by_target double"
    return with_target(series, target).groupBy("name").applyInPandas(one, schema)


def toda_yamamoto_p(cause: np.ndarray, effect: np.ndarray, lags: int, extra: int) -> float:
    """Wald test of the first ``lags`` lags of ``cause`` in a regression with ``lags + extra`` lags,
    constant and trend."""
    total = lags + extra
    target = effect[total:]
    n = len(target)
    m = np.column_stack([np.ones(n), np.arange(n), lag_matrix(cause, total, total), lag_matrix(effect, total, total)])
    spare = n - m.shape[1]
    if spare <= 0:
        return float("nan")
    beta, rss, inverse = ols(target, m)
    pick = slice(2, 2 + lags)
    wald = beta[pick] @ np.linalg.pinv(inverse[pick, pick] * rss / spare) @ beta[pick]
    return chi2_tail(float(wald), lags)


def toda_yamamoto(series: DataFrame, target: str, most: int = 6) -> DataFrame:
    """Causality on undifferenced series, lags by AIC plus the order of integration."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date").dropna()
        x, y = pdf["x"].to_numpy(float), pdf["y"].to_numpy(float)
        row = [pdf["name"].iloc[0] if len(pdf) else None, None, None, None, None]
        if len(y) > 3 * most + 9 and np.ptp(x) > 0 and np.ptp(y) > 0:
            lags, extra = lag_criteria(x, y, most)[0], max(difference_order(x), difference_order(y))
            row[1:] = [lags, extra, toda_yamamoto_p(x, y, lags, extra), toda_yamamoto_p(y, x, lags, extra)]
        return pd.DataFrame([row], columns=["name", "lags", "extra", "causes_target", "caused_by_target"])

    schema = "name string, lags int, extra int, causes_target double, caused_by_target double"
    return with_target(series, target).groupBy("name").applyInPandas(one, schema)


# ---- blended ranking


def blend(scores: Sequence[DataFrame], parts: Sequence[str]) -> DataFrame:
    """Left join of score tables by name, score = sum of the named parts (missing = 0), ranked."""
    joined = reduce(lambda a, b: a.join(b, "name", "left"), scores)
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(p), F.lit(0.0)) for p in parts])
    return joined.withColumn("blended", total).orderBy(F.desc("blended"), "name")


# ---- grouped function over chunks


def run_chunks(df: DataFrame, chunk: str, fn, schema: str) -> DataFrame:
    """Survey 2.17: a user function per chunk, with its status as columns instead of a return code.

    ``fn`` maps a pandas frame to a pandas frame of ``schema``. A failing chunk gives one row with
    its error text and does not stop the others. The caller bounds the size of a chunk.
    """
    names = [part.split()[0] for part in schema.split(",")]

    def safe(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            return fn(pdf).assign(chunk_status="ok", chunk_error=None)
        except Exception as error:  # reported per chunk
            blank = {name: [None] for name in names}
            return pd.DataFrame({**blank, "chunk_status": ["failed"], "chunk_error": [str(error)]})

    return df.groupBy(chunk).applyInPandas(safe, f"{schema}, chunk_status string, chunk_error string")
