"""Model fitting and scoring with Spark ML, clusters, resampling, encodings and anomaly scores."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import add_group_stats, attach_row, global_order, top_per_key
from millrace.session import discard, in_parts, materialise

#: Rows of a forest's part: a row takes some hundred bytes with its share in every tree.
TREE_ROWS = 500_000

# ---- supervised models


def assembled(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Feature vector and double label; rows with missing parts are left out."""
    ready = df.na.drop(subset=[*features, label]).withColumn("label", F.col(label).cast("double"))
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(ready)


def regression_report(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, models: Sequence[str] = ("linear", "ridge", "elastic_net")) -> DataFrame:
    """Linear, ridge and elastic-net fits scored on the test rows (R², RMSE)."""
    fit_on, score_on = assembled(train, features, label), assembled(test, features, label)
    rows = []
    settings = {"linear": (0.0, 0.0), "ridge": (0.1, 0.0), "elastic_net": (0.1, 0.5)}
    for name in models:
        penalty, mix = settings[name]
        model = LinearRegression(regParam=penalty, elasticNetParam=mix).fit(fit_on)
        scored = model.transform(score_on)
        rows.append((name, *[float(RegressionEvaluator(metricName=m).evaluate(scored)) for m in ("r2", "rmse")]))
    return train.sparkSession.createDataFrame(rows, "model string, r2 double, rmse double")


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion counts with precision, recall and F1 of the positive class, in one aggregation."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = scored.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")
    )
    precision, recall = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    f1 = F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    accuracy = (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return counts.select("*", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), accuracy.alias("accuracy"))


def classifiers(names: Sequence[str], trees: int = 50, rounds: int = 20, depth: int = 5) -> dict[str, object]:
    known = {
        "logistic": LogisticRegression(regParam=0.01),
        "forest": RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7),
        "boosting": GBTClassifier(maxIter=rounds, maxDepth=depth, seed=7),
        "bayes": NaiveBayes(modelType="gaussian"),
    }
    return {n: known[n] for n in names}


def classification_report(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                          models: Sequence[str] = ("logistic", "forest", "boosting", "bayes"), trees: int = 50, rounds: int = 20, depth: int = 5) -> DataFrame:
    """AUC, F1 and confusion counts per model; ``trees`` of the forest, boosting ``rounds``, ``depth`` of both."""
    fit_on, score_on = assembled(train, features, label), assembled(test, features, label)
    out = None
    for name, estimator in classifiers(models, trees, rounds, depth).items():
        scored = estimator.fit(fit_on).transform(score_on)
        # by probability: the raw prediction of some models is not comparable between rows
        auc = float(BinaryClassificationEvaluator(rawPredictionCol="probability").evaluate(scored))
        row = confusion(scored).select(F.lit(name).alias("model"), F.lit(auc).alias("auc"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def forest_grid(train: DataFrame, features: Sequence[str], label: str, depths: Sequence[int], trees: Sequence[int], folds: int = 3) -> DataFrame:
    """Mean cross-validated AUC per setting of a random forest."""
    forest = RandomForestClassifier(seed=7)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).addGrid(forest.numTrees, list(trees)).build()
    search = CrossValidator(estimator=forest, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=folds, seed=7)
    model = search.fit(assembled(train, features, label))
    rows = [(int(g[forest.maxDepth]), int(g[forest.numTrees]), float(m)) for g, m in zip(grid, model.avgMetrics)]
    return train.sparkSession.createDataFrame(rows, "depth int, trees int, auc double")


def forest_importance(df: DataFrame, target: str, features: Sequence[str], trees: int = 50, depth: int = 5) -> DataFrame:
    """Impurity importance per column, ranked, with its log scaled to [0, 1]."""
    model = RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=7).fit(in_parts(assembled(df, features, target).select("features", "label"), TREE_ROWS))
    raw = model.featureImportances.toArray()
    logs = np.array([math.log(v) if v > 0 else 0.0 for v in raw])
    span = logs.max() - logs.min()
    scaled = (logs - logs.min()) / span if span else np.zeros(len(logs))
    rank = {int(i): r + 1 for r, i in enumerate(np.argsort(-raw, kind="stable"))}
    rows = [(f, float(raw[i]), float(scaled[i]), rank[i]) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "name string, importance double, importance_scaled double, rank int")


def permutation_importance(df: DataFrame, target: str, features: Sequence[str], trees: int = 20, depth: int = 5, seed: int = 0) -> DataFrame:
    """Growth of the squared error when a column's values are shuffled.

    The rows are dealt to partitions by a hash and ordered by it, once; inside each batch of that order one column after the
    other is permuted, so all columns share one shuffle and the shuffled copies only pass through the model.
    """
    ready = assembled(df.select(target, *features), features, target)
    model = RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=7).fit(in_parts(ready.select("features", "label"), TREE_ROWS))
    names = list(features)
    rows = df.select(target, *features).na.drop("any").select(*[F.col(c).cast("double").alias(c) for c in (target, *features)])
    mixed = rows.withColumn("_hash", F.xxhash64(F.lit(seed), *rows.columns)).repartition("_hash").sortWithinPartitions("_hash")

    def shuffled(batches):
        for pdf in batches:
            yield pdf.assign(feature=-1)
            for i, column in enumerate(names):
                order = np.random.default_rng([seed, i, len(pdf)]).permutation(len(pdf))
                yield pdf.assign(feature=i, **{column: pdf[column].to_numpy()[order]})

    schema = ", ".join(f"`{c}` double" for c in rows.columns) + ", feature int"
    copies = mixed.drop("_hash").mapInPandas(shuffled, schema)
    error = (F.col("prediction") - F.col("label")) ** 2
    scored = model.transform(assembled(copies, features, target)).groupBy("feature").agg(F.avg(error).alias("mse"))
    base = scored.where("feature < 0").select(F.col("mse").alias("_base"))
    named = F.get(F.array(*[F.lit(c) for c in names]), F.col("feature"))
    return attach_row(scored.where("feature >= 0"), base).select(named.alias("name"), (F.col("mse") - F.col("_base")).alias("importance"))


# ---- clusters of series


def series_vectors(series: DataFrame) -> DataFrame:
    """Standardised vectors per series over all dates, missing values as the mean (0).

    A vector has one entry per calendar period; positions come from the table of distinct dates.
    """
    stats = add_group_stats(series, ["name"], _m=F.avg("value"), _sd=F.stddev_pop("value"))
    z = stats.select("name", "date", F.coalesce(F.try_divide(F.col("value") - F.col("_m"), F.col("_sd")), F.lit(0.0)).alias("z"))
    dates = series.select("date").distinct()
    place = dates.select("date", (F.row_number().over(Window.orderBy("date")) - 1).alias("pos"))  # one row per period
    size = dates.agg(F.count(F.lit(1)).cast("int").alias("_size"))
    cells = z.join(place, "date").groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("pos", "z"))).alias("m"))
    filled = attach_row(cells, size)
    vector = F.transform(F.sequence(F.lit(0), F.col("_size") - 1), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    return filled.select("name", array_to_vector(vector).alias("features"))


def variable_clusters(series: DataFrame, k: int, top: int, seed: int = 7) -> DataFrame:
    """Correlation clusters of series with their best members.

    On standardised vectors the squared distance is 2n(1 − r), so k-means groups by correlation. Kept
    per cluster: the ``top`` series by own correlation (descending) and next-cluster correlation.
    """
    vectors = materialise(series_vectors(series), "vectors")
    model = KMeans(k=k, seed=seed).fit(vectors)
    centres = np.array(model.clusterCenters())  # k vectors of calendar length
    centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)

    @F.pandas_udf("array<double>")
    def correlations(vectors: pd.Series) -> pd.Series:
        x = np.stack(vectors.to_numpy())
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        return pd.Series(list(x @ centres.T))

    scored = model.transform(vectors)
    every = scored.select("name", F.col("prediction").alias("cluster"), correlations(vector_to_array("features")).alias("r"))
    own = F.get("r", F.col("cluster"))
    others = F.filter("r", lambda v, i: i != F.col("cluster"))
    ranked = every.select("name", "cluster", own.alias("own"), F.array_max(others).alias("next"))
    return top_per_key(ranked, ["cluster"], [F.desc("own"), F.asc("next"), F.asc("name")], top)


def bounded_clusters(series: DataFrame, most: int) -> DataFrame:
    """Clusters split until each has at most ``most`` series; ``(name, cluster)``.

    Each pass splits every cluster that is too large between two of its members that lie far apart (the farthest from its
    first, and the farthest from that); members go to the nearer one. All clusters are split by the same joins and
    aggregations, so nothing about them is held on the driver. After twice as many passes as even halves would need, what is
    still too large (equal vectors, or one outlier at a time) is cut by rank.
    """
    vectors = series_vectors(series).select("name", vector_to_array("features").alias("z"))
    state = materialise(vectors.withColumn("cluster", F.lit("0")), "clusters")
    total = state.count()

    def apart(one: str, two: str) -> Column:
        return F.aggregate(F.zip_with(one, two, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, x: total + x)

    def farthest(members: DataFrame, poles: DataFrame, out: str) -> DataFrame:
        met = members.join(poles, "cluster")
        return met.groupBy("cluster").agg(F.max_by("z", F.struct(apart("z", poles.columns[1]), "name")).alias(out))

    for _ in range(2 * math.ceil(math.log2(max(1.0, total / most)))):
        large = materialise(state.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("cluster"), "large")
        if not large.limit(1).count():
            break
        split = state.join(large, "cluster")
        first = split.groupBy("cluster").agg(F.min_by("z", "name").alias("_first"))
        one = farthest(split, first, "_one")
        both = one.join(farthest(split, one, "_two"), "cluster")
        side = F.when(apart("z", "_one") <= apart("z", "_two"), "0").otherwise("1")
        halves = split.join(both, "cluster").select("name", "z", F.concat("cluster", side).alias("cluster"))
        after = materialise(state.join(large, "cluster", "left_anti").select("name", "z", "cluster").unionByName(halves), "clusters")
        discard(state, large)
        state = after
    ranked = global_order(state.select("cluster", "name"), [F.asc("cluster"), F.asc("name")], "_at")
    sized = add_group_stats(ranked, ["cluster"], _first=F.min("_at"), _size=F.count(F.lit(1)))
    pieces = F.ceil(F.col("_size") / most)
    part = F.floor((F.col("_at") - F.col("_first")) * pieces / F.col("_size"))
    return sized.select("name", F.concat_ws(".", F.col("cluster"), part.cast("string")).alias("cluster"))


def cluster_quality(series: DataFrame, ks: Sequence[int], seed: int = 7) -> DataFrame:
    """Silhouette per number of clusters."""
    vectors = materialise(series_vectors(series), "vectors")
    rows =[(int(k), float(ClusteringEvaluator().evaluate(KMeans(k=k, seed=seed).fit(vectors).transform(vectors)))) for k in ks]
    return series.sparkSession.createDataFrame(rows, "k int, silhouette double")


# ---- resampling and encodings


def balance(df: DataFrame, label: str, key: Sequence[str], mode: str = "up", seed: int = 0) -> DataFrame:
    """Repeat minority rows (``up``) or drop majority rows (``down``) until all classes have as many rows.

    The rows of a class are ranked by a hash of the key over the whole table; the first ranks are kept, or
    repeated once more than the others. Rows without a label are left out.
    """
    labelled = df.where(F.col(label).isNotNull())
    upto = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    sizes = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))  # one row per class
    sizes = sizes.select(F.col(label).alias("_label"), "_n", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    sizes = add_group_stats(sizes, [], _most=F.max("_n"), _least=F.min("_n"))
    drawn = labelled.withColumn("_draw", F.xxhash64(F.lit(seed), *key))
    placed = global_order(drawn, [F.asc(label), F.asc("_draw"), *map(F.asc, key)], "_at")
    ranked = placed.join(F.broadcast(sizes), F.col(label) == F.col("_label"))
    rank = F.col("_at") - F.col("_before")
    if mode == "down":
        return ranked.where(rank <= F.col("_least")).select(*df.columns)
    copies = F.floor(F.col("_most") / F.col("_n")) + F.when(rank <= F.col("_most") % F.col("_n"), 1).otherwise(0)
    return ranked.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies.cast("long")))).select(*df.columns)


def target_mean_bins(df: DataFrame, category: str, target: str, bins: int = 4) -> DataFrame:
    """Category → mean of the target → one of ``bins`` equal-width, right-closed bins; joined back."""
    means = df.groupBy(category).agg(F.avg(target).alias("_mean"))
    means = add_group_stats(means, [], _lo=F.min("_mean"), _hi=F.max("_mean"))
    share = F.try_divide(F.col("_mean") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    bin_no = F.least(F.greatest(F.ceil(share * bins), F.lit(1)), F.lit(bins)).cast("int")
    coded = means.select(category, bin_no.alias(f"{category}_bin"))
    return df.join(coded, category)


def shared_codes(df: DataFrame, first: str, second: str) -> DataFrame:
    """Both columns encoded with one vocabulary, ids from 0 in sorted order."""
    words = df.select(F.explode(F.array(first, second)).alias("_w")).distinct().where(F.col("_w").isNotNull())
    codes = global_order(words, [F.asc("_w")], "_id").select("_w", (F.col("_id") - 1).alias("_id"))
    out = df
    for column in (first, second):
        side = codes.withColumnsRenamed({"_w": f"_w_{column}", "_id": f"{column}_id"})
        out = out.join(side, F.col(column) == F.col(f"_w_{column}"), "left").drop(f"_w_{column}")
    return out


# ---- anomaly scores


def sigma_split(df: DataFrame, column: str, m: float = 3.0) -> DataFrame:
    """Flag values further than m population deviations from the mean of the column."""
    stats = add_group_stats(df, [], _u=F.avg(column), _s=F.stddev_pop(column))
    return stats.withColumn("outlier", F.abs(F.col(column) - F.col("_u")) > F.lit(m) * F.col("_s")).drop("_u", "_s")


def pca_scores(df: DataFrame, features: Sequence[str], out: str = "score") -> DataFrame:
    """Σ of squared component scores over the component variances, on standardised columns."""
    steps = [
        VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True),
        PCA(k=len(features), inputCol="_std", outputCol="_pc"),
    ]
    model = Pipeline(stages=steps).fit(df)
    # variances of standardised columns add up to their number
    variances = [float(v) * len(features) for v in model.stages[-1].explainedVariance]
    scores = vector_to_array("_pc")
    total = F.lit(0.0)
    for i, variance in enumerate(variances):
        if variance > 1e-12:
            total = total + scores[i] * scores[i] / variance
    return model.transform(df).withColumn(out, total).drop("_raw", "_std", "_pc")


def gaussian_density(df: DataFrame, features: Sequence[str], out: str = "density") -> DataFrame:
    """Multivariate normal density with the mean and sample covariance of the table.

    Moments are one row; the density is a column expression, so scoring stays in the JVM.
    """
    p = len(features)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    moments = df.agg(
        *[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)],
        *[F.covar_samp(features[i], features[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    cov = np.empty((p, p))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = moments[f"c{i}_{j}"]
    inverse = np.linalg.inv(cov)
    norm = 1 / math.sqrt((2 * math.pi) ** p * np.linalg.det(cov))
    quad = F.lit(0.0)
    for i in range(p):
        for j in range(p):
            quad = quad + (F.col(features[i]) - moments[f"m{i}"]) * (F.col(features[j]) - moments[f"m{j}"]) * float(inverse[i, j])
    return df.withColumn(out, F.exp(quad * -0.5) * norm)


def best_threshold(scored: DataFrame, density: str, label: str, steps: int = 1000) -> DataFrame:
    """Cut-off among ``steps`` even ones with the best F1 for "density below the cut-off is positive".

    Rows are counted per step; the running counts then cover ``steps`` rows.
    """
    ranged = add_group_stats(scored, [], _lo=F.min(density), _hi=F.max(density))
    width = (F.col("_hi") - F.col("_lo")) / steps
    # a row turns positive at the first cut-off above it
    step = F.least(F.floor((F.col(density) - F.col("_lo")) / width) + 1, F.lit(steps)).cast("int")
    counts = ranged.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("hits"), F.min("_lo").alias("lo"), F.min(width).alias("width")
    )
    upto = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = counts.agg(F.sum("hits").alias("positives"))
    running = counts.select("step", (F.col("lo") + F.col("step") * F.col("width")).alias("epsilon"), F.sum("n").over(upto).alias("marked"), F.sum("hits").over(upto).alias("tp"))
    f1 = F.try_divide(2 * F.col("tp"), F.col("marked") + F.col("positives"))
    rated = attach_row(running.where(F.col("step") < steps), total).select("step", "epsilon", f1.alias("f1"))
    return rated.orderBy(F.desc_nulls_last("f1"), "step").limit(1)
