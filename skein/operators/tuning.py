"""Parameter search producing trial tables: k-fold validation scored with several metrics
per fit, k-means / Gaussian-mixture / ALS grids, best-trial selection.

The driver loops over trials and folds only (bounded by the grid), never over rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators.classify import describe_params
from skein.operators.forest import forest_search
from skein.operators.grid_fit import kmeans_grid, mixture_grid
from skein.operators.metrics import confusion
from skein.operators.relational import arg_top
from skein.session import spread


def best_trial(trials: DataFrame, metric: str = "score", larger_is_better: bool = True) -> DataFrame:
    """The best row of a trial table; the first trial (lowest ``trial``) wins ties."""
    return arg_top(trials, metric, k=1, desc=larger_is_better, tie=["trial"])


def _pick(scores: list[float | None], larger: bool) -> int | None:
    best, best_i = None, None
    for i, s in enumerate(scores):
        if s is None:
            continue
        if best is None or (s > best if larger else s < best):
            best, best_i = s, i
    return best_i


def fold_column(df: DataFrame, folds: int, seed: int, keys: Sequence[str] | None = None,
                out: str = "fold") -> DataFrame:
    """Fold number from a hash of the row (stable under repartitioning and recomputation)."""
    cols = [F.col(c) for c in (keys or df.columns)]
    return df.withColumn(out, F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(folds)).cast("int"))


def _class_scores(cells: Iterable[tuple], metrics: Sequence[str]) -> dict[str, float]:
    """Accuracy and weighted F1 from the (label, prediction, n) rows of one confusion table."""
    actual, predicted, hits, total = {}, {}, {}, 0
    for label, prediction, n in cells:
        total += n
        actual[label] = actual.get(label, 0) + n
        predicted[prediction] = predicted.get(prediction, 0) + n
        if float(label) == float(prediction):
            hits[label] = hits.get(label, 0) + n
    out = {"accuracy": sum(hits.values()) / total if total else 0.0}
    f1 = 0.0
    for cls, n in actual.items():
        tp = hits.get(cls, 0)
        pp = sum(v for k, v in predicted.items() if float(k) == float(cls))
        p = tp / pp if pp else 0.0
        r = tp / n
        f1 += (2 * p * r / (p + r) if p + r > 0 else 0.0) * n
    out["f1"] = f1 / total if total else 0.0
    unknown = set(metrics) - set(out)
    if unknown:
        raise ValueError(f"unsupported metrics {sorted(unknown)}")
    return {m: out[m] for m in metrics}


def cross_validate(df: DataFrame, estimator, grid, metrics: Sequence[str] = ("accuracy", "f1"),
                   folds: int = 10, seed: int = 123456, label: str = "label",
                   parallelism: int = 1, fold_keys: Sequence[str] | None = None):
    """k-fold validation where each (fold, grid point) model is fitted once and scored
    with every metric from one confusion table; the best grid point per metric (first
    wins ties) is refitted on all rows, once per distinct grid point.

    Returns ``(trials, best)``: trials has (trial, params, metric, fold_score = mean
    over folds, train_score = score of the refitted model on the training rows, only for
    the chosen trial, chosen); ``best`` maps metric -> fitted model.

    Random forests are fitted and scored from counts of binned rows where these are few enough
    (:mod:`skein.operators.forest`), everything else by the estimator over cached rows.
    """
    spark = df.sparkSession
    data = fold_column(df, folds, seed, fold_keys)
    counted = forest_search(data, estimator, grid, folds, label) if isinstance(estimator, RandomForestClassifier) else None
    if counted is None:
        data = spread(data).persist()
        data.count()  # fill the cache once before folds run concurrently
    sums = {m: [0.0] * len(grid) for m in metrics}

    def run_fold(f: int):
        if counted is not None:
            models = ((i, counted.fit(estimator.copy(p), f)) for i, p in enumerate(grid))
            return [(idx, _class_scores(counted.confusion(model, f), metrics)) for idx, model in models]
        train = data.where(F.col("fold") != f)
        valid = data.where(F.col("fold") == f)
        return [(idx, _class_scores(confusion(model.transform(valid), label).collect(), metrics))
                for idx, model in estimator.fitMultiple(train, grid)]

    def refit(b: int):
        if counted is not None:
            model = counted.fit(estimator.copy(grid[b]))
            return model, _class_scores(counted.confusion(model), metrics)
        model = estimator.fit(data, grid[b])
        return model, _class_scores(confusion(model.transform(data), label).collect(), metrics)

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        for scored in pool.map(run_fold, range(folds)):
            for idx, scores in scored:
                for m in metrics:
                    sums[m][idx] += scores[m]
    refits, best, rows = {}, {}, []
    for m in metrics:
        means = [s / folds for s in sums[m]]
        b = _pick(means, True)
        if b not in refits:
            refits[b] = refit(b)
        model, train_scores = refits[b]
        best[m] = model
        for i, pm in enumerate(grid):
            rows.append((i, describe_params(pm), m, float(means[i]),
                         float(train_scores[m]) if i == b else None, i == b))
    if counted is None:
        data.unpersist()
    trials = spark.createDataFrame(rows, "trial int, params string, metric string, fold_score double, "
                                         "train_score double, chosen boolean")
    return trials, best


def search_kmeans(df: DataFrame, ks=(3, 5, 7, 10), max_iters=(10, 20, 50),
                  init_modes=("k-means||", "random"), seed: int = 123456,
                  features: str = "features"):
    """Grid over k x maxIter x initMode, scored by silhouette (squared Euclidean), all grid points in
    one scan an iteration (:mod:`skein.operators.grid_fit`).

    Returns ``(trials, best_model)``; the first trial wins ties, as in a strict ``>`` scan.
    """
    results = kmeans_grid(df, ks, max_iters, init_modes, seed, features)
    b = _pick([r[-1] for r in results], True)
    rows = [(i, k, it, mode, float(s), i == b) for i, (k, it, mode, _, s) in enumerate(results)]
    trials = df.sparkSession.createDataFrame(rows, "trial int, k int, max_iter int, init_mode string, "
                                                   "silhouette double, chosen boolean")
    return trials, results[b][3]


def search_gmm(df: DataFrame, ks=(3, 5, 7, 10), seed: int = 123456, features: str = "features",
               max_iter: int = 100):
    """Gaussian mixtures for all k together, scored by the training log-likelihood."""
    results = mixture_grid(df, ks, seed, max_iter, features)
    b = _pick([r.log_likelihood for r in results], True)
    rows = [(i, int(k), float(r.log_likelihood), i == b) for i, (k, r) in enumerate(zip(ks, results))]
    trials = df.sparkSession.createDataFrame(rows, "trial int, k int, log_likelihood double, chosen boolean")
    return trials, results[b]


def search_als(train: DataFrame, test: DataFrame, ranks=(10, 20, 30), reg_params=(0.01, 0.1, 0.5),
               max_iters=(3, 10, 20), seed: int = 12345, parallelism: int = 1, **als_args):
    """ALS grid scored by test RMSE (cold-start rows dropped before scoring).

    Returns ``(trials, best_model)``. A trial whose test rows are all cold has no score;
    if no trial has one, the first trial's model is returned (score null).
    """
    from pyspark.ml.recommendation import ALS
    spark = train.sparkSession
    grid = list(itertools.product(ranks, reg_params, max_iters))
    n_test = test.count()

    def run(params):
        rank, reg, it = params
        als = ALS(rank=rank, regParam=reg, maxIter=it, userCol="user", itemCol="item",
                  ratingCol="rating", coldStartStrategy="drop", seed=seed, **als_args)
        model = als.fit(train)
        err = F.col("rating").cast("double") - F.col("prediction").cast("double")
        # one pass over the predictions for both the score and the covered share
        row = model.transform(test).agg(F.count("*").alias("n"), F.sqrt(F.avg(err * err)).alias("rmse")).first()
        covered = row["n"] / n_test if n_test else 0.0
        return model, (row["rmse"] if row["n"] else None), covered

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        results = list(pool.map(run, grid))
    b = _pick([s for _, s, _ in results], False)
    chosen = 0 if b is None else b
    rows = [(i, r, reg, it, s, float(c), i == chosen)
            for i, ((r, reg, it), (_, s, c)) in enumerate(zip(grid, results))]
    trials = spark.createDataFrame(rows, "trial int, rank int, reg_param double, max_iter int, "
                                         "rmse double, covered double, chosen boolean")
    return trials, results[chosen][0]


