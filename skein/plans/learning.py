"""Model queries: k-fold classification, k-means and Gaussian-mixture searches.

Fits draw by seed or depend on partitioning, so these have no SQL oracle (the driver checks row counts);
their invariants are in tests/test_models.py. Grids here are small; the library defaults
are the reference's full grids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import classify as C
from skein.operators import cluster as K
from skein.operators import metrics as M
from skein.operators import ml_prep as P
from skein.operators import tuning as T
from skein.plans.registry import register
from skein.sources import testdata as td

# Fixed query parameters: grids small enough for a correctness run.
CV_FOLDS = 3
LOGIT_REGS = [0.01, 0.1]
FOREST_TREES, FOREST_DEPTHS, FOREST_SUBSETS = [10], [5], ["sqrt", "all"]
KMEANS_KS, KMEANS_ITERS, KMEANS_INITS = [3, 5, 7, 10], [10, 20, 50], ["k-means||", "random"]  # the full grid
GMM_KS = [3, 5, 7, 10]  # the full grid
SEED = 123456
PARALLEL_TRIALS = 1  # fits run one after another (concurrent MLlib fits stalled a local run)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    d = P.threshold_label(td.points_big(spark, sf), "l_extendedprice", td.BIG_PRICE_CUT)
    return P.interaction_terms(d, "l_quantity", "l_discount")


def point_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return P.assemble(td.points(spark, sf), ["x", "y", "z"])


LOGIT_FEATURES = ["l_quantity", "l_discount", "l_quantity_l_discount", "l_quantity_squared",
                  "l_discount_squared"]
FOREST_FEATURES = ["l_quantity", "l_discount"]
FOLD_KEYS = ["l_quantity", "l_discount", "l_extendedprice"]


@register("logit_cv")
def q_logit_cv(spark, sf):
    # as in the reference, features are assembled and standardised once on all rows,
    # then the search validates the logistic regression alone
    scaled = P.standardise(labelled(spark, sf), LOGIT_FEATURES, out="scaled",
                           keep=["label"] + FOLD_KEYS)
    lr = C.LogisticRegression(featuresCol="scaled", labelCol="label")
    trials, _ = T.cross_validate(scaled, lr, C.logistic_grid(lr, LOGIT_REGS), folds=CV_FOLDS,
                                 seed=SEED, fold_keys=FOLD_KEYS, parallelism=PARALLEL_TRIALS)
    return trials


@register("forest_cv")
def q_forest_cv(spark, sf):
    data = P.assemble(labelled(spark, sf), FOREST_FEATURES)
    rf = C.RandomForestClassifier(featuresCol="features", labelCol="label", seed=SEED)
    grid = C.forest_grid(rf, FOREST_TREES, FOREST_DEPTHS, FOREST_SUBSETS)
    trials, _ = T.cross_validate(data, rf, grid, folds=CV_FOLDS, seed=SEED, fold_keys=FOLD_KEYS,
                                 parallelism=PARALLEL_TRIALS)
    return trials


def _kmeans(spark, sf):
    data = point_vectors(spark, sf)
    trials, model = T.search_kmeans(data, KMEANS_KS, KMEANS_ITERS, KMEANS_INITS, SEED)
    return data, trials, model


@register("kmeans_trials")
def q_kmeans_trials(spark, sf):
    return _kmeans(spark, sf)[1]


@register("best_kmeans")
def q_best_kmeans(spark, sf):
    return T.best_trial(_kmeans(spark, sf)[1], "silhouette")


@register("kmeans_assign")
def q_kmeans_assign(spark, sf):
    data, _, model = _kmeans(spark, sf)
    return K.assignments(model, data, "id")


@register("kmeans_centres")
def q_kmeans_centres(spark, sf):
    return K.centres(_kmeans(spark, sf)[2], spark)


@register("kmeans_silhouette")
def q_kmeans_silhouette(spark, sf):
    data, _, model = _kmeans(spark, sf)
    return M.silhouette(model.transform(data), ["x", "y", "z"], "prediction")


def _gmm(spark, sf):
    data = point_vectors(spark, sf)
    trials, model = T.search_gmm(data, GMM_KS, SEED)
    return data, trials, model


@register("gmm_trials")
def q_gmm_trials(spark, sf):
    return _gmm(spark, sf)[1]


@register("gmm_params")
def q_gmm_params(spark, sf):
    return K.gaussians(_gmm(spark, sf)[2], spark)


@register("gmm_assign")
def q_gmm_assign(spark, sf):
    data, _, model = _gmm(spark, sf)
    out = model.transform(data)
    return out.select("id", F.col("prediction").alias("cluster"), "probability")
