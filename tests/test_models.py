import math

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skein.operators import classify as C
from skein.operators import ml_prep as P
from skein.operators import tuning as T
from skein.plans.learning import point_vectors
from skein.sources import testdata as td
from tests.conftest import SF_SMALL


def test_standardise_mean_zero_std_one(spark):
    s = P.standardise(td.points(spark, SF_SMALL), ["x", "y", "z"], keep=["id"])
    stats = s.agg(*[F.avg(f"{c}_s").alias(f"m{c}") for c in "xyz"],
                  *[F.stddev_samp(f"{c}_s").alias(f"s{c}") for c in "xyz"]).first()
    for c in "xyz":
        assert abs(stats[f"m{c}"]) < 1e-9 and math.isclose(stats[f"s{c}"], 1.0, rel_tol=1e-9)


def test_kmeans_search_and_nearest_centre(spark):
    data = point_vectors(spark, SF_SMALL)
    trials, model = T.search_kmeans(data, ks=(2, 3), max_iters=(5,), init_modes=("k-means||", "random"))
    rows = trials.orderBy("trial").collect()
    best = max(r.silhouette for r in rows)
    chosen = [r for r in rows if r.chosen]
    assert len(chosen) == 1 and chosen[0].silhouette == best
    assert chosen[0].trial == min(r.trial for r in rows if r.silhouette == best)
    centres = np.array([c for c in model.clusterCenters()])
    pts = model.transform(data).select(vector_to_array("features").alias("f"), "prediction").collect()
    for p in pts:
        d = ((centres - np.array(p.f)) ** 2).sum(axis=1)
        assert d[p.prediction] <= d.min() + 1e-9


def test_gmm_search_picks_max_likelihood(spark):
    trials, model = T.search_gmm(point_vectors(spark, SF_SMALL), ks=(2, 3))
    rows = trials.collect()
    assert [r for r in rows if r.chosen][0].log_likelihood == max(r.log_likelihood for r in rows)


def test_grids_do_not_depend_on_the_layout(spark):
    data = point_vectors(spark, SF_SMALL)
    for fit in (lambda d: T.search_kmeans(d, ks=(2, 4), max_iters=(3, 8)), lambda d: T.search_gmm(d, ks=(2, 3), max_iter=6)):
        one, other = fit(data.repartition(3)), fit(data.orderBy("y").coalesce(1))
        assert sorted(map(tuple, one[0].collect())) == sorted(map(tuple, other[0].collect()))


def test_kmeans_grid_agrees_with_mllib_from_the_same_centres_and_scores(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    data = point_vectors(spark, SF_SMALL)
    trials, model = T.search_kmeans(data, ks=(3,), max_iters=(10,), init_modes=("random",))
    score = ClusteringEvaluator(metricName="silhouette").evaluate(model.transform(data))
    assert math.isclose(trials.first().silhouette, score, abs_tol=1e-6)


def test_mixture_recovers_two_groups_and_its_likelihood(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal((0, 0), (1, 0.5), (600, 2)), rng.normal((8, 3), (0.5, 2), (300, 2))])
    data = P.assemble(spark.createDataFrame(x.tolist(), "a double, b double"), ["a", "b"])
    trials, model = T.search_gmm(data, ks=(2,))
    order = np.argsort(model.means[:, 0])
    assert np.allclose(model.weights[order], [2 / 3, 1 / 3], atol=0.01)
    assert np.allclose(model.means[order], [[0, 0], [8, 3]], atol=0.3)
    logs = model.log_terms(x)
    assert math.isclose(trials.first().log_likelihood, np.logaddexp(logs[:, 0], logs[:, 1]).sum(), rel_tol=1e-6)
    p = model.transform(data).select("probability", "prediction").collect()
    assert all(abs(sum(r.probability) - 1) < 1e-9 and r.prediction == int(np.argmax(r.probability)) for r in p)


def test_cross_validate_trial_table(spark):
    d = P.interaction_terms(P.threshold_label(td.points_big(spark, SF_SMALL), "l_extendedprice", 30000.0),
                            "l_quantity", "l_discount")
    pipe, lr = C.logistic_pipeline(["l_quantity", "l_discount", "l_quantity_l_discount"])
    trials, best = T.cross_validate(d, pipe, C.logistic_grid(lr, [0.01, 1.0]), folds=2,
                                    fold_keys=["l_quantity", "l_discount", "l_extendedprice"])
    rows = trials.collect()
    assert len(rows) == 4 and set(best) == {"accuracy", "f1"}
    for m in ("accuracy", "f1"):
        mine = [r for r in rows if r.metric == m]
        top = max(r.fold_score for r in mine)
        ch = [r for r in mine if r.chosen]
        assert len(ch) == 1 and ch[0].fold_score == top and ch[0].train_score is not None
