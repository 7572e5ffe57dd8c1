import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skein.operators import classify as C
from skein.operators import forest, ml_prep, tuning


def noisy(spark, n=3000, classes=2):
    rng = np.random.default_rng(7)
    x = np.round(np.column_stack([rng.normal(size=n), rng.exponential(size=n), rng.integers(0, 6, n)]), 3)
    y = (np.floor(np.abs(x[:, 0] * 2 + x[:, 1] + rng.normal(scale=0.7, size=n))) % classes).astype(int)
    rows = [(*map(float, r), int(c), i) for i, (r, c) in enumerate(zip(x, y))]
    return ml_prep.assemble(spark.createDataFrame(rows, "a double, b double, c double, label int, id int"), ["a", "b", "c"])


def search(data, folds=3, columns=("a", "b"), **params):
    """A search over two of the features: their bins are few enough to be counted."""
    rf = C.RandomForestClassifier(featuresCol="f", labelCol="label", seed=5, **params)
    data = ml_prep.assemble(data, list(columns), "f")
    return rf, data, tuning.cross_validate(data, rf, C.forest_grid(rf, [6], [4], ["sqrt", "all"]), folds=folds, fold_keys=["id"])


def test_scores_do_not_depend_on_the_layout(spark):
    data = noisy(spark)
    one, other = (sorted(map(tuple, search(d)[2][0].select("trial", "metric", "fold_score", "chosen").collect()))
                  for d in (data.repartition(4), data.orderBy("b").repartition(16)))
    assert one == other


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
@pytest.mark.parametrize("more", [{}, {"maxBins": 5, "minInstancesPerNode": 40}, {"minInfoGain": 0.01, "minWeightFractionPerNode": 0.05}])
def test_a_tree_of_all_rows_is_mllibs(spark, impurity, more):
    data = ml_prep.assemble(noisy(spark, classes=3), ["a", "b"], "f").withColumnRenamed("id", "fold").withColumn("fold", F.lit(0))
    rf = C.RandomForestClassifier(featuresCol="f", labelCol="label", numTrees=1, maxDepth=5, featureSubsetStrategy="all", bootstrap=False,
                                  impurity=impurity, seed=5, **more)
    model = forest.forest_search(data, rf, [{}], 1).fit(rf)
    keys = ["a", "b"]
    mine, want = ({tuple(r[:2]): (r[2], r[3]) for r in m.transform(data).select(*keys, p, "prediction").collect()}
                  for m, p in ((model, "probability"), (rf.fit(data), vector_to_array("probability"))))
    assert len(mine) > 2000 and mine.keys() == want.keys()
    assert all(mine[k][1] == want[k][1] and np.allclose(mine[k][0], want[k][0], atol=1e-9) for k in mine)


def test_scores_are_those_of_the_models_and_near_mllibs(spark):
    rf, data, (trials, best) = search(noisy(spark))
    chosen = [r for r in trials.collect() if r.chosen]
    for r in chosen:
        assert r.metric != "accuracy" or math.isclose(r.train_score, best["accuracy"].transform(data).where("label = prediction").count() / 3000)
    mllib = rf.copy({rf.numTrees: 6, rf.maxDepth: 4, rf.featureSubsetStrategy: "all"}).fit(data).transform(data).where("label = prediction").count() / 3000
    assert abs(chosen[0].train_score - mllib) < 0.03


def test_bags_of_counts_are_bags_of_rows():
    rf = C.RandomForestClassifier(numTrees=400, maxDepth=1, seed=3, subsamplingRate=0.5)
    counts = np.array([[40, 10], [5, 45]])
    model = forest.fit_counts(counts, np.array([[0], [1]]), [np.array([0.5])], rf)
    bags = np.array([t.weights for t in model.trees])  # by class, over both cells: sums of 45 and 55 draws of mean 0.5
    assert np.allclose(bags.mean(axis=0), [22.5, 27.5], rtol=0.05) and np.allclose(bags.var(axis=0), [22.5, 27.5], rtol=0.3)


def test_too_many_cells_and_wrong_labels(spark, monkeypatch):
    data = noisy(spark, 200)
    wrong = data.withColumn("label", data.label - 1)
    with pytest.raises(Exception, match="whole numbers"):
        search(wrong)
    monkeypatch.setattr(forest, "MAX_CELLS", 8)  # MLlib takes over
    assert type(search(data, 2)[2][1]["f1"]).__name__ == "RandomForestClassificationModel"
