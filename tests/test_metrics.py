import math

from pyspark.ml.evaluation import (BinaryClassificationEvaluator, ClusteringEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from skein.operators import metrics as M


def test_roc_on_hard_scores(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (0.0, 1), (0.0, 0), (0.0, 0)], "score double, label int")
    pts = [(r.fpr, r.tpr) for r in M.roc_curve(df).orderBy("step").collect()]
    want = [(0, 0), (1 / 3, 1 / 2), (1, 1), (1, 1)]
    assert all(math.isclose(a, c) and math.isclose(b, d) for (a, b), (c, d) in zip(pts, want))
    assert math.isclose(M.auc(M.roc_curve(df)).first().auc, 7 / 12)


def test_auc_matches_spark(spark):
    df = spark.range(3000).select(F.round(F.rand(1), 2).alias("score"),
                                  (F.rand(2) < 0.4).cast("int").alias("label"))
    df = df.withColumn("label", F.when(F.rand(3) < F.col("score"), 1).otherwise(F.col("label")))
    mine = M.auc(M.roc_curve(df)).first().auc
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    assert math.isclose(mine, spark_auc, rel_tol=1e-9)


def test_accuracy_f1_match_evaluator(spark):
    df = spark.range(2000).select((F.col("id") % 3).cast("double").alias("label"),
                                  ((F.col("id") * 7 + 1) % 3 % 2).cast("double").alias("prediction"))
    for metric, fn, col in [("accuracy", M.accuracy, "accuracy"), ("f1", M.f1_weighted, "f1")]:
        ev = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert math.isclose(fn(df).first()[col], ev, rel_tol=1e-9)


def test_rmse_matches_evaluator(spark):
    df = spark.range(500).select((F.col("id") % 10).cast("double").alias("rating"),
                                 (F.col("id") % 7).cast("double").alias("prediction"))
    ev = RegressionEvaluator(metricName="rmse", labelCol="rating").evaluate(df)
    assert math.isclose(M.rmse(df).first().rmse, ev, rel_tol=1e-9)
    assert M.rmse(df.where("rating > 100")).first().rmse is None


def test_silhouette_matches_evaluator(spark):
    df = spark.range(600).select(F.rand(5).alias("x"), F.rand(6).alias("y"),
                                 (F.col("id") % 4).alias("prediction"))
    df = df.withColumn("x", F.col("x") + F.col("prediction"))
    vec = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    ev = ClusteringEvaluator().evaluate(vec)
    assert math.isclose(M.silhouette(df, ["x", "y"], "prediction").first().silhouette, ev, rel_tol=1e-9)
