"""Clustering results: centres, mixture parameters, assignments, profiles (fits: ``grid_fit``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Per-cluster summary instead of collecting points: count, mean, min and max."""
    aggs = [F.count("*").alias("n")]
    for c in features:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(F.col(cluster).alias("cluster")).agg(*aggs)


def centres(model, spark=None) -> DataFrame:
    """k-means centres as rows (cluster, dim, value); k x d values, bounded by the model."""
    spark = spark or _active()
    rows = [(i, j, float(v)) for i, c in enumerate(model.clusterCenters()) for j, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, dim int, value double")


def gaussians(model, spark=None) -> DataFrame:
    """Mixture parameters flattened: (cluster, weight, kind, i, j, value), kind = mean | cov.

    Built from the fitted model (k x d x d values, bounded by the model, not the data).
    """
    spark = spark or _active()
    rows = []
    for c, (w, mean, cov) in enumerate(zip(model.weights, model.means, model.covariances)):
        for i, v in enumerate(mean):
            rows.append((c, float(w), "mean", i, 0, float(v)))
        for i in range(cov.shape[0]):
            for j in range(cov.shape[1]):
                rows.append((c, float(w), "cov", i, j, float(cov[i, j])))
    return spark.createDataFrame(rows, "cluster int, weight double, kind string, i int, j int, value double")


def assignments(model, df: DataFrame, key: str, prediction: str = "prediction") -> DataFrame:
    """(key, cluster) per row; keeps the row key, so duplicate points never multiply."""
    return model.transform(df).select(key, F.col(prediction).alias("cluster"))


def _active():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()
