"""Model metrics as DataFrame plans (no driver-side loops over rows).

Each metric returns a small DataFrame; the MLlib evaluators give the same numbers
(checked in the tests) but only as a driver-side scalar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.operators.relational import prefix_sum


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) counts."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: share of rows with prediction == label."""
    hit = F.when(F.col(label) == F.col(prediction), 1).otherwise(0)
    return df.agg((F.sum(hit) / F.count("*")).alias("accuracy"))


def f1_weighted(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: per-class F1 weighted by the class's share of true labels (Spark's "f1")."""
    c = confusion(df, label, prediction)
    tp = c.where(F.col("label") == F.col("prediction")).select(F.col("label").alias("cls"), F.col("n").alias("tp"))
    actual = c.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("actual"))
    predicted = c.groupBy(F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = (actual.join(tp, "cls", "left").join(predicted, "cls", "left")
           .select("cls", "actual", F.coalesce("tp", F.lit(0)).alias("tp"),
                   F.coalesce("predicted", F.lit(0)).alias("predicted")))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    r = F.col("tp") / F.col("actual")
    f1 = F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return per.agg((F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("f1"))


def roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """ROC points ``(step, threshold, fpr, tpr)`` as Spark's binary metrics builds them.

    Rows are first aggregated per distinct score (partial aggregation), then cumulative
    true / false positive counts are taken in descending score order with the
    range-partitioned prefix sum (no single-partition window). Step 0 is (0, 0) and the
    last step (threshold null) is (1, 1), appended as in Spark.
    """
    pos = F.when(F.col(label) > 0.5, 1).otherwise(0)
    per_score = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(pos).cast("long").alias("p"), F.sum(1 - pos).cast("long").alias("q"),
        F.max(F.lit(1)).cast("long").alias("one"))
    cum = prefix_sum(per_score, ["threshold"], ["p", "q", "one"], descending=True)
    # totals come from the per-score table (one row per distinct score), not another
    # pass over the scored rows
    tot_p = per_score.agg(F.sum("p")).scalar()
    tot_n = per_score.agg(F.sum("q")).scalar()
    curve = cum.select(F.col("cum_one").alias("step"), "threshold",
                       (F.col("cum_q") / tot_n).alias("fpr"), (F.col("cum_p") / tot_p).alias("tpr"))
    n_steps = per_score.agg(F.count("*")).scalar()
    ends = (df.sparkSession.range(2)
            .select(F.when(F.col("id") == 0, F.lit(0)).otherwise(n_steps + 1).cast("long").alias("step"),
                    F.lit(None).cast("double").alias("threshold"),
                    F.col("id").cast("double").alias("fpr"), F.col("id").cast("double").alias("tpr")))
    return ends.unionByName(curve)


def auc(curve: DataFrame) -> DataFrame:
    """Trapezoid area under ``roc_curve`` output: each step joined with the one before."""
    prev = curve.select((F.col("step") + 1).alias("step"), F.col("fpr").alias("fpr0"),
                        F.col("tpr").alias("tpr0"))
    seg = curve.join(prev, "step")
    return seg.agg(F.sum((F.col("fpr") - F.col("fpr0")) * (F.col("tpr") + F.col("tpr0")) / 2)
                   .alias("auc"))


def rmse(df: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """One row: root mean squared error, null for an empty input (no score)."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def silhouette(df: DataFrame, features: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """One row: mean silhouette with squared Euclidean distance (Spark's definition).

    For a point in cluster A, a = summed squared distance to A's other points / (|A| - 1)
    and b = smallest mean squared distance to another cluster; the coefficient is
    1 - a/b, b/a - 1 or 0, and 0 for a single-point cluster. Distances to a cluster come
    from its statistics (count, feature sums, sum of squared norms), so no point pairs are
    formed; the per-cluster table (one row per cluster) reaches each row as a scalar
    subquery holding an array.
    """
    norm2 = sum((F.col(c) * F.col(c) for c in features), F.lit(0.0))
    stats = df.groupBy(F.col(cluster).alias("c")).agg(
        F.count("*").alias("n"), F.sum(norm2).alias("sq"),
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(features)])
    table = F.col("__stats")
    me = F.col(cluster)
    p_norm = norm2

    def dist(s):
        dot = sum((F.col(c) * s[f"s{i}"] for i, c in enumerate(features)), F.lit(0.0))
        return p_norm + s["sq"] / s["n"] - 2 * dot / s["n"]

    own = F.filter(table, lambda s: s["c"] == me)[0]
    others = F.filter(table, lambda s: s["c"] != me)
    a = dist(own) * own["n"] / (own["n"] - 1)
    b = F.array_min(F.transform(others, dist))
    coef = (F.when(own["n"] <= 1, F.lit(0.0))
            .when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(F.lit(0.0)))
    stats_array = stats.agg(F.collect_list(F.struct(*stats.columns))).scalar()
    with_stats = df.select(*features, cluster, stats_array.alias("__stats"))
    return with_stats.select(coef.alias("__s")).agg(F.avg("__s").alias("silhouette"))
