"""Binary classifiers (MLlib) on assembled feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder

# The reference's search grids and seed.
LOGISTIC_REG_PARAMS = [0.001, 0.01, 0.1, 0.2, 0.5, 0.7, 1.0]
FOREST_NUM_TREES = [2, 10, 20]
FOREST_MAX_DEPTH = [2, 5, 10]
FOREST_SUBSET = ["sqrt", "log2", "all"]
SEED = 123456


def logistic_pipeline(features: Sequence[str], label: str = "label"):
    """Assemble -> standardise -> logistic regression; returns (pipeline, lr stage)."""
    lr = LogisticRegression(featuresCol="scaled", labelCol=label)
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        lr])
    return pipe, lr


def forest_pipeline(features: Sequence[str], label: str = "label", seed: int = SEED):
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, seed=seed)
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"), rf])
    return pipe, rf


def logistic_grid(lr, reg_params=LOGISTIC_REG_PARAMS):
    return ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).build()


def forest_grid(rf, num_trees=FOREST_NUM_TREES, max_depth=FOREST_MAX_DEPTH, subset=FOREST_SUBSET):
    return (ParamGridBuilder().addGrid(rf.numTrees, list(num_trees))
            .addGrid(rf.maxDepth, list(max_depth))
            .addGrid(rf.featureSubsetStrategy, list(subset)).build())


def describe_params(param_map) -> str:
    """Stable text form of a grid point, e.g. ``maxDepth=5,numTrees=10``."""
    return ",".join(f"{p.name}={v}" for p, v in sorted(param_map.items(), key=lambda kv: kv[0].name))
