"""Feature preparation: labels, polynomial terms, vector assembly, standardisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def threshold_label(df: DataFrame, col: str, cut: float, out: str = "label") -> DataFrame:
    """``out`` = 1 when ``col`` > ``cut``, else 0 (null compares false -> 0)."""
    return df.withColumn(out, F.when(F.col(col) > cut, 1).otherwise(0))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def interaction_terms(df: DataFrame, a: str, b: str) -> DataFrame:
    """Add ``a_b`` = a*b, ``a_squared`` = a^2 and ``b_squared`` = b^2."""
    return (df.withColumn(f"{a}_{b}", F.col(a) * F.col(b))
            .withColumn(f"{a}_squared", F.col(a) * F.col(a))
            .withColumn(f"{b}_squared", F.col(b) * F.col(b)))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Dense vector of ``cols``; a null input fails the job (handleInvalid="error")."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def standardise(df: DataFrame, cols: Sequence[str], out: str = "scaled",
                keep: Sequence[str] = ()) -> DataFrame:
    """Mean 0 / sample standard deviation 1 per column (a constant column becomes 0).

    Uses MLlib's scaler (one distributed summary pass); the scaled vector is also
    returned as plain columns ``<col>_s`` so results stay comparable and hashable.
    """
    vec = assemble(df, cols, "__vec")
    model = StandardScaler(inputCol="__vec", outputCol=out, withMean=True, withStd=True).fit(vec)
    scaled = model.transform(vec).withColumn("__arr", vector_to_array(out))
    return scaled.select(*keep, *[F.col("__arr")[i].alias(f"{c}_s") for i, c in enumerate(cols)], out)
