"""Session construction and the checkpoint-directory rule."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every skein job relies on. AQE re-plans joins from measured shuffle sizes
# (broadcast only when the materialised side is small), coalesces small partitions and
# splits skewed join partitions, so one hot airport, stream or user does not land in a
# single task.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "skein", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the defaults above.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it on the context if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is always
    used. Only a local-mode session without the setting (tests) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="skein-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative skein operators need a shared "
            "checkpoint folder on a cluster")
    return sc.getCheckpointDir()


def default_parallelism(spark: SparkSession) -> int:
    """Partition count used to size range partitioning of derived tables."""
    value = spark.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return max(1, int(value))
    except ValueError:
        return int(os.cpu_count() or 8)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once as parquet under the checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint (the files live in the shared folder,
    so a lost executor never forces recomputation of earlier steps), but computes the
    plan only once (``Dataset.checkpoint`` runs it twice unless it is also cached) and
    stores it columnar and compressed.
    """
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/skein-{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out._skein_folder = folder
    return out


def release(df: DataFrame) -> None:
    """Delete the folder behind a :func:`materialize` result that no plan needs any more
    (e.g. the previous round of an iteration once the next one is written), so iterative
    jobs do not leave one copy of their working set per round in the shared folder."""
    folder = getattr(df, "_skein_folder", None)
    if not folder:
        return
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when ``df`` has fewer partitions than the session's
    default parallelism (e.g. one unsplittable file feeding an iterative model fit).

    Inputs that already arrive split wider (the normal case on a cluster) are left as
    they are, so this never adds a shuffle there.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df
