"""Operator 13: exact deduplication by a stream with disk-backed keyed state.

1. :func:`ingest` streams documents into state keyed by the digest of the normalised text (white
   space removed). The state lives in RocksDB on the executors' disks, is checkpointed to the shared
   folder after every batch and never expires: no watermark, so a copy is found however late it
   comes. A key holds the document that stays (most code points, then smallest doc_id, then
   place): its stable identifier and the locator of its content (file and row), and how many
   documents it has had. It never holds a text.
2. :func:`held` reads the state as a table. A run can be continued: streaming more files into the
   same folder goes on from the state that is there, and a lost executor's state is loaded again
   from the folder.
3. A document whose digest the state holds with more than one document is a hit. Hits are settled by
   bytes: the content at the locator is fetched and compared in full. Documents that differ from
   the holder in spite of the digest are grouped anew by their texts, so a collision of
   digests can neither merge nor lose anything.

Defined results: a null text is empty, and equal to texts of white space alone; rows that repeat a
doc_id are documents of their own, of which one at most is kept; a null doc_id ranks after all
others of its length; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skein.session import ensure_checkpoint_dir, materialize

SPACE = r"[\x20\x09-\x0D]+"
# Settings of the stream alone; the session's own are put back once it runs.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # batches add to a log of changes instead of writing whole files of the state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # the memory of all state partitions of an executor together
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # a partition's files take the disk that they fill, not megabytes ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

STATE_BYTES = 256 << 20  # bytes of documents' files for each partition of the state, which holds a tenth of them


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, "")


def digest_of(text: Column, bits: int = 256) -> Column:
    """The first ``bits`` (a multiple of 8) of the SHA-256 of the normalised text."""
    return F.unhex(F.substring(F.sha2(normalised(text), 256), 1, bits // 4))


def _rows(docs: DataFrame, bits: int) -> DataFrame:
    """(doc_id, n_chars, digest, file, row) of documents read from Parquet files."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("n_chars"),
        digest_of(F.col("text"), bits).alias("digest"), _place())


def _place() -> Column:
    """Where a row's content is: the file and the row in it."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("at")


def _rank() -> Column:
    """Greater for the document that stays; ``neg_id`` is null for an unknown id, and null is least."""
    return F.struct("n_chars", (-F.col("doc_id")).alias("neg_id"), "at")


def _as_glob(path: str) -> str:
    """A pattern that fits ``path`` alone: file streams take a folder or a pattern, not one file."""
    return f"{path[:-1]}[{path[-1]}]"


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """The Parquet file or folder ``path`` as a stream of documents."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(_as_glob(path.rstrip("/")))


def state_partitions(docs: DataFrame) -> int:
    """By the bytes of the files: a state partition opens files of its own in every batch, so there are
    as many as the cluster has cores, or as the bytes need."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // STATE_BYTES))


def ingest(docs: DataFrame, folder: str, bits: int = 256, partitions: int | None = None) -> None:
    """Stream all documents there are now into the keyed state of ``folder``, and stop. Called again,
    it takes only the files that have come since. The first call fixes the state's ``partitions``."""
    state = _rows(docs, bits).groupBy("digest").agg(F.max(_rank()).alias("stays"), F.count("*").alias("group_size"))
    wanted = _STATE | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    with _settings(docs.sparkSession, wanted):
        query = (state.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", folder).trigger(availableNow=True).start())
        query.awaitTermination()


def held(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, keep_id, keep_chars, at, group_size): the state as it is after the last batch."""
    with _settings(spark, _STATE):
        state = spark.read.format("statestore").load(folder)
    stays = F.col("value.max")
    return state.select(F.col("key.digest").alias("digest"), (-stays["neg_id"]).alias("keep_id"),
                        stays["n_chars"].alias("keep_chars"), stays["at"].alias("keep_at"),
                        F.col("value.count").alias("group_size"))


def settle(docs: DataFrame, state: DataFrame, bits: int = 256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs`` (Parquet files that the
    state has taken in)."""
    spark = docs.sparkSession
    rows = materialize(_rows(docs, bits).join(state, "digest", "left"), "digests")
    several = rows.where(F.col("group_size") > 1)

    # hits: the full bytes of each against those that the locator of its key leads to
    texts = docs.select(_place(), normalised(F.col("text")).alias("text"))
    places = lambda df: df.select("at").distinct()
    content = (texts.join(several.where(F.col("at") == F.col("keep_at")).select("at", "digest"), "at")
               .select("digest", F.col("text").alias("held_text")))
    hits = several.where(F.col("at") != F.col("keep_at")).select("at", "digest")
    compared = texts.join(hits, "at").join(content, "digest", "left")
    differ = materialize(compared.where(~F.col("text").eqNullSafe(F.col("held_text"))).select("digest").distinct(),
                         "collisions")
    same = "doc_id", "keep_id", "group_size", (F.col("at") == F.col("keep_at")).alias("kept")
    if not differ.limit(1).count():
        sha = F.lower(F.hex("digest")) if bits == 256 else None
        if sha is not None:
            return rows.select(*same, sha.alias("text_sha256"))
        shas = docs.select(_place(), F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
        return rows.join(shas, "at").select(*same, "text_sha256")

    # digests that stand for different texts: their documents are grouped by the texts themselves
    torn = rows.join(differ, "digest", "left_semi").select("doc_id", "n_chars", "at")
    of = torn.join(texts.join(places(torn), "at", "left_semi"), "at")
    groups = of.groupBy("text").agg(F.max(_rank()).alias("stays"), F.count("*").alias("group_size"))
    regrouped = (of.join(groups, "text")
                 .select("doc_id", (-F.col("stays.neg_id")).alias("keep_id"), "group_size",
                         (F.col("at") == F.col("stays.at")).alias("kept"), F.sha2("text", 256).alias("text_sha256")))
    whole = rows.join(differ, "digest", "left_anti")
    shas = docs.select(_place(), F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
    return whole.join(shas, "at").select(*same, "text_sha256").unionByName(regrouped)


def deduplicate(spark: SparkSession, path: str, folder: str | None = None, files_per_batch: int | None = None,
                bits: int = 256) -> DataFrame:
    """Stream ``path`` (Parquet) into the state of ``folder`` (a new one by default) and settle every
    row that it now holds."""
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/dedup-{uuid.uuid4().hex}"
    docs = spark.read.parquet(path)
    ingest(stream(spark, path, docs.schema, files_per_batch), folder, bits, state_partitions(docs))
    return settle(docs, held(spark, folder), bits)
