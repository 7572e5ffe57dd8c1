"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.session import default_parallelism, materialize

# Word hashes kept per Python worker; beyond it the table is started anew (it is only a cache).
WORD_CACHE = 200_000


# Texts handed to a Python worker at a time. Spark's own 10,000 rows are meant for short rows.
TEXTS_PER_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string): only the columns an operator works on, whatever else ``docs``
    carries, so extra columns can't clash. A null text becomes empty. Sessions that leave the Arrow
    batch size at its default get one that suits texts."""
    conf = docs.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 10_000:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it inside
    higher-order functions (Catalyst would otherwise inline it into their lambdas)."""
    return F.transform(F.array(value), body)[0]


def with_positions(df: DataFrame, order: Sequence[Column], name: str = "pos",
                   label: str = "pos") -> DataFrame:
    """``df``, written once, with each row's 0-based global position in ``order``.

    Range partitioning, a sort inside each range, and one offset per range (as many rows as
    there are ranges), so no task sees more than its range and nothing grows on the driver.
    """
    n = default_parallelism(df.sparkSession)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("__mid", F.monotonically_increasing_id()))
    stored = (materialize(ranged, label)
              .withColumn("__range", F.shiftright("__mid", 33))
              .withColumn("__at", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))))
    return (stored.join(F.broadcast(range_offsets(stored, "__range", F.count("*"))), "__range")
            .withColumn(name, F.col("__offset") + F.col("__at"))
            .drop("__mid", "__range", "__at", "__offset"))


def range_offsets(df: DataFrame, part: str, total: Column) -> DataFrame:
    """(part, __offset): the sum of ``total`` over all smaller parts; one row per part, where
    parts are partitions of a written table and so bounded by their number."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return (df.groupBy(part).agg(total.alias("__total"))
            .select(part, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset")))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and broadcasts of plans that are no longer referenced: its cleaner
    acts when the driver collects garbage, which otherwise may be long after a step has been written. The
    driver's heap shrinks with it, where many small steps would let it grow to its limit."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return what a task of this Python worker has freed to the system: idle workers stay beside the
    executor, and those of an earlier stage otherwise keep their largest size."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


class WordHashes(dict):
    """word bytes -> 64-bit hash, filled as words turn up."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > WORD_CACHE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


# Fixed odd multipliers mod 2**64 (splitmix64's increment and its two mixers).
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def shingle_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles; a shorter, non-empty sequence
    is one shingle."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    width = min(n, size)
    acc = np.full(max(1, n - size + 1), np.uint64(width), dtype=np.uint64)
    for j in range(width):
        acc = acc * GOLDEN + word_hashes[j:j + len(acc)]
    return np.unique(mix64(acc))


def digest_rank(*parts) -> str:
    """A stable hash for choosing bounded samples on the driver."""
    return hashlib.sha256("\x1f".join(map(str, parts)).encode()).hexdigest()
