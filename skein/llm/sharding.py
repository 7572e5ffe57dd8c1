"""Operator 8: minimax contiguous partition into shards of near equal bytes.

Equal texts form one atomic group. Groups are ordered by a hash of their text, and neighbouring
groups share a slot of a fixed number of hash slots; a slot holds groups whole, so it is atomic too.
The slots' byte sizes are one bounded, ordered array whatever the corpus, and the smallest shard
capacity for which a greedy left-to-right cut needs no more than the wanted shards is found by
binary search on it. Of the cuts within that capacity, a second search takes those whose smallest
shard is largest. Documents then read their shard off the cuts. Column functions only.

With ``slots`` far above the number of shards, a shard differs from the mean by one slot (the mean
divided by thousands) or by what the largest group of copies forces.

Defined results: null and empty texts have size 1 and are one group; ties and repeated rows go
where their text goes, each with a place of its own; an empty table gives no rows; other columns
are ignored. The law is ``bytes``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import id_and_text, with_positions

SHARDS, SLOTS = 16, 1 << 16


def feasible(before: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Cut points (first slot of each shard after the first) of the greedy cut, or None if it
    needs more shards. ``before[i]`` is the size of the first i slots."""
    cuts, at, n = [], 0, len(before) - 1
    for _ in range(shards):
        at = int(np.searchsorted(before, before[at] + capacity, side="right")) - 1
        if at >= n:
            return cuts
        cuts.append(at)
    return None


def minimax_cuts(sizes: np.ndarray, shards: int) -> tuple[int, list[int]]:
    """(smallest feasible capacity, its cut points)."""
    before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    low, high = int(max(sizes.max(initial=0), -(-int(before[-1]) // shards))), int(before[-1])
    while low < high:
        mid = (low + high) // 2
        if feasible(before, mid, shards) is None:
            low = mid + 1
        else:
            high = mid
    return low, even_cuts(before, low, shards)


def even_cuts(before: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Cut points within a feasible ``capacity`` whose smallest shard is as large as can be, so that
    a shard that one large group fills doesn't leave others empty: a second binary search."""
    def ends(floor: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """[k]: the places where k shards of ``floor`` to ``capacity`` bytes can end; and, for every
        place, the first and the last place where the shard that ends there can start."""
        first = np.searchsorted(before, before - capacity, side="left")
        last = np.searchsorted(before, before - floor, side="right") - 1
        last = np.minimum(last, np.arange(len(before)))
        reached = [np.arange(len(before)) == 0]
        for _ in range(shards):
            upto = np.concatenate([[0], np.cumsum(reached[-1])])
            reached.append((last >= first) & (upto[np.maximum(last, first - 1) + 1] > upto[first]))
        return reached, first, last

    low, high = 0, int(before[-1]) // shards
    while low < high:
        mid = (low + high + 1) // 2
        if ends(mid)[0][shards][-1]:
            low = mid
        else:
            high = mid - 1
    reached, first, last = ends(low)
    cuts, at = [], len(before) - 1
    for left in range(shards, 1, -1):  # from the right, each nearest to an equal share of the rest
        starts = first[at] + np.flatnonzero(reached[left - 1][first[at]:last[at] + 1])
        at = int(starts[np.abs((before[at] - before[starts]) * left - before[at]).argmin()])
        cuts.append(at)
    return cuts[::-1]


def assign(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, hash_slot, shard, slot): shard and gapless place of every row."""
    content = F.col("text").cast("binary")
    rows = id_and_text(docs).select(
        "doc_id", (F.octet_length("text").cast("long") + 1).alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.pmod(F.xxhash64("text"), F.lit(slots)).cast("int").alias("hash_slot"))
    # at most ``slots`` rows come to the driver, however large the corpus
    per_slot = rows.groupBy("hash_slot").agg(F.sum("size").alias("bytes"))
    sizes = np.zeros(slots, dtype=np.int64)
    for r in per_slot.collect():
        sizes[r.hash_slot] = r["bytes"]
    _, cuts = minimax_cuts(sizes, shards)
    shard = sum((F.when(F.col("hash_slot") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    order = ["shard", "doc_id", "text_crc32", "size"]
    placed = with_positions(rows.withColumn("shard", shard.cast("int")),
                            [F.col(c).asc_nulls_first() for c in order], label="shards")
    first = placed.groupBy("shard").agg(F.min("pos").alias("__first"))  # one row per shard
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "hash_slot", "shard",
                    (F.col("pos") - F.col("__first")).alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS) -> None:
    """Write ``docs`` as one folder per shard. Large shards are written by several tasks; the
    cuts are those of :func:`assign`."""
    placed = assign(docs, shards, slots).select("hash_slot", "shard").distinct()  # ``slots`` rows at most
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    (docs.withColumn("hash_slot", F.pmod(F.xxhash64(text), F.lit(slots)).cast("int"))
     .join(F.broadcast(placed), "hash_slot").drop("hash_slot")
     .write.partitionBy("shard").parquet(path))
