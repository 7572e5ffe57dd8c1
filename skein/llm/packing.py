"""Operator 3: best-fit packing with large-item matching.

Lengths are at most ``capacity``, so the corpus is described by its count of pieces per length:
at most ``capacity`` numbers, whatever its size. The plan is made on these counts, whole runs of
equal bins at a time: pieces above a third of the capacity are matched greedily, longest first,
with the longest partner that fits, at most two to a bin; smaller pieces, longest first, go to the
fullest bin they fit. Spark then ranks every piece within its length (counted inside the task that
made it, plus one offset per task and length) and the rank picks its place from the plan.

Defined results: null and empty texts are one piece holding the end id; texts longer than the
capacity are cut; rows that repeat a doc_id are packed each; an empty table gives no rows. Other
columns of ``docs`` are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.bpe import by_chars, encoder
from skein.llm.common import give_back, id_and_text
from skein.session import materialize

CAPACITY, END_ID = 4096, 1


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids): every whole text encoded, ``end_id`` appended, and
    texts above ``capacity`` ids cut; ids are little-endian unsigned 32-bit integers."""
    def cut(batches):
        enc = encoder(tokenizer, False)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()))
            for part in by_chars(rows, lambda r: r[1]):
                out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
                for (doc_id, _), tokens in zip(part, enc.encode([t for _, t in part])):
                    tokens = np.concatenate([tokens, end])
                    for k, at in enumerate(range(0, len(tokens), capacity)):
                        ids = tokens[at:at + capacity]
                        for name, v in zip(out, (doc_id, k, at, len(ids), ids.tobytes())):
                            out[name].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids", pa.binary())]))
        enc.forget()
        give_back()

    return id_and_text(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


class Plan:
    """Places of pieces by (length, rank within that length)."""

    def __init__(self, counts: Iterable[tuple[int, int]], capacity: int):
        self.capacity = capacity
        self.left = {int(n): int(c) for n, c in counts if c}
        self.used = dict.fromkeys(self.left, 0)  # ranks given out so far
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.bins = 0  # sequences opened so far
        # gap -> runs of bins (first sequence, number) with that much room left
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self._large()
        self._small()

    def _put(self, length: int, per_bin: int, first: int, bins: int, at: int, n: int) -> None:
        """The next ``n`` pieces of ``length`` go to ``bins`` bins from ``first``, ``per_bin`` each."""
        self.rows.append((length, self.used[length], n, per_bin, first, at))
        self.used[length] += n
        self.left[length] -= n

    def _gap(self, gap: int, first: int, bins: int) -> None:
        if gap and bins:
            if gap not in self.gaps:
                insort(self.open, gap)
                self.gaps[gap] = []
            self.gaps[gap].append((first, bins))

    def _large(self) -> None:
        self.open: list[int] = []
        large = sorted(n for n in self.left if 3 * n > self.capacity)
        for length in large[::-1]:
            while self.left[length]:
                n = self.left[length]
                # the longest partner that still fits
                k = bisect_left(large, self.capacity - length + 1) - 1
                while k >= 0 and not self.left[large[k]]:
                    large.pop(k)
                    k -= 1
                first = self.bins
                if k < 0:
                    self._put(length, 1, first, n, 0, n)
                    self.bins += n
                    self._gap(self.capacity - length, first, n)
                    break
                partner = large[k]
                if partner >= length:  # two of its own kind
                    pairs, odd = divmod(n, 2)
                    if pairs:
                        self._put(length, 2, first, pairs, 0, 2 * pairs)
                        self.bins += pairs
                        self._gap(self.capacity - 2 * length, first, pairs)
                    if not odd:
                        break
                    k = bisect_left(large, length) - 1
                    while k >= 0 and not self.left[large[k]]:
                        large.pop(k)
                        k -= 1
                    first, n = self.bins, 1
                    if k < 0:
                        self._put(length, 1, first, 1, 0, 1)
                        self.bins += 1
                        self._gap(self.capacity - length, first, 1)
                        break
                    partner = large[k]
                both = min(n, self.left[partner])
                self._put(length, 1, first, both, 0, both)
                self._put(partner, 1, first, both, length, both)
                self.bins += both
                self._gap(self.capacity - length - partner, first, both)

    def _small(self) -> None:
        for length in sorted((n for n in self.left if self.left[n]), reverse=True):
            while n := self.left[length]:
                k = bisect_left(self.open, length)
                if k == len(self.open):  # no room anywhere: new bins, filled with this length
                    per, first = self.capacity // length, self.bins
                    bins = n // per
                    if bins:
                        self._put(length, per, first, bins, 0, bins * per)
                        self._gap(self.capacity - per * length, first, bins)
                    if n % per:
                        self._put(length, n % per, first + bins, 1, 0, n % per)
                        self._gap(self.capacity - (n % per) * length, first + bins, 1)
                    self.bins += bins + bool(n % per)
                    continue
                gap = self.open[k]
                first, bins = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap]
                    self.open.pop(k)
                per, at = gap // length, self.capacity - gap
                full = min(bins, n // per)
                if full:
                    self._put(length, per, first, full, at, full * per)
                    self._gap(gap - per * length, first, full)
                rest = n - full * per
                if full < bins:
                    if 0 < rest < per:
                        self._put(length, rest, first + full, 1, at, rest)
                        self._gap(gap - rest * length, first + full, 1)
                        full += 1
                    self._gap(gap, first + full, bins - full)

    def table(self) -> dict[int, np.ndarray]:
        """length -> rows (first rank, number, per bin, first sequence, offset) in rank order."""
        by: dict[int, list] = {}
        for length, *row in self.rows:
            by.setdefault(length, []).append(row)
        return {n: np.array(rows, dtype=np.int64) for n, rows in by.items()}


def lower_bound(counts: Iterable[tuple[int, int]], capacity: int) -> int:
    """No packing has fewer sequences than this."""
    counts = list(counts)
    return max(-(-sum(n * c for n, c in counts) // capacity),
               sum(c for n, c in counts if 2 * n > capacity))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any table with ``length`` from 1 to ``capacity``) with ``sequence_id`` and
    ``offset``: gapless in every sequence. Rows are written once, with their rank in their task."""
    spark = pieces.sparkSession
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset", "__task", "__rank")]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields
                      if f.name in keep)

    def rank(batches):
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            if len(lengths) and (lengths.min() < 1 or lengths.max() > capacity):
                raise ValueError(f"a length outside 1 to {capacity}")
            order = np.argsort(lengths, kind="stable")
            runs = lengths[order]
            first = np.searchsorted(runs, runs, side="left")
            ranks = np.empty(len(lengths), dtype=np.int64)
            ranks[order] = seen[runs] + np.arange(len(runs)) - first
            seen += np.bincount(runs, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(lengths), task, dtype=np.int32)), pa.array(ranks)],
                names=[*keep, "__task", "__rank"])

    stored = materialize(pieces.select(*keep).mapInArrow(rank, f"{types}, __task int, __rank long"), "pack")
    per_task = stored.groupBy("length", "__task").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    # at most ``capacity`` rows come to the driver, however large the corpus
    counts = [(r["length"], r["n"]) for r in per_task.groupBy("length").agg(F.sum("__n").alias("n")).collect()]
    places = Plan(counts, capacity).table()
    shared = spark.sparkContext.broadcast(places)

    def place(batches):
        plan = shared.value
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("__rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                rows = plan[int(length)]
                row = rows[np.searchsorted(rows[:, 0], ranks[at], side="right") - 1]
                nth = ranks[at] - row[:, 0]
                sequence[at] = row[:, 3] + nth // row[:, 2]
                offset[at] = row[:, 4] + nth % row[:, 2] * length
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(sequence), pa.array(offset)],
                names=[*keep, "sequence_id", "offset"])

    # the offsets (a row per task and length) are hashed; pieces, which may carry their ids, are not sorted
    ranked = (stored.join(offsets.hint("shuffle_hash"), ["length", "__task"])
              .withColumn("__rank", F.col("__rank") + F.col("__first")).select(*keep, "__rank"))
    return ranked.mapInArrow(place, f"{types}, sequence_id long, offset long")
