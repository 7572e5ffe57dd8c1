"""Operator 7: near-duplicate documents by MinHash bands, odd sketches and exact confirmation.

1. One pass makes each document's shingle set into its size, a 128-bit class (equal sets are one
   class, of which one representative goes on), MinHash samples cut into bands, an odd sketch: a
   parity bitmap of the samples, in which the samples two sets share cancel out, and a parity
   bitmap of the whole set.
2. Documents that agree in a band share a bucket. In a bucket every member is paired with one
   centre, the least in one of ORDERS orders, so pairs grow with the members and not with their
   square. Buckets of the same documents and order share a centre, so that a member of a large group
   meets some ORDERS centres and not one a band.
3. The XOR population count of two whole sets' bitmaps is never above the number of shingles in which
   they differ, so a pair whose count is above what the threshold allows is no link, and no link goes.
   That is sharp for sets of up to a few thousand shingles. The count of two odd sketches
   estimates how many samples differ, at any size; pairs clearly below the threshold go. The rest
   are confirmed on full shingle sets and linked; links make components.
4. A bucket whose members are by now one component is done. In the others the star step is repeated
   with new centres: each member meets the centre of another component than its own, so the pairs
   of a round grow with the members, until a round links nothing new or ROUNDS are over.
5. Members of buckets that are still open get an odd sketch of many more samples, and those of
   different components are compared by it and the bitmap, in blocks; only pairs at the threshold
   or just below it leave the comparison and are confirmed. After that no pair that shares a bucket is unjudged.

Two documents at the threshold miss each other in all bands with a probability of at most MISS.

Defined results: null, empty and wordless texts have an empty set and link with nothing; fewer
words than a shingle are one shingle; equal sets are always linked; rows are judged one by one, so
unlike texts of one doc_id are not linked by it; a null doc_id takes part and its component is the
smallest known doc_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import WordHashes, free_shuffles, give_back, id_and_text, mix64, shingle_hashes
from skein.operators.graph import Graph, components
from skein.session import materialize

SHINGLE_WORDS, THRESHOLD = 5, 0.8
BAND_ROWS, MISS = 5, 1e-6
# Odd sketches, coarse and fine: (samples, bits). None: as many samples as the bands have. Pairs are
# judged exactly unless their sketches differ by DEVIATIONS more than those at the threshold do.
COARSE, FINE = (None, 512), (1024, 2048)
DEVIATIONS = 6
WHOLE_BITS = 1024  # of the parity bitmap of a whole set
ORDERS = 4  # of uids, from which buckets take their centres
ROUNDS = 2  # of stars with new centres in buckets that hold several components
BLOCK_MEMBERS = 512  # members of a bucket that one task compares with as many others


def bands_for(threshold: float, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - threshold ** rows))


def sketch_spread(similarity: float, samples: int, bits: int) -> tuple[float, float]:
    """Mean and standard deviation of the XOR population count of two sets' odd sketches: a sample
    differs with 1 - similarity, and each that does flips a random bit of either sketch."""
    def parity(flipped: int) -> float:  # expected product of the signs of so many bits
        return (similarity + (1 - similarity) * (1 - 2 * flipped / bits) ** 2) ** samples

    one, two = parity(1), parity(2)
    return bits / 2 * (1 - one), math.sqrt(max(0.0, bits + bits * (bits - 1) * two - (bits * one) ** 2)) / 2


def sketch_cut(threshold: float, samples: int, bits: int) -> int:
    """Largest XOR population count kept: DEVIATIONS above what is expected at the threshold."""
    mean, deviation = sketch_spread(threshold, samples, bits)
    return math.ceil(mean + DEVIATIONS * deviation)


def parity(bit: np.ndarray, bits: int) -> np.ndarray:
    """Bitmap, as signed 64-bit numbers, of the bits that occur an odd number of times."""
    odd = np.bincount(bit, minlength=bits).astype(np.uint8) & np.uint8(1)
    return np.packbits(odd).view(np.int64)


def whole_parity(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of a whole set: the shingles two sets share cancel out in the XOR, so that its
    population count is at most the size of their symmetric difference."""
    return parity((shingles % np.uint64(WHOLE_BITS)).astype(np.int64), WHOLE_BITS)


class MinHash:
    """Samples of a shingle set, and their fold into a parity bitmap."""

    def __init__(self, samples: int, bits: int):
        draw = np.random.default_rng(samples)
        self.a = draw.integers(1, 1 << 32, samples, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.b = draw.integers(0, 1 << 32, samples, dtype=np.uint64).astype(np.uint32)
        self.place = mix64(np.arange(1, samples + 1, dtype=np.uint64))
        self.bits = bits

    def samples(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        step = max(1, 120_000 // len(self.a))
        for i in range(0, len(x), step):
            part = self.a[:, None] * x[None, i:i + step] + self.b[:, None]
            np.minimum(low, part.min(axis=1), out=low)
        return low.astype(np.uint64)

    def odd(self, low: np.ndarray) -> np.ndarray:
        return parity((mix64(low + self.place) % np.uint64(self.bits)).astype(np.int64), self.bits)


def set_class(shingles: np.ndarray) -> list[int]:
    """The set's 128-bit hash as two signed 64-bit numbers."""
    c = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return np.array([c >> 64, c & ((1 << 64) - 1)], dtype=np.uint64).view(np.int64).tolist()


class Signer:
    """Shingle set -> (128-bit class, band keys, coarse odd sketch, parity bitmap of the whole set)."""

    def __init__(self, bands: int, rows: int = BAND_ROWS):
        draw = np.random.default_rng(bands)
        self.bands, self.rows, self.hashes = bands, rows, MinHash(bands * rows, COARSE[1])
        self.weights = draw.integers(1, 1 << 63, rows, dtype=np.uint64) | np.uint64(1)
        self.salt = mix64(np.arange(1, bands + 1, dtype=np.uint64))

    def sign(self, shingles: np.ndarray):
        low = self.hashes.samples(shingles)
        keys = mix64((low.reshape(self.bands, self.rows) * self.weights).sum(axis=1, dtype=np.uint64) ^ self.salt)
        return (*set_class(shingles), keys.view(np.int64), self.hashes.odd(low), whole_parity(shingles))


def text_key(text: Column) -> Column:
    """What tells the texts of rows of one doc_id, or without any, apart."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def signatures(docs: DataFrame, bands: int, size: int = SHINGLE_WORDS) -> DataFrame:
    """(uid, doc_id, text_key, n_shingles, c1, c2, bands, sketch, whole) for every row; written once, so
    that ``uid`` stays the same."""
    def sign(batches):
        known, signer, uid = WordHashes(), Signer(bands), TaskContext.get().partitionId() << 40
        for batch in batches:
            out = {k: [] for k in ("uid", "doc_id", "text_key", "n_shingles", "c1", "c2", "bands", "sketch", "whole")}
            for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(),
                                         batch.column("text").cast(pa.binary()).to_pylist()):
                found = shingle_hashes(known.of(text.lower().split()), size)
                signed = signer.sign(found) if len(found) else (None,) * 5
                for name, v in zip(out, (uid, doc_id, key, len(found), *signed)):
                    out[name].append(v)
                uid += 1
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("uid", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.binary()), ("n_shingles", pa.int64()),
                ("c1", pa.int64()), ("c2", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())),
                ("whole", pa.list_(pa.int64()))]))
        known.clear()
        give_back()

    rows = id_and_text(docs).withColumn("text_key", text_key(F.col("text")))
    return materialize(rows.mapInArrow(
        sign, "uid long, doc_id long, text_key binary, n_shingles long, c1 long, c2 long, bands array<long>, sketch array<long>, "
        "whole array<long>"), "sign")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int = SHINGLE_WORDS,
              with_fine: bool = False) -> DataFrame:
    """(uid, shingles, n_shingles, fine) of ``wanted(uid, doc_id, c1, c2)``: whole sets, read again
    from the texts, and their fine odd sketches."""
    def sets(batches):
        known, fine = WordHashes(), MinHash(FINE[0], FINE[1])
        for batch in batches:
            out = {k: [] for k in ("doc_id", "c1", "c2", "shingles", "fine")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").cast(pa.binary()).to_pylist()):
                found = shingle_hashes(known.of(text.lower().split()), size)
                sketch = fine.odd(fine.samples(found)) if with_fine and len(found) else None
                for name, v in zip(out, (doc_id, *set_class(found), found.view(np.int64), sketch)):
                    out[name].append(v)
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("shingles", many), ("fine", many)]))
        known.clear()
        give_back()

    w = wanted.select("uid", F.col("doc_id").alias("w_doc"), F.col("c1").alias("w1"), F.col("c2").alias("w2"))
    ids = w.select("w_doc").distinct()
    rows = id_and_text(docs)
    rows = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("w_doc")), "left_semi")
    found = rows.mapInArrow(sets, "doc_id long, c1 long, c2 long, shingles array<long>, fine array<long>")
    matched = found.join(w, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("c1") == F.col("w1"))
                         & (F.col("c2") == F.col("w2"))).dropDuplicates(["uid"])
    return materialize(matched.select("uid", "shingles", F.size("shingles").cast("long").alias("n_shingles"), "fine"),
                       "sets")


def _differ(a: Column, b: Column, bits: int) -> Column:
    """The XOR population count of two bitmaps."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(bits // 64)), F.lit(0))


def _may_link(threshold: float, samples: int, bits: int) -> Column:
    """Of rows with (n, s, w)_a and (n, s, w)_b: sizes within the threshold of each other, no more bits of
    the whole sets' XOR than shingles in which linked sets may differ, and the sketches' XOR within the cut."""
    n_a, n_b, per_cent = F.col("n_a"), F.col("n_b"), round(threshold * 100)
    return ((F.least(n_a, n_b) >= F.greatest(n_a, n_b) * threshold)
            & (_differ(F.col("w_a"), F.col("w_b"), WHOLE_BITS) * (100 + per_cent) <= (n_a + n_b) * (100 - per_cent))
            & (_differ(F.col("s_a"), F.col("s_b"), bits) <= sketch_cut(threshold, samples, bits)))


def _confirm(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(src, dst) of the ``pairs(a, b)`` whose full sets are similar enough; written once."""
    one = sets.select(F.col("uid").alias("a"), F.col("shingles").alias("in_a"))
    two = sets.select(F.col("uid").alias("b"), F.col("shingles").alias("in_b"))
    shared = F.size(F.array_intersect("in_a", "in_b")).cast("long")
    per_cent = round(threshold * 100)
    linked = (pairs.join(two, "b").join(one, "a")
              .select("a", "b", shared.alias("n"), (F.size("in_a") + F.size("in_b")).cast("long").alias("both"))
              .where(100 * F.col("n") >= per_cent * (F.col("both") - F.col("n")))
              .select(F.col("a").alias("src"), F.col("b").alias("dst")))
    found = materialize(linked, "links")
    free_shuffles(pairs.sparkSession)
    return found


def _order(turn: int) -> Column:
    """A number to XOR uids with, which puts them into one of ORDERS orders of this turn; the bucket's key
    picks which."""
    return F.xxhash64(F.pmod("key", F.lit(ORDERS)), F.lit(turn))


def _centres(keys: DataFrame) -> DataFrame:
    """(key, centre, n) of the buckets of ``keys(uid, key)`` with several members."""
    order = _order(0)  # a plain number, so that the least uid and the count need no sort
    return (keys.groupBy("key").agg(F.min(F.col("uid").bitwiseXOR(order)).alias("least"), F.count("*").alias("n"))
            .where("n > 1").select("key", F.col("least").bitwiseXOR(order).alias("centre"), "n"))


def _next_stars(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each member of the open buckets ``rows(key, uid, component)`` with a centre of
    another component: the least member of the bucket in its order of this turn, or, for
    members of that one's component, the least of all others."""
    order = _order(turn + 1)
    heads = rows.groupBy("key", "component").agg(F.min(F.col("uid").bitwiseXOR(order)).alias("head"))
    one = heads.groupBy("key").agg(F.min("head").alias("one"), F.min_by("component", "head").alias("of_one"))
    two = (heads.join(one, "key").where("component <> of_one").groupBy("key").agg(F.min("head").alias("two")))
    centre = F.when(F.col("component") == F.col("of_one"), F.col("two")).otherwise(F.col("one")).bitwiseXOR(order)
    met = rows.join(one.join(two, "key"), "key").select("uid", centre.alias("centre"))
    return met.select(F.least("uid", "centre").alias("a"), F.greatest("uid", "centre").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE_WORDS) -> DataFrame:
    """(uid, doc_id, text_key, n_shingles, component_id, kept, first) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links; ``kept`` marks the document of
    that id and ``first`` one row of each component (the two differ where a doc_id is repeated)."""
    bands = bands_for(threshold)
    signed = signatures(docs, bands, size)
    classes = signed.where(F.col("n_shingles") > 0).groupBy("c1", "c2").agg(F.min("uid").alias("rep"))
    # one row per document with the representative of its class; rows without a set stand alone
    member = materialize(signed.select("uid", "doc_id", "text_key", "n_shingles", "c1", "c2")
                         .join(classes, ["c1", "c2"], "left")
                         .select("uid", "doc_id", "text_key", "n_shingles", F.coalesce("rep", "uid").alias("rep")), "member")
    reps = signed.join(classes.select(F.col("rep").alias("uid")), "uid", "left_semi")
    reps = materialize(reps, "reps")
    known = reps.select("uid", "n_shingles", "sketch", "whole")

    keys = reps.select("uid", F.explode("bands").alias("key"))
    buckets = materialize(keys.join(_centres(keys), "key"), "buckets")
    free_shuffles(docs.sparkSession)

    def judged(pairs: DataFrame) -> DataFrame:
        a, b = (known.select(F.col("uid").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"),
                             F.col("whole").alias(f"w_{x}")) for x in "ab")
        return (pairs.join(a, "a").join(b, "b").where(_may_link(threshold, bands * BAND_ROWS, *COARSE[1:]))
                .select("a", "b"))

    def sets_of(uids: DataFrame, with_fine: bool) -> DataFrame:
        return full_sets(docs, uids.distinct().join(reps.select("uid", "doc_id", "c1", "c2"), "uid"), size, with_fine)

    stars = (buckets.where(F.col("uid") != F.col("centre"))
             .select(F.least("uid", "centre").alias("a"), F.greatest("uid", "centre").alias("b")).distinct())
    star_pairs = materialize(judged(stars), "pairs")
    links = _confirm(star_pairs, sets_of(star_pairs.select(F.explode(F.array("a", "b")).alias("uid")), False), threshold)

    def labels(edges: DataFrame) -> DataFrame:
        ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
        found = materialize(components(Graph(ends, edges)), "labels")
        free_shuffles(docs.sparkSession)
        return found

    label = labels(links)

    def still_open(label: DataFrame, rows: DataFrame) -> DataFrame:
        """(key, uid, component, n) of the buckets in ``rows`` that hold several components."""
        of = rows.select("key", "uid").join(label.withColumnRenamed("id", "uid"), "uid", "left").select(
            "key", "uid", F.coalesce("component", "uid").alias("component"))
        several = (of.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
                   .where("lo <> hi").select("key", "n"))
        return materialize(of.join(several, "key"), "open")

    open_rows = still_open(label, buckets)
    open_sets = sets_of(open_rows.select("uid"), True)
    for turn in range(ROUNDS):
        pairs = materialize(judged(_next_stars(open_rows, turn)).join(star_pairs, ["a", "b"], "left_anti"), "pairs")
        more = _confirm(pairs, open_sets, threshold)
        if not more.limit(1).count():
            break
        star_pairs, links = star_pairs.unionByName(pairs), links.unionByName(more)
        label = labels(links)
        open_rows = still_open(label, open_rows)

    # members are dealt over blocks; every two blocks of a bucket meet in a task of their own
    blocks = F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int")
    finer = open_sets.select("uid", "n_shingles", F.col("fine").alias("sketch")).join(reps.select("uid", "bands", "whole"), "uid")
    dealt = open_rows.join(finer, "uid").withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    def side(name: str, x: Column, y: Column) -> DataFrame:  # noqa: E306
        meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        rows = dealt.select("key", "uid", "component", "n_shingles", "sketch", "whole", "bands", "block", meets)
        return rows.select("key", x.alias("x"), y.alias("y"), F.col("uid").alias(name),
                           F.col("component").alias(f"c_{name}"), F.col("n_shingles").alias(f"n_{name}"),
                           F.col("sketch").alias(f"s_{name}"), F.col("whole").alias(f"w_{name}"),
                           F.col("bands").alias(f"k_{name}"))

    left, right = side("a", F.col("block"), F.col("other")), side("b", F.col("other"), F.col("block"))
    rest = (left.join(right, ["key", "x", "y"])
            .where((F.col("c_a") != F.col("c_b")) & (F.col("a") < F.col("b")) & _may_link(threshold, *FINE)
                # of the buckets that two documents share, one reports them
                & (F.col("key") == F.array_min(F.array_intersect("k_a", "k_b"))))
            .select("a", "b"))
    rest = materialize(rest.join(star_pairs, ["a", "b"], "left_anti"), "rest")
    if rest.limit(1).count():
        more = _confirm(rest, open_sets, threshold)
        if more.limit(1).count():
            label = labels(links.unionByName(more))

    of_row = (member.join(label.select(F.col("id").alias("rep"), "component"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    least = of_row.groupBy("component").agg(F.min("doc_id").alias("component_id"),
                                            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid"))["uid"].alias("one"))
    return (of_row.join(least, "component")
            .select("uid", "doc_id", "text_key", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                    (F.col("uid") == F.col("one")).alias("first")))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, or any one where no id is
    known. Rows are told apart by doc_id and text; those without words all stay. Of rows that
    repeat both, the one with the least hash of all columns stays."""
    found = materialize(near_duplicates(docs, threshold, size), "near")
    rows = (found.where("n_shingles > 0").groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"))
            .agg(F.max("first").alias("stays"), F.count("*").alias("n")))
    rows = materialize(rows, "near-rows")
    keyed = docs.withColumn("__key", text_key(F.col("text")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__text"))
    kept = keyed.join(rows.where("NOT stays"), same, "left_anti")
    repeated = rows.where("stays AND n > 1")
    if repeated.limit(1).count():
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        one = (keyed.join(repeated, same, "left_semi").groupBy(F.col("doc_id"), F.col("__key"))
               .agg(F.min_by(row, F.xxhash64(row)).alias("row")).select("row.*"))
        kept = kept.join(repeated, same, "left_anti").select(*docs.columns).unionByName(one)
    return kept.select(*docs.columns)
