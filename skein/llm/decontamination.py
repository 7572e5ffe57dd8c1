"""Operator 1: benchmark decontamination by size-partitioned MinHash containment search.

A test item is far shorter than the documents that may quote it, so Jaccard similarity says
little; containment (the share of the item's shingles that the document has) does. The MinHash of
the *smaller* set estimates it whatever the document's size: the item's k smallest shingle hashes
are a uniform sample of its shingles, and each is in the document with the probability of the
containment. Items are partitioned by size (powers of two of their shingle counts). Each partition
is searched in its own way: its items' samples grow with their size, the hits that make a
candidate follow from the sample and the threshold (:func:`class_plan`), and documents with fewer
shingles than ``threshold`` times the partition's smallest item skip it. Candidates are verified
with all shingles of both. One pass over the documents serves all partitions and shingle widths.

The main path is DataFrame functions only. Shingles of documents are never shuffled: they meet the
sampled item shingles in the scan (a broadcast whose size is counted first; beyond the limit, a
shuffle join) and only hits move on.

Defined results: null and empty texts (and texts or items without a word) match nothing; an item
shorter than a shingle is one shingle of its whole sequence and is looked for as such; unlike texts
of one item_id are items of their own, of which the best contained is reported; repeated rows of an
item or doc_id count as one; a null id is never reported; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import id_and_text, let
from skein.session import materialize

SHINGLE_WORDS, THRESHOLD = 5, 0.8
# Samples of a size partition's items: whole up to LEAST_SAMPLE shingles, then SAMPLE_STEP more for every
# doubling. An item at the threshold has too few hits with a probability of at most MISS.
LEAST_SAMPLE, SAMPLE_STEP, MISS = 16, 4, 1e-7
LARGEST_CLASS = 40
# Sampled item shingles (16 bytes each) that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

WORDS = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, so that quoting marks and layout don't matter."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def word_shingles(w: Column, size: int) -> Column:
    """64-bit hashes of all ``size``-word shingles of the words ``w``, in order, repeats included."""
    n = F.size(w)
    return F.when(n < size, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))),
                    lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)])))


def shingles(text: Column, size: int) -> Column:
    return let(words(text), lambda w: word_shingles(w, size))


def class_plan(size_class: int, threshold: float) -> tuple[int, int]:
    """(sample, wanted) of the items with more than 2^(size_class - 1) and up to 2^size_class shingles:
    the largest number of hits that an item at ``threshold`` misses with a probability of at most MISS."""
    sample = LEAST_SAMPLE + SAMPLE_STEP * max(0, size_class - LEAST_SAMPLE.bit_length() + 1)
    wanted, below = 0, 0.0
    while wanted < sample:
        below += math.comb(sample, wanted) * threshold ** wanted * (1 - threshold) ** (sample - wanted)
        if below > MISS:
            break
        wanted += 1
    return sample, max(1, wanted)


def item_shingles(items: DataFrame, size: int) -> DataFrame:
    """(item, item_id, width, shingle, n), written once: distinct shingles of each text of an item_id, by a
    number of its own; ``width`` is the words in one, less than ``size`` for shorter texts."""
    rows = materialize(
        items.select(F.col("item_id").cast("long").alias("item_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .where(F.col("item_id").isNotNull()).distinct().withColumn("item", F.monotonically_increasing_id()), "item-rows")
    width = F.least(F.size(words(F.col("text"))), F.lit(size))
    found = (rows.withColumn("width", width).where("width > 0")
             .select("item", "item_id", "width", F.explode(F.coalesce(*[
                 F.when(F.col("width") == w, shingles(F.col("text"), w)) for w in range(1, size + 1)])).alias("shingle")).distinct())
    counts = found.groupBy("item").agg(F.count("*").alias("n"))
    return materialize(found.join(counts, "item"), "items")


def item_samples(all_shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item, width, shingle, size_class, wanted): MinHash sample of each item's shingles by the plan of
    its size partition."""
    plan = [class_plan(c, threshold) for c in range(LARGEST_CLASS + 1)]
    of_class = lambda i: F.get(F.array(*[F.lit(p[i]) for p in plan]), F.col("size_class"))
    place = F.row_number().over(Window.partitionBy("item").orderBy("shingle"))
    ranked = (all_shingles.withColumn("size_class", F.least(F.ceil(F.log2("n")).cast("int"), F.lit(LARGEST_CLASS)))
              .withColumn("place", place).where(F.col("place") <= of_class(0)))
    # a whole sample needs its plan's hits; of an item smaller than it, all shingles are looked up
    whole = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(threshold)).cast("int"))
    return ranked.select("item", "width", "shingle", "size_class",
                         F.when(F.col("n") <= of_class(0), whole).otherwise(of_class(1)).alias("wanted"))


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, item_id, containment, n_shared, n_item): every pair with at least ``threshold`` of
    the shingles of one of the item's texts in the document."""
    known = item_shingles(items, size)
    samples = materialize(item_samples(known, threshold), "item-samples")
    small = samples.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = id_and_text(docs).where(F.col("doc_id").isNotNull())

    # widths below ``size`` are there only for items shorter than a shingle
    widths = sorted(r.width for r in samples.select("width").distinct().collect()) or [size]

    def all_widths(text: Column) -> Column:
        """array<struct<width, shingle, n_doc>> of all widths, from one reading of the words."""
        def of(width: int, w: Column) -> Column:
            return let(word_shingles(w, width), lambda s: F.transform(s, lambda x: F.struct(
                F.lit(width).alias("width"), x.alias("shingle"), F.size(s).alias("n_doc"))))
        return let(words(text), lambda w: F.concat(*[of(width, w) for width in widths]))

    found = rows.select("doc_id", F.explode(all_widths(F.col("text"))).alias("s")).select("doc_id", "s.*")
    hits = (found.join(F.broadcast(samples) if small else samples, ["width", "shingle"])
            # size partitions: a document too small for every item of the class is passed over
            .where(F.col("n_doc") >= F.pow(F.lit(2.0), F.col("size_class") - 1) * threshold)
            .groupBy("doc_id", "item", "width").agg(F.count_distinct("shingle").alias("hits"), F.max("wanted").alias("wanted"))
            .where(F.col("hits") >= F.col("wanted")).select("doc_id", "item", "width"))
    candidates = materialize(hits, "leak-candidates")

    # exact containment of the candidates, with all shingles of both
    theirs = (rows.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
              .select("doc_id", F.explode(all_widths(F.col("text"))).alias("s"))
              .select("doc_id", "s.width", "s.shingle").distinct())
    pairs = (candidates.join(known, ["item", "width"]).join(theirs, ["doc_id", "width", "shingle"])
             .groupBy("doc_id", "item", "item_id").agg(F.count("*").alias("n_shared"), F.max("n").alias("n_item")))
    best = F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_shared", "n_item")).alias("best")
    return (pairs.where(F.col("n_shared") >= F.col("n_item") * F.lit(threshold))
            .groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*"))


def decontaminate(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """``docs`` without the documents that :func:`leaks` reports; rows with a null doc_id go by their
    texts."""
    doc_id, of_text = F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    flagged = leaks(docs, items, **params).select(F.col("doc_id").alias("__leak")).distinct()
    kept = docs.join(flagged, doc_id == F.col("__leak"), "left_anti")
    nulls = docs.where(doc_id.isNull())
    if nulls.limit(1).count():
        theirs = leaks(nulls.select(of_text.alias("doc_id"), "text"), items, **params)
        kept = kept.join(theirs.select(F.col("doc_id").alias("__leak")).distinct(),
                         doc_id.isNull() & (of_text == F.col("__leak")), "left_anti")
    return kept
