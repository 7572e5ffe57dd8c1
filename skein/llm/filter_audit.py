"""Operator 12: what each filter removes in every order of the filters, by a Gray-code subset walk.

1. Each document becomes a mask: one bit for every filter that it fails, whatever the others do.
   Filters are columns; equality with an earlier document is found over the whole table.
2. Documents are counted per part and mask (partial sums in every task), so a part is at most 2^n
   cells of totals, however many documents it has.
3. A part's cells are walked through all subsets of the filters in Gray-code order: one filter is
   switched on or off at a time. Each cell counts how many of the filters that are on it fails; the
   running survivors change by the cells whose counter leaves or reaches zero. The 2^n states are
   stored, and a step of any order is the difference of two of them.

Defined results: a null text is empty, a null ``lang`` is the part ''; a document without a label
is neither good nor toxic, several labels of one doc_id count as one that has all their marks; rows
that repeat a doc_id are documents of their own and do not fail E by each other; a row with a null
doc_id is compared with no other (it neither fails E nor makes another fail it); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import let
from skein.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
LETTERS = "ABCDE"
_TOTALS = ("n", "good", "toxic")
_STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def word_counts(text: Column) -> Column:
    """struct<n, distinct>: the words of a (non-null) text."""
    return let(F.array_remove(F.split(text, SPACE), ""), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct")))


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of a (non-null) text by itself; ``words`` are its :func:`word_counts`."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": words["n"] < 200, "B": 100 * words["distinct"] < 50 * words["n"],
            "C": 100 * capitals > 3 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic) of every document; bit i of ``mask`` is the i-th of LETTERS."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", word_counts(F.col("text")))
    bits = None
    for i, failed in enumerate(text_filters(F.col("text"), F.col("words")).values()):
        bit = F.when(failed, F.lit(1 << i)).otherwise(F.lit(0))
        bits = bit if bits is None else bits + bit
    rows = rows.select("doc_id", "part", bits.alias("bits"), F.unhex(F.sha2("text", 256)).alias("digest"))
    least = (rows.where(F.col("doc_id").isNotNull()).groupBy("digest")
             .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
             .where("least <> most").select("digest", "least"))  # texts that one document has need no join
    # written, so that the join below meets plain shuffles of both sides and Spark can split a hot text
    least = materialize(least, "least")
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           (F.col("quality") == 1).cast("int").alias("good"),
                           (F.col("toxic") == 1).cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    repeat = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return (rows.join(marks, "doc_id", "left").join(least, "digest", "left")
            .select("part", (F.col("bits") + F.when(repeat, F.lit(16)).otherwise(F.lit(0))).alias("mask"),
                    F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))


def cells(found: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): totals of each part's masks."""
    return found.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"),
                                             F.sum("toxic").alias("toxic"))


def walk(mask: np.ndarray, totals: np.ndarray, n_filters: int) -> np.ndarray:
    """Survivors' totals for every subset of the filters that is on: 2^n rows, by subset."""
    states = np.zeros((1 << n_filters, totals.shape[1]), dtype=np.int64)
    active = np.zeros(len(mask), dtype=np.int64)  # filters that are on and the cell fails
    left = totals.sum(axis=0)
    states[0], subset = left, 0
    for i in range(1, 1 << n_filters):
        turned = (i & -i).bit_length() - 1  # the one bit in which consecutive Gray codes differ
        fails = (mask >> turned) & 1 == 1
        subset ^= 1 << turned
        if subset >> turned & 1:
            left = left - totals[fails & (active == 0)].sum(axis=0)
            active += fails
        else:
            active -= fails
            left = left + totals[fails & (active == 0)].sum(axis=0)
        states[subset] = left
    return states


def steps(mask: np.ndarray, totals: np.ndarray, letters: str = LETTERS) -> pd.DataFrame:
    """One row per order of the filters and step, as differences of two states."""
    states = walk(mask, totals, len(letters))
    fails = [int(totals[(mask >> f) & 1 == 1, 0].sum()) for f in range(len(letters))]
    alone = [int(totals[mask == 1 << f, 0].sum()) for f in range(len(letters))]
    rows, removed_by = [], [0] * len(letters)
    for order in permutations(range(len(letters))):
        name, before = "".join(letters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            removed_by[f] += removed
            rows.append((name, step, f, int(states[after][0]), removed, fails[f] - removed, alone[f], good, toxic))
            before = after
    out = pd.DataFrame(rows, columns=["filter_order", "step", "filter", "kept", "removed", "redundant",
                                      "unique_fails", "good_lost", "toxic_lost"])
    out["shapley"] = out["filter"].map(dict(enumerate(removed_by)))
    assert len(out) == factorial(len(letters)) * len(letters)
    return out.drop(columns="filter")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step."""
    def of_part(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        out = steps(cell["mask"].to_numpy(np.int64), cell[list(_TOTALS)].to_numpy(np.int64))
        out.insert(0, "part", key[0])
        return out

    # a group is a part's cells: at most 32 rows
    return cells(masks(docs, labels)).groupBy("part").applyInPandas(of_part, _STEPS)
