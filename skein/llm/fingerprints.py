"""Operator 6: document fingerprints from closed syncmers.

A text is read as words (runs of non-space, long ones in pieces of 16). Of every k consecutive
words, those k-mers are chosen whose smallest inner s-word hash is at the first or the last place.
The choice depends on the k words alone, so an edit elsewhere never moves it: the chosen k-mers are
anchors that two texts share wherever they share words. The fingerprint lists all anchors of the
text, however long it is, as marks: the anchor's hash and its distance from the anchor before. Two
fingerprints are matched by position: a mark is shared where the same anchor follows at the same
distance, wherever the passage stands. Their likeness is the shared part of the distinct marks
and can be had from the two fingerprint strings alone. Column functions only.

Defined results: null and empty (or all-space) texts have the empty fingerprint, and two of them
are alike by 1; a text of fewer than k words, or one of whose k-mers none is chosen, is one anchor;
equal texts have equal fingerprints; rows that repeat both doc_id and text stand at one place in the
order and each have its results; texts of one doc_id follow each other by a hash; a null doc_id is a document after all others; a single
document is its own successor; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import id_and_text, let, with_positions

K, S = 3, 1
HASH_BITS, FARTHEST = 28, 15  # of a mark: its hash, and 4 bits for the distance
WORD = r"\S{1,16}"


def _mer(h: Column, i: Column, size: int) -> Column:
    return F.get(h, i) if size == 1 else F.xxhash64(*[F.get(h, i + j) for j in range(size)])


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<at int, hash bigint>>: closed syncmers in text order; ``at`` counts words."""
    none = F.array().cast("array<struct<at:int,hash:bigint>>")

    def choose(h):
        n = F.size(h)

        def closed(inner):
            window = k - s + 1
            chosen = F.filter(F.sequence(F.lit(0), n - k), lambda i: F.least(
                F.get(inner, i), F.get(inner, i + window - 1))
                == F.least(*[F.get(inner, i + j) for j in range(window)]))
            return F.transform(chosen, lambda i: F.struct(i.alias("at"), _mer(h, i, k).alias("hash")))

        inner = h if s == 1 else F.transform(F.sequence(F.lit(0), n - s), lambda i: _mer(h, i, s))
        whole = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(h).alias("hash")))
        found = F.when(n < k, none).otherwise(closed(h) if s == 1 else let(inner, closed))
        return let(found, lambda c: F.when((n > 0) & (F.size(c) == 0), whole).otherwise(c))

    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    return let(F.transform(words, lambda w: F.xxhash64(w)), choose)


def marks(text: Column, k: int = K, s: int = S) -> Column:
    """array<int>: the mark of every anchor in text order, repeats included: HASH_BITS of its hash, then
    the words since the anchor before (0 for the first, FARTHEST at most)."""
    def of(found):
        def mark(x, i):
            gap = F.when(i == 0, F.lit(0)).otherwise(F.least(F.lit(FARTHEST), x["at"] - F.get(found, i - 1)["at"]))
            return F.shiftleft(F.shiftright(x["hash"], 64 - HASH_BITS).cast("int"), 4).bitwiseOR(gap)
        return F.transform(found, mark)
    return let(anchors(text, k, s), of)


def as_text(found: Column) -> Column:
    """The fingerprint string: 8 hexadecimal digits a mark."""
    return F.array_join(F.transform(found, lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(
        F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the shared part of two fingerprints' distinct :func:`marks` (Jaccard)."""
    return let(F.struct(F.array_distinct(a).alias("a"), F.array_distinct(b).alias("b")), lambda d: let(
        F.size(F.array_intersect(d["a"], d["b"])), lambda both: F.when(
            F.size(d["a"]) + F.size(d["b"]) == 0, F.lit(1.0)).otherwise(both / (F.size(d["a"]) + F.size(d["b"]) - both))))


def positional_matches(a: Column, b: Column) -> Column:
    """array<struct<at_a, at_b>>: places of the anchors that two texts' :func:`anchors` share (the
    first of each hash in ``b``), for aligning them."""
    places = lambda b: F.map_from_entries(F.transform(F.array_distinct(F.transform(
        b, lambda x: x["hash"])), lambda h: F.struct(h, F.filter(b, lambda y: y["hash"] == h)[0]["at"])))
    return let(places(b), lambda m: F.filter(F.transform(a, lambda x: F.struct(
        x["at"].alias("at_a"), F.try_element_at(m, x["hash"]).alias("at_b"))), lambda p: p["at_b"].isNotNull()))


def compare_with_next(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """(doc_id, n_chars, edited_text, marks, edited_marks, near_edited, near_next) for every row.

    A document's edited text has its last third replaced by as much of the next document, in
    descending order of doc_id and round the end. Only each document's id, length and hash are
    ordered; the next document is told how much is wanted of it and sends that, with its distinct marks."""
    rows = id_and_text(docs).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    narrow = (rows.select("doc_id", "tie", F.length("text").alias("n_chars"))
              .groupBy("doc_id", "tie").agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("copies")))
    placed = with_positions(narrow, order, label="order")
    total = placed.agg(F.count("*").alias("n"), F.max("copies").alias("copies")).first()
    if total.copies and total.copies > 1:
        rows = rows.dropDuplicates(["doc_id", "tie"])
    # each document's predecessor wants a third of its own length from it
    wants = placed.select(F.expr(f"pmod(pos + 1, {max(1, total.n)}L)").alias("pos"),
                          F.col("doc_id").alias("for_doc"), F.col("tie").alias("for_tie"),
                          F.floor(F.col("n_chars") / 3).cast("int").alias("take"))
    links = placed.select("pos", "copies", F.col("doc_id").alias("of_doc"), F.col("tie").alias("of_tie")).join(wants, "pos").drop("pos")
    full = (rows.join(links, (F.col("tie") == F.col("of_tie")) & F.col("doc_id").eqNullSafe(F.col("of_doc")))
            .select("doc_id", "tie", "text", "copies", "for_doc", "for_tie", "take"))
    sent = full.select("for_doc", "for_tie", F.substring("text", F.lit(1), F.col("take")).alias("head"),
                       F.array_distinct(marks(F.col("text"), k, s)).alias("next_marks"))
    own = full.select("doc_id", "tie", "text", "copies")
    n = F.length("text")
    both = (own.join(sent, (F.col("tie") == F.col("for_tie")) & F.col("doc_id").eqNullSafe(F.col("for_doc")))
            .select("doc_id", n.cast("long").alias("n_chars"), "copies",
                    F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), "head").alias("edited_text"),
                    marks(F.col("text"), k, s).alias("marks"), "next_marks"))
    done = both.withColumn("edited_marks", marks(F.col("edited_text"), k, s))
    done = done.select("doc_id", "n_chars", "edited_text", "marks", "edited_marks", "copies",
                       likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
                       likeness(F.col("marks"), F.col("next_marks")).alias("near_next"))
    if total.copies and total.copies > 1:
        done = done.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy")
    return done.drop("copies")
