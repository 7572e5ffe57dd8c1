"""Operator 10: quality by compression with two dictionaries.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled bad.
A text is cut into chunks; each is compressed with both, and over the whole text the difference of
the two compressed sizes, divided by its bytes, says which kind it resembles. A logistic curve,
fitted on labelled texts that built neither dictionary, turns that into a score from 0 to 1; it
also sees the smaller of the two sizes (a text that compresses too well repeats itself).

Nothing but the text enters a score. Dictionaries and curve are fitted on bounded samples, chosen
by hash among all labelled rows outside the held-out fold; every whole text is scored.

Defined results: null and empty texts have a difference of 0 and get the curve's value there; rows
of ``labels`` without a doc_id or a quality, and documents labelled both ways, teach nothing;
repeated rows are scored each; with a class missing every score is the share of good labels (0.5
without labels); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import id_and_text

FOLDS, HELD_OUT = 5, 0
CUT = 0.3  # at and above it a text is predicted good
# Bounds of what is fitted on: documents per class and 2 KB pieces per class for a dictionary,
# documents for the curve.
DICT_DOCS, DICT_PIECES, DICT_BYTES, CURVE_DOCS = 2000, 4000, 112 * 1024, 6000
CHUNK, LEVEL = 2048, 3
# share of labelled documents that build dictionaries; the others fit the curve
DICT_SHARE_OF_10 = 4


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT


@dataclass(frozen=True)
class Model:
    """``weights``: of the constant and of each standardised feature."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


class Sizes:
    """Compressed sizes of a text under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard
        self.packers = []
        for content in (good, bad):
            shared = zstandard.ZstdCompressionDict(content)
            if content:
                shared.precompute_compress(level=LEVEL)
            self.packers.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=shared, write_content_size=False, write_dict_id=False))

    def features(self, text: str | None) -> tuple[float, ...]:
        data = (text or "").encode()
        if not data:
            return 0.0, 0.0, 0.0
        good = bad = 0
        for i in range(0, len(data), CHUNK):
            part = data[i:i + CHUNK]
            good += len(self.packers[0].compress(part))
            bad += len(self.packers[1].compress(part))
        n = len(data)
        ratio = min(good, bad) / n
        return (bad - good) / n, ratio, ratio * ratio


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic curve by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0, *np.ones(x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + penalty * len(x),
                               x.T @ (y - p) - len(x) * penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(pieces: list[bytes]) -> bytes:
    import zstandard
    size = min(DICT_BYTES, sum(map(len, pieces)) // 8)
    try:
        return zstandard.train_dictionary(size, pieces, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the pieces themselves
        return b"".join(pieces)[:DICT_BYTES]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit dictionaries and curve on the labelled rows outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("top"))
             .where(F.col("quality") == F.col("top")).drop("top"))
    rank = F.xxhash64(F.lit("quality"), "doc_id")
    builds = F.pmod(F.xxhash64(F.lit("role"), "doc_id"), F.lit(10)) < DICT_SHARE_OF_10
    known = known.withColumn("rank", rank).withColumn("builds", builds)
    take = lambda rows, n: rows.orderBy("rank", "doc_id").limit(n)
    chosen = take(known.where(F.col("builds") & (F.col("quality") == 1)), DICT_DOCS)
    chosen = chosen.unionByName(take(known.where(F.col("builds") & (F.col("quality") == 0)), DICT_DOCS))
    chosen = chosen.unionByName(take(known.where(~F.col("builds")), CURVE_DOCS))
    # at most 2 * DICT_DOCS + CURVE_DOCS rows, so the documents need not be shuffled
    texts = id_and_text(docs).join(F.broadcast(chosen), "doc_id")

    whole = F.col("text").cast("binary")
    pieces = (texts.where("builds").select("quality", F.explode(F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.octet_length("text") - 1, F.lit(0)) / CHUNK).cast("int")),
        lambda i: F.substring(whole, i * CHUNK + 1, F.lit(CHUNK)))).alias("piece")))
    of = {}
    for quality in (1, 0):
        found = (pieces.where(F.col("quality") == quality).select("piece").distinct()
                 .orderBy(F.xxhash64("piece"), "piece").limit(DICT_PIECES).collect())
        of[quality] = _dictionary([bytes(r.piece) for r in found if r.piece])
    good, bad = of[1], of[0]

    def measure(batches):
        sizes = Sizes(good, bad)
        for rows in batches:
            got = [sizes.features(t) for t in rows["text"]]
            yield pd.DataFrame({"f": [list(g) for g in got], "quality": rows["quality"]})

    curve = (texts.where(~F.col("builds")).select("text", "quality")
             .mapInPandas(measure, "f array<double>, quality int").collect())  # at most CURVE_DOCS rows of numbers
    x = np.array([r.f for r in curve], dtype=float).reshape(-1, 3)
    y = np.array([r.quality for r in curve], dtype=float)
    if len(set(y.tolist())) < 2 or not good or not bad:
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return Model(good, bad, (0.0,) * 3, (1.0,) * 3, (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    mean, scale = x.mean(axis=0), np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    w = _logistic((x - mean) / scale, y)
    return Model(good, bad, tuple(mean.tolist()), tuple(scale.tolist()), tuple(w.tolist()))


def score(text: Column, model: Model) -> Column:
    """0 to 1 for every text; higher: good likelier."""
    @F.pandas_udf("double")
    def value(batches: pd.Series) -> pd.Series:
        sizes = Sizes(model.good, model.bad)
        x = np.array([sizes.features(t) for t in batches], dtype=float).reshape(-1, 3)
        z = model.weights[0] + ((x - model.mean) / model.scale) @ np.array(model.weights[1:])
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return value(F.coalesce(text.cast("string"), F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    model = fit(docs, labels)
    return (id_and_text(docs).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                                     score(F.col("text"), model).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0)))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``docs`` without the rows predicted bad."""
    model = fit(docs, labels)
    return docs.where(score(F.col("text"), model) >= cut)
