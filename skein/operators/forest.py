"""Random forests for a whole search from one table of counts.

A forest sees a feature only through its bins (``maxBins`` at most, as in MLlib), so rows that share their
bins, label and fold are the same row to it. One pass counts these cells; the fits of all folds and grid
points, and their scores, are worked out from the counts, whose number depends on bins, folds and
classes and not on rows. A row's weight in a tree's bag is a Poisson draw of mean ``subsamplingRate``; the
draws of m equal rows add up to one draw of mean m times that, so a bag needs one draw a cell. Draws are
seeded by seed, tree and fold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.session import spread

MAX_CELLS = 1 << 18  # combinations of bins that the driver may hold; beyond it MLlib fits from the rows
SPLIT_ROWS = 100_000  # rows whose quantiles give the bins (MLlib takes 10,000)
MAX_CLASSES = 100  # as in MLlib
PURE = 2.0 ** -52  # impurity below which a node is not split

_COUNTS = "fold int, label int, cell long, n long"


@dataclass(frozen=True)
class Node:
    """A node's class weights in its tree's bag; an inner one sends ``feature <= split`` to the left."""
    weights: np.ndarray
    feature: int = -1
    bin: int = -1  # the last bin on the left
    left: "Node | None" = None
    right: "Node | None" = None

    @property
    def leaf(self) -> bool:
        return self.left is None


@dataclass(frozen=True)
class ForestModel:
    """Trees over the bins that ``thresholds`` cut. A tree's vote for a class is its share of the leaf."""
    trees: list[Node]
    thresholds: list[np.ndarray]
    classes: int
    features: str = "features"

    def votes(self, bins: np.ndarray) -> np.ndarray:
        """Sum of the trees' votes (rows x classes) for rows of bin numbers."""
        out = np.zeros((len(bins), self.classes))

        def descend(node: Node, at: np.ndarray) -> None:
            if node.leaf:
                total = node.weights.sum()
                out[at] += node.weights / total if total else 0.0
            elif len(at):
                left = bins[at, node.feature] <= node.bin
                descend(node.left, at[left])
                descend(node.right, at[~left])

        for tree in self.trees:
            descend(tree, np.arange(len(bins)))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (array<double>, by class) and the class of most votes, the lowest on ties."""
        x = vector_to_array(F.col(self.features))

        def votes(node: Node) -> Column:
            if node.leaf:
                total = node.weights.sum() or 1.0
                return F.array(*[F.lit(float(w / total)) for w in node.weights])
            cut = F.lit(float(self.thresholds[node.feature][node.bin]))
            return F.when(F.get(x, F.lit(node.feature)) <= cut, votes(node.left)).otherwise(votes(node.right))

        each = F.array(*[votes(t) for t in self.trees])
        sums = F.aggregate(each, F.array(*[F.lit(0.0)] * self.classes), lambda s, v: F.zip_with(s, v, lambda a, b: a + b))
        p = F.transform(F.array(sums), lambda a: F.transform(a, lambda v: v / F.aggregate(a, F.lit(0.0), lambda s, y: s + y)))[0]
        return (df.withColumn("probability", p)
                .withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double")))


def _thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cuts between neighbouring values: all of them, or those nearest to equal shares
    (the rule of MLlib's continuous features)."""
    distinct, counts = np.unique(values, return_counts=True)
    between = (distinct[:-1] + distinct[1:]) / 2
    if len(between) <= bins - 1:
        return between
    stride, cuts, upto = len(values) / bins, [], np.cumsum(counts)
    target = stride
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            cuts.append(between[i - 1])
            target += stride
    return np.array(cuts)


def _per_node(strategy: str, features: int, trees: int) -> int:
    """How many features a node may choose from."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3),
             "log2": max(1, math.ceil(math.log2(features)))}
    if strategy in named:
        return named[strategy]
    if strategy.isdigit():
        return min(int(strategy), features)
    return math.ceil(float(strategy) * features)


def _impurity(weights: np.ndarray, kind: str) -> np.ndarray:
    total = weights.sum(axis=-1, keepdims=True)
    share = np.divide(weights, total, out=np.zeros(weights.shape), where=total > 0)
    if kind == "gini":
        return np.where(total[..., 0] > 0, 1 - (share ** 2).sum(axis=-1), 0.0)
    return -(share * np.log2(share, out=np.zeros(weights.shape), where=share > 0)).sum(axis=-1)


def _grow(weights: np.ndarray, bins: np.ndarray, sizes: Sequence[int], rf: RandomForestClassifier, draw: np.random.Generator) -> Node:
    """One tree from the cells' class ``weights`` (cells x classes) and ``bins`` (cells x features)."""
    features, kind, depth = bins.shape[1], rf.getImpurity(), rf.getMaxDepth()
    some = _per_node(rf.getFeatureSubsetStrategy(), features, rf.getNumTrees())
    fewest = max(rf.getMinInstancesPerNode(), rf.getMinWeightFractionPerNode() * weights.sum())

    def best(at: np.ndarray, own: float, total: float) -> tuple[float, int, int]:
        found = (0.0, -1, -1)
        for f in np.sort(draw.choice(features, some, replace=False)):
            sums = np.stack([np.bincount(bins[at, f], weights=w, minlength=sizes[f]) for w in weights[at].T], axis=1)
            left = np.cumsum(sums, axis=0)[:-1]
            right = sums.sum(axis=0) - left
            n_left, n_right = left.sum(axis=1), right.sum(axis=1)
            gain = own - n_left / total * _impurity(left, kind) - n_right / total * _impurity(right, kind)
            gain[(n_left < fewest) | (n_right < fewest) | (gain < rf.getMinInfoGain())] = -1.0
            if len(gain) and gain.max() > found[0]:
                found = (float(gain.max()), int(f), int(gain.argmax()))
        return found

    def grow(at: np.ndarray, level: int) -> Node:
        here = weights[at].sum(axis=0)
        own, total = float(_impurity(here, kind)), float(here.sum())
        if level == depth or own < PURE:
            return Node(here)
        gain, f, cut = best(at, own, total)
        if gain <= 0:
            return Node(here)
        to_left = bins[at, f] <= cut
        left, right = grow(at[to_left], level + 1), grow(at[~to_left], level + 1)
        if left.leaf and right.leaf and left.weights.argmax() == right.weights.argmax():
            return Node(here)  # a split that decides nothing
        return Node(here, f, cut, left, right)

    return grow(np.arange(len(bins)), 0)


def fit_counts(counts: np.ndarray, bins: np.ndarray, thresholds: list[np.ndarray], rf: RandomForestClassifier,
               salt: int = 0) -> ForestModel:
    """A forest with the parameters of ``rf`` from ``counts`` (cells x classes) of rows with the given ``bins``."""
    rate, trees, seed = rf.getSubsamplingRate(), rf.getNumTrees(), rf.getSeed() & (2 ** 64 - 1)
    grown = []
    for t in range(trees):
        draw = np.random.default_rng([seed, t, salt])
        if rf.getBootstrap() and not (trees == 1 and rate == 1.0):
            bag = draw.poisson(counts * rate)
        else:
            bag = draw.binomial(counts, rate)
        grown.append(_grow(bag.astype(np.float64), bins, [len(c) + 1 for c in thresholds], rf, draw))
    return ForestModel(grown, thresholds, counts.shape[1], rf.getFeaturesCol())


@dataclass(frozen=True)
class ForestSearch:
    """Counts of ``data``'s rows by fold, cell and label; folds are numbered from 0, None stands for no fold."""
    counts: np.ndarray  # folds x cells x classes
    bins: np.ndarray  # cells x features, over the cuts of all fits
    cuts: list[np.ndarray]  # of these bins
    thresholds: dict[tuple[int | None, int], list[np.ndarray]]  # by fold left out and maxBins

    def _bins(self, thresholds: list[np.ndarray]) -> np.ndarray:
        """The cells' bins over the thresholds of one fit, which are some of the cuts."""
        top = [np.append(c, np.inf) for c in self.cuts]
        return np.stack([np.searchsorted(t, top[f][self.bins[:, f]]) for f, t in enumerate(thresholds)], axis=1)

    def fit(self, rf: RandomForestClassifier, without: int | None = None) -> ForestModel:
        """The forest of all rows but those of fold ``without``."""
        kept = np.array([f != without for f in range(len(self.counts))])
        counts = self.counts[kept].sum(axis=0)
        if not counts.sum():
            raise ValueError("a forest needs at least one row")
        thresholds = self.thresholds[without, rf.getMaxBins()]
        return fit_counts(counts, self._bins(thresholds), thresholds, rf, 0 if without is None else without + 1)

    def confusion(self, model: ForestModel, fold: int | None = None) -> list[tuple[float, float, int]]:
        """(label, prediction, rows) of one fold, or of all rows: a prediction is the same all over a cell."""
        counts = self.counts.sum(axis=0) if fold is None else self.counts[fold]
        predicted = model.votes(self._bins(model.thresholds)).argmax(axis=1)
        return [(float(c), float(p), int(n)) for p in np.unique(predicted)
                for c, n in enumerate(counts[predicted == p].sum(axis=0)) if n]


def forest_search(data: DataFrame, rf: RandomForestClassifier, grid: Sequence[dict], folds: int, label: str = "label") -> ForestSearch | None:
    """The counts for fits of ``rf`` at all ``grid`` points, leaving out each ``fold`` of ``data`` and none.

    None where the counts could be too many (MAX_CELLS) or ``rf`` asks for weights, thresholds or
    categorical features. The bins of a fit are the quantiles of its own rows, taken from SPLIT_ROWS
    of all rows (exact if there are no more)."""
    features = rf.getFeaturesCol()
    attributes = data.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    plain = not (rf.isDefined(rf.weightCol) or rf.isDefined(rf.thresholds) or {"nominal", "binary"} & set(attributes))
    n = data.count() if plain and rf.getLabelCol() == label else 0
    if not n:
        return None
    rows = data.select(F.col("fold"), F.col(label).cast("double").alias("label"), vector_to_array(F.col(features)).alias("x"))
    width = rows.select(F.size("x")).first()[0]
    if not width or width < 1 or 2 ** width > MAX_CELLS:
        return None
    some = (rows if n <= SPLIT_ROWS else rows.sample(SPLIT_ROWS / n, rf.getSeed() & (2 ** 63 - 1))).select("fold", "x").toArrow()
    fold, x = some["fold"].to_numpy(), _matrix(some["x"].combine_chunks(), width)
    thresholds = {(f, b): [_thresholds(c, b) for c in x[np.full(len(x), True) if f is None else fold != f].T]
                  for f in (None, *range(folds)) for b in {rf.copy(p).getMaxBins() for p in grid}}
    cuts = [np.unique(np.concatenate([t[i] for t in thresholds.values()])) for i in range(width)]
    sizes = [len(c) + 1 for c in cuts]
    if math.prod(sizes) > MAX_CELLS:
        return None

    def count(batches):
        found = np.zeros((0, 4), dtype=np.int64)
        for batch in batches:
            values = _matrix(batch.column("x"), width)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            good = (labels >= 0) & (labels < MAX_CLASSES) & (labels == np.floor(labels))
            if not good.all():
                raise ValueError(f"labels must be whole numbers from 0 to {MAX_CLASSES - 1}, not {labels[~good][0]}")
            cell = np.ravel_multi_index([np.searchsorted(c, values[:, i]) for i, c in enumerate(cuts)], sizes)
            key = (batch.column("fold").to_numpy(zero_copy_only=False) * MAX_CLASSES + labels).astype(np.int64) * MAX_CELLS + cell
            keys, counts = np.unique(key, return_counts=True)
            found = _summed(np.concatenate([found[:, 0], keys]), np.concatenate([found[:, 1], counts]))
        keys = found[:, 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys // (MAX_CELLS * MAX_CLASSES), pa.int32()), pa.array(keys // MAX_CELLS % MAX_CLASSES, pa.int32()),
             pa.array(keys % MAX_CELLS), pa.array(found[:, 1])], names=["fold", "label", "cell", "n"])

    got = (spread(rows).mapInArrow(count, _COUNTS).groupBy("fold", "label", "cell").agg(F.sum("n").alias("n"))).toArrow()
    cells, cell = np.unique(got["cell"].to_numpy(), return_inverse=True)
    labels = got["label"].to_numpy()
    counts = np.zeros((folds, len(cells), max(2, int(labels.max()) + 1)), dtype=np.int64)
    counts[got["fold"].to_numpy(), cell, labels] = got["n"].to_numpy()
    return ForestSearch(counts, np.stack(np.unravel_index(cells, sizes), axis=1), cuts, thresholds)


def _summed(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(key, sum of its counts), in the order of keys."""
    names, at = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(names), dtype=np.int64)
    np.add.at(sums, at, counts)
    return np.stack([names, sums], axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Feature arrays as rows x ``width``; as in MLlib, a null, NaN or infinite one fails the job."""
    if column.null_count:
        raise ValueError("features must not be null")
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    if not np.isfinite(x).all():
        raise ValueError("features must not be NaN or infinite")
    return x
