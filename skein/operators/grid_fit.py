"""k-means and Gaussian mixtures for a whole grid at once: one scan of the points an iteration.

All models of a grid advance together. A scan turns each batch of points into sufficient statistics
of every model, tasks add theirs up, and Spark adds the tasks'; what reaches the driver is a few
numbers per cluster, whatever the number of points. Every row's contribution is rounded to a fixed
point and added as a whole number, so sums, and with them centres, mixtures and scores, are the same
for any partitioning, order or repeated task. Starting rows are chosen by a hash of the point.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.session import materialize

TERM_BITS = 40  # of a row's usual largest contribution
BATCH_ROWS = 10_000
TOLERANCE = 1e-4  # centres that move less than this have converged
LIKELIHOOD_TOLERANCE = 0.01
INIT_STEPS = 2  # rounds of oversampling that choose k-means|| candidates
SAMPLES = 5  # starting rows of each mixture component
RIDGE = 1e-9  # added to covariances' diagonals, as a share of the largest squared value


@dataclass(frozen=True)
class Points:
    """Rows written once as (x array<double>, turn long); ``scale`` is the fixed point's unit."""
    rows: DataFrame
    scale: float
    largest: float
    n: int

    @staticmethod
    def of(df: DataFrame, features: str, seed: int) -> "Points":
        x = vector_to_array(F.col(features))
        rows = materialize(df.where(F.col(features).isNotNull()).select(x.alias("x"))
                           .withColumn("turn", F.xxhash64(F.lit(seed), "x")), "points")
        top = rows.agg(F.max(F.array_max(F.transform("x", F.abs))).alias("m"), F.count("*").alias("n")).first()
        largest = max(1.0, top.m or 0.0)
        return Points(rows, 2.0 ** (TERM_BITS - math.ceil(math.log2(4 * largest * largest))), largest, top.n)

    def first(self, n: int, salt: int = 0) -> np.ndarray:
        """The ``n`` distinct points with the smallest hashes: a sample that no layout changes."""
        picked = (self.rows.select("x").distinct().orderBy(F.xxhash64(F.lit(salt), "x"), "x").limit(n).collect())
        return np.array([r.x for r in picked], dtype=np.float64)

    def sums(self, statistics: Callable[[np.ndarray], dict[int, np.ndarray]], columns: Sequence[str] = ("x",)) -> dict[int, np.ndarray]:
        """Per key, the sum over all rows of the terms that ``statistics`` has for a batch; one job."""
        scale = self.scale

        def add(batches):
            total: dict[int, list[int]] = {}
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    part = batch.slice(at, BATCH_ROWS)
                    x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    for key, terms in statistics(x).items():
                        whole = np.rint(terms * scale)
                        # machine integers where a batch's sum fits, else Python's
                        fits = np.abs(whole).max(initial=0.0) * len(whole) < 2.0 ** 62
                        whole = whole.astype(np.int64 if fits else object).sum(axis=0).ravel().tolist()
                        total[key] = [a + b for a, b in zip(total.get(key, [0] * len(whole)), whole)]
            rows = [(key, slot, Decimal(int(v))) for key, values in total.items() for slot, v in enumerate(values)]
            yield pa.RecordBatch.from_pydict({"key": pa.array([r[0] for r in rows], pa.int32()),
                                              "slot": pa.array([r[1] for r in rows], pa.int32()),
                                              "value": pa.array([r[2] for r in rows], pa.decimal128(38, 0))})

        found = (self.rows.select(*columns).mapInArrow(add, "key int, slot int, value decimal(38,0)")
                 .groupBy("key", "slot").agg(F.sum("value").alias("value")).collect())
        out: dict[int, dict[int, float]] = {}
        for r in found:
            out.setdefault(r.key, {})[r.slot] = float(Decimal(r.value) / Decimal(scale))
        return {key: np.array([v[i] for i in range(len(v))]) for key, v in out.items()}


def _square_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Term by term, so that a row's distances do not depend on the rows beside it."""
    out = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        out += (x[:, j, None] - centres[None, :, j]) ** 2
    return out


def _per_cluster(nearest: np.ndarray, k: int, terms: np.ndarray) -> np.ndarray:
    """(rows, k, terms): each row's terms at its cluster, zeros elsewhere."""
    return (nearest[:, None] == np.arange(k)[None, :])[:, :, None] * terms[:, None, :]


@dataclass(frozen=True)
class KMeansFit:
    centres: np.ndarray
    features: str = "features"
    prediction: str = "prediction"

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 (the name that MLlib's model has)
        return list(self.centres)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with each row's nearest centre, the lowest number on ties."""
        x = vector_to_array(F.col(self.features))
        far = lambda c: sum(((F.get(x, F.lit(j)) - F.lit(float(v))) ** 2 for j, v in enumerate(c)), F.lit(0.0))
        each = F.array(*[F.struct(far(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(self.centres)])
        return df.withColumn(self.prediction, F.array_min(each)["i"])


def _weighted_start(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k of the (few) weighted candidates by k-means++ and some local steps."""
    draw = np.random.default_rng(seed)
    chosen = [int(draw.choice(len(candidates), p=weights / weights.sum()))]
    while len(chosen) < min(k, len(candidates)):
        d = _square_distances(candidates, candidates[chosen]).min(axis=1) * weights
        if d.sum() <= 0:
            break
        chosen.append(int(draw.choice(len(candidates), p=d / d.sum())))
    centres = candidates[chosen].copy()
    for _ in range(30):
        near = _square_distances(candidates, centres).argmin(axis=1)
        for c in range(len(centres)):
            if weights[near == c].sum() > 0:
                centres[c] = np.average(candidates[near == c], axis=0, weights=weights[near == c])
    return centres


def _parallel_starts(points: Points, ks: Sequence[int], seed: int) -> dict[int, np.ndarray]:
    """k-means|| for several k together: rounds that take a point with a probability in proportion to its
    squared distance from the candidates so far, then a weighted start among the candidates."""
    found = {k: points.first(1, seed) for k in ks}
    for step in range(INIT_STEPS):
        cost = points.sums(lambda x: {k: _square_distances(x, c).min(axis=1)[:, None] for k, c in found.items()})
        x = F.col("x")
        draw = (F.xxhash64(F.lit(seed + step), "x").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
        for k in ks:
            # about 2 k rows of each round come to the driver
            near = F.array_min(F.array(*[sum(((F.get(x, F.lit(j)) - F.lit(float(v))) ** 2 for j, v in enumerate(c)), F.lit(0.0))
                                         for c in found[k]]))
            total = float(cost[k][0])
            if total <= 0:
                continue
            more = points.rows.where(draw < near * F.lit(2.0 * k / total)).select("x").distinct().collect()
            if more:
                found[k] = np.unique(np.vstack([found[k], [r.x for r in more]]), axis=0)
    weights = points.sums(lambda x: {k: _per_cluster(_square_distances(x, c).argmin(axis=1), len(c), np.ones((len(x), 1)))
                                     .reshape(len(x), -1) for k, c in found.items()})
    return {k: _weighted_start(found[k], np.maximum(weights[k], 1e-9), k, seed) for k in ks}


def kmeans_grid(df: DataFrame, ks: Sequence[int], max_iters: Sequence[int], init_modes: Sequence[str],
                seed: int, features: str = "features") -> list[tuple[int, int, str, KMeansFit, float]]:
    """(k, max_iter, init mode, fit, silhouette) for every grid point. One run of each (k, mode) serves
    all iteration limits: its centres are kept where a limit is reached or it has converged."""
    points = Points.of(df, features, seed)
    starts: dict[tuple[int, str], np.ndarray] = {}
    for mode in init_modes:
        if mode == "k-means||":
            starts |= {(k, mode): c for k, c in _parallel_starts(points, ks, seed).items()}
        elif mode == "random":
            starts |= {(k, mode): points.first(k, seed + 1) for k in ks}
        else:
            raise ValueError(f"unknown init mode {mode}")
    names, at = list(starts), {i: c for i, c in enumerate(starts.values())}
    kept: dict[tuple[int, int], np.ndarray] = {}
    running = set(at)
    for step in range(1, max(max_iters) + 1):
        def terms(x: np.ndarray) -> dict[int, np.ndarray]:
            ones = np.hstack([np.ones((len(x), 1)), x])
            return {i: _per_cluster(_square_distances(x, at[i]).argmin(axis=1), len(at[i]), ones).reshape(len(x), -1)
                    for i in running}
        for i, total in (points.sums(terms) if running else {}).items():
            total = total.reshape(len(at[i]), -1)
            some = total[:, 0] > 0.5
            moved = at[i].copy()
            moved[some] = total[some, 1:] / total[some, :1]
            if ((moved - at[i]) ** 2).sum(axis=1).max() <= TOLERANCE ** 2:
                running.discard(i)
            at[i] = moved
        kept |= {(i, step): at[i] for i in at if step in max_iters}
    grid = list(itertools.product(ks, max_iters, init_modes))
    models = [kept[names.index((k, mode)), limit] for k, limit, mode in grid]
    scores = silhouettes(points, models)
    return [(k, limit, mode, KMeansFit(c, features), s) for (k, limit, mode), c, s in zip(grid, models, scores)]


def silhouettes(points: Points, models: Sequence[np.ndarray]) -> list[float]:
    """Mean silhouette (squared Euclidean) of each set of centres; two scans for all of them."""
    different = {c.tobytes(): c for c in models}
    centres = list(different.values())
    def moments(x):  # noqa: E306
        ones = np.hstack([np.ones((len(x), 1)), (x * x).sum(axis=1, keepdims=True), x])
        return {i: _per_cluster(_square_distances(x, c).argmin(axis=1), len(c), ones).reshape(len(x), -1) for i, c in enumerate(centres)}
    held = {i: v.reshape(len(centres[i]), -1) for i, v in points.sums(moments).items()}

    def coefficients(x):
        out = {}
        for i, c in enumerate(centres):
            n, sq, s = held[i][:, 0], held[i][:, 1], held[i][:, 2:]
            some = n > 0.5
            near = _square_distances(x, c).argmin(axis=1)
            dot = np.zeros((len(x), len(c)))
            for j in range(x.shape[1]):
                dot += x[:, j, None] * s[None, :, j]
            mean = (x * x).sum(axis=1)[:, None] + (sq / np.maximum(n, 1))[None, :] - 2 * dot / np.maximum(n, 1)[None, :]
            own = n[near]
            a = mean[np.arange(len(x)), near] * own / np.maximum(own - 1, 1)
            mean[:, ~some] = np.inf
            mean[np.arange(len(x)), near] = np.inf
            b = mean.min(axis=1)
            top = np.maximum(a, b)
            value = np.where((own <= 1.5) | (top <= 0) | ~np.isfinite(top), 0.0, (b - a) / np.where(top > 0, top, 1))
            out[i] = np.where(np.isfinite(value), value, 0.0)[:, None]
        return out

    total = points.sums(coefficients)
    score = {key: float(total[i][0] / points.n) if i in total else 0.0 for i, key in enumerate(different)}
    return [score[c.tobytes()] for c in models]


@dataclass(frozen=True)
class MixtureFit:
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float
    features: str = "features"
    prediction: str = "prediction"

    def log_terms(self, x: np.ndarray) -> np.ndarray:
        """log(weight * density) of each row and component, term by term."""
        out = np.zeros((len(x), len(self.weights)))
        for c, (w, mean, cov) in enumerate(zip(self.weights, self.means, self.covariances)):
            inverse, off = np.linalg.inv(cov), x - mean
            form = np.zeros(len(x))
            for i, j in itertools.product(range(len(mean)), repeat=2):
                form += off[:, i] * inverse[i, j] * off[:, j]
            out[:, c] = math.log(max(w, 1e-300)) - 0.5 * (form + np.linalg.slogdet(cov)[1] + len(mean) * math.log(2 * math.pi))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (array<double>, by component) and the likeliest component."""
        x = vector_to_array(F.col(self.features))

        def log_term(c: int) -> Column:
            mean, inverse = self.means[c], np.linalg.inv(self.covariances[c])
            off = [F.get(x, F.lit(i)) - F.lit(float(v)) for i, v in enumerate(mean)]
            form = sum((off[i] * off[j] * F.lit(float(inverse[i, j])) for i, j in itertools.product(range(len(off)), repeat=2)), F.lit(0.0))
            fixed = math.log(max(self.weights[c], 1e-300)) - 0.5 * (np.linalg.slogdet(self.covariances[c])[1] + len(mean) * math.log(2 * math.pi))
            return F.lit(float(fixed)) - 0.5 * form

        logs = F.array(*[log_term(c) for c in range(len(self.weights))])
        shares = F.transform(F.array(logs), lambda a: F.transform(a, lambda v: F.exp(v - F.array_max(a))))[0]
        p = F.transform(F.array(shares), lambda a: F.transform(a, lambda v: v / F.aggregate(a, F.lit(0.0), lambda s, y: s + y)))[0]
        return (df.withColumn("probability", p)
                .withColumn(self.prediction, (F.array_position("probability", F.array_max("probability")) - 1).cast("int")))


def mixture_grid(df: DataFrame, ks: Sequence[int], seed: int, max_iter: int = 100, features: str = "features") -> list[MixtureFit]:
    """A full-covariance Gaussian mixture for each k by expectation maximisation, all k in one scan an
    iteration, until the log-likelihood gains less than LIKELIHOOD_TOLERANCE or ``max_iter``."""
    points = Points.of(df, features, seed)
    if not points.n:
        raise ValueError("a mixture needs at least one point")
    ridge = RIDGE * points.largest ** 2
    fits: dict[int, MixtureFit] = {}
    for i, k in enumerate(ks):
        rows = points.first(k * SAMPLES, seed + 1)
        groups = [g if len(g) else rows[:1] for g in np.array_split(rows, k)]
        spread = np.diag(rows.var(axis=0) + ridge)
        fits[i] = MixtureFit(np.full(k, 1 / k), np.array([g.mean(axis=0) for g in groups]),
                             np.array([np.diag(g.var(axis=0)) + ridge * np.eye(rows.shape[1]) if len(g) > 1 and (g.var(axis=0) > ridge).all()
                                       else spread for g in groups]), -math.inf, features)
    running = set(fits)
    unit = 1.0 / points.scale
    for step in range(max_iter + 1):
        def terms(x: np.ndarray) -> dict[int, np.ndarray]:
            d, out = x.shape[1], {}
            pairs = [x[:, i] * x[:, j] for i in range(d) for j in range(i, d)]
            base = np.column_stack([np.ones(len(x)), x, *pairs])
            for i in running:
                logs = fits[i].log_terms(x)
                top = logs.max(axis=1, keepdims=True)
                shares = np.exp(logs - top)
                whole = shares.sum(axis=1, keepdims=True)
                each = (shares / whole)[:, :, None] * base[:, None, :]
                out[i] = np.hstack([top + np.log(whole), each.reshape(len(x), -1)])
            return out
        for i, total in points.sums(terms).items():
            fit, d = fits[i], fits[i].means.shape[1]
            likelihood, parts = float(total[0]), total[1:].reshape(len(fit.weights), -1)
            done = abs(likelihood - fit.log_likelihood) < LIKELIHOOD_TOLERANCE or step == max_iter
            if done:
                running.discard(i)
                fits[i] = MixtureFit(fit.weights, fit.means, fit.covariances, likelihood, features)
                continue
            weights, means, covariances = parts[:, 0] / points.n, fit.means.copy(), fit.covariances.copy()
            for c, row in enumerate(parts):
                if row[0] <= points.n * unit:
                    continue  # no share of any row: it stays where it is
                means[c] = row[1:d + 1] / row[0]
                second, at = np.zeros((d, d)), d + 1
                for a in range(d):
                    for b in range(a, d):
                        second[a, b] = second[b, a] = row[at] / row[0]
                        at += 1
                cov = second - np.outer(means[c], means[c]) + ridge * np.eye(d)
                if np.linalg.eigvalsh(cov)[0] > 0:
                    covariances[c] = cov
            fits[i] = MixtureFit(weights, means, covariances, likelihood, features)
        if not running:
            break
    return [fits[i] for i in range(len(ks))]
