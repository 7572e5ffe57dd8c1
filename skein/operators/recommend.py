"""Viewing-time recommender: cleaning, item encoding, split, ALS search, top-N lists,
cold-start users and per-segment models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.relational import dense_ids, hash_split, skew_join
from skein.operators.topn import top_items
from skein.session import materialize, release

REQUIRED = ("User_ID", "Stream_ID", "Streamer_Username", "Time_Start", "Time_Stop")


def clean_interactions(views: DataFrame) -> DataFrame:
    """Add ``Duration`` = stop - start, keep rows with Duration > 0 and no null field.

    The subtraction is ``try_subtract``: an int overflow gives null (row dropped) rather
    than failing the job under ANSI mode.
    """
    d = views.withColumn("Duration", F.try_subtract(F.col("Time_Stop"), F.col("Time_Start")))
    return d.where(F.col("Duration") > 0).dropna(subset=list(REQUIRED))


def encode_items(views: DataFrame, key: str = "Stream_ID", out: str = "item") -> DataFrame:
    """Materialised (key, dense int id) mapping ordered by the key (see ``dense_ids``)."""
    return dense_ids(views, key, out)


def ratings(views: DataFrame, mapping: DataFrame, key: str = "Stream_ID",
            repeat: str = "keep") -> DataFrame:
    """(user, item, rating = Duration); ``repeat`` = keep | sum | max for repeated pairs."""
    # a hot stream may hold a large share of all views: split it off (skew_join)
    r = skew_join(views, mapping, key).select(F.col("User_ID").alias("user"), F.col("item"),
                                        F.col("Duration").alias("rating"))
    if repeat == "sum":
        r = r.groupBy("user", "item").agg(F.sum("rating").alias("rating"))
    elif repeat == "max":
        r = r.groupBy("user", "item").agg(F.max("rating").alias("rating"))
    return r


def decode_items(df: DataFrame, mapping: DataFrame, item: str = "item",
                 key: str = "Stream_ID") -> DataFrame:
    return df.join(mapping.withColumnRenamed("item", item), item)


def split(df: DataFrame, share: float = 0.8, seed: int = 12345, bucket: Column | None = None,
          keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split (see ``relational.hash_split``)."""
    return hash_split(df, keys=keys, share=share, seed=seed, bucket=bucket)


def cold_users(train: DataFrame, test: DataFrame, user: str = "user") -> DataFrame:
    """Users of ``test`` that never occur in ``train`` (anti join; both sides distinct)."""
    return (test.select(user).distinct()
            .join(train.select(user).distinct(), user, "left_anti"))


def items_seen_by(views: DataFrame, users: DataFrame, user: str = "User_ID",
                  key: str = "Stream_ID", users_col: str = "user") -> DataFrame:
    """Distinct items that the given users interacted with (semi join)."""
    u = users.select(F.col(users_col).alias(user))
    return views.join(u, user, "left_semi").select(key).distinct()


def similar_users(views: DataFrame, train_users: DataFrame, items: DataFrame,
                  user: str = "User_ID", key: str = "Stream_ID",
                  users_col: str = "user") -> DataFrame:
    """Training users that interacted with any of ``items``: (similar_user)."""
    tu = train_users.select(F.col(users_col).alias(user))
    return (views.join(tu, user, "left_semi").join(items.select(key), key, "left_semi")
            .select(F.col(user).alias("similar_user")).distinct())


@dataclass(frozen=True)
class Recommendations:
    """Result bundle: nested top-N lists, the split, the chosen model and the search."""
    result: DataFrame
    test: DataFrame
    train: DataFrame
    model: ALSModel
    mapping: DataFrame
    trials: DataFrame
    lists: DataFrame | None = None  # (user, item, rating): the top-N lists before decoding
    n: int | None = None  # of those lists


def nest(flat: DataFrame, group: str = "user", item: str = "Stream_ID",
         score: str = "rating", out: str = "recommendations") -> DataFrame:
    """Re-nest (group, item, score) rows into an array sorted by score desc, item asc.

    Only used on top-N output, so every list is bounded by N.
    """
    key = F.struct((-F.col(score)).alias("k"), F.col(item).alias("i"), F.col(score).alias("s"))
    arr = F.sort_array(F.collect_list(key))
    return flat.groupBy(group).agg(
        F.transform(arr, lambda x: F.struct(x["i"].alias(item), x["s"].alias(score))).alias(out))


def flatten(nested: DataFrame, group: str = "user", out: str = "recommendations") -> DataFrame:
    """(group, rank 1..N, fields of each list element)."""
    e = nested.select(group, F.posexplode(out).alias("pos", "__r"))
    return e.select(group, (F.col("pos") + 1).alias("rank"), "__r.*")


def _top_per(df: DataFrame, group: str, item: str, score: str, n: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(item).asc())
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def top_n(views: DataFrame, n: int = 10, ranks=(10, 20, 30), reg_params=(0.01, 0.1, 0.5),
          max_iters=(3, 10, 20), bucket: Column | None = None, share: float = 0.8,
          seed: int = 12345, parallelism: int = 1) -> Recommendations:
    """Encode items -> split -> ALS grid by test RMSE -> top-N per user -> decode -> nest."""
    columns = [F.col("User_ID"), F.col("Stream_ID"), F.col("Duration")]
    if bucket is not None:
        columns.append(bucket.alias("__b"))
    # numbering, hot streams and the join with the numbers read the views: they are worked out once
    stored = materialize(views.select(*columns), "views")
    return _top_n(stored, n, ranks, reg_params, max_iters, bucket is not None, share, seed, parallelism)


def _top_n(views: DataFrame, n: int, ranks, reg_params, max_iters, has_bucket: bool, share: float, seed: int,
           parallelism: int) -> Recommendations:
    """``top_n`` over stored (User_ID, Stream_ID, Duration) rows, ``__b`` too where a bucket is given."""
    from skein.operators.tuning import search_als
    mapping = encode_items(views)
    extra = ["__b"] if has_bucket else []
    rated = materialize(skew_join(views, mapping, "Stream_ID").select(
        F.col("User_ID").alias("user"), "item", F.col("Duration").cast("float").alias("rating"), *extra), "rated")
    train, test = split(rated, share=share, seed=seed, bucket=F.col("__b") if has_bucket else None,
                        keys=None if has_bucket else ["user", "item", "rating"])
    if has_bucket:
        train, test = train.drop("__b"), test.drop("__b")
    trials, model = search_als(train, test, ranks, reg_params, max_iters, seed=seed,
                               parallelism=parallelism)
    flat = top_items(model.userFactors, model.itemFactors, n).lists
    decoded = flat.join(mapping, "item").select("user", "Stream_ID", "rating")
    return Recommendations(nest(decoded), test, train, model, mapping, trials, flat, n)


def cold_start(recs: Recommendations, views: DataFrame, n: int = 10) -> DataFrame:
    """Top-N lists for users seen only in the test split: (cold_user, recommendations).

    A cold user's candidates are the top-N lists of the training users who share an
    item with them ("similar users"); a candidate's score is its best predicted rating
    among those users. This is computed without forming user pairs: similar users'
    lists are first reduced per shared item (best score per (item, candidate), top N per
    item; exact, since an item's top N holds every candidate that can reach a cold
    user's top N through it), then each cold user combines the lists of its own items.
    """
    cold = cold_users(recs.train, recs.test).select(F.col("user").alias("User_ID"))
    cold_pairs = views.join(cold, "User_ID", "left_semi").select("User_ID", "Stream_ID").distinct()
    shared = cold_pairs.select("Stream_ID").distinct()
    train_users = recs.train.select(F.col("user").alias("User_ID")).distinct()
    sim_pairs = (views.join(train_users, "User_ID", "left_semi")
                 .join(shared, "Stream_ID", "left_semi")
                 .select(F.col("User_ID").alias("user"), "Stream_ID").distinct())
    sim_users = sim_pairs.select("user").distinct()
    if recs.lists is not None and recs.n == n:  # a user's list depends on no other user: top_n has them all
        sim_lists = recs.lists.join(sim_users, "user", "left_semi")
    else:
        factors = recs.model.userFactors.join(sim_users.withColumnRenamed("user", "id"), "id", "left_semi")
        sim_lists = top_items(factors, recs.model.itemFactors, n).lists
    sim_recs = sim_lists.withColumnRenamed("item", "cand")
    per_item = (sim_pairs.join(sim_recs, "user")
                .groupBy("Stream_ID", "cand").agg(F.max("rating").alias("rating")))
    per_item = _top_per(per_item, "Stream_ID", "cand", "rating", n)
    per_user = (cold_pairs.join(per_item, "Stream_ID")
                .groupBy(F.col("User_ID").alias("cold_user"), "cand").agg(F.max("rating").alias("rating")))
    per_user = _top_per(per_user, "cold_user", "cand", "rating", n)
    decoded = (per_user.join(recs.mapping.withColumnRenamed("item", "cand").withColumnRenamed(
        "Stream_ID", "rec_stream"), "cand").select("cold_user", F.col("rec_stream").alias("Stream_ID"), "rating"))
    return nest(decoded, group="cold_user")


@dataclass(frozen=True)
class ColdClasses:
    """Cold start with ``match="all"``, in which every cold user gets the lists of every similar user, as a
    factorised relation: cold users and similar users are linked to a class, and the pairs are the
    join of both links. They are never formed; all that is asked of them follows from the factors."""
    cold: DataFrame  # (class, cold_user)
    similar: DataFrame  # (class, similar_user)

    def counts(self) -> DataFrame:
        """(class, cold_users, similar_users, pairs)"""
        links = (self.cold.select("class", F.lit(1).alias("c"), F.lit(0).alias("s"))
                 .unionByName(self.similar.select("class", F.lit(0).alias("c"), F.lit(1).alias("s"))))
        n = links.groupBy("class").agg(F.sum("c").alias("cold_users"), F.sum("s").alias("similar_users"))
        return n.where("cold_users > 0 AND similar_users > 0").withColumn("pairs", F.col("cold_users") * F.col("similar_users"))

    def best_lists(self, lists: DataFrame, n: int = 10) -> DataFrame:
        """(class, rank, item, rating): the ``n`` best items of the similar users' ``lists(user, item,
        rating)``, each by its best rating; one list serves all cold users of the class."""
        per = (lists.join(self.similar.withColumnRenamed("similar_user", "user"), "user")
               .groupBy("class", "item").agg(F.max("rating").alias("rating")))
        w = Window.partitionBy("class").orderBy(F.col("rating").desc(), F.col("item").asc())
        return (per.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
                .select("class", "rank", "item", "rating"))


def cold_classes(views: DataFrame, train: DataFrame, test: DataFrame) -> ColdClasses:
    """The one class of all cold users (in ``test`` only) and all users of ``train`` who share an item with
    any of them."""
    cold = cold_users(train, test)
    similar = similar_users(views, train.select("user").distinct(), items_seen_by(views, cold))
    return ColdClasses(cold.select(F.lit(0).alias("class"), F.col("user").alias("cold_user")),
                       similar.select(F.lit(0).alias("class"), "similar_user"))


def segment(views: DataFrame, k: int = 3, seed: int = 12345,
            features: Sequence[str] = ("Duration", "Time_Start")) -> DataFrame:
    """Behavioural segments: k-means on standardised features -> ``cluster`` column."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    vec = VectorAssembler(inputCols=list(features), outputCol="__f").transform(views)
    scaled = StandardScaler(inputCol="__f", outputCol="__sf", withMean=True, withStd=True).fit(vec).transform(vec)
    model = KMeans(k=k, seed=seed, featuresCol="__sf", predictionCol="cluster").fit(scaled)
    return model.transform(scaled).drop("__f", "__sf")


def per_segment(views: DataFrame, k: int = 3, seed: int = 12345, n: int = 10, ranks=(10, 20, 30),
                reg_params=(0.01, 0.1, 0.5), max_iters=(3, 10, 20), bucket: Column | None = None,
                share: float = 0.8, parallelism: int = 1) -> tuple[DataFrame, DataFrame]:
    """Segment, then run ``top_n`` and ``cold_start`` inside each non-empty segment.

    The loop runs over the k segment numbers (bounded by k, not the data); the segment
    table is checkpointed once. Returns flat (cluster, user, rank, Stream_ID, rating) for
    top-N and (cluster, cold_user, rank, Stream_ID, rating) for cold start.
    """
    has_bucket = bucket is not None
    extra = [bucket.alias("__b")] if has_bucket else []
    # the scaler, the clusters and their prediction each read the views: they are worked out once
    stored = materialize(views.select("User_ID", "Stream_ID", "Duration", "Time_Start", *extra), "views")
    seg = materialize(segment(stored, k, seed).drop("Time_Start"), "segments")
    release(stored)
    tops, colds = [], []
    for c in range(k):
        part = seg.where(F.col("cluster") == c)
        if part.limit(1).count() == 0:
            continue
        recs = _top_n(part.drop("cluster"), n, ranks, reg_params, max_iters, has_bucket, share, seed, parallelism)
        tops.append(flatten(recs.result).withColumn("cluster", F.lit(c)))
        colds.append(flatten(cold_start(recs, part, n), group="cold_user").withColumn("cluster", F.lit(c)))
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    cold = colds[0]
    for t in colds[1:]:
        cold = cold.unionByName(t)
    return top, cold
