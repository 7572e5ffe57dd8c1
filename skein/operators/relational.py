"""Relational building blocks: ordered top-k, distributed prefix sums, dense ids, hash and
exact-share splits, hot keys and skew joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.session import default_parallelism, materialize


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_fractional(df: DataFrame, name) -> bool:
    if not isinstance(name, str):
        return True
    field = df.schema[name] if name in df.columns else None
    return field is None or isinstance(field.dataType, (T.DoubleType, T.FloatType))


def arg_top(df: DataFrame, by, k: int = 1, desc: bool = True,
            tie: Sequence = ()) -> DataFrame:
    """The ``k`` rows with the largest (``desc``) or smallest value of ``by``.

    NaN and null always rank last, whatever the direction; ``tie`` columns (ascending)
    make the choice deterministic. Plans as TakeOrderedAndProject: each task keeps its own
    k best rows and only those k x tasks rows are merged.
    """
    value = _col(by)
    missing = value.isNull()
    if _is_fractional(df, by):
        missing = missing | F.isnan(value)
    order = [F.when(missing, F.lit(1)).otherwise(F.lit(0)).asc(),
             value.desc() if desc else value.asc()]
    order += [_col(t).asc_nulls_last() for t in tie]
    return df.orderBy(*order).limit(k)


# Ranges for each shuffle partition (so that hashing them over partitions evens out), and sampled
# keys for each range: the driver holds RANGES * partitions boundaries, whatever the table's size.
RANGES, SAMPLED = 4, 64


def range_bounds(df: DataFrame, order: Sequence[str], ranges: int) -> list:
    """At most ``ranges - 1`` ascending keys that cut ``df`` into ranges of about equal size.

    A bottom-k sketch: the keys with the smallest hashes are a uniform sample that tasks merge, and
    every SAMPLED-th of it in order is a boundary. The result is a plain list, drawn once."""
    size = ranges * SAMPLED
    key = F.struct(*order)
    sample = (df.select(key.alias("key"), F.xxhash64(*order).alias("turn")).distinct()
              .orderBy("turn", "key").limit(size).select("key"))
    # the sample is bounded, so one task may number it
    numbered = sample.select("key", F.row_number().over(Window.orderBy("key")).alias("at"),
                             F.count("*").over(Window.partitionBy()).alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / ranges))
    return [r.key for r in numbered.where((F.col("at") % step == 0) & (F.col("at") < F.col("n")))
            .orderBy("at").select("key").limit(ranges - 1).collect()]


def range_of(df: DataFrame, order: Sequence[str], bounds: Sequence) -> Column:
    """0-based range of a row: how many of the ascending ``bounds`` its key is not below, found by
    binary search. A pure function of the row and the list, so every plan that uses it agrees."""
    if not bounds:
        return F.lit(0)
    kinds = [df.schema[c].dataType for c in order]
    table = F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(order, b, kinds)]) for b in bounds])
    key = F.struct(*order)

    def halve(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        open_, up = s["lo"] < s["hi"], F.get(table, mid) <= s["key"]
        return F.struct(F.when(open_ & up, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(open_ & ~up, mid).otherwise(s["hi"]).alias("hi"), s["key"].alias("key"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"), key.alias("key"))
    steps = F.array(*[F.lit(i) for i in range(len(bounds).bit_length())])
    return F.aggregate(steps, start, halve, lambda s: s["lo"])


def prefix_sum(df: DataFrame, order: Sequence[str], values: Sequence[str],
               out_prefix: str = "cum_", partitions: int | None = None,
               descending: bool = False) -> DataFrame:
    """Inclusive running sums of ``values`` in the order of the ``order`` columns.

    Never one un-partitioned window. ``df`` is written once; a quantile sketch of its keys fixes one
    list of boundaries; every row finds its range by binary search in that list. Ranges take local
    running sums, and their totals (partial sums, one row per range) become offsets that are
    broadcast back. Totals and rows read the same table and the same list, whatever else they
    carry. The order key should be unique (aggregate first); ties would be summed in arbitrary order
    among themselves. Nulls come first (last if ``descending``), NaN after all numbers.
    """
    n = (partitions or default_parallelism(df.sparkSession)) * RANGES
    stored = materialize(df, "prefix")
    ranged = stored.withColumn("__range", range_of(stored, order, range_bounds(stored, order, n)))
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    local = Window.partitionBy("__range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ranged.groupBy("__range").agg(*[F.sum(v).alias(f"__off_{v}") for v in values])
    # one row per range: a bound fixed by ``n``, not by the data
    before = (Window.orderBy(F.desc("__range") if descending else F.asc("__range"))
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("__range", *[F.coalesce(F.sum(f"__off_{v}").over(before), F.lit(0)).alias(f"__off_{v}")
                                         for v in values])
    out = ranged.select("*", *[F.sum(v).over(local).alias(f"__local_{v}") for v in values])
    return (out.join(F.broadcast(offsets), "__range")
            .select(*df.columns, *[(F.col(f"__local_{v}") + F.col(f"__off_{v}")).alias(f"{out_prefix}{v}")
                                   for v in values]))


def dense_ids(df: DataFrame, key: str, out: str = "id", checkpoint: bool = True) -> DataFrame:
    """Map each distinct ``key`` to a 0-based dense integer id, ordered by the key.

    The mapping is materialised once with a reliable checkpoint, so encoding and
    decoding always agree (a lazily re-evaluated numbering need not).
    """
    keys = df.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__one", F.lit(1))
    numbered = prefix_sum(keys, [key], ["__one"], out_prefix="__cum")
    mapping = numbered.select(key, (F.col("__cum__one") - 1).cast("int").alias(out))
    if checkpoint:
        mapping = materialize(mapping, "ids")
    return mapping


def hash_split(df: DataFrame, keys: Sequence[str] | None = None, share: float = 0.8,
               seed: int = 12345, bucket: Column | None = None,
               buckets: int = 10) -> tuple[DataFrame, DataFrame]:
    """Deterministic train / test split.

    A row goes to train when its bucket (``xxhash64(seed, keys) mod buckets`` by default,
    or the supplied ``bucket`` expression) is below ``share * buckets``. Unlike
    ``randomSplit`` the assignment does not depend on partitioning or recomputation.
    """
    if bucket is None:
        cols = [F.col(k) for k in (keys or df.columns)]
        bucket = F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(buckets))
    cut = share * buckets
    flagged = df.withColumn("__bucket", bucket)
    train = flagged.where(F.col("__bucket") < cut).drop("__bucket")
    test = flagged.where(F.col("__bucket") >= cut).drop("__bucket")
    return train, test


DIGIT_BITS = 12  # of a key hash settled by each pass of kth_hash: a histogram of 4096 counts


def kth_hash(df: DataFrame, turn: Column, k: int) -> int:
    """The ``k``-th smallest (from 1) of the 60-bit hashes ``turn`` of the rows, by refining a
    histogram: each pass counts the rows by the next digit among those that share the digits found
    so far, so the driver sees 4096 counts a pass and no pass shuffles rows."""
    hashes, prefix, left = df.select(turn.alias("turn")), 0, k
    for shift in range(60 - DIGIT_BITS, -1, -DIGIT_BITS):
        here = hashes.where(F.shiftright("turn", shift + DIGIT_BITS) == F.lit(prefix))
        digit = F.shiftright("turn", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        for row in here.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).orderBy("digit").collect():
            if row.n >= left:
                break
            left -= row.n
        prefix = (prefix << DIGIT_BITS) | row.digit
    return prefix


def exact_split(df: DataFrame, keys: Sequence[str], share: float = 0.8,
                seed: int = 12345) -> tuple[DataFrame, DataFrame]:
    """Train / test split with exactly ``round(share * rows)`` train rows.

    Rows are ordered by a hash of ``keys`` (which should tell rows apart); the train rows are those up to the
    k-th smallest hash. The assignment depends on the keys alone, not on partitions. Rows whose
    hashes tie at the cut (rows that repeat their keys) are settled by a count of those few rows.
    """
    turn = F.xxhash64(F.lit(seed), *keys).bitwiseAND(F.lit((1 << 60) - 1))
    stored = materialize(df.withColumn("__turn", turn), "split")
    total = stored.count()
    k = round(share * total)
    if k <= 0:
        return stored.where(F.lit(False)).drop("__turn"), stored.drop("__turn")
    cut = kth_hash(stored, F.col("__turn"), k)
    below = stored.where(F.col("__turn") < cut)
    ties = stored.where(F.col("__turn") == cut)
    spare = k - below.count()
    if ties.count() == spare:
        return stored.where(F.col("__turn") <= cut).drop("__turn"), stored.where(F.col("__turn") > cut).drop("__turn")
    # rows with one hash: the first ``spare`` of them in the order of all columns go to train
    placed = materialize(prefix_sum(ties.groupBy(*df.columns, "__turn").agg(F.count("*").alias("__copies")),
                                    list(df.columns), ["__copies"], out_prefix="__upto_"), "split-ties")
    first = F.greatest(F.lit(0), F.least(F.col("__copies"), F.lit(spare) - F.col("__upto___copies") + F.col("__copies")))
    def copies(n: Column) -> DataFrame:  # noqa: E306
        return (placed.withColumn("__n", n.cast("int")).where("__n > 0")
                .withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*df.columns))
    return (below.drop("__turn").unionByName(copies(first)),
            stored.where(F.col("__turn") > cut).drop("__turn").unionByName(copies(F.col("__copies") - first)))


def require_not_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fail the job on the first null in ``cols`` instead of only asserting the schema."""
    cols = list(cols or df.columns)
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    message = F.lit("null value in a required column of " + ",".join(cols))
    # A filter keeps the check in the plan (a dropped projection would be pruned away).
    return df.where(F.when(cond, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


# Share of a table's rows above which one key counts as hot. At most 1 / HOT_SHARE keys can
# pass, which bounds every broadcast made of hot keys.
HOT_SHARE = 0.01


def hot_keys(df: DataFrame, key: str, min_share: float = HOT_SHARE,
             counts: DataFrame | None = None, count_col: str = "__n") -> DataFrame:
    """Keys holding at least ``min_share`` of the rows (at most ``1/min_share`` of them).

    ``counts`` may supply an existing (key, count) aggregate so no extra pass is needed.
    """
    if counts is None:
        counts = df.groupBy(key).agg(F.count("*").alias(count_col))
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.where(F.col(count_col) >= total * F.lit(min_share)).select(key)


def skew_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
              min_share: float = HOT_SHARE, hot: DataFrame | None = None) -> DataFrame:
    """Join a large table with a table holding at most one row per key, splitting hot keys.

    Rows of hot keys (see :func:`hot_keys`) meet a broadcast of just those keys' rows of
    ``small`` inside the map tasks, so no single reduce task receives a hot key's rows;
    all other rows go through the ordinary shuffle join. Both broadcasts are bounded by
    ``1/min_share`` keys.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    hot = F.broadcast(hot if hot is not None else hot_keys(big, key, min_share))
    small_hot = F.broadcast(small.join(hot, key, "left_semi"))
    hot_rows = big.join(hot, key, "left_semi").join(small_hot, key, how)
    cold_rows = (big.join(hot, key, "left_anti")
                 .join(small.join(hot, key, "left_anti"), key, how))
    return hot_rows.unionByName(cold_rows)
