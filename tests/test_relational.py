import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skein.operators.relational import (arg_top, dense_ids, exact_split, hash_split, kth_hash, prefix_sum, range_bounds,
                                        range_of, require_not_null)


def test_arg_top_nan_and_null_last(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", None), ("c", 2.0), ("d", 2.0), ("e", 1.0)],
                               "k string, v double")
    assert [r.k for r in arg_top(df, "v", 2, desc=True, tie=["k"]).collect()] == ["c", "d"]
    assert [r.k for r in arg_top(df, "v", 1, desc=False, tie=["k"]).collect()] == ["e"]
    assert [r.k for r in arg_top(df, "v", 5, desc=True, tie=["k"]).collect()][-2:] == ["a", "b"]


def test_prefix_sum_matches_window(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = prefix_sum(df, ["k"], ["v"], partitions=6)
    want = df.withColumn("cum_v", F.sum("v").over(Window.orderBy("k")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    desc = prefix_sum(df, ["k"], ["v"], partitions=5, descending=True).where("k = 0").first()
    assert desc.cum_v == df.agg(F.sum("v")).first()[0]


def test_prefix_sum_of_a_million_rows_with_payload(spark):
    df = spark.range(1_000_000).select(
        F.pmod(F.col("id") * 7919, F.lit(1_000_003)).alias("k"), F.concat(F.lit("pay"), "id").alias("payload"),
        F.lit(1).alias("one"), (F.col("id") % 5).alias("v")).repartition(8)
    got = prefix_sum(df, ["k"], ["one", "v"], partitions=8)
    found = got.agg(F.count("*").alias("n"), F.max("cum_one").alias("top"), F.min("cum_one").alias("low"),
                    F.count_distinct("cum_one").alias("distinct"), F.max("cum_v").alias("v")).first()
    assert (found.n, found.top, found.low, found.distinct, found.v) == (1_000_000, 1_000_000, 1, 1_000_000, 2_000_000)
    # the running count is the rank of the key, whatever the payload
    want = df.withColumn("cum_one", F.row_number().over(Window.orderBy("k"))).withColumn(
        "cum_v", F.sum("v").over(Window.orderBy("k")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_prefix_sum_nulls_nan_strings_and_empty(spark):
    rows = [(None, "a", 1), (float("nan"), "b", 2), (1.5, "c", 3), (1.5, "d", 4), (-2.0, None, 5), (None, None, 6)]
    df = spark.createDataFrame(rows, "x double, s string, v int")
    for descending in (False, True):
        order = [F.col(c).desc() if descending else F.col(c).asc() for c in ("x", "s")]
        want = df.withColumn("cum_v", F.sum("v").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
        got = prefix_sum(df, ["x", "s"], ["v"], partitions=2, descending=descending)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert prefix_sum(df.limit(0), ["x"], ["v"]).count() == 0


def test_ranges_are_even_and_agree_with_a_scan_of_the_bounds(spark):
    df = spark.range(50_000).select(F.xxhash64("id").alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    bounds = range_bounds(df, ["b", "a"], 16)
    assert bounds == sorted(bounds) and len(bounds) == 15
    rows = df.withColumn("r", range_of(df, ["b", "a"], bounds)).collect()
    assert all(r.r == sum((b.b, b.a) <= (r.b, r.a) for b in bounds) for r in rows[::97])
    sizes = [sum(r.r == i for r in rows) for i in range(16)]
    assert max(sizes) < 2 * 50_000 / 16


def test_exact_split_has_the_exact_share_and_is_stable(spark):
    df = spark.range(3001).select("id", (F.col("id") % 10).alias("g"))
    for share in (0.8, 0.0, 1.0, 0.333):
        a, b = exact_split(df, ["id"], share, seed=4)
        c, _ = exact_split(df.repartition(9), ["id"], share, seed=4)
        assert a.count() == round(share * 3001) and b.count() == 3001 - a.count()
        assert a.unionByName(b).exceptAll(df).count() == 0 and a.exceptAll(c).count() == 0
    # repeated keys tie in one hash and are still split to the row
    same = df.select("g", F.lit(1).alias("x"))
    a, b = exact_split(same, ["g"], 0.5)
    assert a.count() == 1500 and a.unionByName(b).exceptAll(same).count() == 0 and same.exceptAll(a.unionByName(b)).count() == 0
    assert [x.count() for x in exact_split(df.limit(0), ["id"])] == [0, 0]


def test_kth_hash(spark):
    df = spark.range(500).select(F.xxhash64("id").bitwiseAND(F.lit((1 << 60) - 1)).alias("h"))
    ordered = sorted(r.h for r in df.collect())
    assert [kth_hash(df, F.col("h"), k) for k in (1, 250, 500)] == [ordered[0], ordered[249], ordered[499]]


def test_dense_ids_ordered_and_contiguous(spark):
    df = spark.createDataFrame([(f"S{i % 37}",) for i in range(400)], "s string").repartition(7)
    ids = dense_ids(df, "s", "item").orderBy("s").collect()
    assert [r.item for r in ids] == list(range(37))
    assert [r.s for r in ids] == sorted(f"S{i}" for i in range(37))


def test_hash_split_stable_under_repartitioning(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") * 3).alias("x"))
    a, _ = hash_split(df, ["id"], 0.8, seed=1)
    b, _ = hash_split(df.repartition(11), ["id"], 0.8, seed=1)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    share = a.count() / 3000
    assert math.isclose(share, 0.8, abs_tol=0.05)


def test_require_not_null(spark):
    ok = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert require_not_null(ok, ["a", "b"]).count() == 1
    bad = spark.createDataFrame([(1, None)], "a int, b double")
    with pytest.raises(Exception):
        require_not_null(bad, ["a", "b"]).count()


def test_skew_join_equals_plain_join(spark):
    from skein.operators.relational import hot_keys, skew_join
    big = spark.range(5000).select(
        F.when(F.col("id") % 5 < 2, F.lit(7)).otherwise(F.col("id") % 300).alias("k"), "id")
    small = spark.range(250).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    hot = [r.k for r in hot_keys(big, "k", 0.05).collect()]
    assert hot == [7]
    for how in ("inner", "left"):
        got = skew_join(big, small, "k", how=how, min_share=0.05)
        want = big.join(small, "k", how)
        assert got.count() == want.count()
        assert got.exceptAll(want.select(*got.columns)).count() == 0
