import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.operators import recommend as R
from skein.operators import topn
from skein.operators.topn import top_items
from skein.sources import testdata as td
from tests.conftest import SF_SMALL


def test_cold_start_sets(spark):
    views = spark.createDataFrame([(1, "a"), (2, "b"), (1, "b"), (3, "a"), (4, "c")],
                                  "User_ID int, Stream_ID string")
    train = spark.createDataFrame([(1,), (2,)], "user int")
    test = spark.createDataFrame([(1,), (3,), (4,)], "user int")
    cold = R.cold_users(train, test)
    assert sorted(r.user for r in cold.collect()) == [3, 4]
    items = R.items_seen_by(views, cold)
    assert sorted(r.Stream_ID for r in items.collect()) == ["a", "c"]
    train_views = views.where("User_ID IN (1, 2) AND NOT (User_ID = 1 AND Stream_ID = 'b')")
    sim = R.similar_users(views, train, items)
    assert [r.similar_user for r in sim.collect()] == [1]
    del train_views


@pytest.fixture(scope="module")
def recs(spark):
    views = R.clean_interactions(td.views(spark, SF_SMALL, full_loads_only=False))
    return views, R.top_n(views, n=5, ranks=(4,), reg_params=(0.1,), max_iters=(3,),
                          bucket=F.col("bucket"))


@pytest.mark.parametrize("block_items", [7, 16_384])
def test_top_items_equal_all_products(recs, block_items):
    _, r = recs
    got = {}
    found = top_items(r.model.userFactors, r.model.itemFactors, 5, block_items)
    for x in found.lists.collect():
        got.setdefault(x.user, []).append((-x.rating, x.item))
    want = {x.user: [(-y.rating, y.item) for y in x.recommendations] for x in r.model.recommendForAllUsers(5).collect()}
    assert set(got) == set(want) and found.products <= found.all_products
    for user, rows in got.items():
        assert [s for s, _ in sorted(rows)] == pytest.approx([s for s, _ in want[user]], rel=1e-4, abs=1e-6)


def test_top_items_stop_early_and_break_ties_by_item(spark):
    items = spark.createDataFrame([(i, [float(100 - i // 2), 0.0]) for i in range(100)], "id int, features array<float>")
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 0.0]), (4, None)], "id int, features array<float>")
    found = top_items(users, items, 3, 10)
    lists = {}
    for x in found.lists.orderBy("user", F.desc("rating"), "item").collect():
        lists.setdefault(x.user, []).append((x.item, x.rating))
    assert lists == {1: [(0, 100.0), (1, 100.0), (2, 99.0)], 2: [(98, -51.0), (99, -51.0), (96, -52.0)],
                     3: [(0, 0.0), (1, 0.0), (2, 0.0)]}
    assert found.products < found.all_products == 300  # the first user needs one block
    assert top_items(users, items.limit(0), 3).lists.count() == 0


def test_cold_classes_hold_the_product_as_factors(spark):
    views = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "c"), (6, "z")], "User_ID int, Stream_ID string")
    train, test = (spark.createDataFrame([(u,) for u in us], "user int") for us in ((1, 2, 5, 6), (1, 3, 4)))
    classes = R.cold_classes(views, train, test)
    assert [tuple(r) for r in classes.counts().collect()] == [(0, 2, 2, 4)]
    plan = classes.counts()._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lists = spark.createDataFrame([(1, 7, 0.5), (5, 7, 0.9), (5, 8, 0.5), (1, 9, 0.4), (2, 9, 3.0)], "user int, item int, rating double")
    assert [tuple(r) for r in classes.best_lists(lists, 2).orderBy("rank").collect()] == [(0, 1, 7, 0.9), (0, 2, 8, 0.5)]


def test_top_n_sorted_bounded_and_decodable(recs):
    views, r = recs
    rows = r.result.collect()
    assert rows
    known = {x.Stream_ID for x in views.select("Stream_ID").distinct().collect()}
    for row in rows:
        lst = row.recommendations
        assert 0 < len(lst) <= 5
        keys = [(-x.rating, x.Stream_ID) for x in lst]
        assert keys == sorted(keys)
        assert all(x.Stream_ID in known for x in lst)
    assert r.trials.where("chosen").count() == 1


def test_cold_start_equals_pairwise_brute_force(spark):
    views = R.clean_interactions(td.views(spark, SF_SMALL))
    r = R.top_n(views, n=5, ranks=(4,), reg_params=(0.1,), max_iters=(3,), bucket=F.col("bucket"))
    got = {row.cold_user: [(x.Stream_ID, x.rating) for x in row.recommendations]
           for row in R.cold_start(r, views, 5).collect()}
    # brute force: every (cold user, similar user) pair that shares an item
    train_users = {x.user for x in r.train.select("user").distinct().collect()}
    test_users = {x.user for x in r.test.select("user").distinct().collect()}
    cold = test_users - train_users
    seen = {}
    for x in views.select("User_ID", "Stream_ID").distinct().collect():
        seen.setdefault(x.User_ID, set()).add(x.Stream_ID)
    sims = spark.createDataFrame([(u,) for u in train_users], "user int")
    lists = {x.user: x.recommendations for x in r.model.recommendForUserSubset(sims, 5).collect()}
    names = {x.item: x.Stream_ID for x in r.mapping.collect()}
    want = {}
    for u in cold:
        best = {}
        for s in train_users:
            if seen.get(u, set()) & seen.get(s, set()):
                for rec in lists.get(s, []):
                    best[rec.item] = max(best.get(rec.item, float("-inf")), rec.rating)
        if best:
            top = sorted(best.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
            want[u] = [(names[i], v) for i, v in top]
    assert set(got) == set(want)
    for u in want:
        assert [v for _, v in got[u]] == pytest.approx([v for _, v in want[u]])


def test_views_are_worked_out_once_and_lists_are_reused(spark, monkeypatch):
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    made = [(u, f"S{(u * 7 + k) % 23}", 1 + (u + k) % 9, k, u % 10) for u in range(40) for k in range(5)]
    schema = "User_ID int, Stream_ID string, Duration int, Time_Start int, bucket int"
    views = spark.createDataFrame(made, schema).mapInArrow(counted, schema)
    search = {"n": 5, "ranks": (2,), "reg_params": (0.1,), "max_iters": (1,), "bucket": F.col("bucket")}
    r = R.top_n(views, **search)
    assert r.train.count() + r.test.count() == len(made) == rows.value
    plain = spark.createDataFrame(made, schema)
    fresh = sorted(map(str, R.cold_start(dataclasses.replace(r, lists=None), plain, 5).collect()))
    monkeypatch.setattr(R, "top_items", None)  # users' lists of the same length are at hand
    assert sorted(map(str, R.cold_start(r, plain, 5).collect())) == fresh != []


def test_score_block_keeps_the_best_of_all_steps():
    rng = np.random.default_rng(3)
    factors = rng.integers(-3, 4, (3000, 3)).astype(np.float32)  # with many ties
    norms = np.sqrt((factors.astype(float) ** 2).sum(axis=1))
    by_length = np.argsort(-norms, kind="stable")
    ids, factors, norms = rng.permutation(3000).astype(np.int32), factors[by_length], norms[by_length]
    users = rng.integers(-3, 4, (50, 3)).astype(np.float32)
    items, scores = np.full((50, 7), np.iinfo(np.int32).max, np.int32), np.full((50, 7), -np.inf, np.float32)
    done = topn._score_block(users, items, scores, ids, factors, norms, 7, None)
    assert done.all()
    for u, got, values in zip(users, items, scores):
        want = sorted(zip(-(factors @ u), ids))[:7]
        assert [(-s, i) for s, i in want] == list(zip(values, got))


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("share", [1.0, 0.4])
def test_cones_leave_out_no_item_of_a_list(whole, share):
    rng = np.random.default_rng(11)
    factors = (rng.integers(-4, 5, (6000, 4)) if whole else rng.normal(size=(6000, 4))).astype(np.float32)  # whole ones: with many ties
    factors[:50] = 0
    norms = np.sqrt((factors.astype(float) ** 2).sum(axis=1))
    by_length = np.argsort(-norms, kind="stable")
    ids, factors, norms = rng.permutation(6000).astype(np.int32), factors[by_length], norms[by_length]
    users = (rng.integers(-3, 4, (300, 4)) if whole else rng.normal(size=(300, 4))).astype(np.float32)
    users[:3], users[3:5] = 0, 1e-20
    cones = topn.Cones.of(ids, factors, norms)
    assert sorted(cones.ids) == sorted(ids[topn.FIRST_ITEMS:]) and len(cones.starts) > 100
    at = int(share * 6000)  # the block's end: the rest comes in a second one
    items, scores = np.full((300, 7), np.iinfo(np.int32).max, np.int32), np.full((300, 7), -np.inf, np.float32)
    products = np.zeros(300, dtype=np.int64)
    for part in (slice(0, at), slice(at, 6000)):
        if part.start < part.stop:
            block = ids[part], factors[part], norms[part]
            topn._score_block(users, items, scores, *block, 7, None, topn.Cones.of(*block), products)
    assert products[:3].min() == 6000 == products.max()  # all scores of a user of length 0 are ties
    assert np.median(products) < 3000
    for u, got, values in zip(users, items, scores):
        all_scores = factors @ u
        if whole:
            want = sorted(zip(-all_scores, ids))[:7]
            assert [(-s, i) for s, i in want] == list(zip(values, got))
        else:
            assert np.allclose(values, np.sort(all_scores)[::-1][:7], rtol=1e-5, atol=1e-25) and len(set(got)) == 7


def test_rounds_of_blocks_with_cones_equal_all_products(spark, monkeypatch):
    rng = np.random.default_rng(2)
    items, users = rng.normal(size=(9000, 5)) * rng.exponential(size=(9000, 1)), rng.normal(size=(200, 5))
    made = [spark.createDataFrame([(i, [float(v) for v in f]) for i, f in enumerate(m)], "id int, features array<float>") for m in (users, items)]
    monkeypatch.setattr(topn, "ROUND_FLOATS", 3 * 2000 * 5)  # three blocks in a round
    found = top_items(*made, 6, 2000)
    got = {}
    for r in found.lists.collect():
        got.setdefault(r.user, []).append(r.rating)
    want = np.sort(users @ items.T, axis=1)[:, ::-1][:, :6]
    assert len(got) == 200 and all(np.allclose(sorted(v, reverse=True), want[u], rtol=1e-4) for u, v in got.items())
    assert found.products < 0.5 * found.all_products == 0.5 * 200 * 9000
