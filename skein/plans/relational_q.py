"""Interaction cleaning, item encoding, splits, cold-start sets, feature prep and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import metrics as M
from skein.operators import ml_prep as P
from skein.operators import recommend as R
from skein.operators.relational import exact_split, prefix_sum
from skein.plans import views_sql as V
from skein.plans.registry import register
from skein.sources import testdata as td

# Fixed query parameters: the rule classifier and score used to exercise the metrics.
RULE_QUANTITY = 25
SCORE_SCALE = 50.0


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return R.clean_interactions(td.views(spark, sf))


def _rated(spark: SparkSession, sf: str):
    c = clean(spark, sf)
    mapping = R.encode_items(c)
    r = c.join(mapping, "Stream_ID").select(F.col("User_ID").alias("user"), "item",
                                            F.col("Duration").alias("rating"), "bucket")
    train, test = R.split(r, bucket=F.col("bucket"))
    return c, mapping, train.drop("bucket"), test.drop("bucket")


def _r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


_IDS = """ids AS (SELECT Stream_ID, CAST(row_number() OVER (ORDER BY Stream_ID) - 1 AS INTEGER) AS item
  FROM (SELECT DISTINCT Stream_ID FROM clean)),
rated AS (SELECT c.User_ID AS user, m.item, c.Duration AS rating, c.bucket
  FROM clean c JOIN ids m ON c.Stream_ID = m.Stream_ID),
train AS (SELECT user, item, rating FROM rated WHERE bucket < 8),
test AS (SELECT user, item, rating FROM rated WHERE bucket >= 8),
cold AS (SELECT DISTINCT user FROM test EXCEPT SELECT DISTINCT user FROM train),
cold_items AS (SELECT DISTINCT Stream_ID FROM clean WHERE User_ID IN (SELECT user FROM cold))"""


def _rsql(body: str) -> str:
    return V.with_views(V.CLEAN_VIEWS, extra=_IDS) + body


@register("clean_views", V.with_views(V.CLEAN_VIEWS) +
          "SELECT User_ID, Stream_ID, Streamer_Username, Time_Start, Time_Stop, Duration FROM clean")
def q_clean_views(spark, sf):
    return clean(spark, sf).drop("bucket")


@register("item_ids", _rsql("SELECT Stream_ID, item FROM ids"))
def q_item_ids(spark, sf):
    return R.encode_items(clean(spark, sf))


@register("encode_decode", _rsql("""SELECT r.user, r.item, m.Stream_ID, r.rating
FROM rated r JOIN ids m ON r.item = m.item"""))
def q_encode_decode(spark, sf):
    c = clean(spark, sf)
    mapping = R.encode_items(c)
    r = R.ratings(c, mapping)
    return R.decode_items(r, mapping).select("user", "item", "Stream_ID", "rating")


@register("ratings", _rsql("SELECT user, item, rating FROM rated"))
def q_ratings(spark, sf):
    c = clean(spark, sf)
    return R.ratings(c, R.encode_items(c))


@register("split_train", _rsql("SELECT user, item, rating FROM train"))
def q_split_train(spark, sf):
    return _rated(spark, sf)[2]


@register("split_test", _rsql("SELECT user, item, rating FROM test"))
def q_split_test(spark, sf):
    return _rated(spark, sf)[3]


@register("cold_users", _rsql("SELECT user FROM cold"))
def q_cold_users(spark, sf):
    _, _, train, test = _rated(spark, sf)
    return R.cold_users(train, test)


@register("cold_items", _rsql("SELECT Stream_ID FROM cold_items"))
def q_cold_items(spark, sf):
    c, _, train, test = _rated(spark, sf)
    return R.items_seen_by(c, R.cold_users(train, test))


@register("similar_users", _rsql("""SELECT DISTINCT User_ID AS similar_user FROM clean
WHERE User_ID IN (SELECT user FROM train) AND Stream_ID IN (SELECT Stream_ID FROM cold_items)"""))
def q_similar_users(spark, sf):
    c, _, train, test = _rated(spark, sf)
    items = R.items_seen_by(c, R.cold_users(train, test))
    return R.similar_users(c, train.select("user").distinct(), items)


@register("cold_pairs_all", _rsql("""SELECT 0 AS class, count(DISTINCT c.user) AS cold_users,
  count(DISTINCT s.similar_user) AS similar_users, count(*) AS pairs
FROM cold c CROSS JOIN (SELECT DISTINCT User_ID AS similar_user FROM clean
  WHERE User_ID IN (SELECT user FROM train) AND Stream_ID IN (SELECT Stream_ID FROM cold_items)) s
HAVING count(*) > 0"""))
def q_cold_pairs_all(spark, sf):
    c, _, train, test = _rated(spark, sf)
    return R.cold_classes(c, train, test).counts()


# ------------------------------------------------------------------ running totals, exact split

@register("running_total", """SELECT o_orderdate, o_orderkey, o_custkey, o_orderstatus, cents,
  (sum(cents) OVER (ORDER BY o_orderdate, o_orderkey))::BIGINT AS total_cents,
  row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS place
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)""")
def q_running_total(spark, sf):
    o = td.table(spark, sf, "orders").select(
        "o_orderdate", "o_orderkey", "o_custkey", "o_orderstatus",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.lit(1).cast("long").alias("one"))
    return prefix_sum(o, ["o_orderdate", "o_orderkey"], ["cents", "one"]).select(
        "o_orderdate", "o_orderkey", "o_custkey", "o_orderstatus", "cents",
        F.col("cum_cents").alias("total_cents"), F.col("cum_one").alias("place"))


@register("exact_split_shares", """SELECT part, CASE WHEN part = 'train' THEN k ELSE n - k END AS n
FROM (SELECT count(*) AS n, CAST(round(0.8 * count(*)) AS BIGINT) AS k FROM lineitem),
     (SELECT unnest(['train', 'test']) AS part)""")
def q_exact_split_shares(spark, sf):
    rows = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    train, test = exact_split(rows, ["l_orderkey", "l_linenumber"], 0.8)
    return (train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part")))
            .groupBy("part").agg(F.count("*").alias("n")))


# ------------------------------------------------------------------ feature preparation

_BIG = f"""big AS (SELECT l_quantity, l_discount, l_extendedprice,
  CASE WHEN l_extendedprice > 30000 THEN 1 ELSE 0 END AS label,
  CASE WHEN l_quantity > {RULE_QUANTITY} THEN 1 ELSE 0 END AS prediction,
  l_quantity / {SCORE_SCALE} AS score FROM lineitem)"""


def big(spark: SparkSession, sf: str) -> DataFrame:
    d = P.threshold_label(td.points_big(spark, sf), "l_extendedprice", td.BIG_PRICE_CUT)
    return (d.withColumn("prediction", F.when(F.col("l_quantity") > RULE_QUANTITY, 1).otherwise(0))
            .withColumn("score", F.col("l_quantity") / SCORE_SCALE))


def _bsql(body: str, recursive: bool = False) -> str:
    return "WITH " + _BIG + "\n" + body


@register("label_balance", _bsql("SELECT label, count(*) AS n FROM big GROUP BY label"))
def q_label_balance(spark, sf):
    return P.class_balance(big(spark, sf))


@register("poly_terms", _bsql("""SELECT l_quantity, l_discount,
  round(l_quantity * l_discount, 6) AS l_quantity_l_discount,
  round(l_quantity * l_quantity, 6) AS l_quantity_squared,
  round(l_discount * l_discount, 6) AS l_discount_squared FROM big"""))
def q_poly_terms(spark, sf):
    d = P.interaction_terms(td.points_big(spark, sf), "l_quantity", "l_discount")
    return d.select("l_quantity", "l_discount", _r6("l_quantity_l_discount"),
                    _r6("l_quantity_squared"), _r6("l_discount_squared"))


@register("scaled_points", V.with_views(V.POINTS) + """SELECT id,
  round((x - avg(x) OVER ()) / stddev_samp(x) OVER (), 6) AS x_s,
  round((y - avg(y) OVER ()) / stddev_samp(y) OVER (), 6) AS y_s,
  round((z - avg(z) OVER ()) / stddev_samp(z) OVER (), 6) AS z_s FROM points""")
def q_scaled_points(spark, sf):
    s = P.standardise(td.points(spark, sf), ["x", "y", "z"], keep=["id"])
    return s.select("id", _r6("x_s"), _r6("y_s"), _r6("z_s"))


# ------------------------------------------------------------------ metrics

@register("confusion", _bsql("SELECT label, prediction, count(*) AS n FROM big GROUP BY label, prediction"))
def q_confusion(spark, sf):
    return M.confusion(big(spark, sf))


@register("accuracy", _bsql(
    "SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM big"))
def q_accuracy(spark, sf):
    return M.accuracy(big(spark, sf)).select(_r6("accuracy"))


@register("f1_weighted", _bsql("""SELECT round(sum(f1 * actual) / sum(actual), 6) AS f1 FROM (
  SELECT a.cls, a.actual,
    CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM (
      SELECT cls, actual,
        CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p, tp / actual AS r FROM (
        SELECT label AS cls, count(*) AS actual,
          (SELECT count(*) FROM big b2 WHERE b2.label = b.label AND b2.prediction = b.label) AS tp,
          (SELECT count(*) FROM big b3 WHERE b3.prediction = b.label) AS predicted
        FROM big b GROUP BY label)) a)"""))
def q_f1(spark, sf):
    return M.f1_weighted(big(spark, sf)).select(_r6("f1"))


def _roc_sql(score: str) -> str:
    return _bsql(f"""
, per AS (SELECT CAST({score} AS DOUBLE) AS threshold, sum(label) AS p, sum(1 - label) AS q
  FROM big GROUP BY {score}),
tot AS (SELECT sum(label) AS P, sum(1 - label) AS N FROM big),
cum AS (SELECT row_number() OVER (ORDER BY threshold DESC) AS step, threshold,
  sum(q) OVER (ORDER BY threshold DESC) AS cq, sum(p) OVER (ORDER BY threshold DESC) AS cp FROM per),
curve AS (
  SELECT CAST(step AS BIGINT) AS step, threshold, cq / (SELECT N FROM tot) AS fpr,
         cp / (SELECT P FROM tot) AS tpr FROM cum
  UNION ALL SELECT 0, NULL, 0.0, 0.0
  UNION ALL SELECT (SELECT count(*) FROM per) + 1, NULL, 1.0, 1.0)
""")


def _roc(spark, sf, score):
    return M.roc_curve(big(spark, sf), score=score, label="label")


@register("roc_points", _roc_sql("score") +
          "SELECT step, threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM curve")
def q_roc_points(spark, sf):
    return _roc(spark, sf, "score").select("step", "threshold", _r6("fpr"), _r6("tpr"))


@register("roc_hard", _roc_sql("prediction") +
          "SELECT step, threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM curve")
def q_roc_hard(spark, sf):
    return _roc(spark, sf, "prediction").select("step", "threshold", _r6("fpr"), _r6("tpr"))


@register("roc_auc", _roc_sql("score") + """SELECT round(sum((c.fpr - d.fpr) * (c.tpr + d.tpr) / 2), 6) AS auc
FROM curve c JOIN curve d ON c.step = d.step + 1""")
def q_roc_auc(spark, sf):
    return M.auc(_roc(spark, sf, "score")).select(_r6("auc"))


@register("rmse_rule", V.with_views(V.CLEAN_VIEWS) + """SELECT round(sqrt(avg(
  (Duration - (SELECT avg(Duration) FROM clean)) * (Duration - (SELECT avg(Duration) FROM clean)))), 6)
  AS rmse FROM clean""")
def q_rmse_rule(spark, sf):
    c = clean(spark, sf)
    mean = c.agg(F.avg("Duration")).scalar()
    return M.rmse(c.withColumn("prediction", mean), label="Duration").select(_r6("rmse"))


@register("cluster_profile", V.with_views(V.POINTS) + """SELECT class AS cluster, count(*) AS n,
  round(avg(x), 6) AS mean_x, round(avg(y), 6) AS mean_y, round(avg(z), 6) AS mean_z,
  min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM points GROUP BY class""")
def q_cluster_profile(spark, sf):
    from skein.operators.cluster import profile
    p = profile(td.points(spark, sf), "class", ["x", "y", "z"])
    return p.select("cluster", "n", _r6("mean_x"), _r6("mean_y"), _r6("mean_z"),
                    "min_x", "max_x", "min_y", "max_y")


@register("silhouette_class", V.with_views(V.POINTS) + """, d AS (
  SELECT p.id, p.class AS c, q.class AS qc,
         (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) + (p.z - q.z) * (p.z - q.z) AS d2
  FROM points p JOIN points q ON p.id <> q.id),
own AS (SELECT id, avg(d2) AS a FROM d WHERE c = qc GROUP BY id),
oth AS (SELECT id, min(m) AS b FROM (SELECT id, qc, avg(d2) AS m FROM d WHERE c <> qc
        GROUP BY id, qc) GROUP BY id),
coef AS (SELECT p.id, CASE WHEN own.a IS NULL THEN 0.0 WHEN own.a < oth.b THEN 1 - own.a / oth.b
                          WHEN own.a > oth.b THEN oth.b / own.a - 1 ELSE 0.0 END AS s
         FROM points p LEFT JOIN own ON p.id = own.id LEFT JOIN oth ON p.id = oth.id)
SELECT round(avg(s), 6) AS silhouette FROM coef""")
def q_silhouette_class(spark, sf):
    return M.silhouette(td.points(spark, sf), ["x", "y", "z"], "class").select(_r6("silhouette"))
