import math

from pyspark.sql import functions as F

from skein.functions.geo import great_circle_km
from skein.operators.routes import routes_with_distance


def _dist(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    return [r[0] for r in df.select(great_circle_km("a", "b", "c", "d")).collect()]


def test_great_circle_fixed_points(spark):
    r = 6371.0
    got = _dist(spark, [(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0), (0.0, 0.0, 0.0, 90.0),
                        (12.3, 45.6, 12.3, 45.6), (None, 1.0, 2.0, 3.0)])
    assert math.isclose(got[0], math.pi * r, rel_tol=1e-12)
    assert math.isclose(got[1], math.pi * r, rel_tol=1e-12)
    assert math.isclose(got[2], math.pi / 2 * r, rel_tol=1e-12)
    assert got[3] == 0.0
    assert got[4] is None


def test_equal_endpoints_never_nan(spark):
    df = spark.range(2000).select((F.rand(7) * 180 - 90).alias("la"), (F.rand(8) * 360 - 180).alias("lo"))
    out = df.select(great_circle_km("la", "lo", "la", "lo").alias("d"))
    assert out.where(F.isnan("d") | (F.col("d") != 0)).count() == 0


def test_routes_with_unknown_endpoints_vanish(spark):
    airports = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 90.0)],
                                     "airport_id long, latitude double, longitude double")
    routes = spark.createDataFrame([("A", 1, 2, 0), ("B", 1, None, 0), ("C", 1, 99, 0)],
                                   "airline string, source_airport_id long, dest_airport_id long, stops int")
    out = routes_with_distance(routes, airports).collect()
    assert [r.airline for r in out] == ["A"]
    assert math.isclose(out[0].distance, math.pi / 2 * 6371.0, rel_tol=1e-12)
