"""Route enrichment (both endpoints joined to the airport dimension) and carrier totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.geo import great_circle_km
from skein.operators.relational import arg_top


def with_endpoints(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """Join the airport table twice (role-playing dimension): as source and as target.

    Routes whose endpoint is null or unknown drop out (inner joins), as in the reference.
    No broadcast hint: the airport table grows with the data, so the join strategy is left
    to AQE, which broadcasts only when the measured side is below the threshold.
    """
    ends = airports.select("airport_id", "latitude", "longitude")
    src = ends.select(F.col("airport_id").alias("__s_id"), F.col("latitude").alias("src_lat"),
                      F.col("longitude").alias("src_lon"))
    dst = ends.select(F.col("airport_id").alias("__d_id"), F.col("latitude").alias("dst_lat"),
                      F.col("longitude").alias("dst_lon"))
    return (routes.join(src, routes.source_airport_id == src.__s_id)
            .join(dst, F.col("dest_airport_id") == dst.__d_id)
            .drop("__s_id", "__d_id"))


def routes_with_distance(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """Route table with endpoint coordinates and great-circle ``distance`` in km."""
    e = with_endpoints(routes, airports)
    return e.select("source_airport_id", "dest_airport_id", "src_lat", "src_lon", "dst_lat",
                    "dst_lon", "airline", "stops",
                    great_circle_km("src_lat", "src_lon", "dst_lat", "dst_lon").alias("distance"))


def carrier_totals(route_dist: DataFrame) -> DataFrame:
    """(airline, total_distance): partial sums per task, one shuffle on the airline."""
    return route_dist.groupBy("airline").agg(F.sum("distance").alias("total_distance"))


def carrier_extreme(route_dist: DataFrame, largest: bool = True) -> DataFrame:
    """Carrier with the largest (or smallest) total distance; ties go to the lowest name."""
    return arg_top(carrier_totals(route_dist), "total_distance", k=1, desc=largest,
                   tie=["airline"])
