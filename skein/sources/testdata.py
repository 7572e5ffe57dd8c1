"""Stand-in inputs derived from the driver's parquet tables.

The reference reads four CSV files that it does not ship. These views build tables of the
same shape from ``/root/testdata/sf*/``; every one is a lazy plan over the parquet scans,
so its size grows with the scale factor.

* airports: one per supplier, named by supplier, country = nation, synthetic coordinates.
* routes: one flight per line item shipped as a full load (``l_quantity = 50``), from the
  supplying airport to airport ``l_partkey mod #suppliers``, carrier = part brand.
* points / points_big: numeric feature tables (embedding components; line-item money).
* views: viewing intervals, user = customer, stream = part, start / stop = order / ship day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the stand-in definitions (shared with the SQL oracle text).
FULL_LOAD_QUANTITY = 50
LAT_MULTIPLIER, LAT_MODULUS = 7919, 17000
LON_MULTIPLIER, LON_MODULUS = 104729, 36000
SPARSE_DISCOUNT, SPARSE_MAX_TAX = 0.04, 0.02
BIG_PRICE_CUT = 30000.0
TRAIN_BUCKETS = 8  # of 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # nation (25 rows) and region (5 rows) are fixed-size by the schema's definition:
    # their broadcast is bounded whatever the scale factor.
    nat = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    reg = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    key = F.col("s_suppkey")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
            .join(reg, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(key.alias("airport_id"),
                    F.col("s_name").alias("airport_name"),
                    F.col("n_name").alias("country"),
                    F.col("r_name").alias("region"),
                    ((key * LAT_MULTIPLIER) % LAT_MODULUS).cast("double") / 100 - 85,
                    ((key * LON_MULTIPLIER) % LON_MODULUS).cast("double") / 100 - 180)
            .toDF("airport_id", "airport_name", "country", "region", "latitude", "longitude"))


def routes(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    """Route records (airline, source_airport_id, dest_airport_id, stops, l_discount, l_tax)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    n_airports = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    cond = F.col("l_quantity") == FULL_LOAD_QUANTITY
    if sparse:
        cond = cond & (F.col("l_discount") == SPARSE_DISCOUNT) & (F.col("l_tax") <= SPARSE_MAX_TAX)
    flights = li.where(cond).select("l_partkey", "l_suppkey", "l_discount", "l_tax")
    return (flights.join(part, flights.l_partkey == part.p_partkey)
            .select(F.col("p_brand").alias("airline"),
                    F.col("l_suppkey").alias("source_airport_id"),
                    (F.col("l_partkey") % n_airports).alias("dest_airport_id"),
                    F.lit(0).alias("stops"),
                    "l_discount", "l_tax"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, x, y, z, class) from the first three embedding components."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("id"),
                      F.col("embedding")[0].cast("double").alias("x"),
                      F.col("embedding")[1].cast("double").alias("y"),
                      F.col("embedding")[2].cast("double").alias("z"),
                      F.col("label").alias("class"))


def points_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_quantity, l_discount, l_extendedprice) per line item; one row per line item."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_quantity", "l_discount", "l_extendedprice")


def views(spark: SparkSession, sf_dir: str, full_loads_only: bool = True) -> DataFrame:
    """Viewing intervals with the reference's column names plus the split bucket.

    Columns: User_ID int, Stream_ID string, Streamer_Username string, Time_Start int,
    Time_Stop int, bucket int (0-9, train when < 8).
    """
    li = table(spark, sf_dir, "lineitem")
    if full_loads_only:
        li = li.where(F.col("l_quantity") == FULL_LOAD_QUANTITY)
    li = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .select(F.col("o_custkey").cast("int").alias("User_ID"),
                    F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("Stream_ID"),
                    F.col("l_suppkey").cast("string").alias("Streamer_Username"),
                    F.unix_date(F.to_date("o_orderdate")).alias("Time_Start"),
                    F.unix_date(F.to_date("l_shipdate")).alias("Time_Stop"),
                    ((F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17) % 10)
                    .cast("int").alias("bucket")))
