"""Text sources: route records rendered as text lines from ``lineitem`` (some
corrupted on purpose, chosen by line number), then parsed back.

The oracle does not parse text: it states the expected records straight from the
source columns, so it checks the parsers independently.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.plans.registry import register
from skein.session import ensure_checkpoint_dir, spread
from skein.operators.relational import require_not_null
from skein.sources import AIRPORTS_SCHEMA, POINTS_SCHEMA, ROUTES_SCHEMA, parse_lines, read_delimited
from skein.sources import testdata as td

# Which line numbers carry which defect.
SHIFTED_QUOTE_LINE = 4   # airline is a quoted text holding a comma
NULL_ID_LINE = 3         # airline id is the null token
BAD_ID_LINE = 7          # source airport id is not a number
SHORT_LINE = 6           # record cut after three fields
CODESHARE_LINE = 1       # codeshare "Y" (empty otherwise)
NO_EQUIPMENT_LINE = 2    # trailing empty equipment field


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def route_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = td.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                                "l_linenumber", "l_returnflag")
    n = F.col("l_linenumber")
    airline = F.when(n == SHIFTED_QUOTE_LINE, F.concat(F.lit('"B,'), "l_returnflag", F.lit('"'))) \
        .otherwise(F.concat(F.lit("A"), "l_returnflag"))
    airline_id = F.when(n == NULL_ID_LINE, F.lit("\\N")).otherwise(_s("l_orderkey"))
    src_id = F.when(n == BAD_ID_LINE, F.concat(F.lit("x"), _s("l_suppkey"))).otherwise(_s("l_suppkey"))
    fields = [airline, airline_id, F.concat(F.lit("P"), _s("l_partkey")), src_id,
              F.concat(F.lit("S"), _s("l_suppkey")), _s("l_partkey"),
              F.when(n == CODESHARE_LINE, F.lit("Y")).otherwise(F.lit("")),
              (n - 1).cast("string"),
              F.when(n == NO_EQUIPMENT_LINE, F.lit("")).otherwise(F.concat(F.lit("E"), n.cast("string")))]
    full = F.concat_ws(",", *fields)
    short = F.concat_ws(",", *fields[:3])
    return spread(li.select(F.when(n == SHORT_LINE, short).otherwise(full).alias("value")))


_LINES_SQL = r"""WITH src AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS n, l_returnflag,
    CASE WHEN l_linenumber = 4 THEN '"B,' || l_returnflag || '"' ELSE 'A' || l_returnflag END AS f1,
    CASE WHEN l_linenumber = 3 THEN '\N' ELSE CAST(l_orderkey AS VARCHAR) END AS f2,
    'P' || CAST(l_partkey AS VARCHAR) AS f3,
    CASE WHEN l_linenumber = 7 THEN 'x' || CAST(l_suppkey AS VARCHAR) ELSE CAST(l_suppkey AS VARCHAR) END AS f4
  FROM lineitem),
lines AS (SELECT *, CASE WHEN n = 6 THEN f1 || ',' || f2 || ',' || f3
  ELSE f1 || ',' || f2 || ',' || f3 || ',' || f4 || ',S' || CAST(l_suppkey AS VARCHAR) || ','
       || CAST(l_partkey AS VARCHAR) || ',' || CASE WHEN n = 1 THEN 'Y' ELSE '' END || ','
       || CAST(n - 1 AS VARCHAR) || ',' || CASE WHEN n = 2 THEN '' ELSE 'E' || CAST(n AS VARCHAR) END
  END AS line FROM src),
expected AS (SELECT
  CASE WHEN n = 4 THEN 'B,' || l_returnflag ELSE 'A' || l_returnflag END AS airline,
  CASE WHEN n = 3 THEN NULL ELSE l_orderkey END AS airline_id,
  'P' || CAST(l_partkey AS VARCHAR) AS source_airport, l_suppkey AS source_airport_id,
  'S' || CAST(l_suppkey AS VARCHAR) AS dest_airport, l_partkey AS dest_airport_id,
  CASE WHEN n = 1 THEN 'Y' ELSE NULL END AS codeshare, n - 1 AS stops,
  CASE WHEN n = 2 THEN NULL ELSE 'E' || CAST(n AS VARCHAR) END AS equipment, n
  FROM src)
"""


@register("parse_good", _LINES_SQL + "SELECT * EXCLUDE (n) FROM expected WHERE n NOT IN (6, 7)")
def q_parse_good(spark, sf):
    good, _ = parse_lines(route_lines(spark, sf), "route")
    return good


@register("parse_rejects", _LINES_SQL + """SELECT line, CASE WHEN n = 6
  THEN 'bad field: source_airport_id,dest_airport,dest_airport_id,codeshare,stops'
  ELSE 'bad field: source_airport_id' END AS reason FROM lines WHERE n IN (6, 7)""")
def q_parse_rejects(spark, sf):
    _, rejects = parse_lines(route_lines(spark, sf), "route")
    return rejects


@register("parse_good_unquoted", _LINES_SQL +
          "SELECT * EXCLUDE (n) FROM expected WHERE n NOT IN (4, 6, 7)")
def q_parse_good_unquoted(spark, sf):
    good, _ = parse_lines(route_lines(spark, sf), "route", quoted=False)
    return good


@register("scan_routes_text", _LINES_SQL + "SELECT * EXCLUDE (n) FROM expected WHERE n NOT IN (6, 7)")
def q_scan_routes_text(spark, sf):
    """Write the lines as a text data set in the shared checkpoint folder, then scan it
    with the schema-first delimited reader dropping malformed records."""
    folder = f"{ensure_checkpoint_dir(spark)}/skein-text-{uuid.uuid4().hex}"
    route_lines(spark, sf).write.mode("overwrite").text(folder)
    return read_delimited(spark, folder, ROUTES_SCHEMA, null_token="\\N", on_bad="drop")


@register("scan_routes_count", _LINES_SQL + "SELECT count(*) AS n FROM expected WHERE n NOT IN (6, 7)")
def q_scan_routes_count(spark, sf):
    """A bare count over the drop-malformed scan: it must equal the rows a full read
    returns (the reader keeps every column parsed, so malformed lines never count)."""
    return q_scan_routes_text(spark, sf).agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ airport and point layouts

# A line per customer; which keys carry which defect.
NO_IATA, QUOTED_NAME, NO_ZONE, BAD_LATITUDE, CUT = 3, 5, 7, 11, 13  # customer keys divisible by


def airport_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the airport layout, one per customer."""
    key = F.col("c_custkey")
    has = lambda n: key % n == 0
    latitude = F.concat((key % 170 - 85).cast("string"), F.lit(".5"))
    fields = [_s("c_custkey"),
              F.when(has(QUOTED_NAME), F.concat(F.lit('"Field, '), _s("c_custkey"), F.lit('"'))).otherwise(F.concat(F.lit("Field "), _s("c_custkey"))),
              F.concat(F.lit("City "), (key % 9).cast("string")), F.concat(F.lit("N"), _s("c_nationkey")),
              F.when(has(NO_IATA), F.lit("\\N")).otherwise(F.concat(F.lit("I"), (key % 100).cast("string"))),
              F.concat(F.lit("C"), _s("c_custkey")),
              F.when(has(BAD_LATITUDE), F.concat(F.lit("x"), latitude)).otherwise(latitude),
              F.concat((key % 360 - 180).cast("string"), F.lit(".25")), (key % 3000).cast("string"),
              F.when(has(NO_ZONE), F.lit("\\N")).otherwise((key % 24 - 12).cast("string")), F.lit("E"), F.lit("Zone/One"),
              F.lit("airport"), F.lit("made")]
    lines = td.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return lines.select(F.when(has(CUT), F.concat_ws(",", *fields[:5])).otherwise(F.concat_ws(",", *fields)).alias("value"))


_AIRPORTS_SQL = r"""WITH src AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer),
texts AS (SELECT k, CAST(k % 170 - 85 AS VARCHAR) || '.5' AS lat, CAST(k % 360 - 180 AS VARCHAR) || '.25' AS lon,
  CASE WHEN k % 5 = 0 THEN 'Field, ' ELSE 'Field ' END || k AS name, 'City ' || (k % 9) AS city, 'N' || n AS country,
  CASE WHEN k % 3 = 0 THEN NULL ELSE 'I' || (k % 100) END AS iata, 'C' || k AS icao,
  CAST(k % 3000 AS DOUBLE) AS altitude, CASE WHEN k % 7 = 0 THEN NULL ELSE k % 24 - 12 END AS zone FROM src),
good AS (SELECT *, CAST(lat AS DOUBLE) AS latitude, CAST(lon AS DOUBLE) AS longitude FROM texts WHERE k % 11 <> 0 AND k % 13 <> 0)
"""


@register("parse_airports", _AIRPORTS_SQL +
          "SELECT k AS id, name, city, country, iata, icao, latitude, longitude, altitude FROM good")
def q_parse_airports(spark, sf):
    return parse_lines(airport_lines(spark, sf), "airport")[0]


@register("parse_airports_extended", _AIRPORTS_SQL + """SELECT k AS id, name, city, country, latitude, longitude, altitude,
  CAST(zone AS INTEGER) AS timezone, 'E' AS dst FROM good""")
def q_parse_airports_extended(spark, sf):
    return parse_lines(airport_lines(spark, sf), "airport_extended")[0]


@register("parse_airports_rejects", _AIRPORTS_SQL + """SELECT CASE WHEN k % 13 = 0
  THEN 'bad field: icao,latitude,longitude,altitude' ELSE 'bad field: latitude' END AS reason, count(*) AS n
FROM src WHERE k % 11 = 0 OR k % 13 = 0 GROUP BY reason""")
def q_parse_airports_rejects(spark, sf):
    return parse_lines(airport_lines(spark, sf), "airport")[1].groupBy("reason").agg(F.count("*").alias("n"))


def _as_text(spark: SparkSession, lines: DataFrame) -> str:
    folder = f"{ensure_checkpoint_dir(spark)}/skein-text-{uuid.uuid4().hex}"
    lines.write.text(folder)
    return folder


@register("scan_airports_text", _AIRPORTS_SQL + """SELECT k AS airport_id, name AS airport_name, city, country, iata, icao,
  latitude, longitude, altitude, CAST(zone AS DOUBLE) AS timezone, 'E' AS dst, 'Zone/One' AS tz_timezone,
  'airport' AS airport_type, 'made' AS source FROM good""")
def q_scan_airports_text(spark, sf):
    return read_delimited(spark, _as_text(spark, airport_lines(spark, sf)), AIRPORTS_SCHEMA, null_token="\\N", on_bad="drop")


@register("scan_points_required", """SELECT CAST(l_partkey AS INTEGER) AS OSM_ID, CAST(l_suppkey % 360 - 180 AS DOUBLE) AS LONGITUDE,
  CAST(l_linenumber AS DOUBLE) AS LATITUDE, CAST(l_quantity AS DOUBLE) AS ALTITUDE FROM lineitem""")
def q_scan_points_required(spark, sf):
    """Points written as text and scanned with the point schema; a null in any column would fail the job."""
    li = td.table(spark, sf, "lineitem")
    lines = li.select(F.concat_ws(",", _s("l_partkey"), (F.col("l_suppkey") % 360 - 180).cast("string"), _s("l_linenumber"),
                                  F.col("l_quantity").cast("double").cast("string")).alias("value"))
    return require_not_null(read_delimited(spark, _as_text(spark, lines), POINTS_SCHEMA))
