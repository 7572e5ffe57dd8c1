"""SQL text of the stand-in views (see ``skein.sources.testdata``) for the oracles.

Each constant is one CTE body; ``with_views`` assembles the ones a query needs.
"""

from __future__ import annotations

AIRPORTS = """airports AS (
  SELECT s.s_suppkey AS airport_id, s.s_name AS airport_name, n.n_name AS country,
         r.r_name AS region,
         CAST((s.s_suppkey * 7919) % 17000 AS DOUBLE) / 100 - 85 AS latitude,
         CAST((s.s_suppkey * 104729) % 36000 AS DOUBLE) / 100 - 180 AS longitude
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_ROUTES_BODY = """
  SELECT p.p_brand AS airline, l.l_suppkey AS source_airport_id,
         l.l_partkey % (SELECT count(*) FROM supplier) AS dest_airport_id, 0 AS stops,
         l.l_discount, l.l_tax
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_quantity = 50{extra})"""

ROUTES = "routes AS (" + _ROUTES_BODY.format(extra="")
ROUTES_SPARSE = "routes_sparse AS (" + _ROUTES_BODY.format(
    extra=" AND l.l_discount = 0.04 AND l.l_tax <= 0.02")

_DIST_BODY = """
  SELECT r.source_airport_id, r.dest_airport_id, a.latitude AS src_lat, a.longitude AS src_lon,
         b.latitude AS dst_lat, b.longitude AS dst_lon, r.airline, r.stops,
         CASE WHEN a.latitude = b.latitude AND a.longitude = b.longitude THEN 0.0
              ELSE acos(least(1.0, greatest(-1.0,
                     sin(radians(a.latitude)) * sin(radians(b.latitude)) +
                     cos(radians(a.latitude)) * cos(radians(b.latitude)) *
                     cos(radians(b.longitude) - radians(a.longitude))))) * 6371.0 END AS distance
  FROM {src} r JOIN airports a ON r.source_airport_id = a.airport_id
       JOIN airports b ON r.dest_airport_id = b.airport_id)"""

ROUTE_DIST = "route_dist AS (" + _DIST_BODY.format(src="routes")
ROUTE_DIST_SPARSE = "route_dist_sparse AS (" + _DIST_BODY.format(src="routes_sparse")

GVERTS = """gverts AS (SELECT airport_id AS id, airport_name, country, region FROM airports)"""
GEDGES = """gedges AS (SELECT source_airport_id AS src, dest_airport_id AS dst, distance, airline
  FROM route_dist)"""
GEDGES_SPARSE = """gedges_sparse AS (SELECT source_airport_id AS src, dest_airport_id AS dst,
  distance, airline FROM route_dist_sparse)"""

VIEWS = """views AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS User_ID, 'S' || CAST(l.l_partkey AS VARCHAR) AS Stream_ID,
         CAST(l.l_suppkey AS VARCHAR) AS Streamer_Username,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o.o_orderdate AS DATE)) AS INTEGER) AS Time_Start,
         CAST(date_diff('day', DATE '1970-01-01', CAST(l.l_shipdate AS DATE)) AS INTEGER) AS Time_Stop,
         CAST((l.l_orderkey * 31 + l.l_linenumber * 17) % 10 AS INTEGER) AS bucket
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_quantity = 50)"""

CLEAN_VIEWS = """clean AS (
  SELECT User_ID, Stream_ID, Streamer_Username, Time_Start, Time_Stop,
         Time_Stop - Time_Start AS Duration, bucket
  FROM views
  WHERE Time_Stop - Time_Start > 0 AND User_ID IS NOT NULL AND Stream_ID IS NOT NULL
    AND Streamer_Username IS NOT NULL AND Time_Start IS NOT NULL AND Time_Stop IS NOT NULL)"""

POINTS = """points AS (
  SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
         CAST(embedding[3] AS DOUBLE) AS z, label AS class FROM embeddings)"""

_ORDER = [AIRPORTS, ROUTES, ROUTES_SPARSE, ROUTE_DIST, ROUTE_DIST_SPARSE, GVERTS, GEDGES,
          GEDGES_SPARSE, VIEWS, CLEAN_VIEWS, POINTS]
_DEPS = {
    ROUTE_DIST: [AIRPORTS, ROUTES], ROUTE_DIST_SPARSE: [AIRPORTS, ROUTES_SPARSE],
    GVERTS: [AIRPORTS], GEDGES: [ROUTE_DIST], GEDGES_SPARSE: [ROUTE_DIST_SPARSE],
    CLEAN_VIEWS: [VIEWS],
}


def with_views(*views: str, extra: str = "", recursive: bool = False) -> str:
    """``WITH`` clause holding the given views, their dependencies, then ``extra`` CTEs."""
    need: set[str] = set()

    def add(v: str) -> None:
        if v not in need:
            need.add(v)
            for d in _DEPS.get(v, []):
                add(d)
    for v in views:
        add(v)
    ctes = [v for v in _ORDER if v in need]
    if extra:
        ctes.append(extra)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"
