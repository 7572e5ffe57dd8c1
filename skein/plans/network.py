"""Route and graph queries (carrier totals, itineraries, degrees, paths, clusters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.operators import graph as G
from skein.operators.relational import arg_top
from skein.operators.routes import carrier_extreme, carrier_totals, routes_with_distance
from skein.plans import views_sql as V
from skein.plans.registry import register
from skein.sources import testdata as td

# Fixed query parameters (the reference asks the same questions of its own airports).
SRC_REGION, DST_REGION = "AFRICA", "ASIA"
NEIGHBOR_REGION = "EUROPE"
PATH_SOURCE, PATH_TARGET, PATH_MAX_EDGES = 1, 5, 4
LARGE_CLUSTER, ISOLATED_MIN = 5, 2
LPA_ROUNDS = 5
MAX_TRANSFERS = 2  # the task text: at most two transfers (three flights)


def route_dist(spark: SparkSession, sf: str, sparse: bool = False) -> DataFrame:
    return routes_with_distance(td.routes(spark, sf, sparse=sparse), td.airports(spark, sf))


def flight_graph(spark: SparkSession, sf: str, sparse: bool = False) -> G.Graph:
    return G.graph_from_routes(td.airports(spark, sf), route_dist(spark, sf, sparse))


def _r3(c: str) -> F.Column:
    return F.round(F.col(c), 3).alias(c)


# ------------------------------------------------------------------ routes and carriers

@register("route_distance", V.with_views(V.ROUTE_DIST) + """
SELECT source_airport_id, dest_airport_id, src_lat, src_lon, dst_lat, dst_lon, airline, stops,
       round(distance, 3) AS distance FROM route_dist""")
def q_route_distance(spark, sf):
    d = route_dist(spark, sf)
    return d.select(*[c for c in d.columns if c != "distance"], _r3("distance"))


@register("route_count", V.with_views(V.ROUTE_DIST) + "SELECT count(*) AS n FROM route_dist")
def q_route_count(spark, sf):
    return route_dist(spark, sf).agg(F.count("*").alias("n"))


@register("carrier_total", V.with_views(V.ROUTE_DIST) + """
SELECT airline, round(sum(distance), 3) AS total_distance FROM route_dist GROUP BY airline""")
def q_carrier_total(spark, sf):
    return carrier_totals(route_dist(spark, sf)).select("airline", _r3("total_distance"))


_CARRIER_EXTREME_SQL = V.with_views(V.ROUTE_DIST) + """
SELECT airline, round(total_distance, 3) AS total_distance FROM (
  SELECT airline, sum(distance) AS total_distance FROM route_dist GROUP BY airline)
ORDER BY total_distance {dir}, airline LIMIT 1"""


@register("carrier_max", _CARRIER_EXTREME_SQL.format(dir="DESC"))
def q_carrier_max(spark, sf):
    return carrier_extreme(route_dist(spark, sf), largest=True).select("airline", _r3("total_distance"))


@register("carrier_min", _CARRIER_EXTREME_SQL.format(dir="ASC"))
def q_carrier_min(spark, sf):
    return carrier_extreme(route_dist(spark, sf), largest=False).select("airline", _r3("total_distance"))


# ------------------------------------------------------------------ itineraries

@register("itinerary_direct", V.with_views(V.GVERTS, V.GEDGES) + f"""
SELECT e.src, e.dst, round(e.distance, 3) AS distance, e.airline
FROM gedges e JOIN gverts a ON e.src = a.id JOIN gverts c ON e.dst = c.id
WHERE a.region = '{SRC_REGION}' AND c.region = '{DST_REGION}'""")
def q_itinerary_direct(spark, sf):
    g = flight_graph(spark, sf)
    m = G.motif(g, [("a", "e", "c")], where={"a": F.col("region") == SRC_REGION,
                                             "c": F.col("region") == DST_REGION})
    return m.select(F.col("e.src").alias("src"), F.col("e.dst").alias("dst"),
                    F.round("e.distance", 3).alias("distance"), F.col("e.airline").alias("airline"))


@register("itinerary_one_transfer", V.with_views(V.GVERTS, V.GEDGES) + f"""
SELECT a.id AS a_id, b.id AS b_id, c.id AS c_id, e1.airline AS e1_airline,
       e2.airline AS e2_airline, round(e1.distance, 3) AS e1_distance,
       round(e2.distance, 3) AS e2_distance, a.country AS a_country, c.country AS c_country
FROM gedges e1 JOIN gedges e2 ON e1.dst = e2.src
     JOIN gverts a ON e1.src = a.id JOIN gverts b ON e1.dst = b.id JOIN gverts c ON e2.dst = c.id
WHERE a.region = '{SRC_REGION}' AND c.region = '{DST_REGION}'""")
def q_itinerary_one_transfer(spark, sf):
    g = flight_graph(spark, sf)
    m = G.motif(g, [("a", "e1", "b"), ("b", "e2", "c")],
                where={"a": F.col("region") == SRC_REGION, "c": F.col("region") == DST_REGION})
    return m.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"),
                    F.col("c.id").alias("c_id"), F.col("e1.airline").alias("e1_airline"),
                    F.col("e2.airline").alias("e2_airline"),
                    F.round("e1.distance", 3).alias("e1_distance"),
                    F.round("e2.distance", 3).alias("e2_distance"),
                    F.col("a.country").alias("a_country"), F.col("c.country").alias("c_country"))


@register("two_leg_distance", V.with_views(V.GVERTS, V.GEDGES) + f"""
SELECT e1.src, e1.dst AS via, e2.dst, round(e1.distance + e2.distance, 3) AS distance
FROM gedges e1 JOIN gedges e2 ON e1.dst = e2.src
WHERE e1.src IN (SELECT id FROM gverts WHERE region = '{SRC_REGION}')
  AND e2.dst IN (SELECT id FROM gverts WHERE region = '{DST_REGION}')""")
def q_two_leg(spark, sf):
    g = flight_graph(spark, sf)
    t = G.two_leg(g, F.col("region") == SRC_REGION, F.col("region") == DST_REGION)
    return t.select("src", "via", "dst", _r3("distance"))


@register("triplets", V.with_views(V.GVERTS, V.GEDGES) + """
SELECT e.src, e.dst, round(e.distance, 3) AS distance, e.airline,
       s.airport_name AS src_airport_name, s.country AS src_country, s.region AS src_region,
       d.airport_name AS dst_airport_name, d.country AS dst_country, d.region AS dst_region
FROM gedges e JOIN gverts s ON e.src = s.id JOIN gverts d ON e.dst = d.id""")
def q_triplets(spark, sf):
    t = G.triplets(flight_graph(spark, sf))
    return t.select("src", "dst", _r3("distance"), "airline", "src_airport_name", "src_country",
                    "src_region", "dst_airport_name", "dst_country", "dst_region")


@register("neighbors", V.with_views(V.GVERTS, V.GEDGES) + f"""
SELECT e.src AS id, e.dst AS neighbor, e.airline, round(e.distance, 3) AS distance
FROM gedges e WHERE e.src IN (SELECT id FROM gverts WHERE region = '{NEIGHBOR_REGION}')""")
def q_neighbors(spark, sf):
    g = flight_graph(spark, sf)
    ids = g.vertices.where(F.col("region") == NEIGHBOR_REGION).select("id")
    return G.neighbors(g, ids).select("id", "neighbor", "airline", _r3("distance"))


# ------------------------------------------------------------------ degrees

_DEG_CTE = """deg AS (
  SELECT id, CAST(sum(n) AS BIGINT) AS degree FROM (
    SELECT src AS id, count(*) AS n FROM gedges GROUP BY src
    UNION ALL SELECT dst AS id, count(*) AS n FROM gedges GROUP BY dst) GROUP BY id)"""


@register("degrees", V.with_views(V.GEDGES, extra=_DEG_CTE) + "SELECT id, degree FROM deg")
def q_degrees(spark, sf):
    return G.degrees(flight_graph(spark, sf))


@register("in_degrees", V.with_views(V.GEDGES) +
          "SELECT dst AS id, count(*) AS in_degree FROM gedges GROUP BY dst")
def q_in_degrees(spark, sf):
    return G.in_degrees(flight_graph(spark, sf))


@register("out_degrees", V.with_views(V.GEDGES) +
          "SELECT src AS id, count(*) AS out_degree FROM gedges GROUP BY src")
def q_out_degrees(spark, sf):
    return G.out_degrees(flight_graph(spark, sf))


@register("busiest", V.with_views(V.GEDGES, extra=_DEG_CTE) +
          "SELECT id, degree FROM deg ORDER BY degree DESC, id LIMIT 1")
def q_busiest(spark, sf):
    return G.busiest(flight_graph(spark, sf))


@register("quietest", V.with_views(V.GEDGES, extra=_DEG_CTE) +
          "SELECT id, degree FROM deg ORDER BY degree ASC, id LIMIT 1")
def q_quietest(spark, sf):
    return G.quietest(flight_graph(spark, sf))


# ------------------------------------------------------------------ bounded paths

_WALK_CTE = f"""se AS (SELECT src, dst, min(distance) AS w FROM gedges WHERE src <> dst GROUP BY src, dst),
walk(path, last, d, n) AS (
  SELECT [CAST(id AS BIGINT)], CAST(id AS BIGINT), CAST(0.0 AS DOUBLE), 0 FROM gverts WHERE id = {PATH_SOURCE}
  UNION ALL
  SELECT list_append(w.path, se.dst), se.dst, w.d + se.w, w.n + 1
  FROM walk w JOIN se ON w.last = se.src
  WHERE w.n < {PATH_MAX_EDGES} AND w.last <> {PATH_TARGET} AND NOT list_contains(w.path, se.dst)),
paths AS (SELECT path, n AS n_edges, d AS distance FROM walk WHERE last = {PATH_TARGET})"""


def _paths_sql(order: str | None) -> str:
    body = ("SELECT array_to_string(path, '->') AS path, n_edges, round(distance, 3) AS distance "
            "FROM paths")
    if order:
        body += f" ORDER BY distance {order}, n_edges, path LIMIT 1"
    return V.with_views(V.GVERTS, V.GEDGES, extra=_WALK_CTE, recursive=True) + body


def _path_text(df: DataFrame) -> DataFrame:
    return df.select(F.array_join("path", "->").alias("path"), "n_edges", _r3("distance"))


@register("paths_upto4", _paths_sql(None))
def q_paths(spark, sf):
    g = flight_graph(spark, sf)
    return _path_text(G.simple_paths(g, PATH_SOURCE, PATH_TARGET, PATH_MAX_EDGES))


@register("shortest_path", _paths_sql("ASC"))
def q_shortest(spark, sf):
    g = flight_graph(spark, sf)
    return _path_text(G.shortest_path(g, PATH_SOURCE, PATH_TARGET, PATH_MAX_EDGES))


@register("longest_path", _paths_sql("DESC"))
def q_longest(spark, sf):
    g = flight_graph(spark, sf)
    return _path_text(G.longest_path(g, PATH_SOURCE, PATH_TARGET, PATH_MAX_EDGES))


_TRANSFERS_CTE = f"""se AS (SELECT src, dst, min(distance) AS w FROM gedges WHERE src <> dst GROUP BY src, dst),
walk(path, last, d, n) AS (
  SELECT [CAST(id AS BIGINT)], CAST(id AS BIGINT), CAST(0.0 AS DOUBLE), 0 FROM gverts
  WHERE region = '{SRC_REGION}'
  UNION ALL
  SELECT list_append(w.path, se.dst), se.dst, w.d + se.w, w.n + 1
  FROM walk w JOIN se ON w.last = se.src
  WHERE w.n < {MAX_TRANSFERS + 1} AND NOT list_contains(w.path, se.dst))"""


@register("itinerary_upto2_transfers",
          V.with_views(V.GVERTS, V.GEDGES, extra=_TRANSFERS_CTE, recursive=True) + f"""
SELECT array_to_string(path, '->') AS path, n AS n_edges, round(d, 3) AS distance FROM walk
WHERE n >= 1 AND last IN (SELECT id FROM gverts WHERE region = '{DST_REGION}')""")
def q_itinerary_upto2(spark, sf):
    g = flight_graph(spark, sf)
    p = G.simple_paths(g, F.col("region") == SRC_REGION, F.col("region") == DST_REGION,
                       max_edges=MAX_TRANSFERS + 1)
    return _path_text(p)


# ------------------------------------------------------------------ components

_REACH_CTE = """und AS (SELECT src AS a, dst AS b FROM gedges_sparse WHERE src <> dst
              UNION SELECT dst AS a, src AS b FROM gedges_sparse WHERE src <> dst),
reach(a, b) AS (SELECT id, id FROM gverts
                UNION SELECT r.a, u.b FROM reach r JOIN und u ON r.b = u.a),
comp AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)"""


def _comp_sql(body: str) -> str:
    return V.with_views(V.GVERTS, V.GEDGES_SPARSE, extra=_REACH_CTE, recursive=True) + body


@register("components", _comp_sql("SELECT id, component FROM comp"))
def q_components(spark, sf):
    return G.components(flight_graph(spark, sf, sparse=True))


@register("component_sizes", _comp_sql(
    "SELECT component AS cluster, count(*) AS size FROM comp GROUP BY component"))
def q_component_sizes(spark, sf):
    return G.clusters(G.components(flight_graph(spark, sf, sparse=True)), "component")


@register("large_components", _comp_sql(
    f"SELECT component AS cluster, count(*) AS size FROM comp GROUP BY component "
    f"HAVING count(*) >= {LARGE_CLUSTER}"))
def q_large_components(spark, sf):
    return G.clusters(G.components(flight_graph(spark, sf, sparse=True)), "component", LARGE_CLUSTER)


@register("large_component_members", _comp_sql(
    f"SELECT component AS cluster, id FROM comp WHERE component IN (SELECT component FROM comp "
    f"GROUP BY component HAVING count(*) >= {LARGE_CLUSTER})"))
def q_large_component_members(spark, sf):
    labels = G.components(flight_graph(spark, sf, sparse=True))
    return G.cluster_members(labels, "component", LARGE_CLUSTER)


@register("isolated_components", _comp_sql(f"""
SELECT component AS cluster, count(*) AS size FROM comp
WHERE component NOT IN (
  SELECT x.component FROM gedges_sparse e JOIN comp x ON e.src = x.id JOIN comp y ON e.dst = y.id
  WHERE x.component <> y.component)
GROUP BY component HAVING count(*) >= {ISOLATED_MIN}"""))
def q_isolated_components(spark, sf):
    g = flight_graph(spark, sf, sparse=True)
    return G.isolated(g, G.components(g), "component", ISOLATED_MIN)


@register("isolated_countries", V.with_views(V.GVERTS, V.GEDGES) + f"""
SELECT country AS cluster, count(*) AS size FROM gverts
WHERE country NOT IN (
  SELECT s.country FROM gedges e JOIN gverts s ON e.src = s.id JOIN gverts d ON e.dst = d.id
  WHERE s.country <> d.country
  UNION SELECT d.country FROM gedges e JOIN gverts s ON e.src = s.id JOIN gverts d ON e.dst = d.id
  WHERE s.country <> d.country)
GROUP BY country HAVING count(*) >= {ISOLATED_MIN}""")
def q_isolated_countries(spark, sf):
    g = flight_graph(spark, sf)
    return G.isolated(g, g.vertices, "country", ISOLATED_MIN)


# ------------------------------------------------------------------ label propagation

def _lpa_ctes(rounds: int) -> str:
    ctes = ["pairs AS (SELECT DISTINCT src, dst FROM gedges)",
            "msg AS (SELECT src AS f, dst AS t FROM pairs UNION ALL SELECT dst AS f, src AS t FROM pairs)",
            "l0 AS (SELECT id, id AS label FROM gverts)"]
    for r in range(1, rounds + 1):
        p = f"l{r - 1}"
        ctes.append(f"""l{r} AS (
  SELECT v.id, COALESCE(b.label, v.label) AS label FROM {p} v LEFT JOIN (
    SELECT id, label FROM (
      SELECT m.t AS id, l.label, row_number() OVER (
        PARTITION BY m.t ORDER BY count(*) DESC, l.label ASC) AS rn
      FROM msg m JOIN {p} l ON m.f = l.id GROUP BY m.t, l.label) WHERE rn = 1) b ON v.id = b.id)""")
    return ",\n".join(ctes)


_LPA_SQL = V.with_views(V.GVERTS, V.GEDGES, extra=_lpa_ctes(LPA_ROUNDS))
_LAST = f"l{LPA_ROUNDS}"


@register("label_propagation", _LPA_SQL + f"SELECT id, label FROM {_LAST}")
def q_label_propagation(spark, sf):
    return G.label_propagation(flight_graph(spark, sf), LPA_ROUNDS)


@register("lpa_clusters", _LPA_SQL + f"""SELECT label AS cluster, count(*) AS size FROM {_LAST}
GROUP BY label HAVING count(*) >= {LARGE_CLUSTER}""")
def q_lpa_clusters(spark, sf):
    labels = G.label_propagation(flight_graph(spark, sf), LPA_ROUNDS)
    return G.clusters(labels, "label", LARGE_CLUSTER)
