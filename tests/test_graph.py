"""Hand-computed mini flight graph (FIXTURES.md 3.1)."""

import pytest
from pyspark.sql import functions as F

from skein.operators import graph as G
from skein.operators.routes import routes_with_distance

COUNTRIES = {1: "PL", 2: "PL", 3: "DE", 4: "BE", 5: "BE", 6: "X", 7: "X", 8: "X", 9: "X"}
EDGES = [("A", 1, 4), ("B", 1, 4), ("A", 1, 3), ("A", 3, 4), ("A", 2, 3), ("B", 3, 5),
         ("C", 6, 7), ("C", 7, 6), ("D", 9, 9), ("E", 1, None), ("E", 1, 99)]


@pytest.fixture(scope="module")
def g(spark):
    airports = spark.createDataFrame(
        [(i, f"air{i}", c, float(i), float(i * 2)) for i, c in COUNTRIES.items()],
        "airport_id long, airport_name string, country string, latitude double, longitude double")
    routes = spark.createDataFrame([(a, s, d, 0) for a, s, d in EDGES],
                                   "airline string, source_airport_id long, dest_airport_id long, stops int")
    return G.graph_from_routes(airports, routes_with_distance(routes, airports),
                               vertex_attrs=("airport_name", "country"))


def _pairs(df, a, b):
    return sorted((r[a], r[b]) for r in df.collect())


def test_usable_edges(g):
    assert g.edges.count() == 9


def test_direct_and_one_transfer(g):
    pl, be = F.col("country") == "PL", F.col("country") == "BE"
    assert G.direct(g, pl, be).count() == 2
    m = G.motif(g, [("a", "e", "c")], where={"a": pl, "c": be})
    assert m.columns == ["a", "e", "c"] and m.count() == 2
    two = G.motif(g, [("a", "e1", "b"), ("b", "e2", "c")], where={"a": pl, "c": be})
    got = sorted((r.a.id, r.b.id, r.c.id) for r in two.collect())
    assert got == [(1, 3, 4), (1, 3, 5), (2, 3, 4), (2, 3, 5)]
    legs = G.two_leg(g, pl, be).collect()
    assert sorted((r.src, r.via, r.dst) for r in legs) == got


def test_degrees_and_extremes(g):
    deg = dict(_pairs(G.degrees(g), "id", "degree"))
    assert deg == {1: 3, 2: 1, 3: 4, 4: 3, 5: 1, 6: 2, 7: 2, 9: 2}
    assert G.busiest(g).first().asDict() == {"id": 3, "degree": 4}
    assert G.quietest(g).first().asDict() == {"id": 2, "degree": 1}
    iso = dict(_pairs(G.degrees(g, include_isolated=True), "id", "degree"))
    assert iso[8] == 0


def test_simple_paths(g):
    paths = sorted(tuple(r.path) for r in G.simple_paths(g, 1, 4).collect())
    assert paths == [(1, 3, 4), (1, 4)]
    same = G.simple_paths(g, 1, 1).collect()
    assert [tuple(r.path) for r in same] == [(1,)] and same[0].distance == 0.0
    assert G.simple_paths(g, 1, 8).count() == 0
    assert list(G.shortest_path(g, 1, 4).first().path) in ([1, 4], [1, 3, 4])


def test_simple_paths_brute_force(spark):
    # random small multigraph: compare with a plain depth-first enumeration
    import random
    rnd = random.Random(3)
    edges = [(rnd.randint(0, 7), rnd.randint(0, 7), float(rnd.randint(1, 9))) for _ in range(30)]
    v = spark.createDataFrame([(i,) for i in range(8)], "id long")
    e = spark.createDataFrame(edges, "src long, dst long, distance double")
    gr = G.Graph(v, e)
    w = {}
    for s, d, x in edges:
        if s != d:
            w[(s, d)] = min(x, w.get((s, d), x))
    out = {}

    def dfs(path, dist):
        if path[-1] == 6 and len(path) > 1:
            out[tuple(path)] = dist
            return
        if len(path) > 4:
            return
        for (s, d), x in w.items():
            if s == path[-1] and d not in path:
                dfs(path + [d], dist + x)
    dfs([0], 0.0)
    got = {tuple(r.path): r.distance for r in G.simple_paths(gr, 0, 6, 4).collect()}
    assert got == out


@pytest.mark.parametrize("max_edges", [1, 2, 3, 5, 6])
def test_paths_of_any_length_and_vertex_sets(spark, max_edges):
    import random
    rnd = random.Random(max_edges)
    pairs = sorted({(rnd.randint(0, 8), rnd.randint(0, 8)) for _ in range(26)})
    gr = G.Graph(spark.createDataFrame([(i, "s" if i < 2 else "t" if i > 6 else "m") for i in range(9)], "id long, kind string"),
                 spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src long, dst long, distance double"))

    def walk(path, ends, through):
        if len(path) > 1 and path[-1] in ends:
            yield tuple(path)
            if not through:
                return
        if len(path) <= max_edges:
            for a, b in pairs:
                if a == path[-1] and b not in path:
                    yield from walk([*path, b], ends, through)

    one = [tuple(r.path) for r in G.simple_paths(gr, 0, 8, max_edges).collect()]
    assert sorted(one) == sorted(walk([0], {8}, False))
    found = G.simple_paths(gr, F.col("kind") == "s", F.col("kind") == "t", max_edges).collect()
    assert sorted(tuple(r.path) for r in found) == sorted(p for s in (0, 1) for p in walk([s], {7, 8}, True))
    assert all(r.n_edges == len(r.path) - 1 == r.distance for r in found)


def test_components_of_a_power_law_graph_with_a_hub(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    n = 3000
    edges = [(7, int(x)) for x in rng.integers(0, n, 2000)]  # a third of all edges
    edges += [(int(a), int(b)) for a, b in zip((rng.random(4000) ** 3 * n * 4).astype(int), rng.integers(0, 4 * n, 4000))]
    gr = G.Graph(spark.range(4 * n), spark.createDataFrame(edges, "src long, dst long").repartition(6))
    parent = list(range(4 * n))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert dict(_pairs(G.components(gr), "id", "component")) == {i: find(i) for i in range(4 * n)}
    # of the rows that are shuffled to the first round's join none has the hub's key
    ends = spark.createDataFrame([(7, 2000), (8, 1), (9, 1999)], "u long, n long")
    assert [r.u for r in G._hubs(ends, "n", 8000).collect()] == []
    assert sorted(r.u for r in G._hubs(ends, "n", 4000).collect()) == [7, 9]
    assert G.components(G.Graph(spark.range(3), gr.edges.limit(0))).where("id <> component").count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_of_hubs_are_followed_in_the_same_pass_as_all_others(spark, kind):
    rows = [(1, x) for x in range(50)] + [(2, 1), (3, 2), (3, 2)]
    to = {1: 0, 2: 7, 3: 2}
    edges = spark.createDataFrame(rows, "a long, b long").select(F.col("a").cast(kind), F.col("b").cast(kind))
    pointers = spark.createDataFrame(list(to.items()), "u long, to long").select(F.col("u").cast(kind), F.col("to").cast(kind))
    got = G._follow(edges, pointers, "a", spark.createDataFrame([(1,)], "u long").select(F.col("u").cast(kind)))
    assert got.columns == ["a", "b"] and got.dtypes == edges.dtypes
    assert sorted((int(r.a), int(r.b)) for r in got.collect()) == sorted((to[a], b) for a, b in rows)
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()  # which would plan the rows twice


@pytest.mark.parametrize("rounds", [1, 2, 3, 7])
def test_label_propagation_by_changes_equals_plain_rounds(spark, rounds):
    import random
    from collections import Counter
    rnd = random.Random(rounds)
    edges = [(rnd.randint(0, 59), rnd.randint(0, 59)) for _ in range(90)] + [(0, i) for i in range(40)] + [(99, 1), (5, 98)]
    gr = G.Graph(spark.range(60), spark.createDataFrame(edges, "src long, dst long"))
    label = {i: i for i in range(60)}
    for _ in range(rounds):
        seen = {i: Counter() for i in range(60)}
        for a, b in set(edges):
            for x, y in ((a, b), (b, a)):
                if x in label and y in seen:
                    seen[y][label[x]] += 1
        label = {i: min(c, key=lambda v: (-c[v], v)) if c else label[i] for i, c in seen.items()}
    assert dict(_pairs(G.label_propagation(gr, rounds), "id", "label")) == label


def test_components_and_clusters(g):
    comp = dict(_pairs(G.components(g), "id", "component"))
    assert comp == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 6, 7: 6, 8: 8, 9: 9}
    labels = G.components(g)
    assert _pairs(G.clusters(labels, "component", 5), "cluster", "size") == [(1, 5)]
    assert sorted(r.cluster for r in G.isolated(g, labels, "component", 2).collect()) == [1, 6]
    assert [r.cluster for r in G.isolated(g, g.vertices, "country", 2).collect()] == ["X"]
    members = G.cluster_members(labels, "component", 5)
    assert sorted(r.id for r in members.collect()) == [1, 2, 3, 4, 5]


def test_components_long_chain(spark):
    n = 200
    v = spark.range(n).select(F.col("id"))
    # a path 0-1-2-...-(n-1) written in scrambled orientation plus a second chain
    e = spark.range(n - 1).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") + 1).alias("src"),
        F.when(F.col("id") % 2 == 0, F.col("id") + 1).otherwise(F.col("id")).alias("dst"))
    e = e.where(F.col("src") != 120).where(F.col("dst") != 120)
    comp = dict(_pairs(G.components(G.Graph(v, e)), "id", "component"))
    assert all(comp[i] == 0 for i in range(120))
    assert comp[120] == 120
    assert all(comp[i] == 121 for i in range(121, n))


def test_label_propagation(g):
    lab = dict(_pairs(G.label_propagation(g, 5), "id", "label"))
    assert lab == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 7, 7: 6, 8: 8, 9: 9}


def test_triplets_and_neighbors(g, spark):
    t = G.triplets(g)
    assert t.count() == 9 and "src_country" in t.columns and "dst_country" in t.columns
    ids = spark.createDataFrame([(1,)], "id long")
    assert sorted(r.neighbor for r in G.neighbors(g, ids).collect()) == [3, 4, 4]


def test_paths_between_vertex_sets(g):
    pl, be = F.col("country") == "PL", F.col("country") == "BE"
    got = sorted(tuple(r.path) for r in G.simple_paths(g, pl, be, max_edges=3).collect())
    assert got == [(1, 3, 4), (1, 3, 5), (1, 4), (2, 3, 4), (2, 3, 5)]
    assert G.simple_paths(g, pl, be, max_edges=1).count() == 1


def test_hub_graph_against_python(spark):
    """A hub holding over a third of all edges: label propagation and components match a
    plain simulation (exercises the hot-key split of skew_join)."""
    import random
    rnd = random.Random(11)
    n = 120
    edges = [(0, rnd.randint(1, n - 1)) for _ in range(150)]           # hub 0
    edges += [(rnd.randint(1, n - 1), rnd.randint(1, n - 1)) for _ in range(200)]
    edges += [(130, 131), (131, 132)]                                    # separate chain
    ids = list(range(n)) + [130, 131, 132, 140]                          # 140 isolated
    v = spark.createDataFrame([(i,) for i in ids], "id long")
    e = spark.createDataFrame(edges, "src long, dst long")
    gr = G.Graph(v, e)

    pairs = sorted(set(edges))
    labels = {i: i for i in ids}
    for _ in range(5):
        counts = {}
        for s, d in pairs:
            counts.setdefault(d, {}).setdefault(labels[s], 0)
            counts[d][labels[s]] += 1
            counts.setdefault(s, {}).setdefault(labels[d], 0)
            counts[s][labels[d]] += 1
        labels = {i: (min(c, key=lambda lab: (-c[lab], lab)) if (c := counts.get(i)) else labels[i])
                  for i in ids}
    assert dict(_pairs(G.label_propagation(gr, 5), "id", "label")) == labels

    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for s, d in edges:
        a, b = find(s), find(d)
        if a != b:
            parent[max(a, b)] = min(a, b)
    want = {}
    for i in ids:
        want[i] = min(j for j in ids if find(j) == find(i))
    assert dict(_pairs(G.components(gr), "id", "component")) == want
