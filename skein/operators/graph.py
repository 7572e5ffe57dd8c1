"""Property-graph operators on a vertex DataFrame and an edge DataFrame.

A graph is ``Graph(vertices(id, ...), edges(src, dst, ...))``: a directed multigraph.
Every operator is a plan of joins and aggregates; iterative ones (components, label
propagation) checkpoint each round to the session's reliable checkpoint folder, so a
lost executor costs one round, never the whole lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators.relational import HOT_SHARE, arg_top, hot_keys, skew_join
from skein.session import default_parallelism, ensure_checkpoint_dir, materialize, release


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame
    edges: DataFrame

    def __post_init__(self):
        if "id" not in self.vertices.columns:
            raise ValueError("vertices need an 'id' column")
        missing = {"src", "dst"} - set(self.edges.columns)
        if missing:
            raise ValueError(f"edges need columns {sorted(missing)}")


def graph_from_routes(airports: DataFrame, route_dist: DataFrame,
                      vertex_attrs: Sequence[str] = ("airport_name", "country", "region"),
                      edge_attrs: Sequence[str] = ("distance", "airline")) -> Graph:
    """Airports as vertices, enriched routes as edges (ids as long)."""
    v = airports.select(F.col("airport_id").cast("long").alias("id"),
                        *[a for a in vertex_attrs if a in airports.columns])
    e = route_dist.select(F.col("source_airport_id").cast("long").alias("src"),
                          F.col("dest_airport_id").cast("long").alias("dst"), *edge_attrs)
    return Graph(v, e)


# --------------------------------------------------------------------------- one pass

def triplets(g: Graph) -> DataFrame:
    """Each edge with the attributes of both endpoints (``src_*`` / ``dst_*`` prefixes)."""
    attrs = [c for c in g.vertices.columns if c != "id"]
    s = g.vertices.select(F.col("id").alias("__sid"), *[F.col(a).alias(f"src_{a}") for a in attrs])
    d = g.vertices.select(F.col("id").alias("__did"), *[F.col(a).alias(f"dst_{a}") for a in attrs])
    return (g.edges.join(s, F.col("src") == F.col("__sid"))
            .join(d, F.col("dst") == F.col("__did")).drop("__sid", "__did"))


def out_degrees(g: Graph) -> DataFrame:
    return g.edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_degree"))


def in_degrees(g: Graph) -> DataFrame:
    return g.edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_degree"))


def degrees(g: Graph, include_isolated: bool = False) -> DataFrame:
    """(id, degree) = in + out edges; a self-loop counts twice.

    One pass over the edges: each edge yields both endpoints, counted with partial
    (per-task) aggregation before the shuffle, so a hub vertex sends one row per task,
    not one per edge. Vertices without edges are absent unless ``include_isolated``.
    """
    deg = (g.edges.select(F.explode(F.array("src", "dst")).alias("id"))
           .groupBy("id").agg(F.count("*").alias("degree")))
    if include_isolated:
        deg = (g.vertices.select("id").join(deg, "id", "left")
               .select("id", F.coalesce("degree", F.lit(0)).cast("long").alias("degree")))
    return deg


def busiest(g: Graph, k: int = 1) -> DataFrame:
    return arg_top(degrees(g), "degree", k=k, desc=True, tie=["id"])


def quietest(g: Graph, k: int = 1) -> DataFrame:
    return arg_top(degrees(g), "degree", k=k, desc=False, tie=["id"])


def neighbors(g: Graph, ids: DataFrame) -> DataFrame:
    """(id, neighbor, edge attrs...) for every out-edge of the vertices in ``ids(id)``."""
    keys = ids.select(F.col("id").alias("src")).distinct()
    return (g.edges.join(keys, "src", "left_semi")
            .withColumnRenamed("src", "id").withColumnRenamed("dst", "neighbor"))


def motif(g: Graph, pattern: Sequence[tuple[str, str, str]],
          where: dict[str, Column] | None = None) -> DataFrame:
    """Match a chain pattern such as ``[("a", "e1", "b"), ("b", "e2", "c")]``.

    Output: one struct column per name, in pattern order. ``where`` maps a vertex name
    to a predicate over vertex columns; it is applied to the vertex table before any
    join, and each edge triple is joined with its filtered endpoints before triples are
    joined together, so the filtered ends shrink the edge sets first. Rows multiply
    over parallel edges (multigraph semantics); names need not bind distinct vertices.
    """
    where = where or {}
    vcols, ecols = g.vertices.columns, g.edges.columns
    order: list[str] = []
    for a, e, b in pattern:
        for n in (a, e, b):
            if n not in order:
                order.append(n)
    vertex_names = [n for n in order if any(n in (a, b) for a, _, b in pattern)]

    def vtab(name: str) -> DataFrame:
        v = g.vertices.where(where[name]) if name in where else g.vertices
        return v.select(F.col("id").alias(f"__{name}"), F.struct(*vcols).alias(name))

    parts = []
    for a, e, b in pattern:
        t = g.edges.select(F.col("src").alias(f"__{a}"),
                           F.col("dst").alias(f"__{b}" if b != a else "__self"),
                           F.struct(*ecols).alias(e))
        if b == a:
            t = t.where(F.col(f"__{a}") == F.col("__self")).drop("__self")
        for n in dict.fromkeys((a, b)):
            if n in where:
                t = t.join(vtab(n), f"__{n}")
        parts.append((t, {a, b}))

    result, bound = parts[0]
    joined = {n for n in bound if n in where}
    for t, names in parts[1:]:
        shared = [f"__{n}" for n in names if n in bound]
        if not shared:
            raise ValueError("pattern must be connected: each triple shares a vertex with the ones before")
        dup = [n for n in names if n in bound and n in where]
        t = t.drop(*dup)  # already carried by ``result``
        result = result.join(t, shared)
        bound |= names
        joined |= {n for n in names if n in where}
    for n in vertex_names:
        if n not in joined:
            result = result.join(vtab(n), f"__{n}")
    return result.select(*order)


def two_leg(g: Graph, src_where: Column, dst_where: Column,
            weight: str = "distance") -> DataFrame:
    """Itineraries with one transfer: (src, via, dst, distance = leg1 + leg2).

    Legs are filtered by their outer endpoint first (semi joins with the filtered vertex
    tables), then joined on the transfer vertex.
    """
    src_ids = g.vertices.where(src_where).select(F.col("id").alias("src"))
    dst_ids = g.vertices.where(dst_where).select(F.col("id").alias("dst"))
    first = (g.edges.join(src_ids, "src", "left_semi")
             .select("src", F.col("dst").alias("via"), F.col(weight).alias("__w1")))
    second = (g.edges.join(dst_ids, "dst", "left_semi")
              .select(F.col("src").alias("via"), "dst", F.col(weight).alias("__w2")))
    return (first.join(second, "via")
            .select("src", "via", "dst", (F.col("__w1") + F.col("__w2")).alias(weight)))


def direct(g: Graph, src_where: Column, dst_where: Column) -> DataFrame:
    """Edges whose source matches ``src_where`` and target matches ``dst_where``."""
    src_ids = g.vertices.where(src_where).select(F.col("id").alias("src"))
    dst_ids = g.vertices.where(dst_where).select(F.col("id").alias("dst"))
    return g.edges.join(src_ids, "src", "left_semi").join(dst_ids, "dst", "left_semi")


# --------------------------------------------------------------------------- bounded paths

def _simple_edges(g: Graph, weight: str) -> DataFrame:
    """Distinct (src, dst) pairs without self-loops, with the smallest weight."""
    return (g.edges.where(F.col("src") != F.col("dst"))
            .groupBy("src", "dst").agg(F.min(weight).alias("__w")))


def _endpoint_ids(g: Graph, end) -> DataFrame:
    if isinstance(end, Column):
        return g.vertices.where(end).select(F.col("id").cast("long").alias("v")).distinct()
    return g.vertices.where(F.col("id") == F.lit(end)).select(F.col("id").cast("long").alias("v"))


def simple_paths(g: Graph, source, target, max_edges: int = 4,
                 weight: str = "distance") -> DataFrame:
    """All simple paths source -> target with at most ``max_edges`` edges.

    ``source`` / ``target`` are a vertex id or a vertex predicate (a Column over vertex
    columns, e.g. ``F.col("region") == "ASIA"``) naming a set of vertices. Output
    ``(path array<long>, n_edges int, <weight> double)``. Parallel edges count once
    (smallest weight) and self-loops are ignored. For a single source equal to a single
    target the result is the one-vertex path of weight 0; with vertex sets a path needs
    at least one edge and may pass through other target vertices.

    Paths meet in the middle: half paths grow forward from the sources and backward from the
    targets, each at most half of ``max_edges`` long and written once per length. A path of n
    edges is the one pair of halves of ceil(n / 2) and floor(n / 2) edges that end at the same vertex
    and share no other, so no path is made twice and levels hold the square root of what a
    one-sided search would hold.
    """
    ensure_checkpoint_dir(g.edges.sparkSession)
    sets = isinstance(source, Column) or isinstance(target, Column)
    start, targets = _endpoint_ids(g, source), _endpoint_ids(g, target)
    if not sets and source == target:
        return start.select(F.array("v").alias("path"), F.lit(0).alias("n_edges"),
                            F.lit(0.0).alias(weight))
    edges = materialize(_simple_edges(g, weight), "path-edges")

    def grow(ends: DataFrame, levels: int, at: str, to: str, add, stop) -> list[DataFrame]:
        """Half paths of 0 to ``levels`` edges; a single end (``stop``) is never passed through."""
        found = [ends.select(F.array("v").alias("path"), F.col("v").alias("at"), F.lit(0.0).alias("d"))]
        for _ in range(levels):
            frontier = found[-1] if sets else found[-1].where(F.col("at") != F.lit(stop))
            found.append(materialize(
                frontier.join(edges, frontier["at"] == edges[at])
                .where(~F.array_contains("path", F.col(to)))
                .select(add("path", F.col(to)).alias("path"), F.col(to).alias("at"), (F.col("d") + F.col("__w")).alias("d")),
                "half-paths"))
        return found

    ahead = grow(start, (max_edges + 1) // 2, "src", "dst", F.array_append, target)
    behind = grow(targets, max_edges // 2, "dst", "src", F.array_prepend, source)
    paths = None
    for n in range(1, max_edges + 1):
        first, rest = ahead[(n + 1) // 2], behind[n // 2]
        rest = rest.select(F.col("at"), F.slice("path", 2, max(1, n // 2)).alias("rest"), F.col("d").alias("d_rest"))
        whole = (first.join(rest, "at").where(~F.arrays_overlap("path", "rest"))
                 .select(F.concat("path", "rest").alias("path"), (F.col("d") + F.col("d_rest")).alias("d")))
        paths = whole if paths is None else paths.unionByName(whole)
    return paths.select("path", (F.size("path") - 1).alias("n_edges"), F.col("d").alias(weight))


def shortest_path(g: Graph, source, target, max_edges: int = 4,
                  weight: str = "distance") -> DataFrame:
    return arg_top(simple_paths(g, source, target, max_edges, weight), weight, k=1,
                   desc=False, tie=["n_edges", "path"])


def longest_path(g: Graph, source, target, max_edges: int = 4,
                 weight: str = "distance") -> DataFrame:
    return arg_top(simple_paths(g, source, target, max_edges, weight), weight, k=1,
                   desc=True, tie=["n_edges", "path"])


# --------------------------------------------------------------------------- iterative

def _undirected(g: Graph) -> DataFrame:
    e = g.edges.where(F.col("src") != F.col("dst"))
    return e.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()


def _canonical(df: DataFrame, x: str, y: str) -> DataFrame:
    return (df.where(F.col(x) != F.col(y))
            .select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct())


def _hubs(ends: DataFrame, count: str, total: int) -> DataFrame:
    """Vertices with more than a partition's share of ``total`` rows; fewer than there are partitions."""
    share = default_parallelism(ends.sparkSession)
    return ends.where(F.col(count) * F.lit(share) > F.lit(total)).select("u")


def _follow(rows: DataFrame, pointers: DataFrame, col: str, hubs: DataFrame | None) -> DataFrame:
    """``rows`` with ``col`` replaced by where ``pointers(u, to)`` leads. A hub's rows meet its pointer in
    the map tasks. They pass the join with all other pointers dealt by their own hash, so that ``rows`` are
    planned once, not once for hubs and once for the rest."""
    to = pointers.select(F.col("u").alias(col), F.col("to").alias("__to"))
    if hubs is None:
        return rows.join(to, col).withColumn(col, F.col("__to")).drop("__to")
    hub = to.join(F.broadcast(hubs.select(F.col("u").alias(col))), col, "left_semi").withColumnRenamed("__to", "__hub")
    kind = "long" if dict(rows.dtypes)[col] == "bigint" else "string"  # of a key that holds ids or hashes
    met = rows.join(F.broadcast(hub), col, "left").withColumn(
        "__key", F.when(F.col("__hub").isNull(), F.col(col).cast(kind)).otherwise(F.xxhash64(*rows.columns).cast(kind)))
    others = to.select(F.col(col).cast(kind).alias("__u"), "__to")
    joined = met.join(others, (F.col("__key") == F.col("__u")) & F.col("__hub").isNull(), "left")
    return joined.where("__hub IS NOT NULL OR __to IS NOT NULL").withColumn(
        col, F.coalesce("__hub", "__to")).select(*rows.columns)


def components(g: Graph, max_rounds: int = 200) -> DataFrame:
    """Weakly connected components: (id, component = smallest vertex id in it).

    Rounds of contraction. Every vertex with an edge left points to the smallest vertex of its
    closed neighbourhood (partial minima in the tasks first, so a hub's neighbourhood is never in
    one place), and pointers are followed twice. Edges move to where their ends point; those inside
    a merged vertex are settled and gone, so the edge table shrinks every round, and with no edge left
    the loop ends: only local minima survive a round, at most half of the vertices. A hub's share of
    the edges is split: its rows meet the hub's pointer in the map tasks (:func:`_follow`; the
    broadcast holds fewer vertices than there are partitions). The written pointer tables, from
    the last to the first, give the labels. Vertices without edges are their own component.
    """
    ensure_checkpoint_dir(g.edges.sparkSession)
    e = materialize(_undirected(g), "cc")
    levels: list[DataFrame] = []
    for _ in range(max_rounds):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        near = materialize(both.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("degree")), "cc-near")
        ends = near.agg(F.sum("degree").alias("total"), F.max("degree").alias("most"), F.count("*").alias("n")).first()
        if not ends.total:
            release(near)
            break
        partitions = default_parallelism(e.sparkSession)
        hubs = _hubs(near, "degree", ends.total) if ends.most * partitions > ends.total else None
        pointers = near.select("u", F.least("u", "least").alias("to"))
        # vertices that many point to (no more than they have edges)
        aims = (_hubs(pointers.groupBy(F.col("to").alias("u")).agg(F.count("*").alias("n")), "n", ends.n)
                if ends.most * partitions > ends.n else None)
        jumped = materialize(_follow(pointers, pointers, "to", aims), "cc-to")
        moved = _follow(_follow(e, jumped, "a", hubs), jumped, "b", hubs)
        previous, e = e, materialize(_canonical(moved, "a", "b"), "cc")
        release(previous)
        release(near)
        levels.append(jumped)
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    release(e)
    labels = None
    for level in levels[::-1]:
        if labels is not None:
            above = labels.select(F.col("u").alias("to"), F.col("to").alias("__root"))
            upper, level = level, materialize(
                level.join(above, "to", "left").select("u", F.coalesce("__root", "to").alias("to")), "cc-label")
            release(upper)
            release(labels)
        labels = level
    vertices = g.vertices.select("id").distinct()
    if labels is None:
        return vertices.select("id", F.col("id").alias("component"))
    return (vertices.join(labels.withColumnRenamed("u", "id"), "id", "left")
            .select("id", F.coalesce("to", "id").alias("component")))


def label_propagation(g: Graph, rounds: int = 5) -> DataFrame:
    """Synchronous label propagation: (id, label).

    Every vertex starts with its own id. Per round each edge carries the label of each
    endpoint to the other one (edges are first made distinct on (src, dst), so parallel
    carriers count once while A->B and B->A count twice); a vertex takes the most
    frequent incoming label, the lowest label on ties, and keeps its label without
    messages.

    The counts per (vertex, incoming label) are kept as a first table and a log of changes. After
    the first round only vertices whose label changed send anything: -1 for the label they had and
    +1 for the new one. Only vertices that receive such a change are counted again, from their own
    part of the log, so a round's traffic follows the changes and not the edges. Counting is a
    partial aggregate on (vertex, label): a hub does not gather its messages in one task.
    """
    ensure_checkpoint_dir(g.edges.sparkSession)
    pairs = g.edges.select("src", "dst").distinct()
    messages = materialize(
        pairs.select(F.col("src").alias("from"), F.col("dst").alias("to"))
        .unionByName(pairs.select(F.col("dst").alias("from"), F.col("src").alias("to")))
        .groupBy("from", "to").agg(F.count("*").alias("n"))
        .join(g.vertices.select(F.col("id").alias("from")).distinct(), "from", "left_semi"), "lpa")
    # what a hub sends meets a broadcast of the labels of hubs (at most 1/HOT_SHARE vertices)
    hot = materialize(hot_keys(messages, "from", HOT_SHARE), "lpa-hot")
    any_hot = hot.limit(1).count() > 0  # reads at most one row of a tiny written table
    labels = materialize(g.vertices.select("id", F.col("id").alias("label")).distinct(), "lpa")
    vertices = labels
    log = [messages.select(F.col("to").alias("id"), F.col("from").alias("label"), "n")]
    written = [messages, hot]
    for r in range(rounds):
        counted = log[0]
        for part in log[1:]:
            counted = counted.unionByName(part)
        if r:
            counted = counted.join(log[-1].select("id").distinct(), "id", "left_semi")
        best = (counted.groupBy("id", "label").agg(F.sum("n").alias("n")).where("n > 0")
                .groupBy("id").agg(F.max(F.struct(F.col("n"), (-F.col("label")).alias("neg"))).alias("__best")))
        changed = materialize(labels.join(best.select("id", (-F.col("__best.neg")).alias("new")), "id")
                              .where("label <> new"), "lpa-changed")
        written.append(changed)
        if not changed.limit(1).count():
            break
        previous, labels = labels, materialize(
            labels.join(changed.select("id", "new"), "id", "left")
            .select("id", F.coalesce("new", "label").alias("label")), "lpa")
        if previous is not vertices:
            release(previous)
        if r + 1 < rounds:
            senders = changed.withColumnRenamed("id", "from")
            sent = (skew_join(messages, senders, "from", hot=hot) if any_hot else messages.join(senders, "from"))
            news = F.explode(F.array(F.struct(F.col("label").alias("label"), (-F.col("n")).alias("n")),
                                     F.struct(F.col("new").alias("label"), F.col("n").alias("n"))))
            delta = (sent.select(F.col("to").alias("id"), news.alias("x")).groupBy("id", "x.label")
                     .agg(F.sum("x.n").alias("n")).where("n <> 0"))
            log.append(materialize(delta, "lpa-log"))
            written.append(log[-1])
    for table in written:
        release(table)
    return labels


def clusters(labels: DataFrame, label_col: str, min_size: int = 1) -> DataFrame:
    """(cluster, size) for groups of at least ``min_size`` vertices."""
    return (labels.groupBy(F.col(label_col).alias("cluster")).agg(F.count("*").alias("size"))
            .where(F.col("size") >= min_size))


def cluster_members(labels: DataFrame, label_col: str, min_size: int = 1) -> DataFrame:
    """(cluster, id) rows of the clusters kept by :func:`clusters` (no per-group lists)."""
    keep = clusters(labels, label_col, min_size).select("cluster")
    return (labels.select(F.col(label_col).alias("cluster"), "id")
            .join(keep, "cluster", "left_semi"))


def isolated(g: Graph, labels: DataFrame, label_col: str, min_size: int = 2) -> DataFrame:
    """Clusters with at least ``min_size`` vertices and no edge to another cluster.

    Works for any labelling (components, label propagation, an attribute such as the
    country): both endpoints of every edge are labelled, edges whose labels differ mark
    both clusters as open, and the open ones are removed with an anti join.
    """
    lab = labels.select("id", F.col(label_col).alias("__l"))
    e = (g.edges.select("src", "dst")
         .join(lab.withColumnRenamed("id", "src").withColumnRenamed("__l", "__ls"), "src")
         .join(lab.withColumnRenamed("id", "dst").withColumnRenamed("__l", "__ld"), "dst")
         .where(F.col("__ls") != F.col("__ld")))
    open_ = (e.select(F.col("__ls").alias("cluster"))
             .unionByName(e.select(F.col("__ld").alias("cluster"))).distinct())
    return clusters(labels, label_col, min_size).join(open_, "cluster", "left_anti")
