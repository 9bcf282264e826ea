"""Graph assembly, merging, filtering, metrics and components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.places import placed
from textloom.session import discard, materialize


def merge_edges(edges: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted edges after new ones of weight 1 are added."""
    new = fresh.select(*keys, F.lit(1).cast("bigint").alias("weight"))
    return edges.select(*keys, F.col("weight").cast("bigint").alias("weight")).unionByName(new).groupBy(*keys).agg(F.sum("weight").alias("weight"))


def assemble(triplets: DataFrame, graph: str, position: str, subject: str, relation: str, object_: str, loops: bool = True) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of each graph; without `loops` a triplet whose ends are equal is none.

    A node stands for a lower-case trimmed label; it is numbered in order of first
    appearance, a subject before its object. An edge is (source, target,
    relation) with the number of triplets as weight.
    """
    norm = lambda c: F.lower(F.trim(F.col(c)))
    rows = triplets.select(graph, position, norm(subject).alias("s"), norm(object_).alias("o"), norm(relation).alias("r")).where("s != '' and o != ''")
    if not loops:
        rows = rows.where("s != o")
    ends = rows.select(graph, F.explode(F.array(F.struct((F.col(position) * 2).alias("at"), F.col("s").alias("label")), F.struct((F.col(position) * 2 + 1).alias("at"), F.col("o").alias("label")))).alias("e"))
    nodes = ends.groupBy(graph, F.col("e.label").alias("label")).agg(F.min("e.at").alias("first_at"), F.count("*").alias("mentions"))
    nodes = placed(nodes, [graph], "first_at", "node")
    edges = rows.groupBy(graph, "s", "o", "r").agg(F.count("*").alias("weight"))
    side = lambda c, name: nodes.select(graph, F.col("label").alias(c), F.col("node").alias(name))
    edges = edges.join(side("s", "source"), [graph, "s"]).join(side("o", "target"), [graph, "o"])
    return nodes.select(graph, "node", "label", "mentions"), edges.select(graph, "source", "target", F.col("r").alias("relation"), "weight")


def variant_label(e: float, r: float) -> str:
    return f"e={e:.2f},r={r:.2f}"


def default_variant(node_levels: list[float], edge_levels: list[float], zipped: bool = False) -> str:
    """The variant in the middle of a sweep."""
    pairs = list(zip(node_levels, edge_levels, strict=False)) if zipped else [(a, b) for a in node_levels for b in edge_levels]
    return variant_label(*pairs[len(pairs) // 2])


def importance_sweep(nodes: DataFrame, edges: DataFrame, node_levels: list[float], edge_levels: list[float], zipped: bool = False, drop_orphans: bool = False) -> DataFrame:
    """(graph_id, variant, n_nodes, n_edges, n_orphans) for all pairs of thresholds, or the zipped ones, in one job; orphans may be left out of n_nodes.

    nodes (graph_id, node, score), edges (graph_id, source, target, score). A node lives at its threshold
    or above; an edge needs both ends alive. Thresholds are laid out by explode.
    """
    pairs = zip(node_levels, edge_levels, strict=False) if zipped else ((a, b) for a in node_levels for b in edge_levels)
    grid = F.array(*(F.struct(F.lit(a).alias("e"), F.lit(b).alias("r")) for a, b in pairs))
    low = edges.join(nodes.select("graph_id", F.col("node").alias("source"), F.col("score").alias("s1")), ["graph_id", "source"])
    low = low.join(nodes.select("graph_id", F.col("node").alias("target"), F.col("score").alias("s2")), ["graph_id", "target"])
    alive = low.select("graph_id", "source", "target", F.col("score"), F.least("s1", "s2").alias("ends"), F.explode(grid).alias("t")).where((F.col("score") >= F.col("t.r")) & (F.col("ends") >= F.col("t.e")))
    label = F.format_string("e=%.2f,r=%.2f", F.col("t.e"), F.col("t.r"))
    kept = nodes.select("graph_id", "node", "score", F.explode(grid).alias("t")).where(F.col("score") >= F.col("t.e")).select("graph_id", label.alias("variant"), "node")
    per_edge = alive.select("graph_id", label.alias("variant"), "source", "target")
    touched = per_edge.select("graph_id", "variant", F.explode(F.array("source", "target")).alias("node")).distinct().withColumn("touched", F.lit(1))
    n_nodes = kept.join(touched, ["graph_id", "variant", "node"], "left").groupBy("graph_id", "variant").agg(F.count("*").alias("n_nodes"), F.count_if(F.col("touched").isNull()).alias("n_orphans"))
    if drop_orphans:
        n_nodes = n_nodes.withColumn("n_nodes", F.col("n_nodes") - F.col("n_orphans"))
    n_edges = per_edge.groupBy("graph_id", "variant").agg(F.count("*").alias("n_edges"))
    return n_nodes.join(n_edges, ["graph_id", "variant"], "left").select("graph_id", "variant", "n_nodes", F.coalesce("n_edges", F.lit(0)).alias("n_edges"), "n_orphans")


def simple_pairs(edges: DataFrame, graph: str, a: str, b: str) -> DataFrame:
    """Undirected edges without direction, repeats and self loops: (graph, u, v), u < v."""
    pairs = edges.where(F.col(a) != F.col(b))
    return pairs.select(graph, F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()


def degrees(edges: DataFrame, graph: str, a: str, b: str) -> DataFrame:
    """(graph, node, degree) in the simple graph; a self loop adds 2."""
    pairs = simple_pairs(edges, graph, a, b).select(graph, F.explode(F.array("u", "v")).alias("node"), F.lit(1).alias("d"))
    loops = edges.where(F.col(a) == F.col(b)).select(graph, F.col(a).alias("node")).distinct().withColumn("d", F.lit(2))
    return pairs.unionByName(loops).groupBy(graph, "node").agg(F.sum("d").alias("degree"))


def degree_metrics(nodes: DataFrame, edges: DataFrame, graph: str, a: str, b: str, node: str) -> DataFrame:
    """(graph, n, e, avg_degree, max_degree, min_degree, density); nodes without edges count with degree 0."""
    all_nodes = nodes.select(graph, F.col(node).alias("node")).distinct()
    deg = all_nodes.join(degrees(edges, graph, a, b), [graph, "node"], "left").fillna(0, ["degree"])
    per = deg.groupBy(graph).agg(F.count("*").alias("n"), F.sum("degree").alias("sum_degree"), F.round(F.avg("degree"), 6).alias("avg_degree"), F.max("degree").alias("max_degree"), F.min("degree").alias("min_degree"))
    e = (F.col("sum_degree") / 2).cast("bigint")
    density = F.when(F.col("n") > 1, F.round(2.0 * e / (F.col("n") * (F.col("n") - 1)), 6)).otherwise(0.0)
    return per.select(graph, "n", e.alias("e"), "avg_degree", "max_degree", "min_degree", density.alias("density"))


def clustering_coefficients(edges: DataFrame, graph: str, a: str, b: str) -> DataFrame:
    """(graph, node, coefficient): closed over possible neighbour pairs, 0 below two neighbours.

    Triangles are found by joining edges directed from lower to higher degree,
    which bounds the wedges of a hub.
    """
    pairs = simple_pairs(edges, graph, a, b)
    ends = pairs.select(graph, F.explode(F.array("u", "v")).alias("node")).groupBy(graph, "node").agg(F.count("*").alias("k"))
    rank = lambda c: ends.select(graph, F.col("node").alias(c), F.col("k").alias(f"k_{c}"))
    ranked = pairs.join(rank("u"), [graph, "u"]).join(rank("v"), [graph, "v"])
    up = (F.col("k_u") < F.col("k_v")) | ((F.col("k_u") == F.col("k_v")) & (F.col("u") < F.col("v")))
    directed = ranked.select(graph, F.when(up, F.col("u")).otherwise(F.col("v")).alias("x"), F.when(up, F.col("v")).otherwise(F.col("u")).alias("y"))
    one, two = directed.select(graph, "x", F.col("y").alias("p")), directed.select(graph, "x", F.col("y").alias("q"))
    wedges = one.join(two, [graph, "x"]).where("p < q")
    closed = wedges.join(pairs.select(graph, F.col("u").alias("p"), F.col("v").alias("q")), [graph, "p", "q"])
    corners = closed.select(graph, F.explode(F.array("x", "p", "q")).alias("node")).groupBy(graph, "node").agg(F.count("*").alias("t"))
    both = ends.join(corners, [graph, "node"], "left")
    value = F.when(F.col("k") > 1, 2.0 * F.coalesce("t", F.lit(0)) / (F.col("k") * (F.col("k") - 1))).otherwise(0.0)
    return both.select(graph, "node", F.round(value, 6).alias("coefficient"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node each node is connected with.

    Large-star and small-star passes until nothing changes: every pass is two
    group-bys, and passes grow with the logarithm of the diameter. Each round is
    written to the shared folder, which cuts the lineage; rounds are compared by
    their number of links and a sum of hashes.
    """
    links = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("x"), F.least(a, b).alias("m")).distinct()
    links = materialize(links, "links")
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("x", "m").cast("decimal(38,0)"))).first())
    before = mark(links)
    while before[0]:
        around = links.unionByName(links.select(F.col("m").alias("x"), F.col("x").alias("m")))
        least = around.groupBy("x").agg(F.least(F.min("m"), F.col("x")).alias("least"))
        large = around.join(least, "x").where("m > x").select(F.col("m").alias("x"), F.col("least").alias("m")).distinct()
        floor = large.groupBy("x").agg(F.min("m").alias("least"))
        small = large.join(floor, "x")
        small = small.select("x", F.col("least").alias("m")).unionByName(small.where("m != least").select(F.col("m").alias("x"), F.col("least").alias("m"))).distinct()
        older, links = links, materialize(small, "links")
        discard(older)
        after = mark(links)
        if after == before:
            break
        before = after
    tops = links.select(F.col("m").alias("node")).distinct().join(links.select(F.col("x").alias("node")).distinct(), "node", "left_anti")
    found = links.groupBy(F.col("x").alias("node")).agg(F.min("m").alias("component"))
    alone = edges.where(F.col(a) == F.col(b)).select(F.col(a).alias("node")).distinct().join(found.select("node").unionByName(tops), "node", "left_anti")
    roots = tops.unionByName(alone)
    return found.unionByName(roots.select("node", F.col("node").alias("component")))


def hubs(edges: DataFrame, graph: str, a: str, b: str, n: int) -> DataFrame:
    """(graph, node, degree, place): the n nodes of the highest degree in each graph, the smaller id first among equals."""
    order = Window.partitionBy(graph).orderBy(F.desc("degree"), "node")
    return degrees(edges, graph, a, b).withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def collapse(edges: DataFrame, clusters: DataFrame, graph: str, a: str, b: str, weight: Column) -> DataFrame:
    """Edges between clusters: ends replaced by their cluster, self loops dropped, weights summed."""
    side = lambda c, name: clusters.select(graph, F.col("node").alias(c), F.col("cluster").alias(name))
    joined = edges.withColumn("_w", weight).join(side(a, "ca"), [graph, a], "left").join(side(b, "cb"), [graph, b], "left")
    named = joined.select(graph, F.coalesce("ca", a).alias("source"), F.coalesce("cb", b).alias("target"), "_w")
    return named.where("source != target").groupBy(graph, "source", "target").agg(F.count("*").alias("size"), F.sum("_w").alias("weight"))


def visual_attributes(degree: Column, weight: Column) -> tuple[Column, Column]:
    """(node size between 10 and 40, edge width between 1 and 8)."""
    return F.least(F.greatest(10 + 5 * degree, F.lit(10)), F.lit(40)), F.least(F.greatest(1 + F.log1p(weight), F.lit(1.0)), F.lit(8.0))


def assemble_weighted(entities: DataFrame, triplets: DataFrame, graph: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) with importance.

    entities (graph, order, name, importance) come before triplets (graph,
    order, subject, predicate, object, importance). A node's importance is the
    largest of its entities and of the triplets it takes part in; an edge's that
    of its triplets. Blank names make no node and blank relations no triplet; the
    other end of a triplet with a blank end is a node all the same.
    """
    part = lambda c: F.trim(F.coalesce(c, F.lit("")))
    whole = triplets.select(graph, order, part("subject").alias("s"), part("predicate").alias("r"), part("object").alias("o"), "importance").where("r != ''")
    named = entities.select(graph, F.lit(0).alias("late"), (F.col(order) * 2).alias("at"), part("name").alias("label"), "importance")
    for k, c in enumerate(("s", "o")):
        named = named.unionByName(whole.select(graph, F.lit(1).alias("late"), (F.col(order) * 2 + k).alias("at"), F.col(c).alias("label"), "importance"))
    nodes = named.where("label != ''").groupBy(graph, "label").agg(F.min(F.struct("late", "at")).alias("f"), F.max("importance").alias("importance"), F.count("*").alias("mentions"))
    span = nodes.groupBy(graph).agg(F.max(F.when(F.col("f.late") == 0, F.col("f.at"))).alias("_last"))
    nodes = nodes.join(span, graph).withColumn("first_at", F.when(F.col("f.late") == 0, F.col("f.at")).otherwise(F.coalesce("_last", F.lit(-1)) + 1 + F.col("f.at")))
    nodes = placed(nodes.drop("f", "_last"), [graph], "first_at", "node").select(graph, "node", "label", "importance", "mentions")
    edges = whole.where("s != '' and o != ''").groupBy(graph, "s", "o", "r").agg(F.count("*").alias("weight"), F.max("importance").alias("importance"))
    side = lambda c, name: nodes.select(graph, F.col("label").alias(c), F.col("node").alias(name))
    edges = edges.join(side("s", "source"), [graph, "s"]).join(side("o", "target"), [graph, "o"])
    return nodes, edges.select(graph, "source", "target", F.col("r").alias("relation"), "weight", "importance")


def grown_nodes(nodes: DataFrame, edges: DataFrame, graph: str, node: str, ends: list[str]) -> DataFrame:
    """(graph, node): the nodes of a graph and the ends of its new edges, each once."""
    out = nodes.select(graph, node)
    for end in ends:
        out = out.unionByName(edges.select(graph, F.col(end).alias(node)))
    return out.where(F.col(node).isNotNull()).distinct()


def valid_edges(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges with two ends that are neither blank nor equal."""
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    return edges.where(filled(a) & filled(b) & (F.trim(a) != F.trim(b)))


def degree_histogram(nodes: DataFrame, edges: DataFrame, graph: str, a: str, b: str, node: str) -> DataFrame:
    """(graph, degree, n): nodes by degree, those without edges as 0."""
    all_nodes = nodes.select(graph, F.col(node).alias("node")).distinct()
    return all_nodes.join(degrees(edges, graph, a, b), [graph, "node"], "left").fillna(0, ["degree"]).groupBy(graph, "degree").agg(F.count("*").alias("n"))


def histogram_maps(histogram: DataFrame, graph: str) -> DataFrame:
    """(graph, degrees): degree -> number of nodes as a map in the order of degrees."""
    return histogram.groupBy(graph).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("degree", "n")))).alias("degrees"))


def mean_clustering(nodes: DataFrame, edges: DataFrame, graph: str, a: str, b: str, node: str) -> DataFrame:
    """(graph, clustering): the mean coefficient of all nodes, 0 for those without two neighbours."""
    all_nodes = nodes.select(graph, F.col(node).alias("node")).distinct()
    joined = all_nodes.join(clustering_coefficients(edges, graph, a, b), [graph, "node"], "left")
    return joined.groupBy(graph).agg(F.round(F.avg(F.coalesce("coefficient", F.lit(0.0))), 4).alias("clustering"))


def component_shares(nodes: DataFrame, edges: DataFrame, graph: str, a: str, b: str, node: str) -> DataFrame:
    """(graph, n, components, largest): number of components and the share of nodes in the largest one; node ids are unique over all graphs."""
    all_nodes = nodes.select(graph, F.col(node).alias("node")).distinct()
    joined = all_nodes.join(components(edges, a, b), "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = joined.groupBy(graph, "component").agg(F.count("*").alias("size"))
    return sizes.groupBy(graph).agg(F.sum("size").alias("n"), F.count("*").alias("components"), F.round(F.max("size") / F.sum("size"), 6).alias("largest"))


PATH_NODES = 500


def path_lengths(nodes: DataFrame, edges: DataFrame, graph: str, a: str, b: str, node: str) -> DataFrame:
    """(graph, diameter, average_path): null for graphs that aren't connected or have more than PATH_NODES nodes.

    The gate is worked out for all graphs; what goes on are graphs of at most
    PATH_NODES nodes, each searched breadth first from every node.
    """
    shares = component_shares(nodes, edges, graph, a, b, node)
    small = shares.where((F.col("components") == 1) & (F.col("n") <= PATH_NODES) & (F.col("n") > 1)).select(graph)
    pairs = simple_pairs(edges, graph, a, b).join(small, graph, "left_semi")
    kind = edges.schema[graph].dataType.simpleString()

    def search(part: pd.DataFrame) -> pd.DataFrame:
        ids = sorted(set(part["u"]) | set(part["v"]))
        at = {x: i for i, x in enumerate(ids)}
        near = np.zeros((len(ids), len(ids)), bool)
        for u, v in zip(part["u"], part["v"], strict=True):
            near[at[u], at[v]] = near[at[v], at[u]] = True
        reached = np.eye(len(ids), dtype=bool)
        edge, total, steps = reached, 0, 0
        while True:
            edge = (edge.astype(np.float32) @ near.astype(np.float32) > 0) & ~reached
            if not edge.any():
                break
            steps += 1
            total += steps * int(edge.sum())
            reached |= edge
        return pd.DataFrame({graph: [part[graph].iloc[0]], "diameter": [steps], "average_path": [round(total / (len(ids) * (len(ids) - 1)), 6)]})

    found = pairs.groupBy(graph).applyInPandas(search, f"{graph} {kind}, diameter int, average_path double")
    return shares.select(graph).join(found, graph, "left")


def leaf_nodes(edges: DataFrame, graph: str, a: str, b: str) -> DataFrame:
    """(graph, node): nodes of degree 1."""
    return degrees(edges, graph, a, b).where("degree = 1").select(graph, "node")


def ranked(rows: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The first n rows by value, largest first, the smaller key first among equals."""
    return rows.orderBy(F.desc(value), key).limit(n)


def promoted(nodes: DataFrame, edges: DataFrame, graph: str, node: str, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a clustered graph that holds each node and edge as a cluster of its own: ids `c0`, `ce0`, … in order."""
    named = placed(nodes, [graph], node, "_no").withColumn("id", F.concat(F.lit("c"), "_no"))
    side = lambda c, name: named.select(graph, F.col(node).alias(c), F.col("id").alias(name))
    kept = edges.join(side(a, "source"), [graph, a]).join(side(b, "target"), [graph, b])
    lines = placed(kept, [graph], "edge_id", "_no").select(graph, F.concat(F.lit("ce"), "_no").alias("id"), "source", "target")
    return named.select(graph, "id", F.col(node).alias("member")), lines


def edge_width(size: Column) -> Column:
    """Width of a cluster's edge in a drawing."""
    return 1 + F.least(0.5 * size, F.lit(4.0))


def cluster_radius(size: Column, low: Column, high: Column, wide: bool = False) -> Column:
    """Radius of a cluster in a drawing: linear between the smallest and the largest size."""
    t = F.when(high > low, (size - low) / (high - low)).otherwise(F.lit(0.0))
    return 30 + 60 * t if wide else 18 + 40 * t
