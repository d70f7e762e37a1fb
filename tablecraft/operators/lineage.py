"""Lineage graph walks over edge tables (source, target, ...)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.session import cut_lineage

# Kinds of column mapping.
MAPPING_TYPES = ["direct", "rename", "derived", "aggregation", "constant"]

# Hops planned as one job before the frontier is stored.
HOPS_PER_PLAN = 4


def _walk(
    edges: DataFrame, roots: DataFrame, depth: int, near: str, far: str, first_hop: Column | None
) -> DataFrame:
    """All (root, node, depth) with the number of paths, all roots at once.

    Paths are counted and not listed: at every hop equal (root, node) pairs are
    summed before the next join, so the frontier never holds more than one row
    per pair. The depth ends walks through cycles.
    """
    # one row per pair of nodes; the number of parallel edges multiplies the paths
    def steps(e: DataFrame) -> DataFrame:
        return e.groupBy(F.col(near).alias("_near"), F.col(far).alias("_far")).agg(
            F.count(F.lit(1)).alias("_n")
        )

    # every hop reads the links, so they are built once
    links = cut_lineage(steps(edges)) if depth > 1 else steps(edges)
    first = links if first_hop is None else steps(edges.filter(first_hop))
    frontier = roots.select(
        F.col("root"), F.col("root").alias("node"), F.lit(1).cast("long").alias("n_paths")
    ).distinct()
    levels = []
    for hop in range(1, depth + 1):
        table = first if hop == 1 else links
        frontier = (
            frontier.join(table, frontier["node"] == table["_near"])
            .groupBy("root", F.col("_far").alias("node"))
            .agg(F.sum(F.col("n_paths") * F.col("_n")).alias("n_paths"))
        )
        if hop % HOPS_PER_PLAN == 0 and hop < depth:
            frontier = cut_lineage(frontier)
            if frontier.isEmpty():
                break
        levels.append(frontier.withColumn("depth", F.lit(hop).cast("long")))
    return reduce(DataFrame.unionByName, levels).select("root", "node", "depth", "n_paths")


def upstream(
    edges: DataFrame, roots: DataFrame, depth: int = 3, first_hop: Column | None = None
) -> DataFrame:
    """Sources of each root. ``first_hop`` filters the edges of the first hop only."""
    return _walk(edges, roots, depth, "target", "source", first_hop)


def downstream(
    edges: DataFrame, roots: DataFrame, depth: int = 3, first_hop: Column | None = None
) -> DataFrame:
    """Dependents of each root: distinct targets per level."""
    return _walk(edges, roots, depth, "source", "target", first_hop).drop("n_paths")


def hop_edges(
    edges: DataFrame, roots: DataFrame, depth: int = 3, carried: Sequence[str] = ()
) -> DataFrame:
    """The distinct edges a walk upstream of each root takes, with what they carry.

    (root, source, target, ``carried``, depth), where depth is the hop. One row per
    edge and hop, not per path: the nodes met before a hop meet their edges once.
    """
    links = edges.select("source", "target", *carried).distinct()
    start = roots.select("root", F.col("root").alias("node"), F.lit(0).cast("long").alias("depth")).distinct()
    met = start if depth == 1 else start.unionByName(upstream(edges, roots, depth - 1).drop("n_paths"))
    return met.join(links, met["node"] == links["target"]).select(
        "root", "source", "target", *carried, (F.col("depth") + 1).alias("depth")
    )


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def reach(edges: DataFrame, roots: DataFrame, up: bool = True, most: int | None = None) -> DataFrame:
    """Every node that a root reaches, at any depth, with one shortest path.

    (root, node, depth, path): the path begins with the root and ends with the node; of
    equally short ones it is the least. The walk takes a hop a round and goes on only from
    pairs not met before, so cycles end it; ``most`` bounds the hops. Roots do not reach
    themselves. A NULL end leads nowhere.

    The first hop is the links of the roots as they are. Later hops begin where a link
    ends, so they read the links of such nodes only, and compare what they find with those
    pairs met before whose node lies ahead.
    """
    near, far = ("target", "source") if up else ("source", "target")
    links = cut_lineage(
        edges.select(F.col(near).alias("_near"), F.col(far).alias("_far")).dropna().distinct(), "links"
    )
    inner = links.join(links.select(F.col("_far").alias("_near")).distinct(), "_near", "left_semi")
    inner = cut_lineage(inner, "links")
    starts = roots.select("root").dropna().distinct()
    first = links.join(starts, F.col("root") == F.col("_near")).where("root <> _far").select("root", F.col("_far").alias("node"))
    if most is not None and most < 1:
        first = first.limit(0)
    levels = [cut_lineage(first, "reach").withColumn("path", F.array("root", "node"))]
    while most is None or len(levels) < most:
        here = levels[-1].select(F.col("node").alias("_near")).distinct()
        ahead = inner.join(here, "_near", "left_semi").select(F.col("_far").alias("node")).distinct()
        steps = (
            levels[-1].join(inner, F.col("node") == F.col("_near")).where("root <> _far")
            .groupBy("root", F.col("_far").alias("node")).agg(F.min("path").alias("path"))
            .select("root", "node", F.concat("path", F.array("node")).alias("path"))
        )
        met = _union([x.select("root", "node") for x in levels]).join(ahead, "node", "left_semi")
        level = cut_lineage(steps.join(met, ["root", "node"], "left_anti"), "reach")
        if level.isEmpty():
            break
        levels.append(level)
    found = [x.withColumn("depth", F.lit(i).cast("long")) for i, x in enumerate(levels, start=1)]
    return _union(found).select("root", "node", "depth", "path")


def closure(edges: DataFrame) -> DataFrame:
    """All pairs (source, target) with a path between them, its length and one shortest path.

    A round doubles the lengths covered, so the number of rounds grows with the logarithm
    of the longest shortest path. It appends to the paths found (heads) those of exactly
    the length covered so far (tails), since every longer shortest path ends with one; only
    heads that end where a tail begins are joined, and only pairs from the sources of such
    heads can have been met before. For few roots ``reach`` does less. A node is not paired
    with itself.
    """
    links = edges.select("source", "target").dropna().where("source <> target").distinct()
    found, half = [
        cut_lineage(links, "paths").withColumns({"length": F.lit(1).cast("long"), "path": F.array("source", "target")})
    ], 1
    while True:
        tails = found[-1].where(F.col("length") == half)
        begin = cut_lineage(tails.select(F.col("source").alias("target")).distinct(), "begin")
        heads = cut_lineage(_union(found).join(begin, "target", "left_semi"), "heads")
        if heads.isEmpty():
            return _union(found)
        left = heads.select("source", F.col("target").alias("_mid"), F.col("length").alias("_l"), F.col("path").alias("_p"))
        right = tails.select(F.col("source").alias("_mid"), "target", F.slice("path", 2, half).alias("_rest"))
        # of the paths of a pair no two have the same head, so the heads alone give their order
        best = F.min(F.struct("_l", "_p", "_rest")).alias("b")
        longer = left.join(right, "_mid").where("source <> target").groupBy("source", "target").agg(best)
        met = _union(found).join(heads.select("source").distinct(), "source", "left_semi")
        fresh = longer.join(met, ["source", "target"], "left_anti").select(
            "source", "target", (F.col("b._l") + half).alias("length"), F.concat("b._p", "b._rest").alias("path")
        )
        found.append(cut_lineage(fresh, "paths"))
        half *= 2


def cycles(pairs: DataFrame) -> DataFrame:
    """(node, component): nodes of a closure that reach each other, under the least of them."""
    back = pairs.select(F.col("target").alias("source"), F.col("source").alias("target"))
    return (
        pairs.join(back, ["source", "target"])
        .groupBy(F.col("source").alias("node"))
        .agg(F.least(F.col("node"), F.min("target")).alias("component"))
    )


def nearest(walk: DataFrame) -> DataFrame:
    """(root, node) with the smallest depth."""
    return walk.groupBy("root", "node").agg(F.min("depth").alias("depth"))


def neighbours(edges: DataFrame, node) -> DataFrame:
    """Distinct direct upstream and downstream nodes of one node."""
    up = edges.filter(F.col("target") == node).select(
        F.lit("upstream").alias("direction"), F.col("source").alias("node")
    )
    down = edges.filter(F.col("source") == node).select(
        F.lit("downstream").alias("direction"), F.col("target").alias("node")
    )
    return up.unionByName(down).distinct()


def mapping_profile(mapping: DataFrame, types: Sequence[str] = tuple(MAPPING_TYPES)) -> DataFrame:
    """Mapping counts per target and type, one column per type."""
    return mapping.groupBy("target_entity_id").agg(
        *[
            F.sum(F.when(F.col("mapping_type") == t, 1).otherwise(0)).cast("long").alias(t)
            for t in types
        ]
    )


def unmapped(attribute: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attributes that no mapping targets."""
    targets = mapping.select(F.col("target_attribute_id").alias("attribute_id"))
    return attribute.join(targets, "attribute_id", "left_anti")
