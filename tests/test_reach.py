"""Reachability at any depth against a breadth-first search in memory."""

import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import lineage as ln


def shortest(edges, root):
    """node -> least of the shortest paths from root."""
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    found, queue = {root: (root,)}, deque([root])
    while queue:
        level, queue = list(queue), deque()
        options = {}
        for node in level:
            for far in after.get(node, ()):
                if far not in found:
                    options.setdefault(far, []).append(found[node] + (far,))
        for far, paths in options.items():
            found[far] = min(paths)
            queue.append(far)
    return {k: v for k, v in found.items() if k != root}


def graph(seed):
    rnd = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(30)]
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(45)]
    return edges + edges[:5] + [("n01", "n01")] + [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(20)] + [("c20", "c00")]


@pytest.mark.parametrize("seed", range(2))
def test_reach_and_closure_of_cyclic_graphs(spark, seed):
    edges = graph(seed)
    df = spark.createDataFrame([*edges, (None, "n00"), ("n00", None)], "source string, target string")
    roots = sorted({a for a, _ in edges})
    want = {(r, n): p for r in roots for n, p in shortest(edges, r).items()}
    pairs = ln.closure(df)
    rows = pairs.collect()
    assert {(r["source"], r["target"]): tuple(r["path"]) for r in rows} == want
    assert all(r["length"] == len(r["path"]) - 1 for r in rows)
    some = roots[::7]
    out = ln.reach(df, spark.createDataFrame([(r,) for r in some + some[:1]], "root string"), up=False).collect()
    assert {(r["root"], r["node"]): tuple(r["path"]) for r in out} == {k: v for k, v in want.items() if k[0] in some}
    back = ln.reach(df, spark.createDataFrame([("c00",)], "root string")).collect()
    assert {r["node"] for r in back} == {a for a, b in want if b == "c00"}
    near = ln.reach(df, spark.createDataFrame([("c00",)], "root string"), up=False, most=2).collect()
    assert sorted((r["node"], r["depth"]) for r in near) == [("c01", 1), ("c02", 2)]
    loops = {r["node"]: r["component"] for r in ln.cycles(pairs).collect()}
    assert loops == {
        a: min([a] + [b for (x, b) in want if x == a and (b, a) in want]) for a in roots if any((b, a) in want for (x, b) in want if x == a)
    }


def test_no_roots_and_no_edges(spark):
    none = spark.createDataFrame([], "source string, target string")
    assert ln.closure(none).count() == 0
    assert ln.reach(none, spark.createDataFrame([("a",)], "root string")).count() == 0


def test_pairs_are_stored_and_aggregated_once(spark, monkeypatch):
    stored, sorts = Counter(), Counter()

    def counted(df, name="cut", cut=ln.cut_lineage):
        sorts[name] += "SortAggregate" in df._jdf.queryExecution().executedPlan().toString()
        kept = cut(df, name)
        stored[name] += kept.count()
        return kept

    monkeypatch.setattr(ln, "cut_lineage", counted)
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("c", "e"), ("x", "y")], "source string, target string")
    assert ln.closure(df).count() == stored["paths"] == 10
    assert ln.reach(df, spark.createDataFrame([("a",), ("b",)], "root string"), up=False).count() == stored["reach"] == 7
    # the first hop is the links as they are
    assert sorts["reach"] == 3
