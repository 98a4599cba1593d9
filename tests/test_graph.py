"""Orders of dependencies against loops in Python."""

import random

import pytest

from lodestone.operators import graph


def levels(edges, nodes):
    out = {n: {d for s, d in edges if s == n and d != n} for n in nodes}
    level = {n: 0 for n in nodes if not out[n]}
    while True:
        now = {n: 1 + max(level.get(d, 0) for d in out[n]) for n in nodes if n not in level and all(d in level or d not in out for d in out[n])}
        if not now:
            return {n: level.get(n) for n in nodes}
        level |= now


def ordered(spark, edges, nodes):
    rows = graph.leaf_first(spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame([(n,) for n in nodes], "node long")).collect()
    assert len(rows) == len(set(nodes))
    return {r.node: r.level for r in rows}


@pytest.mark.parametrize("seed", range(4))
def test_levels_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    nodes = list(range(40))
    # mostly from larger to smaller nodes, with some that close cycles, self loops, repeats and nodes of no table
    edges = [(s, d) for s in nodes for d in rng.sample(range(s + 1), min(s, rng.choice((0, 1, 1, 2, 3))))]
    edges += [(rng.randrange(25, 40), rng.randrange(25, 40)) for _ in range(seed)] + [(3, 3), (7, 99), (98, 1)] + edges[:5]
    assert ordered(spark, edges, nodes) == levels(edges, nodes)


def test_chains_and_cycles(spark):
    chain = [(i + 1, i) for i in range(1000)]
    ring = [(2000, 2001), (2001, 2002), (2002, 2000), (2003, 2000), (2004, 2003), (2004, 5)]
    nodes = [*range(1001), *range(2000, 2005), 3000]
    found = ordered(spark, chain + ring, nodes + [7])
    assert found == {**{i: i for i in range(1001)}, **dict.fromkeys(range(2000, 2005)), 3000: 0}


def test_no_edges_and_no_nodes(spark):
    assert ordered(spark, [], [1, 2]) == {1: 0, 2: 0}
    assert ordered(spark, [(1, 2)], []) == {}


def reached(edges, start, depth):
    seen = dict.fromkeys(start, 0)
    for d in range(1, depth + 1):
        front = {n for n in seen if seen[n] == d - 1}
        seen |= {y: d for s, t in edges for x, y in ((s, t), (t, s)) if x in front and y not in seen}
    return seen


def test_reachable_sends_the_front_and_keeps_edges_in_place(spark):
    edges = [(1, 2), (1, 2), (2, 3), (4, 3), (4, 4), (5, 4), (8, 9), (None, 1)]
    got = graph.reachable(spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame([(1,)], "node long"), 3)
    known = [e for e in edges if None not in e]
    assert {r.node: r.depth for r in got.collect() if r.node is not None} == reached(known, [1], 3)
    # no shuffle of edges: what is stored of each hop are its nodes
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_edges_are_dealt_by_their_number(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 3)], "src long, dst long")
    assert graph.dealt(edges, ["src", "dst"], 1_000_001).rdd.getNumPartitions() == 3
    got = graph.degrees(graph.dealt(edges, ["src", "dst"], 3, each=1)).collect()
    assert {(r.node, r.n_out, r.n_in) for r in got} == {(1, 1, 0), (2, 1, 1), (3, 0, 1)}


@pytest.mark.parametrize("name", ["q_degree_centrality", "q_entry_leaf", "q_graph_stats", "q_xrefs_to"])
def test_plans_deal_rows_by_their_number(spark, name):
    from lodestone import catalog

    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_expansion_counts_the_neighbours_edges_alone(spark):
    from lodestone import catalog

    plan = catalog.queries()["q_expansion"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
