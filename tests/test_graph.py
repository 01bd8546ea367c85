"""Components and the greedy pass: against plain Python, on long chains, in a bounded number of jobs."""

import random

import numpy as np
import pytest

from acadlake.operators import entity, graph


def plain_labels(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in list(root)}


def plain_leaders(nodes, edges):
    near = {}
    for a, b in edges:
        near.setdefault(min(a, b), []).append(max(a, b))
    leader = {}
    for x in sorted(nodes):
        if x not in leader:
            leader[x] = x
            for y in near.get(x, ()):
                leader.setdefault(y, x)
    return leader


def graphs():
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(3000)]
    mixed = [tuple(sorted(rng.sample(range(400), 2))) for _ in range(330)]
    shuffled = rng.sample(range(2000), 2000)
    path = [tuple(sorted(e)) for e in zip(shuffled, shuffled[1:])]
    return {"chain": chain, "random path": path, "mixed": sorted(set(mixed)), "star": [(0, i) for i in range(1, 500)],
            "clique": [(i, j) for j in range(40) for i in range(j)]}


def partition(labels):
    groups = {}
    for x, c in labels.items():
        groups.setdefault(c, set()).add(x)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("name", graphs())
def test_labels_in_one_task(name):
    edges = np.array(graphs()[name])
    nodes, label = graph.labels_of(edges[:, 0], edges[:, 1])
    assert dict(zip(nodes.tolist(), label.tolist())) == plain_labels(edges.tolist())


@pytest.mark.parametrize("name,bound", [("random path", 10 ** 6), ("random path", 100), ("mixed", 20)])
def test_components_by_contraction(spark, name, bound):
    edges = graphs()[name]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long"), bound).collect()}
    assert partition(got) == partition(plain_labels(edges))


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    got = entity.greedy_leaders(spark.range(3).withColumnRenamed("id", "pos"), spark.createDataFrame([], "a_pos long, b_pos long"))
    assert sorted(tuple(r) for r in got.collect()) == [(0, 0), (1, 1), (2, 2)]


@pytest.mark.parametrize("name", graphs())
def test_walk_is_the_sequential_pass(name):
    edges = np.array(graphs()[name])
    for part in [edges]:
        pos, leader = entity.walk(part[:, 0], part[:, 1])
        assert dict(zip(pos, leader)) == plain_leaders(set(part.reshape(-1).tolist()), part.tolist())


@pytest.mark.parametrize("bound", [500_000, 50])
def test_leaders_small_and_large_components(spark, bound):
    edges = graphs()["mixed"] + [(1000 + a, 1000 + b) for a, b in graphs()["clique"]]
    nodes = list(range(420)) + list(range(1000, 1040))
    got = entity.greedy_leaders(spark.createDataFrame([(n,) for n in nodes], "pos long"),
                                spark.createDataFrame(edges, "a_pos long, b_pos long"), bound)
    assert {r.pos: r.lider for r in got.collect()} == plain_leaders(nodes, edges)


def test_long_chain_takes_as_many_jobs_as_a_short_one(spark):
    sc, jobs = spark.sparkContext, []
    for n in (10, 10_000):
        sc.setJobGroup(f"chain-{n}", "greedy pass")
        edges = spark.range(n).selectExpr("id AS a_pos", "id + 1 AS b_pos")
        got = entity.greedy_leaders(spark.range(n + 1).withColumnRenamed("id", "pos"), edges).collect()
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"chain-{n}")))
        assert {r.pos: r.lider for r in got} == {i: i - i % 2 for i in range(n + 1)}
    sc.setJobGroup(None, None)
    assert jobs[1] <= jobs[0] + 4
