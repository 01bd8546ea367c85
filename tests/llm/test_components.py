import random

from acadlake.llm.components import components


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    edges += edges[:5]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(near):
        stack = [n]
        while stack:
            x = stack.pop()
            if x not in want:
                want[x] = n
                stack += near[x]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    loops = {n for n in want if near[n] == {n}}
    assert got == {n: c for n, c in want.items() if n not in loops}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
