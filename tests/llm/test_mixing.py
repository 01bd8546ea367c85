import math

import pytest
from pyspark.sql import functions as F

import edge
from acadlake.llm import mixing


def plain_targets(sizes, cap=3.0, weights=(1, 2, 3)):
    """Share by weight, stop at the limit, share the excess again, until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, float(sum(sizes.values()))
    while True:
        open_ = [s for s in order if s not in full]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]] if open_ else []
        if not over:
            return full | {s: left * weight[s] / total for s in open_}
        for s in over:
            full[s] = cap * sizes[s]
        left = sum(sizes.values()) - sum(full.values())


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 1, "c": 2, None: 3}, {"a": 0, "b": 5, "c": 0}, {"a": 0},
    {"B": 10, "a": 20, "é": 30, "b": 1, None: 7, "": 4000},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)
    rates = mixing.balance(mixing.targets(df)).collect()
    for r in rates:
        if sizes[r.source]:
            assert math.isclose(r.rate * sizes[r.source], want[r.source], rel_tol=1e-9)


def test_newton_from_far_away(spark):
    df = spark.createDataFrame([("a", 10 ** 12, 5.0), ("b", 7, 21.0), ("c", 3, 0.0)], "source string, source_size long, target double")
    got = {r.source: r.rate for r in mixing.balance(df).collect()}
    assert math.isclose(got["a"], 5e-12, rel_tol=1e-9) and math.isclose(got["b"], 3.0) and got["c"] == 0


def test_query(spark, small):
    rows = mixing.op1_mixing(spark, small).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    sizes, taken, target = {}, {}, {}
    for r in rows:
        d = docs[r.doc_id]
        assert r.size == len([w for w in d.text.split(" ") if w.strip()]) or r.size == len(d.text.encode().split())
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        sizes[d.source] = sizes.get(d.source, 0) + r.size
        taken[d.source] = taken.get(d.source, 0) + r.taken
        target[d.source] = r.target
    want = plain_targets(sizes)
    assert len(rows) == len(docs)
    for s in sizes:
        assert math.isclose(target[s], want[s])
        assert abs(taken[s] - want[s]) <= 0.08 * want[s], s       # ten documents a source
    again = mixing.op1_mixing(spark, small).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_hot_class_of_copies(spark, folder):
    docs = [(i, "same ten words in each of these copies right here", "en", "a", 1) for i in range(900)]
    docs += [(1000 + i, "b " * (i + 1), "en", "b", 1) for i in range(40)]
    rows = mixing.op1_mixing(spark, folder(documents=docs)).collect()
    a = [r for r in rows if r.doc_id < 900]
    assert abs(sum(r.taken for r in a) - a[0].target) <= 10 and {r.copies for r in a} <= {0, 1}
    b = [r for r in rows if r.doc_id >= 1000]
    assert abs(sum(r.taken for r in b) - b[0].target) <= 2


def test_edge_rows(spark):
    out = mixing.mix(edge.with_clashes(edge.documents(spark)))
    rows = out.collect()
    assert len(rows) == len(edge.DOCUMENTS)
    assert all(r["copies"] == 0 for r in rows if r["size"] == 0)
    assert {r["target"] for r in rows if r["source"] is None} == {0.0}
    assert mixing.mix(edge.documents(spark).limit(0)).count() == 0
    none = mixing.mix(edge.documents(spark).filter("doc_id in (2, 5)")).collect()
    assert [(r["size"], r["copies"], r["target"]) for r in none] == [(0, 0, 0.0)] * 2


def test_native_without_cross_joins(spark, small):
    plan = mixing.op1_mixing(spark, small)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
    assert F is not None
