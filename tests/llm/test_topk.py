import math
import random

import pytest
from pyspark.sql import functions as F

from acadlake.llm import topk
from tools.oracle_check import compare, duck_con


def plain(rows, is_query, k=10):
    vec = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows
           if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in sorted({i for i, _ in vec if is_query(i)}):
        best = {}
        for own in (v for i, v in vec if i == q):
            for i, v in vec:
                if i != q and len(v) == len(own):
                    best[i] = max(best.get(i, -10 ** 40), sum(a * b for a, b in zip(own, v)))
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1):
            out.add((q, rank, i, s))
    return out


@pytest.mark.parametrize("blocks", [(4096, 2048, 128), (16, 8, 3)])
def test_ties_copies_and_bad_vectors(spark, monkeypatch, blocks):
    for name, n in zip(("ROW_BLOCK", "QUERY_BLOCK", "QUERY_STEP"), blocks):
        monkeypatch.setattr(topk, name, n)
    rng = random.Random(blocks[0])
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25]) for _ in range(3)]) for i in range(150)]
    rows += [(1000 + i, [0.25, 0.25, 0.25]) for i in range(60)]                 # a hot vector
    rows += [(7, rows[7][1]), (8, [0.1, 0.2, 0.3]), (10, [1.0, 2.0]), (20, [1.0, -1.0])]
    rows += [(301, None), (302, []), (303, [1.0, None, 1.0]), (304, [float("nan")] * 3), (305, [float("inf"), 0.0, 0.0]),
             (None, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0).collect()}
    assert got == plain([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 10 == 0)


def test_large_numbers_stay_exact(spark):
    rows = [(0, [3.0e4, 2.0e4]), (1, [3.0e4 + 1, 2.0e4]), (2, [3.0e4, 2.0e4 + 1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0).collect()} == plain(rows, lambda i: i == 0)


def test_products_beyond_a_long_saturate(spark):
    rows = [(0, [1e19, 4e6]), (1, [1e19, 4e6]), (2, [-1e19, 1.0]), (3, [4e6, 4e6]), (4, [3e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    most = (1 << 63) - 1
    assert got == [(1, most), (3, most), (4, most), (2, -most - 1)]


@pytest.mark.parametrize("nodes", [1, 3, 4, 7])
def test_any_number_of_nodes_gives_the_same(spark, nodes):
    rng = random.Random(nodes)
    rows = [(i, [rng.gauss(0, 1) for _ in range(rng.choice([7, 7, 7, 2, 1]))]) for i in range(300)]
    rows += [(5, [rng.gauss(0, 2) for _ in range(7)]) for _ in range(100)]              # one id on many vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, nodes=nodes).collect()}
    assert got == plain(rows, lambda i: i % 10 == 0)


def test_phases_leave_most_pairs_out_and_look_some_up(spark, monkeypatch):
    """Fewer entries than pairs are sent, fewer still are looked up, and the last phase has work."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    looked, lookup, sent, cut = [], topk._scored, [], topk.cut_lineage

    def scored(pairs, *more):
        looked.append(pairs.count())
        return lookup(pairs, *more)

    def counted(frame, label):
        out = cut(frame, label)
        if label == "topk-entries":
            sent.append(out.count())
        return out

    monkeypatch.setattr(topk, "_scored", scored)
    monkeypatch.setattr(topk, "cut_lineage", counted)
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0).collect()}
    assert got == plain(rows, lambda i: i % 100 == 0)
    pairs = 40 * 4000
    first, last = looked
    assert first <= 40 * 2 * 11 and 0 < last < sent[0] < pairs / 5


def test_query_against_sql_and_empty(spark, small, folder):
    assert compare("op3", topk.op3_topk_search(spark, small), topk.ORACLE, duck_con(small))
    assert topk.op3_topk_search(spark, folder()).count() == 0
    assert topk.op3_topk_search(spark, folder(embeddings=[(100, [1.0], 1)])).count() == 0
