"""Pairs kept as their sides answer like their rows, and do not make them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from acadlake.operators import contracts as C
from acadlake.operators import maintenance as M
from acadlake.operators.pairs import Pairs
from test_plans import plan_text

CONTRACT = C.Contract("t", (C._f("a", "CHAR(3)", True), C._f("b", "CHAR(2)", True)), ("a", "b"))


def sides(spark, left, right, more):
    return Pairs(spark.createDataFrame(left, "a string, __left array<string>"),
                 spark.createDataFrame(right, "b string, __right array<string>"),
                 spark.createDataFrame(more, "a string, b string"))


def brute(left, right, more):
    return [(a, b) for a, s in left for b, t in right if set(s) & set(t)] + list(more)


def links(r):
    return sorted(r.sample("1234", r.choice((1, 1, 2, 3))))


def made(seed):
    """Keys that repeat in their sides and in more, NULL and blank ones, ones that break a limit."""
    r = random.Random(seed)
    a, b = ["a1", "a2", "a3", "long1", " ", "", None, "x7"], ["b1", "b2", "b33", "", " ", "c1"]
    return ([(r.choice(a), links(r)) for _ in range(9)], [(r.choice(b), links(r)) for _ in range(7)],
            [(r.choice([*a, "q", "r"]), r.choice([*b, "z"])) for _ in range(8)])


def found(df):
    return sorted((tuple(map(repr, x)) for x in df.collect()))


CASES = [made(1), made(2), ([("a", ["1"]), ("b", ["1", "2"])], [("x", ["1"]), ("y", ["2"])], [("c", "x")]), ([], [], [])]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_pairs_answer_like_their_rows(spark, case):
    left, right, more = CASES[case]
    pairs = sides(spark, left, right, more)
    rows = spark.createDataFrame(brute(left, right, more), "a string, b string")
    assert found(pairs.rows()) == found(rows)
    for check in (C.violations, C.row_rejects, C.key_uniqueness, C.duplicate_keys):
        assert found(check(pairs, CONTRACT)) == found(check(rows, CONTRACT)), check.__name__
        assert check(pairs, CONTRACT).dtypes == check(rows, CONTRACT).dtypes
    # a load by a condition, and one that has other links and other single rows than the system
    for condition in (F.col("a").endswith("1"), F.col("a") > "a2"):
        gone = M.deactivation_keys(pairs, pairs.where(condition), ["a", "b"])
        assert found(gone) == found(M.deactivation_keys(rows, rows.where(condition), ["a", "b"]))
    other = [(a, s[:1]) for a, s in left[::2]]
    load = Pairs(sides(spark, other, [], []).left, pairs.right, sides(spark, [], [], more[:3]).more)
    want = M.deactivation_keys(rows, spark.createDataFrame(brute(other, right, more[:3]), "a string, b string"), ["a", "b"])
    assert found(M.deactivation_keys(pairs, load, ["a", "b"])) == found(want)


def test_checks_do_not_make_the_pairs(spark):
    """20,000 x 20,000 pairs of one link: counted, checked for repeated keys and broken rules from the sides."""
    n = 20000
    side = lambda k: spark.range(n).select(F.col("id").cast("string").alias(k))      # noqa: E731
    pairs = Pairs(side("a").withColumn("__left", F.array(F.lit("1"))), side("b").withColumn("__right", F.array(F.lit("1"))),
                  spark.createDataFrame([("0", "q"), ("0", "q")], "a string, b string"))
    contract = C.Contract("t", (C._f("a", "CHAR(4)", True), C._f("b", "CHAR(5)", True)), ("a", "b"))
    assert [r.violacoes for r in C.violations(pairs, contract).collect()] == [0, n // 2 * n, 0, 0]
    assert [tuple(r)[1:] for r in C.key_uniqueness(pairs, contract).collect()] == [(n * n + 2, n * n + 1, 1)]
    assert [tuple(r)[1:] for r in C.duplicate_keys(pairs, contract).collect()] == [("0|q", 2)]
    wide = C.Contract("t", (C._f("a", "CHAR(5)", True), C._f("b", "CHAR(5)", True)), ("a", "b"))
    assert C.row_rejects(pairs, wide).count() == 0


def test_deactivated_pairs_are_not_shuffled(spark):
    pairs = sides(spark, [("a", ["1"]), ("b", ["1", "2"])], [("x", ["1"]), ("y", ["2"])], [("c", "x")])
    text = plan_text(pairs.absent(pairs.where(F.col("a") == "a")))
    # of keys that occur once, nothing is above the join of the two sides
    assert not re.search(r"HashAggregate|Exchange", text[:text.index("Join")])


def test_stored_product_of_pairs_is_its_sides(spark, sf):
    from acadlake.plans.load_tables import produced, produced_form
    from acadlake.views import domain
    d = domain(spark, sf)
    form = produced_form(d, "imp_008_usuarios_disciplinas")
    assert isinstance(form, Pairs) and produced_form(d, "imp_008_usuarios_disciplinas") is form
    from acadlake.plans.products import load_users_subjects
    assert found(produced(d, "imp_008_usuarios_disciplinas")) == found(load_users_subjects(d))


def test_pairs_are_made_of_blocks(spark):
    """A left row is joined with blocks of the right rows of a set, which become rows behind the join."""
    from acadlake.operators import pairs as PR
    n = 2 * PR.BLOCK_ROWS + 1
    left = spark.createDataFrame([("a", ["1"]), ("b", ["1", "2"]), ("c", ["2"]), ("d", ["3"])], "a string, __left array<string>")
    right = spark.range(n).select(F.col("id").cast("string").alias("b"), F.when(F.col("id") == 7, F.array(F.lit("1"), F.lit("2")))
                                  .otherwise(F.array(F.lit("1"))).alias("__right"))
    rows = PR.Pairs(left, right, spark.createDataFrame([], "a string, b string")).rows()
    assert sorted(map(tuple, rows.groupBy("a").agg(F.count("*"), F.countDistinct("b")).collect())) == [
        ("a", n, n), ("b", n, n), ("c", 1, 1)]
    text = plan_text(rows)
    assert "Generate" in text[:text.index("Join")]
