"""Generations and keyed tables: conflicts, expiry, touched buckets, rejects and counts."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.session import scratch_path
from acadlake.tables.generations import Conflict, Generations
from acadlake.tables.keyed import KeyedTable

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()), T.StructField("w", T.StringType())])


def table(spark, buckets=8, **args):
    return KeyedTable(spark, scratch_path(spark, "keyed"), SCHEMA, ["k"], buckets, **args)


def load(spark, rows):
    return spark.createDataFrame(rows, "k string, v bigint, w string, seq int")


def held(t):
    return sorted(tuple(r) for r in t.read().collect())


def test_generations_one_of_two_writers_wins(spark):
    root = scratch_path(spark, "gen")
    a, b = Generations(spark, root), Generations(spark, root)
    assert a.current() == (0, {})
    assert a.publish(0, {"x": 1}) == 1 and b.current() == (1, {"x": 1})
    assert a.publish(1, {"x": 2}) == 2
    with pytest.raises(Conflict):
        b.publish(1, {"x": 3})
    assert b.current() == (2, {"x": 2}) and b.numbers() == [1, 2]


def test_generations_expire_by_age_not_by_count(spark):
    import time
    g = Generations(spark, scratch_path(spark, "gen"))
    for i in range(3):
        spark.range(1).write.parquet(f"{g.root}/dados/v=f{i}")
        g.publish(i, {"f": f"v=f{i}"})
    named = lambda c: {c["f"]}
    assert g.expire(3600, "dados", named) == [] and g.numbers() == [1, 2, 3]
    later = time.time() + 7200
    assert sorted(g.expire(3600, "dados", named, now=later)) == ["v=f0", "v=f1"]
    assert g.numbers() == [3] and g.current() == (3, {"f": "v=f2"})
    spark.range(1).write.parquet(f"{g.root}/dados/v=young")          # a writer at work
    assert g.expire(3600, "dados", named) == []


def test_upsert_counts_add_up_with_bad_and_repeated_keys(spark):
    t = table(spark)
    t.upsert(load(spark, [("a", 1, "x", 1), ("b", 2, "y", 1)]), ["seq"])
    c = t.upsert(load(spark, [("b", 3, None, 1), ("b", 4, None, 2), ("c", 5, "z", 1), (None, 6, "n", 1), (None, 6, "n", 1),
                              ("", 7, "e", 1), ("  ", 8, "s", 1)]), ["seq"])
    assert held(t) == [("a", 1, "x"), ("b", 4, None), ("c", 5, "z")]
    assert c == {"lidos": 7, "inseridos": 1, "atualizados": 1, "removidos": 0, "inalterados": 0, "ignorados": 1, "rejeitados": 4}
    assert sorted(r.v for r in t.rejects().collect()) == [6, 6, 7, 8]
    assert sorted((r.k, r.acao) for r in t.read_load().collect()) == [("a", "keep"), ("b", "update"), ("c", "insert")]
    # the same load once more changes nothing but is read again
    again = t.upsert(load(spark, [("c", 5, "z", 1)]), ["seq"])
    assert held(t) == [("a", 1, "x"), ("b", 4, None), ("c", 5, "z")] and again["atualizados"] == 1
    assert t.rejects().count() == 0


def test_keep_old_and_insert_absent(spark):
    t = table(spark)
    t.upsert(load(spark, [("a", 1, "x", 1)]), ["seq"])
    t.upsert(load(spark, [("a", 2, None, 1), ("b", None, "q", 1)]), ["seq"], keep_old=True)
    assert held(t) == [("a", 2, "x"), ("b", None, "q")]
    c = t.insert_absent(load(spark, [("a", 9, "n", 1), ("c", 3, "first", 1), ("c", 4, "second", 2), (None, 1, "", 1)]), ["seq"])
    assert held(t) == [("a", 2, "x"), ("b", None, "q"), ("c", 3, "first")]
    assert (c["inseridos"], c["inalterados"], c["ignorados"], c["rejeitados"]) == (1, 1, 1, 1)
    # a source without some columns keeps them
    t.upsert(spark.createDataFrame([("a", 7)], "k string, v bigint"))
    assert held(t)[0] == ("a", 7, "x")


def test_load_of_one_bucket_touches_that_bucket_only(spark):
    t = table(spark, buckets=16)
    t.upsert(spark.range(4000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit("w").alias("w")))
    before = t.generations.current()[1]["baldes"]
    assert len(before) == 16
    small = t.read().withColumn("b", t._bucket(16)).where("b = 5").limit(3).select("k", F.lit(-1).cast("bigint").alias("v"))
    t.upsert(small)
    content = t.generations.current()[1]
    changed = {b for b, v in content["baldes"].items() if v != before[b]}
    assert changed == {"5"} and content["tocados"] == [5] and content["linhas"] == 4000
    files = t.scan(content, {5}).inputFiles()
    assert files and all("/balde=5/" in f for f in files)
    plan = t.scan(content, {5})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "balde#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert t.read().where("v = -1").count() == 3 and t.read().count() == 4000
    only = t.lookup(spark.createDataFrame([("17",), ("nope",)], "k string"))
    assert [r.k for r in only.collect()] == ["17"] and len([f for f in only.inputFiles() if "/balde=" in f]) <= 2


def test_one_shuffle_of_the_touched_buckets(spark, monkeypatch):
    """The grouping and the partitioned write follow the repartitioning by bucket: no second exchange of the table."""
    t, kind = table(spark), type(spark.range(1))
    t.upsert(load(spark, [("a", 1, "x", 1)]), ["seq"])
    plans, observe = [], kind.observe
    monkeypatch.setattr(kind, "observe", lambda self, *a: plans.append(
        self._jdf.queryExecution().executedPlan().toString()) or observe(self, *a))
    t.upsert(load(spark, [("a", 2, "x", 1)]), ["seq"])
    assert plans[0].count("Exchange") == 1 and "REPARTITION_BY_COL" in plans[0]


def test_conflicting_loads_and_reset_across_processes(spark):
    t = table(spark)
    t.upsert(load(spark, [("a", 1, "x", 1)]), ["seq"])
    other = KeyedTable(spark, t.root, SCHEMA, ["k"])
    number = t.generations.current()[0]
    other.generations.publish(number, t.generations.current()[1])           # somebody was faster
    with pytest.raises(Conflict):
        t._publish(number, t._state()[1], "v=none", set(), 8, {"inseridos": 0, "removidos": 0})
    other.reset()
    assert held(t) == [] and held(KeyedTable(spark, t.root, SCHEMA, ["k"])) == []
    assert [tuple(r) for r in t.read(generation=1).collect()] == [("a", 1, "x")]     # a reader of the old generation goes on
    import time
    assert t.expire(3600) == []
    assert len(t.expire(3600, now=time.time() + 7200)) == 1
    t.upsert(load(spark, [("z", 1, "x", 1)]), ["seq"])
    assert held(other) == [("z", 1, "x")]


def test_failing_load_leaves_the_table(spark):
    t = table(spark)
    t.upsert(load(spark, [("a", 1, "x", 1)]), ["seq"])
    bad = load(spark, [("b", 2, "y", 1)]).withColumn("v", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        t.upsert(bad, ["seq"])
    assert held(t) == [("a", 1, "x")]


def test_buckets_double_when_outgrown(spark):
    t = table(spark, buckets=2, rows_per_bucket=50)
    for start in (0, 300, 600):
        t.upsert(spark.range(start, start + 300).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit("").alias("w")))
    assert t.generations.current()[1]["n"] >= 8
    assert t.read().count() == 900 == t.read().select("k").distinct().count()
    assert t.lookup(spark.createDataFrame([("899",)], "k string")).count() == 1


def test_guarded_delete_and_conditional_rewrite(spark):
    t = table(spark)
    t.upsert(load(spark, [(x, i, "o", 1) for i, x in enumerate("abcdef")]), ["seq"])
    live = spark.createDataFrame([("a",), ("b",)], "k string")
    assert t.guarded_delete(live) == {"total": 6, "obsoletos": 4, "abortado": True, "removidos": 0}
    assert t.guarded_delete(live.limit(0))["abortado"] and t.read().count() == 6
    live = spark.createDataFrame([(x,) for x in "abcd"], "k string")
    assert t.guarded_delete(live)["removidos"] == 2 and [r[0] for r in held(t)] == list("abcd")
    assert t.guarded_delete(live) == {"total": 4, "obsoletos": 0, "abortado": False, "removidos": 0}
    upd = spark.createDataFrame([("a", "o", "n"), ("b", "other", "n"), ("zz", "o", "n"), ("c", "o", "o")],
                                "k string, valor_antigo string, valor_novo string")
    c = t.rewrite_if_unchanged(upd, "w")
    assert [r[2] for r in held(t)] == ["n", "o", "o", "o"] and (c["atualizados"], c["inseridos"]) == (1, 0)


def test_random_loads_against_a_dictionary(spark):
    rng = random.Random(3)
    t, want = table(spark, buckets=4), {}
    for turn in range(4):
        rows = [(rng.choice([None, "", *"abcdefghij", "hot", "hot", "hot"]), rng.randrange(99), rng.choice([None, "x"]), i)
                for i in range(40)]
        mode = rng.choice(["upsert", "old", "absent", "lowest"])
        df = load(spark, rows).repartition(3)
        good = [r for r in rows if r[0]]
        if mode == "upsert":
            counts = t.upsert(df, ["seq"])
            want.update({k: (v, w) for k, v, w, _ in good})
        elif mode == "old":
            counts = t.upsert(df, ["seq"], keep_old=True)
            last = {k: (v, w) for k, v, w, _ in good}
            want.update({k: (v, w if w is not None else want.get(k, (0, None))[1]) for k, (v, w) in last.items()})
        elif mode == "absent":
            counts = t.insert_absent(df, ["seq"])
            for k, v, w, _ in good:
                want.setdefault(k, (v, w))
        else:
            counts = t.lowest_wins(df.drop("seq"), ["v"])
            for k, v, w, _ in sorted(good, key=lambda r: (r[1], r[2] is not None)):
                if k not in want or v < want[k][0]:
                    want[k] = (v, w)
        assert held(t) == sorted(((k, v, w) for k, (v, w) in want.items())), (turn, mode)
        assert counts["lidos"] == 40 == sum(counts[x] for x in ("inseridos", "atualizados", "inalterados", "ignorados", "rejeitados"))
