"""Two-level ranks and runs against plain Python, with hot keys, ties and many partitions."""

import random

import pytest
from pyspark.sql import functions as F

from acadlake.operators import ordering as O


def plain_runs(rows):
    """{(key, order): (place, run)} of (key, order, value)."""
    out, key, last, pos, run = {}, object(), None, 0, 0
    for k, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        if k != key:
            key, pos, run = k, 0, 0
        else:
            pos += 1
            run += v is None or last is None or v != last
        last = v
        out[k, o] = (pos, run)
    return out


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_places_and_runs(spark, partitions):
    rng = random.Random(partitions)
    keys = ["hot"] * 300 + [f"k{i}" for i in range(60)] * 3 + [None] * 9
    rows = [(k, i, rng.choice([1, 1, 2, None])) for i, k in enumerate(rng.sample(keys, len(keys)))]
    df = spark.createDataFrame(rows, "k string, o long, v int").repartition(5)
    got = O.key_runs(df, ["k"], [F.col("o")], "v", partitions).collect()
    assert {(r.k, r.o): (r["__pos"], r["__run"]) for r in got} == plain_runs(rows) and len(got) == len(rows)


def test_hot_key_is_ranked_in_many_tasks(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("o"))
    ranged = df.repartitionByRange(8, "k", "o").groupBy(F.spark_partition_id()).count()
    assert ranged.count() == 8 and O.repeat_suffix(df, "k", [F.col("o")]).where("seq = o").count() == 4000


def test_empty(spark):
    df = spark.createDataFrame([], "k string, o long, v int")
    assert O.islands(df, ["k"], "o", "v").count() == 0 == O.repeat_suffix(df, "k", [F.col("o")]).count()


def test_free_codes_skip_what_is_given(spark):
    rng = random.Random(4)
    given = ["A", "A01", "A03", "A3", "A003", "A100", "B02", "AB", "A101", "C", "C00", "X1", "X101", None, "", "A01"]
    rows = [(rng.choice(["A", "A", "A", "B", "C", "X1", "Z"]), i) for i in range(400)]
    blank = spark.createDataFrame(rows, "base string, pos long")
    got = O.free_codes(blank, spark.createDataFrame([(g,) for g in given], "codigo string"), "base", F.col("pos"), "codigo")
    want, taken = [], set(given)
    for base, pos in sorted(rows, key=lambda r: r[1]):
        i = 0
        while (code := base if i == 0 else f"{base}{i:02d}") in taken:
            i += 1
        taken.add(code)
        want.append((base, pos, code))
    assert sorted((r.base, r.pos, r.codigo) for r in got.collect()) == sorted(want)
