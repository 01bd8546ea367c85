"""Plan guards: no registered query plans a Cartesian product or a nested-loop join,
and the partitioned scan prunes partitions."""

import contextlib
import io

import pytest

import __spark_entry__ as E

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
NAMES = sorted(E.queries())


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop(spark, sf, name):
    text = plan_text(E.queries()[name](spark, sf))
    assert not any(f in text for f in FORBIDDEN), name


def test_partition_pruning_and_pushdown(spark, sf):
    text = plan_text(E.queries()["pruned_scan"](spark, sf))
    assert "PartitionFilters: [isnotnull(ano" in text and "(ano#" in text
    text = plan_text(E.queries()["enrol_feed"](spark, sf))
    assert "ReadSchema: struct<c_custkey:bigint>" in text


def test_a_large_period_has_several_writers(spark):
    from pyspark.sql import functions as F
    from acadlake.session import scratch_path
    from acadlake.sources import landing as L
    df = spark.range(200_000).select(F.when(F.col("id") < 180_000, 1998).otherwise(F.col("id") % 3 + 1990).alias("ano"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("aluno")).repartition(16)
    path, key = scratch_path(spark, "layout"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        L.write_partitioned(df, path, ["ano"], ["aluno"])
    finally:
        spark.conf.set(key, old)
    stored = spark.read.parquet(path)
    files = stored.select(F.input_file_name().alias("f"), "ano").distinct().groupBy("ano").count().collect()
    n = {r.ano: r["count"] for r in files}
    assert n[1998] >= 4 and all(n[y] <= 3 for y in n if y != 1998)
    assert stored.count() == 200_000


def test_keys_prune_folders_and_reach_the_scan(spark, sf):
    text = plan_text(E.queries()["period_lookup"](spark, sf))
    assert "dynamicpruning" in text.lower() or "dynamicPruningExpression" in text
    text = plan_text(E.queries()["keyed_lookup"](spark, sf))
    assert "PushedFilters: [In(aluno" in text and "Join" not in text


def test_an_absent_key_inside_the_range_reads_no_row_group(spark):
    from pyspark.sql import functions as F
    from acadlake.session import scratch_path
    from acadlake.sources import landing as L
    df = spark.range(80_000).select(F.lit(1).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("k"))

    def rows_read(path, key):
        found = L.keyed_lookup(spark.read.parquet(path), spark.createDataFrame([(key,)], "k string"), ["k"])
        n = len(found.collect())
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return n, scan.metrics().get("numOutputRows").get().value()

    path, plain = scratch_path(spark, "bloom"), scratch_path(spark, "no-bloom")
    L.write_partitioned(df, path, ["p"], ["k"])
    df.write.partitionBy("p").parquet(plain)
    there = df.first().k
    absent = "8" * 64
    assert rows_read(path, absent) == (0, 0) and rows_read(path, there)[0] == 1
    assert rows_read(plain, absent)[1] > 0


def test_enrolment_scan_prunes_columns(spark, sf):
    from acadlake.views import Domain, domain
    text = plan_text(domain(spark, sf).enrol.select("aluno", "ano"))          # stored mirror
    assert "ReadSchema: struct<aluno:string,ano:bigint>" in text
    raw = Domain(spark, sf, stored_mirrors=False)                            # derivation from the driver tables
    text = plan_text(raw.enrol.select("aluno", "ano"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate" in text


def test_class_key_joins_are_colocated(spark, sf):
    """Bucketed mirrors: enrolment x class on the class key needs no exchange on either side."""
    from acadlake.views import domain
    d = domain(spark, sf)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = d.enrol.join(d.view("class"), ["ano", "semestre", "turma", "disciplina"])
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        text = buf.getvalue()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_hot_key_mirror_falls_back_to_shuffled_joins(spark):
    """A class key holding most rows must not be served as one bucket: the mirror is read as plain files."""
    from pyspark.sql import functions as F
    from acadlake.sources import mirror
    df = spark.range(4000).select(
        F.when(F.col("id") < 3000, F.lit(2000)).otherwise(F.col("id")).cast("bigint").alias("ano"),
        F.lit(1).cast("bigint").alias("semestre"), F.lit("T0").alias("turma"), F.lit("D1").alias("disciplina"),
        F.col("id").alias("v"))
    keys = ["ano", "semestre", "turma", "disciplina"]

    def self_join_plan(t):
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            return plan_text(t.join(t.select(*keys), keys))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

    hot = mirror.store(spark, "class", df, "hot-key-fixture")
    assert hot.count() == 4000
    assert "Exchange" in self_join_plan(hot)                    # shuffled: AQE can split the hot key
    cool = mirror.store(spark, "class", df.withColumn("ano", F.col("v")), "cool-fixture")
    assert "Exchange" not in self_join_plan(cool)               # bucketed: co-located
    # more buckets asked for than there are keys: still co-located, with buckets of several keys
    few = df.withColumn("ano", F.col("v") % 40)
    spark.conf.set("acadlake.mirror.buckets", "1000")
    try:
        assert mirror.layout(few, keys, 1000) == (10, False)
        assert "Exchange" not in self_join_plan(mirror.store(spark, "class", few, "few-keys-fixture"))
    finally:
        spark.conf.unset("acadlake.mirror.buckets")


def test_classes_grow_with_the_data(spark):
    from acadlake.views import Domain
    small, large = (Domain(spark, f"/root/testdata/{s}", stored_mirrors=False) for s in ("sf0.001", "sf0.01"))
    for view in ("class", "subject", "grid"):
        assert large.view(view).count() > 5 * small.view(view).count(), view


def test_mirror_source_is_computed_once_and_keys_are_not_shuffled(spark):
    """The layout counts rows by bucket: its shuffle is as small as the number of buckets; the source's join runs once."""
    from pyspark.sql import functions as F
    from acadlake.sources import mirror
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(len(r))
            yield r

    keys = mirror.LAYOUT["enrol"]
    df = spark.range(4000).select((F.col("id") % 1000).alias("ano"), F.lit(1).cast("bigint").alias("semestre"),
                                  F.lit("T01").alias("turma"), F.lit("D").alias("disciplina"), "id")
    n, hot = mirror.layout(df, keys, 8)
    assert (n, hot) == (8, False)
    once = df.mapInPandas(count, df.schema)
    held = mirror.store(spark, "enrol", once, "computed-once-fixture")
    assert seen.value == 4000
    assert held.count() == 4000 and held.select("id").distinct().count() == 4000


def test_members_of_codes_are_joined_without_shuffling_the_pairs(spark):
    """imp_008: subjects times members pairs come out once each, and what is shuffled is the two sides."""
    import re
    from acadlake.plans import products as P
    codes = spark.createDataFrame([(c, k) for c in ("A", "B", "C") for k in ("1", "2")] + [("A", "1"), ("D", "3"), ("E", None), ("F", "9")],
                                  "codigoDisciplina string, curso string")
    members = spark.createDataFrame([("1", "x"), ("2", "x"), ("2", "y"), ("3", "z"), ("4", "w"), (None, "v")],
                                    "curso string, emailUsuario string")
    taught = spark.createDataFrame([("A", "x"), ("A", "t"), ("D", "x"), ("F", "z"), ("Q", "w"), ("E", "v")],
                                   "codigoDisciplina string, emailUsuario string")
    out = P._codes_by_members(codes, members, taught)
    given = {(c, m) for c, k in {tuple(r) for r in codes.collect()} for k2, m in {tuple(r) for r in members.collect()} if k == k2 and k}
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == given | {tuple(r) for r in taught.collect()}
    text = plan_text(out)
    # no aggregate and no exchange above the join of the two sides
    assert not re.search(r"HashAggregate|Exchange", text[:text.index("Join")])


def test_derived_mirror_takes_over_its_parents_buckets(spark, monkeypatch):
    """Classes and exams are not counted or shuffled again: their rows come bucket by bucket from the mirror they are made of."""
    from pyspark.sql import functions as F
    from acadlake.sources import mirror
    keys = mirror.LAYOUT["enrol"]
    df = spark.range(4000).select((F.col("id") % 1000).alias("ano"), F.lit(1).cast("bigint").alias("semestre"),
                                  F.lit("T01").alias("turma"), F.lit("D").alias("disciplina"), "id")
    enrol = mirror.store(spark, "enrol", df, "derived-fixture")
    monkeypatch.setattr(mirror, "layout", lambda *a: pytest.fail("counted again"))
    classes = mirror.store(spark, "class", enrol.groupBy(*keys).agg(F.min("id").alias("id")), "derived-fixture")
    exams = mirror.store(spark, "exam", classes.unionByName(classes).unionByName(classes), "derived-fixture")
    assert (classes.count(), exams.count()) == (1000, 3000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = exams.join(classes.withColumnRenamed("id", "c"), keys)
        assert "Exchange" not in plan_text(joined) and joined.where("id = c").count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_products_are_built_once_and_students_read_the_stored_offerings(spark, sf, monkeypatch):
    from acadlake.plans import load_tables as LT
    from acadlake.plans import products as P
    from acadlake.views import Domain
    built, offerings = [], LT.BUILDERS[LT.OFFERINGS]
    monkeypatch.setitem(LT.BUILDERS, LT.OFFERINGS, lambda d: built.append(1) or offerings(d))
    monkeypatch.setattr(P, "load_student_offerings", lambda *a: pytest.fail("built again"))
    d = Domain(spark, sf)
    forms = LT.produced_forms(d)
    assert list(forms) == [t for t, _, _ in LT.PRODUCED] and built == [1]
    assert forms[LT.STUDENTS].count() > 0 and LT.produced_forms(d)[LT.STUDENTS] is forms[LT.STUDENTS]


def test_values_of_a_key_are_joined_by_sets_of_values(spark):
    """150 values (three numbers of 64 bits) and facts that repeat; the join has a row for a fact and 64 values."""
    from pyspark.sql import functions as F
    from acadlake.operators import relational as J
    links = [(f"s{i % 7}", f"c{i:03}") for i in range(150)] + [("s1", "c001"), ("s9", "c200"), (None, "c201")]
    facts = [(k, f"s{(k * 3 + j) % 11}") for k in range(5) for j in range(4)] * 2 + [(None, "s1"), (9, None)]
    f, g = spark.createDataFrame(facts, "k int, s string"), spark.createDataFrame(links, "s string, c string")
    want = {(k, c) for k, s in facts for s2, c in links if s is not None and s == s2}
    got = [tuple(r) for r in J.linked_values(f, g, "k", "s", "c").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert "bit_or" in plan_text(J.linked_values(f, g, "k", "s", "c"))
