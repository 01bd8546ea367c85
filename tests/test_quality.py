"""Stored snapshots and mergeable sketches."""

from pyspark.sql import functions as F

from acadlake.operators import aggregates as A
from acadlake.operators import quality as Q
from acadlake.session import scratch_path


def frame(spark, pages):
    rows = [(p, k) for p, keys in pages.items() for k in keys]
    return spark.createDataFrame(rows, "pagina long, k long")


def said(df):
    return {r.pagina: (r.tamanho_atual, r.tamanho_anterior, r.identica, r.chaves_adicionadas, r.chaves_removidas)
            for r in df.collect()}


def test_snapshot_compares_with_what_was_stored(spark):
    store = Q.SnapshotStore(spark, scratch_path(spark, "snap"))
    store.save(frame(spark, {0: [1, 2, 2, None], 1: [3], 700: [9, 10]}), "k", "pagina")
    now = frame(spark, {0: [2, 1], 700: [10, 11, 12], 5: [4]})
    assert said(store.compare(now, "k", "pagina")) == {
        0: (2, 2, True, "", ""), 1: (0, 1, False, "", "3"), 700: (3, 2, False, "11,12", "9"), 5: (1, 0, False, "4", "")}
    again = Q.SnapshotStore(spark, store.generations.root)          # another process
    again.save(now, "k", "pagina")
    assert all(v[2] for v in said(store.compare(now, "k", "pagina")).values())


def test_unchanged_pages_are_not_read(spark):
    df = spark.range(100_000).select(F.floor(F.col("id") / 10).cast("long").alias("pagina"), F.col("id").alias("k"))
    store = Q.SnapshotStore(spark, scratch_path(spark, "snap"))
    store.save(df, "k", "pagina")
    changed = spark.createDataFrame([(3, 0, 1)], "pagina long, faixa long, mudou int")
    changed.write.parquet(path := scratch_path(spark, "changed"))
    changed = spark.read.parquet(path).where("mudou = 1")
    keys = store.stored_keys(changed)
    assert "dynamicpruning" in keys._jdf.queryExecution().executedPlan().toString().lower()
    assert sorted(r.chave for r in keys.collect()) == list(range(30, 40))
    files = spark.read.parquet(store._folder("chaves")).where("faixa = 0").count()
    assert files == 2560                            # the one folder that is read: 256 of 10,000 pages
    got = store.compare(df.where("k <> 35"), "k", "pagina").where("NOT identica").collect()
    assert [(r.pagina, r.chaves_removidas) for r in got] == [(3, "35")]


def test_merged_sketches_keep_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 6).alias("carga"), (F.col("id") % 20_000).alias("a"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("b"))
    stored = A.sketches(df, "carga", ["a", "b"])
    assert stored.count() == 12
    rows = {r.coluna: r for r in A.merged_profile(stored).collect()}
    assert abs(rows["a"].distintos - 20_000) <= A.SKETCH_ERROR * 20_000 and rows["b"].distintos == 7
    assert (rows["a"].linhas, rows["b"].preenchidas, rows["b"].duplicados) == (60_000, 40_000, 39_993)
    half = A.merged_profile(stored.where("carga < 3")).where("coluna = 'a'").first()
    exact = df.where("carga < 3").select("a").distinct().count()
    assert abs(half.distintos - exact) <= A.SKETCH_ERROR * exact


def test_exact_profile_copies_no_row(spark):
    df = spark.range(1000).selectExpr("id % 7 AS a", "id % 11 AS b", "CASE WHEN id % 2 = 0 THEN id END AS c")
    out = A.profile(df, ["a", "b", "c"], {"par": F.col("a") % 2 == 0}, "b")
    assert tuple(out.first()) == (1000, 7, 11, 500, 571, 10)
    assert "Expand" not in out._jdf.queryExecution().toString()
    assert tuple(A.profile(df.limit(0), ["a"], max_col="b").first()) == (0, 0, None)


def test_row_checks_make_messages_for_broken_rows_only(spark):
    from acadlake.operators import contracts as C
    from test_plans import plan_text
    contract = C.Contract("t", (C._f("a", "CHAR(3)", True), C._f("b", "CHAR(2)", False)), ("a",))
    df = spark.createDataFrame([("x", "y"), ("", "y"), ("　 ", None), (None, "yyy"), ("abcd", "yyy"), ("　x", "y")], "a string, b string")
    assert [(r.a, r.violacoes) for r in C.row_rejects(df, contract).collect()] == [
        ("", ["a:obrigatorio"]), ("　 ", ["a:obrigatorio"]), (None, ["a:obrigatorio", "b:CHAR(2)"]), ("abcd", ["a:CHAR(3)", "b:CHAR(2)"])]
    kept = [x for x in plan_text(C.row_rejects(df, contract)).splitlines() if x.startswith("Condition")]
    assert kept and not any("filter(array" in x for x in kept)      # the rows are chosen without their lists
