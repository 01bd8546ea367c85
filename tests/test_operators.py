"""Operator properties: merges, guarded delete, dedupe, ids, versioning, streaming resume."""

from pyspark.sql import functions as F

from acadlake.operators import maintenance as M
from acadlake.operators import ordering as O
from acadlake.operators import relational as J
from acadlake.session import scratch_path
from acadlake.sources import landing as L
from acadlake.sources import sinks as KS
from acadlake.streaming.paged import PagedLoad
from acadlake.views import domain

TARGET = [(1, "a", "x"), (2, "b", "y"), (3, "c", None)]
SOURCE = [(2, "B", None, 1), (2, "BB", "w", 2), (4, "d", "z", 1)]


def frames(spark):
    t = spark.createDataFrame(TARGET, "k bigint, v string, w string")
    s = spark.createDataFrame(SOURCE, "k bigint, v string, w string, seq int")
    return t, s


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_m1_upsert_last_wins_and_nulls(spark):
    t, s = frames(spark)
    out = rows(M.upsert(t, s, ["k"], order=["seq"]))
    assert out == [(1, "a", "x", "keep"), (2, "BB", "w", "update"), (3, "c", None, "keep"), (4, "d", "z", "insert")]


def test_m1_null_overwrites_m2_keeps(spark):
    t, s = frames(spark)
    s1 = s.where("seq = 1")
    assert rows(M.upsert(t, s1, ["k"], order=["seq"]))[1] == (2, "B", None, "update")
    assert rows(M.upsert_keep_old(t, s1, ["k"], order=["seq"]))[1] == (2, "B", "y", "update")


def test_m1_idempotent(spark):
    t, s = frames(spark)
    once = M.upsert(t, s, ["k"], order=["seq"]).drop("acao")
    twice = M.upsert(once, s, ["k"], order=["seq"]).drop("acao")
    assert rows(once) == rows(twice)


def test_m3_insert_absent(spark):
    t, s = frames(spark)
    out = rows(M.insert_absent(t, s.select("k", "v", "w", "seq"), ["k"], ["seq"]))
    assert out == [(1, "a", "x", "keep"), (2, "b", "y", "keep"), (3, "c", None, "keep"), (4, "d", "z", "insert")]


def test_m4_m5_empty_policy(spark):
    t, _ = frames(spark)
    empty = t.limit(0)
    kept, _ = M.full_refresh(t, empty, ["k"], empty_policy="keep")
    cleared, _ = M.full_refresh(t, empty, ["k"], empty_policy="clear")
    assert kept.count() == 3 and cleared.count() == 0


def test_m6_guard(spark):
    t = spark.range(10).withColumnRenamed("id", "k")
    state, stats = M.guarded_delete(t, spark.range(3).withColumnRenamed("id", "k"), ["k"])
    assert stats["abortado"] and state.count() == 10            # 70% obsolete: abort
    state, stats = M.guarded_delete(t, spark.range(6).withColumnRenamed("id", "k"), ["k"])
    assert not stats["abortado"] and state.count() == 6
    state, stats = M.guarded_delete(t, t.limit(0), ["k"])
    assert stats["abortado"] and state.count() == 10             # empty live set: nothing


def test_m8_sweep_null_safe(spark):
    prev = spark.createDataFrame([("c", "n", None), ("c", "m", "e")], "c string, n string, e string")
    cur = spark.createDataFrame([("c", "n", None)], "c string, n string, e string")
    out = rows(M.mark_and_sweep(prev, cur, ["c", "n", "e"], null_safe=("e",)))
    assert out == [("c", "m", "e", "N"), ("c", "n", None, "S")]


def test_m12_m13(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("006", "2026", 3)], "curso string, curriculo string, prazo int")
    schema = T.StructType([T.StructField("curso", T.StringType()), T.StructField("prazo", T.LongType()),
                           T.StructField("ativo", T.StringType())])
    assert M.evolve(df, schema, {"ativo": "S"}).first().asDict() == {"curso": "006", "prazo": 3, "ativo": "S"}
    assert M.rekey(df, ["curso", "curriculo", "prazo"]).first()["id"] == "006_2026_3"


def test_m14_deactivation(spark):
    system = spark.createDataFrame([("a", None), ("b", "x")], "k string, p string")
    load = spark.createDataFrame([("a", None)], "k string, p string")
    assert rows(M.deactivation_keys(system, load, ["k", "p"], null_safe=("p",))) == [("b", "x")]


def test_m15_version_swap(spark):
    root = scratch_path(spark, "versioned")
    vt = M.VersionedTable(spark, root)
    assert vt.current() is None
    vt.write(spark.range(3))
    first = vt.current()
    vt.write(spark.range(5))
    assert vt.current() != first and vt.read().count() == 5


def test_m4_refresh_counts_in_the_write_and_keeps_rejects_apart(spark):
    vt = M.VersionedTable(spark, scratch_path(spark, "refresh"))
    kinds = "k string, n int"
    src = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("b", 0), ("b", None), ("c", 4)], kinds)
    assert vt.refresh(src, ["k", "n"], numeric=("n",)) == {"lidos": 6, "validos": 2, "rejeitados": 4} == vt.stats()
    assert rows(vt.read()) == [("a", 1), ("c", 4)] and vt.rejects().count() == 4 and vt.read().columns == ["k", "n"]
    vt.refresh(src.limit(0), ["k"])
    assert vt.read().count() == 2 and vt.stats()["lidos"] == 0              # kept
    vt.refresh(spark.createDataFrame([("", 1)], kinds), ["k"])
    assert vt.read().count() == 0 and vt.rejects().count() == 1             # rows came, none valid
    vt.refresh(src, ["k"])
    vt.refresh(src.limit(0), ["k"], empty_policy="clear")
    assert vt.read().count() == 0


def test_m15_conflict_and_expiry(spark):
    import time
    import pytest
    from acadlake.tables.generations import Conflict
    vt = M.VersionedTable(spark, scratch_path(spark, "versioned"))
    vt.write(spark.range(3))
    base, old = vt.number(), vt.current()
    vt.write(spark.range(4), base=base)
    with pytest.raises(Conflict):
        M.VersionedTable(spark, vt.root).write(spark.range(9), base=base)
    assert vt.read().count() == 4 and spark.read.parquet(old).count() == 3
    assert vt.expire(3600) == [] and len(vt.expire(3600, now=time.time() + 7200)) == 2      # the old one and the loser's
    assert vt.read().count() == 4


def test_merges_leave_out_records_without_a_key(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    s = spark.createDataFrame([("a", 2), (None, 3), (None, 3), ("", 4), (" ", 5), ("b", 6), ("b", 7)], "k string, v int")
    for merge in (M.upsert, M.upsert_keep_old):
        assert rows(merge(t, s, ["k"], order=["v"])) == [("a", 2, "update"), ("b", 7, "insert")]
    assert rows(M.insert_absent(t, s, ["k"], ["v"])) == [("a", 1, "keep"), ("b", 6, "insert")]
    assert M.split_by_key(s, ["k"])[1].count() == 4
    c = M.merge_statistics(M.upsert(t, s, ["k"], order=["v"]), s, ["k"]).first()
    assert (c.lidos, c.inseridos, c.atualizados, c.ignorados, c.erros) == (7, 1, 1, 1, 4)


def test_m15_failing_writes_leave_the_old_version(spark):
    import pytest
    vt = M.VersionedTable(spark, scratch_path(spark, "versioned"))
    vt.write(spark.range(4), expected=4)
    old = vt.current()
    with pytest.raises(Exception, match="broken"):
        vt.write(spark.range(9).select(F.when(F.col("id") > 5, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")))
    with pytest.raises(ValueError, match="3 rows stored"):
        vt.write(spark.range(3), expected=4)
    assert vt.current() == old and vt.read().count() == 4


def test_m12_rebuild_without_a_required_column(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    assert M.evolve(spark.range(3).withColumnRenamed("id", "v"), schema, required=("k",)).count() == 0
    assert M.evolve(spark.range(3).withColumnRenamed("id", "k"), schema, required=("k",)).count() == 3


def test_dedupe_unique_by_key(spark, sf):
    e = domain(spark, sf).enrol
    out = O.pick_per_key(e.select("aluno", "disciplina", "ano", "turma"), ["aluno"], ["ano", "turma"], keep="last")
    assert out.count() == out.select("aluno").distinct().count() == e.select("aluno").distinct().count()


def test_w2_sequential_ids_consecutive(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    ids = O.sequential_ids(df, [F.col("v").asc()], "seq", partitions=6)
    got = [(r["v"], r["seq"]) for r in ids.orderBy("seq").collect()]
    assert [s for _, s in got] == list(range(1, 5001))
    assert [v for v, _ in got] == sorted(v for v, _ in got)


def test_w8_islands(spark):
    df = spark.createDataFrame([(1, 0, 1), (1, 1, 1), (1, 2, 2), (1, 3, 1)], "k int, p int, t int")
    assert [r["grupo"] for r in O.islands(df, ["k"], "p", "t").orderBy("p").collect()] == [0, 0, 1, 2]


def test_j3_anti_keys_drop_nulls(spark):
    a = spark.createDataFrame([(1,), (None,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(1,)], "k int")
    assert rows(J.anti_keys(a, b, ["k"])) == [(2,)]


def test_s9_rename_alternates(spark):
    df = spark.createDataFrame([("T1", "", "a@b", None)], "turmaPref string, turma string, resp_e_mail string, resp_email string")
    out = L.rename_fields(df, {}, fallbacks={"turma": ["turmaPref", "turma"]}, alternates={"resp_email": "resp_e_mail"})
    assert out.first().asDict() == {"turma": "T1", "resp_email": "a@b"}


def test_k5_unknown_table_skipped(spark, sf):
    d = domain(spark, sf)
    lines, skipped = KS.export_tables({"imp_001_cursos": d.course.select(F.col("curso").alias("codigoCurso")),
                                       "nao_existe": d.course})
    assert skipped == ["nao_existe"] and lines.where("__k = 5").first()["linha"].startswith("codigoCurso;")


def test_t1_resume_adds_nothing(spark, sf):
    d = domain(spark, sf)
    root = scratch_path(spark, "t-landing")
    ev = d.events.select(F.col("event_id").alias("eventId"), F.col("event_type").alias("eventType"))
    L.land_pages(ev, root, [F.col("eventId").asc()], 100, bare_every=3, stray_after_end={"eventId": 10 ** 12})
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("eventId", T.LongType()), T.StructField("eventType", T.StringType())])
    load = PagedLoad(spark, root, scratch_path(spark, "t-target"), scratch_path(spark, "t-ckpt"), schema, "eventId")
    assert load.run() > 0
    first = load.result().count()
    assert load.run() == 0                                   # resume: nothing new
    assert load.result().count() == first == ev.count()      # stray page after the end ignored, no duplicates
    assert load.high_water().first()[0] == ev.agg(F.max("eventId")).first()[0]


def test_t2_bounded_increments(spark, sf):
    d = domain(spark, sf)
    root = scratch_path(spark, "b-landing")
    ev = d.events.select(F.col("event_id").alias("eventId"))
    L.land_pages(ev, root, [F.col("eventId").asc()], 100)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("eventId", T.LongType())])
    load = PagedLoad(spark, root, scratch_path(spark, "b-target"), scratch_path(spark, "b-ckpt"), schema, "eventId")
    assert load.run_pages(3) == 2
    assert load.result().count() == 300
    last = 2
    while True:
        new = load.run_pages(3)
        if new == last:
            break
        last = new
    assert load.result().count() == ev.count()
    state = load.state().first()
    assert (state.ultima_pagina, state.ultima_chave) == (last, ev.agg(F.max("eventId")).first()[0])


PAGE_SCHEMA = "eventId long, v string"


def land(spark, root, pages):
    """Pages in the order given, each in a file of its own, under its range's folder."""
    import json
    for n, body in pages:
        line = f"{n}\t" + json.dumps({"data": [{"eventId": k, "v": v} for k, v in body]})
        spark.createDataFrame([(0, line)], "faixa long, value string").coalesce(1).write.mode("append").partitionBy("faixa").text(root)


def paged(spark, root, name):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("eventId", T.LongType()), T.StructField("v", T.StringType())])
    return lambda: PagedLoad(spark, root, f"{name}/t", f"{name}/c", schema, "eventId", files_per_batch=1)


def test_t5_late_repeated_and_out_of_order_pages_leave_unique_keys(spark):
    root, name = scratch_path(spark, "o-landing"), scratch_path(spark, "o-load")
    new = paged(spark, root, name)
    land(spark, root, [(9, [(99, "behind the end")]), (1, [(1, "late"), (4, "d")])])
    load = new()
    load.run()
    assert load.high_water().first()[0] == 99
    land(spark, root, [(0, [(1, "a"), (2, "b")]), (1, [(1, "late"), (4, "d")]), (2, [(2, "again"), (5, "e")]), (3, [])])
    load = new()                                    # a restart: another object on the same folders
    load.run()
    stored = load.table().read()                    # the table itself, not a view of it
    assert rows(stored.select("eventId", "v", "pagina")) == [(1, "a", 0), (2, "b", 0), (4, "d", 1), (5, "e", 2)]
    assert load.high_water().first()[0] == 5        # the page behind the end is gone
    before = load.table().generations.numbers()
    land(spark, root, [(1, [(1, "late"), (4, "d")])])
    new().run()                                     # a page that came before reaches no bucket
    assert load.table().generations.numbers() == before
    land(spark, root, [(7, [(70, "x")])])
    new().run()
    assert load.result().count() == 4 and load.result().select("eventId").distinct().count() == 4


def test_t5_reading_shuffles_nothing(spark):
    root, name = scratch_path(spark, "o-landing"), scratch_path(spark, "o-load")
    load = paged(spark, root, name)()
    land(spark, root, [(0, [(1, "a")]), (1, [])])
    load.run()
    assert "Exchange" not in load.result()._jdf.queryExecution().executedPlan().toString()


def test_t3_reset_holds_for_every_process(spark):
    import time
    import pytest
    from acadlake.tables.generations import Conflict
    root, name = scratch_path(spark, "x-landing"), scratch_path(spark, "x-load")
    new = paged(spark, root, name)
    land(spark, root, [(0, [(1, "a"), (2, "b")]), (1, [])])
    first, second = new(), new()
    first.run()
    assert rows(second.result().select("eventId")) == [(1,), (2,)]
    number = first.resets.current()[0]
    first.reset()
    assert second.result().count() == 0 and new().result().count() == 0 and new().high_water().first()[0] is None
    with pytest.raises(Conflict):                   # who started from the old generation loses
        second.resets.publish(number, {"pasta": "estado=x"})
    assert new().run() > 0 and first.result().count() == 2
    later = time.time() + 7200
    assert new().expire(3600) == []
    assert len([g for g in new().expire(3600, now=later) if g.startswith("estado=")]) == 1
    assert new().result().count() == 2


def test_t3_reset_reloads_everything(spark, sf):
    from pyspark.sql import types as T
    d = domain(spark, sf)
    root = scratch_path(spark, "r-landing")
    ev = d.events.select(F.col("event_id").alias("eventId"))
    L.land_pages(ev, root, [F.col("eventId").asc()], 100)
    schema = T.StructType([T.StructField("eventId", T.LongType())])
    load = PagedLoad(spark, root, scratch_path(spark, "r-target"), scratch_path(spark, "r-ckpt"), schema, "eventId",
                     files_per_batch=1)
    load.run()
    assert load.result().count() == ev.count()
    load.reset()
    assert load.result().count() == 0
    load.run()
    assert load.result().count() == ev.count()


def test_k1_csv_quoting_and_booleans(spark):
    df = spark.createDataFrame([("a;b", 'say "hi"', None, True), ("x", "y", "z", False)],
                               "c1 string, c2 string, c3 string, ok boolean")
    lines = [r["linha"] for r in KS.csv_lines(df, ["c1", "c2", "c3", "ok"]).orderBy("__k", "linha").collect()]
    assert lines == ["c1;c2;c3;ok", '"a;b";"say ""hi""";;true', "x;y;z;false"]


def test_k3_html_escaping(spark):
    df = spark.createDataFrame([("C&A", "<b>", "1")], "g string, v string, o string")
    lines = {r["linha"] for r in KS.html_report_lines(df, "g", [("v", "Valor")], ["o"]).collect()}
    assert "<tr><td>&lt;b&gt;</td></tr>" in lines
    assert any(line.startswith("<h2>C&amp;A (1)</h2>") for line in lines)


def test_k4_load_sheet_layout(spark):
    from acadlake.operators.contracts import CONTRACTS
    df = spark.createDataFrame([("006", "ENG", 5)], "codigoCurso string, nomeCurso string, quantPeriodos bigint")
    got = [r["linha"] for r in KS.load_sheet_lines(df, CONTRACTS["imp_001_cursos"]).orderBy("__k").collect()]
    assert got == ["Tipo de Carga:;Incremental", "Escopo da Carga:;Instituicao", "Limite do Escopo:;",
                   "Conteúdo da Carga:;IMP-001 - Cursos", "",
                   "codigoCurso;nomeCurso;quantPeriodos;codigoUnidadeOrganizacional", "006;ENG;5;"]


def test_t1_backlog_is_read_in_few_batches(spark):
    """A run over many files rewrites the table a bounded number of times, however many files landed."""
    from pyspark.sql import types as T
    from acadlake.streaming.paged import MOST_BATCHES
    schema = T.StructType([T.StructField("eventId", T.LongType())])
    root, rows = scratch_path(spark, "backlog"), 20 * L.PAGES_PER_FILE
    L.land_pages(spark.range(rows).select(F.col("id").alias("eventId")), root, [F.col("eventId").asc()], 1)
    load = PagedLoad(spark, root, scratch_path(spark, "bl-target"), scratch_path(spark, "bl-ckpt"), schema, "eventId",
                     files_per_batch=1)
    assert 1 < load.run() <= MOST_BATCHES
    assert load.result().agg(F.count("*"), F.countDistinct("eventId")).first() == (rows, rows)
    assert load.run() == 0


def test_deactivated_keys_are_grouped_once(spark):
    from acadlake.operators import maintenance as M
    from test_plans import plan_text
    system = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), (None, "x"), ("c", "y"), ("d", "z")], "k string, p string")
    load = spark.createDataFrame([("a", None), (None, "x"), ("c", "q"), ("d", "z"), ("e", "w")], "k string, p string")
    gone = M.deactivation_keys(system, load, ["k", "p"], null_safe=("p",))
    assert sorted(map(tuple, gone.collect()), key=repr) == [("b", "x"), ("c", "y"), (None, "x")]
    assert sorted(map(tuple, M.deactivation_keys(system, load, ["k", "p"]).collect()), key=repr) == [
        ("a", None), ("b", "x"), ("c", "y"), (None, "x")]
    text = plan_text(M.deactivation_keys(system, load, ["k", "p"], null_safe=("p",)))
    assert text.count("hashpartitioning") == 1 and "Join" not in text
