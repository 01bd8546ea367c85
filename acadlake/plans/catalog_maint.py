"""Registered maintenance queries (M1-M14, A12) and their oracles.

Merge inputs: the stored snapshot is the orders placed before 1999 and the new
extract is every order placed from 1997 on (the two windows overlap, so keys
are updated, kept and inserted), plus a later correction row for urgent
orders, which the merge must apply last.  In the extract some records come
without key (NULL, empty, blanks): they are rejects.  The snapshot is a stored
keyed table; what the queries return is read back from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.functions import constants as K
from acadlake.functions import scalars as S
from acadlake.operators import contracts as C
from acadlake.operators import maintenance as M
from acadlake.operators import ordering as O
from acadlake.plans import products as P
from acadlake.plans import worklists as WL
from acadlake.plans.catalog_products import COMMITTEE_CTES, committee_ctes
from acadlake.plans.load_tables import PRODUCED, product_ctes, produced_forms, union
from acadlake.plans.oracle_sql import ci, q, strip, with_views
from acadlake.session import scratch_path
from acadlake.tables.keyed import KeyedTable
from acadlake.views import domain

QUERIES = {}
ORACLES = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


SNAPSHOT_END = "1999-01-01"
EXTRACT_START = "1997-01-01"


def _order_key(lost: bool):
    key = F.concat(F.lit("P"), F.col("o_orderkey").cast("string"))
    if not lost:
        return key
    n = F.col("o_orderkey")
    return F.when(n % 11 == 0, F.lit(None)).when(n % 13 == 0, "").when(n % 17 == 0, "  ").otherwise(key)


def order_versions(spark, sf) -> tuple[DataFrame, DataFrame]:
    o = domain(spark, sf).orders
    cols = [F.col("o_custkey").alias("cliente"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("valor"),
            F.col("o_orderpriority").alias("prioridade")]
    target = o.where(F.col("o_orderdate") < F.lit(SNAPSHOT_END).cast("timestamp_ntz")).select(
        _order_key(False).alias("chave"), *cols)
    new = o.where(F.col("o_orderdate") >= F.lit(EXTRACT_START).cast("timestamp_ntz")).select(_order_key(True).alias("chave"), *cols)
    extract = new.select("chave", "cliente", F.when(F.col("status") == "O", "F").otherwise(F.col("status")).alias("status"),
                         "valor", F.when(F.col("prioridade").startswith("1"), F.lit(None).cast("string"))
                         .otherwise(F.col("prioridade")).alias("prioridade"), F.lit(1).alias("seq"))
    correction = new.where(F.col("prioridade") == "1-URGENT").select(
        "chave", "cliente", F.lit("P").alias("status"), "valor", F.lit(None).cast("string").alias("prioridade"),
        F.lit(2).alias("seq"))
    return target, extract.unionByName(correction)


def stored_orders(spark, target: DataFrame) -> KeyedTable:
    table = KeyedTable(spark, scratch_path(spark, "orders"), target.schema, ["chave"])
    table.upsert(target)
    return table


_LOST = """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN '  '
        ELSE 'P' || CAST(o_orderkey AS VARCHAR) END"""
ORDER_CTES = [
    f"""tgt AS (SELECT 'P' || CAST(o_orderkey AS VARCHAR) AS chave, o_custkey AS cliente, o_orderstatus AS status,
      o_totalprice AS valor, o_orderpriority AS prioridade FROM orders WHERE o_orderdate < TIMESTAMP '{SNAPSHOT_END}')""",
    f"""src_all AS (
      SELECT {_LOST} AS chave, o_custkey AS cliente, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status,
        o_totalprice AS valor, CASE WHEN starts_with(o_orderpriority, '1') THEN NULL ELSE o_orderpriority END AS prioridade, 1 AS seq
      FROM orders WHERE o_orderdate >= TIMESTAMP '{EXTRACT_START}'
      UNION ALL
      SELECT {_LOST}, o_custkey, 'P', o_totalprice, NULL, 2 FROM orders
      WHERE o_orderdate >= TIMESTAMP '{EXTRACT_START}' AND o_orderpriority = '1-URGENT')""",
    "src_keyed AS (SELECT * FROM src_all WHERE trim(chave) <> '')",
    """src AS (SELECT chave, cliente, status, valor, prioridade FROM (SELECT *, row_number() OVER (PARTITION BY chave
      ORDER BY seq DESC, cliente DESC, status DESC, valor DESC, prioridade DESC) AS rn FROM src_keyed) x WHERE rn = 1)""",
]


def _merge_sql(null_preserving: bool) -> str:
    cols = ["cliente", "status", "valor", "prioridade"]
    sel = ", ".join(
        f"CASE WHEN s.chave IS NOT NULL THEN {'coalesce(s.' + c + ', t.' + c + ')' if null_preserving else 's.' + c} ELSE t.{c} END AS {c}"
        for c in cols)
    return f"""SELECT coalesce(t.chave, s.chave) AS chave, {sel},
  CASE WHEN s.chave IS NOT NULL AND t.chave IS NOT NULL THEN 'update' WHEN s.chave IS NOT NULL THEN 'insert' ELSE 'keep' END AS acao
FROM tgt t FULL OUTER JOIN src s ON t.chave = s.chave"""


@register("merge_upsert", with_views(_merge_sql(False), *ORDER_CTES))
def q_merge_upsert(spark, sf):
    t, s = order_versions(spark, sf)
    table = stored_orders(spark, t)
    table.upsert(s, ["seq"])
    return table.read_load()


@register("merge_coalesce", with_views(_merge_sql(True), *ORDER_CTES))
def q_merge_coalesce(spark, sf):
    t, s = order_versions(spark, sf)
    table = stored_orders(spark, t)
    table.upsert(s, ["seq"], keep_old=True)
    return table.read_load()


@register("merge_stats", with_views(f"""
SELECT count(*) FILTER (WHERE acao = 'insert') AS inseridos, count(*) FILTER (WHERE acao = 'update') AS atualizados,
  count(*) FILTER (WHERE acao = 'keep') AS mantidos, count(*) FILTER (WHERE acao <> 'keep') AS processados,
  (SELECT count(*) FROM src_all) AS lidos, (SELECT count(chave) - count(DISTINCT chave) FROM src_keyed) AS ignorados,
  (SELECT count(*) FROM src_all WHERE chave IS NULL OR trim(chave) = '') AS erros
FROM ({_merge_sql(False)}) m""", *ORDER_CTES))
def q_merge_stats(spark, sf):
    """The counts that the write itself took; every row read is counted once."""
    t, s = order_versions(spark, sf)
    table = stored_orders(spark, t)
    c = table.upsert(s, ["seq"])
    assert c["lidos"] == c["inseridos"] + c["atualizados"] + c["ignorados"] + c["rejeitados"]
    done = c["inseridos"] + c["atualizados"]
    row = (c["inseridos"], c["atualizados"], table.rows() - done, done, c["lidos"], c["ignorados"], c["rejeitados"])
    return spark.createDataFrame([row], ", ".join(f"{n} bigint" for n in (
        "inseridos", "atualizados", "mantidos", "processados", "lidos", "ignorados", "erros")))


@register("merge_rejects", with_views("""
SELECT chave, cliente, status, valor, prioridade FROM src_all WHERE chave IS NULL OR trim(chave) = ''""", *ORDER_CTES))
def q_merge_rejects(spark, sf):
    """The records that the merge did not take, as its write kept them apart."""
    t, s = order_versions(spark, sf)
    table = stored_orders(spark, t)
    table.upsert(s, ["seq"])
    return table.rejects()


@register("enrol_feed_merge", with_views(f"""
SELECT coalesce(s.aluno, t.aluno) AS "externalEnrollmentId", {q(K.FEED_CLASS_SUBJECT_ID)} AS "externalClassSubjectId",
  CASE WHEN s.aluno IS NOT NULL THEN {q(K.FEED_PERIOD_ID)} ELSE 'anterior' END AS "externalPeriodId",
  CASE WHEN s.aluno IS NULL THEN 'keep' WHEN t.aluno IS NULL THEN 'insert' ELSE 'update' END AS acao
FROM (SELECT aluno FROM student WHERE unidade_ensino = '002' AND ano_ingresso <= 2023) t
FULL OUTER JOIN (SELECT aluno FROM student WHERE unidade_ensino = '002' AND {ci('sit_aluno', 'Ativo')}) s ON s.aluno = t.aluno"""))
def q_enrol_feed_merge(spark, sf):
    """D17 + M1: the feed goes into the stored feed table (what earlier intakes had, under the period before)."""
    d = domain(spark, sf)
    name = "externalEnrollmentId"
    feed = WL.enrol_feed(d).withColumnRenamed("ext.info.tags", "ext_info_tags")
    earlier = d.student.where((F.col("unidade_ensino") == K.FEED_UNIT) & (F.col("ano_ingresso") <= 2023))
    stored = earlier.select(F.col("aluno").alias(name), F.lit(K.FEED_CLASS_SUBJECT_ID).alias("externalClassSubjectId"),
                            F.lit("anterior").alias("externalPeriodId"))
    return M.upsert(stored, feed, [name])


@register("insert_absent", with_views("""
SELECT chave, cliente, status, valor, prioridade, 'keep' AS acao FROM tgt
UNION ALL
SELECT chave, cliente, status, valor, prioridade, 'insert' AS acao FROM (
  SELECT *, row_number() OVER (PARTITION BY chave ORDER BY seq, cliente, status, valor, prioridade NULLS FIRST) AS rn
  FROM src_keyed WHERE chave NOT IN (SELECT chave FROM tgt)) x WHERE rn = 1""", *ORDER_CTES))
def q_insert_absent(spark, sf):
    t, s = order_versions(spark, sf)
    table = stored_orders(spark, t)
    table.insert_absent(s, ["seq"])
    return table.read_load()


# --------------------------------------------------------------------------- M4-M7

_REFRESH_OK = "(cpf IS NOT NULL AND cpf <> '' AND num_func IS NOT NULL AND num_func <> 0)"


def refreshed_teachers(spark, sf) -> M.VersionedTable:
    table = M.VersionedTable(spark, scratch_path(spark, "teachers"))
    table.refresh(domain(spark, sf).teacher, ["cpf", "num_func"], numeric=("num_func",))
    return table


@register("full_refresh", with_views(f"SELECT * FROM teacher WHERE {_REFRESH_OK}"))
def q_full_refresh(spark, sf):
    return refreshed_teachers(spark, sf).read()


@register("refresh_stats", with_views(f"""
SELECT count(*) AS lidos, count(*) FILTER (WHERE {_REFRESH_OK}) AS validos, count(*) FILTER (WHERE NOT {_REFRESH_OK}) AS rejeitados
FROM teacher"""))
def q_refresh_stats(spark, sf):
    """The counts that the write took; a record is valid or a reject."""
    c = refreshed_teachers(spark, sf).stats()
    assert c["lidos"] == c["validos"] + c["rejeitados"]
    return spark.createDataFrame([(c["lidos"], c["validos"], c["rejeitados"])], "lidos bigint, validos bigint, rejeitados bigint")


@register("refresh_rejects", with_views(f"SELECT * FROM teacher WHERE ({_REFRESH_OK}) IS NOT TRUE"))
def q_refresh_rejects(spark, sf):
    return refreshed_teachers(spark, sf).rejects()


@register("guarded_delete", with_views(f"""
SELECT s.* FROM student s
WHERE s.aluno IN (SELECT aluno FROM live)
   OR (SELECT count(*) FROM student WHERE aluno NOT IN (SELECT aluno FROM live)) > (SELECT count(*) FROM student) * 0.5
   OR NOT EXISTS (SELECT 1 FROM live)""", f"live AS (SELECT aluno FROM student WHERE {ci('sit_aluno', 'Ativo')})"))
def q_guarded_delete(spark, sf):
    d = domain(spark, sf)
    live = d.student.where(S.ci_equals("sit_aluno", "Ativo")).select("aluno")
    table = KeyedTable(spark, scratch_path(spark, "students"), d.student.schema, ["aluno"])
    table.upsert(d.student)
    table.guarded_delete(live)
    return table.read()


@register("empty_source", with_views("""
SELECT 'keep' AS politica, num_func, cpf FROM teacher
UNION ALL SELECT 'clear', num_func, cpf FROM teacher WHERE 1 = 0"""))
def q_empty_source(spark, sf):
    """M5: an extract without rows keeps the stored table under one policy and clears it under the other."""
    d = domain(spark, sf)
    stored = d.teacher.select("num_func", "cpf")
    extract = stored.where(F.col("num_func").isNull())         # no teacher lacks a number: an empty extract
    out = []
    for policy in ("keep", "clear"):
        table = M.VersionedTable(spark, scratch_path(spark, f"empty-{policy}"))
        table.write(stored)
        table.refresh(extract, ["num_func"], numeric=("num_func",), empty_policy=policy)
        out.append(table.read().select(F.lit(policy).alias("politica"), "num_func", "cpf"))
    return union(out)


@register("guarded_delete_abort", with_views("""
SELECT s.aluno, s.sit_aluno, (SELECT count(*) FROM student) AS total,
  (SELECT count(*) FROM student WHERE unidade_ensino <> '007') AS obsoletos, true AS abortado FROM student s"""))
def q_guarded_delete_abort(spark, sf):
    """M6: only one unit's students are live, so more than half would go: nothing is deleted."""
    d = domain(spark, sf)
    live = d.student.where(F.col("unidade_ensino") == "007").select("aluno")
    state, stats = M.guarded_delete(d.student, live, ["aluno"])
    return state.select("aluno", "sit_aluno", F.lit(stats["total"]).cast("bigint").alias("total"),
                        F.lit(stats["obsoletos"]).cast("bigint").alias("obsoletos"), F.lit(stats["abortado"]).alias("abortado"))


_STAMP_TXT = ("strftime(make_timestamp(CAST(CASE WHEN {x} > 1e12 THEN {x} / 1000 ELSE {x} END * 1000000 AS BIGINT)), "
              "'%Y-%m-%d %H:%M:%S')")


def _stamp_versions(spark, sf):
    s = domain(spark, sf).student.select("aluno", "nome_compl", "stamp_atualizacao")
    n = F.col("aluno").cast("bigint")
    # the store lacks every ninth student and the stamp of every seventh
    stored = s.where(n % 9 != 0).select("aluno", F.when(n % 7 != 0, S.epoch_to_text("stamp_atualizacao")).alias("stamp"))
    # a fifth changed; some come without stamp, new ones among them
    changed = F.when(n % 6 == 0, None).when(n % 5 == 0, F.col("stamp_atualizacao") + 86400000) \
        .otherwise(F.col("stamp_atualizacao"))
    extract = s.select("aluno", "nome_compl", S.epoch_to_text(changed).alias("stamp"))
    return stored, extract


@register("stamp_incremental", with_views(f"""
SELECT e.aluno, e.nome_compl, e.stamp, CASE WHEN t.aluno IS NULL THEN 'insert' ELSE 'update' END AS acao
FROM (SELECT aluno, nome_compl, {_STAMP_TXT.format(x="CASE WHEN CAST(aluno AS BIGINT) % 6 = 0 THEN NULL WHEN CAST(aluno AS BIGINT) % 5 = 0 THEN stamp_atualizacao + 86400000 ELSE stamp_atualizacao END")} AS stamp FROM student) e
LEFT JOIN (SELECT aluno, CASE WHEN CAST(aluno AS BIGINT) % 7 <> 0 THEN {_STAMP_TXT.format(x='stamp_atualizacao')} END AS stamp
  FROM student WHERE CAST(aluno AS BIGINT) % 9 <> 0) t ON e.aluno = t.aluno
WHERE t.aluno IS NULL OR e.stamp IS DISTINCT FROM t.stamp"""))
def q_stamp_incremental(spark, sf):
    stored, extract = _stamp_versions(spark, sf)
    return M.changed_by_stamp(stored, extract, ["aluno"], "stamp")


# --------------------------------------------------------------------------- M8-M10

def _previous_sheet(d):
    """The committee sheet as loaded last time: every fourth member sat on the next course."""
    sh = d.committee_sheet
    moved = F.lpad(((F.col("codigoCurso").try_cast("bigint") + 1) % 25).cast("string"), 3, "0")
    return sh.withColumn("codigoCurso", F.when(F.col("linha") % 4 == 0, moved).otherwise(F.col("codigoCurso")))


PREV_CTES = committee_ctes("p", "prev_sheet")


@register("soft_delete", with_views("""
SELECT coalesce(p.codigoCurso, c.codigoCurso) AS codigoCurso, coalesce(p.nomeMembro, c.nomeMembro) AS nomeMembro,
  CASE WHEN p.codigoCurso IS NOT NULL THEN p.emailMembro ELSE c.emailMembro END AS emailMembro,
  CASE WHEN c.codigoCurso IS NOT NULL THEN 'S' ELSE 'N' END AS status
FROM pcm p FULL OUTER JOIN cm c ON p.codigoCurso = c.codigoCurso AND p.nomeMembro = c.nomeMembro
  AND p.emailMembro IS NOT DISTINCT FROM c.emailMembro""",
    "prev_sheet AS (SELECT linha, CASE WHEN linha % 4 = 0 THEN lpad(CAST((TRY_CAST(codigoCurso AS BIGINT) + 1) % 25 AS VARCHAR), 3, '0') "
    "ELSE codigoCurso END AS codigoCurso, nomeCurso, Coordenador, emailCoordenador, nomeMembro, emailMembro FROM committee_sheet)",
    *COMMITTEE_CTES, *PREV_CTES))
def q_soft_delete(spark, sf):
    d = domain(spark, sf)
    _, prev = P.committee(d, _previous_sheet(d))
    _, cur = P.committee(d)
    keys = ["codigoCurso", "nomeMembro", "emailMembro"]
    return M.mark_and_sweep(prev, cur, keys, null_safe=("emailMembro",))


_M9 = """g AS (SELECT disciplina, CASE WHEN count(DISTINCT curso) > 1 THEN '999' ELSE min(curso) END AS curso_novo
      FROM grid WHERE disciplina IS NOT NULL AND curso IS NOT NULL GROUP BY disciplina)""", \
    """j AS (SELECT t.*, s.n AS grupo, g.curso_novo FROM class t
      JOIN (SELECT disciplina, ano, semestre, count(*) AS n FROM class GROUP BY ALL) s
        ON s.disciplina = t.disciplina AND s.ano = t.ano AND s.semestre = t.semestre
      LEFT JOIN g ON g.disciplina = t.disciplina)""", \
    """u AS (SELECT j.*, coalesce(grupo = 1 AND curso_novo IS NOT NULL AND curso IS DISTINCT FROM curso_novo, false) AS upd FROM j)"""


@register("lookup_update", with_views("""
SELECT ano, semestre, turma, disciplina, CASE WHEN upd THEN curso_novo ELSE curso END AS curso, sit_turma,
  unidade_responsavel, turno, CASE WHEN upd THEN 'update' ELSE 'keep' END AS acao FROM u""", *_M9))
def q_lookup_update(spark, sf):
    d = domain(spark, sf)
    return M.class_course_update(d.view("class"), d.grid)[0]


@register("lookup_update_stats", with_views("""
SELECT count(*) FILTER (WHERE grupo > 1) AS ignorados, count(*) FILTER (WHERE grupo = 1) AS processados,
  count(*) FILTER (WHERE upd) AS atualizados FROM u""", *_M9))
def q_lookup_update_stats(spark, sf):
    d = domain(spark, sf)
    return M.class_course_update(d.view("class"), d.grid)[1]


def contract_answers(d) -> DataFrame:
    """Contract acceptance facts per (student, year, period): accepted when any enrolment is active."""
    e = d.enrol.groupBy(F.col("aluno").alias("codAluno"), F.col("ano"), F.col("semestre").alias("periodo")).agg(
        F.max(F.when(F.col("sit_matricula") == "Matriculado", "S").otherwise("N")).alias("existeContratoAceito"))
    return e


@register("flag_update", with_views("""
SELECT s.aluno, s.sit_aluno, f.aceite AS aceite_contrato FROM student s LEFT JOIN (
  SELECT codAluno, existeContratoAceito AS aceite FROM (SELECT *, row_number() OVER (PARTITION BY codAluno
    ORDER BY ano DESC, periodo DESC, existeContratoAceito DESC) AS rn FROM (
    SELECT aluno AS codAluno, ano, semestre AS periodo, max(CASE WHEN sit_matricula = 'Matriculado' THEN 'S' ELSE 'N' END)
      AS existeContratoAceito FROM enrol GROUP BY ALL) a) b WHERE rn = 1) f ON f.codAluno = s.aluno"""))
def q_flag_update(spark, sf):
    d = domain(spark, sf)
    latest = O.pick_per_key(contract_answers(d), ["codAluno"], ["ano", "periodo"], keep="last")
    return M.flag_update(d.student.select("aluno", "sit_aluno"), latest, "aluno", "codAluno", "aceite_contrato",
                         "existeContratoAceito")


# --------------------------------------------------------------------------- M12-M14

CURRICULUM_SCHEMA = T.StructType([
    T.StructField("curso", T.StringType()), T.StructField("curriculo", T.StringType()),
    T.StructField("prazo_ideal", T.DoubleType()), T.StructField("turno", T.StringType()),
    T.StructField("ativo", T.StringType())])


@register("schema_evolve", with_views("""
SELECT curso, curriculo, CAST(prazo_ideal AS DOUBLE) AS prazo_ideal, turno, 'S' AS ativo FROM curriculum"""))
def q_schema_evolve(spark, sf):
    return M.evolve(domain(spark, sf).curriculum, CURRICULUM_SCHEMA, {"ativo": "S"})


@register("rekey", with_views(f"""
SELECT coalesce(nullif({strip('curso')}, ''), 'N') || '_' || coalesce(nullif({strip('curriculo')}, ''), 'N') || '_'
  || coalesce(nullif({strip('turno')}, ''), 'N') AS id, curso, curriculo, prazo_ideal, regime, turno FROM curriculum"""))
def q_rekey(spark, sf):
    return M.rekey(domain(spark, sf).curriculum, ["curso", "curriculo", "turno"])


# a complete load in the queries below: rows whose first key part has an odd length and does not end in 1 or a

def _first_key(table: str) -> str:
    return C.CONTRACTS[table].key[0]


def _deactivation_sql(name: str) -> str:
    _, keys, optional, table = C.DEACTIVATIONS[name]
    alias, first = f"p{[t for t, _, _ in PRODUCED].index(table)}", _first_key(table)
    on = " AND ".join([f'l."{k}" = s."{k}"' for k in keys] + [f'l."{k}" IS NOT DISTINCT FROM s."{k}"' for k in optional])
    text = " || '|' || ".join(f"coalesce(CAST(s.\"{k}\" AS VARCHAR), '')" for k in keys + optional)
    return (f"SELECT DISTINCT '{name}' AS contrato, {text} AS chave FROM {alias} s WHERE NOT EXISTS (SELECT 1 FROM {alias} l "
            f"WHERE length(l.\"{first}\") % 2 = 1 AND right(l.\"{first}\", 1) NOT IN ('1', 'a') AND {on})")


DEACTIVATED = [n for n, (_, _, _, t) in C.DEACTIVATIONS.items() if t in {x for x, _, _ in PRODUCED}]


@register("deactivation_set", with_views("\nUNION ALL ".join(map(_deactivation_sql, DEACTIVATED)), *product_ctes()))
def q_deactivation_set(spark, sf):
    """Every deactivation contract whose load table is produced (all but organisational units)."""
    forms, out = produced_forms(domain(spark, sf)), []
    for name in DEACTIVATED:
        _, keys, optional, table = C.DEACTIVATIONS[name]
        system, first = forms[table], F.col(_first_key(table))
        sheet = system.where((F.length(first) % 2 == 1) & ~F.right(first, F.lit(1)).isin("1", "a"))
        gone = M.deactivation_keys(system, sheet, list(keys + optional), null_safe=optional)
        out.append(gone.select(F.lit(name).alias("contrato"), C.key_text(keys + optional).alias("chave")))
    return union(out)
