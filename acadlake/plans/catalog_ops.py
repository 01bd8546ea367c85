"""Registered operator queries: scalar functions (F), rules (V), predicates (P),
per-key selection (W/O), aggregations (A) and the feeds / work lists (D17-D24)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.functions import constants as K
from acadlake.functions import rules as R
from acadlake.functions import scalars as S
from acadlake.operators import aggregates as A
from acadlake.operators import ordering as O
from acadlake.operators import relational as J
from acadlake.plans import worklists as WL
from acadlake.plans.catalog_products import ASSESS_CTES, ASSESS_SELECT
from acadlake.plans.oracle_sql import (email_ok, initials, mailbox_user, offering_code, offering_type,
                                       present, q, shift, strip, subject_code, trunc, with_views, within)
from acadlake.plans.products import CLASS_KEYS, assessment_units_keyed
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


STR = T.StringType()


def _nullwords(x):
    return f"CASE WHEN lower({strip(x)}) IN ('null', 'none', '') THEN NULL ELSE {strip(x)} END"


# --------------------------------------------------------------------------- F1-F5, F11

@register("normalize_values", with_views(f"""
SELECT aluno, {_nullwords('nome_compl')} AS nome_f1, {_nullwords('turno')} AS turno_f1,
  CASE WHEN {strip('nome_compl')} = '' THEN NULL ELSE {strip('nome_compl')} END AS nome_f3,
  CASE WHEN representante_turma = 's' THEN 'S' ELSE 'N' END AS rep_f1,
  CASE WHEN representante_turma = 's' THEN 'True' ELSE 'False' END AS rep_f3,
  serie AS serie_f1, CAST(NULL AS VARCHAR) AS nested_f2
FROM student"""))
def q_normalize_values(spark, sf):
    s = domain(spark, sf).student
    rep = F.col("representante_turma") == "s"
    nested = F.struct("curso", "turno")
    return s.select(
        "aluno",
        S.normalize_value("nome_compl", STR).alias("nome_f1"),
        S.normalize_value("turno", STR).alias("turno_f1"),
        S.normalize_value("nome_compl", STR, null_words=False).alias("nome_f3"),
        S.normalize_value(rep, T.BooleanType()).alias("rep_f1"),
        S.normalize_value(rep, T.BooleanType(), null_words=False).alias("rep_f3"),
        S.normalize_value("serie", T.LongType()).alias("serie_f1"),
        S.normalize_value(nested, T.StructType()).alias("nested_f2"))


@register("typed_values", with_views(f"""
SELECT aluno, TRY_CAST(trim(CAST(serie AS VARCHAR)) AS BIGINT) AS serie_int,
  TRY_CAST(trim(dt_ingresso) AS BIGINT) AS dt_int,
  CASE WHEN representante_turma IS NULL THEN NULL WHEN upper(representante_turma) = 'S' THEN 'S' ELSE 'N' END AS rep_flag,
  strftime(make_timestamp(CAST(CASE WHEN stamp_atualizacao > 1e12 THEN stamp_atualizacao / 1000
       ELSE stamp_atualizacao END * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS stamp_txt,
  {strip('dt_ingresso')} AS dt_txt,
  regexp_replace(strip_accents(turno), '[^\\x00-\\x7F]', '', 'g') AS turno_ascii
FROM student"""))
def q_typed_values(spark, sf):
    s = domain(spark, sf).student
    return s.select(
        "aluno",
        S.typed_integer("serie").alias("serie_int"),
        S.typed_integer("dt_ingresso").alias("dt_int"),
        S.typed_flag("representante_turma").alias("rep_flag"),
        S.typed_stamp("stamp_atualizacao", T.LongType()).alias("stamp_txt"),
        S.typed_stamp("dt_ingresso", STR).alias("dt_txt"),
        S.strip_accents("turno").alias("turno_ascii"))


# --------------------------------------------------------------------------- F6-F10, F22, F30

_CPF_CLEAN = strip("regexp_replace(cpf, '[.\\-]', '', 'g')")


@register("text_functions", with_views(f"""
SELECT pessoa, {mailbox_user('e_mail')} AS usuario, lower(e_mail) AS email_min,
  CASE WHEN NOT {present('cpf')} THEN NULL WHEN regexp_matches({_CPF_CLEAN}, '^[0-9]{{11}}$')
       THEN substr({_CPF_CLEAN}, 1, 3) || '.' || substr({_CPF_CLEAN}, 4, 3) || '.' || substr({_CPF_CLEAN}, 7, 3) || '-' || substr({_CPF_CLEAN}, 10, 2)
       ELSE {_CPF_CLEAN} END AS cpf_fmt,
  CASE WHEN NOT {present('cpf')} THEN '' ELSE regexp_replace(cpf, '\\D', '', 'g') END AS cpf_digitos,
  {trunc('nome_compl', 10)} AS nome_10,
  {trunc(f"CASE WHEN {strip('nome_social')} = '' THEN NULL ELSE {strip('nome_social')} END", 100)} AS nome_social_limpo,
  {q(K.ORG_UNIT_CODE)} AS unidade
FROM person"""))
def q_text_functions(spark, sf):
    p = domain(spark, sf).person
    return p.select("pessoa", S.mailbox_user("e_mail").alias("usuario"), S.lower_text("e_mail").alias("email_min"),
                    S.format_national_id("cpf").alias("cpf_fmt"), S.digits_only("cpf").alias("cpf_digitos"),
                    S.truncate("nome_compl", 10).alias("nome_10"),
                    S.clean_subject_name("nome_social").alias("nome_social_limpo"),
                    S.fixed(K.ORG_UNIT_CODE).alias("unidade"))


# --------------------------------------------------------------------------- F12-F15, F19, F21, F27

@register("code_functions", with_views(f"""
SELECT t.ano, t.semestre, t.turma, t.disciplina,
  CASE WHEN NOT {present('c.nome')} THEN '' ELSE {trunc(initials('c.nome'), 30)} END AS iniciais,
  {subject_code('t.disciplina', 'c.nome', 't.curso')} AS cod_disciplina,
  {offering_code('t.disciplina', 't.turma', 't.ano', 't.semestre')} AS cod_oferta,
  {offering_type('t.turma')} AS tipo_oferta,
  {shift('t.turno')} AS turno_mapa,
  coalesce(nullif({strip('t.curso')}, ''), 'N') || '_' || coalesce(nullif({strip('t.turma')}, ''), 'N') || '_'
    || coalesce(nullif({strip('t.turno')}, ''), 'N') AS chave,
  CAST(t.ano AS VARCHAR) || '/' || CAST(t.semestre AS VARCHAR) AS periodo
FROM class t LEFT JOIN course c ON c.curso = t.curso"""))
def q_code_functions(spark, sf):
    d = domain(spark, sf)
    t = d.view("class").join(d.course.select("curso", "nome"), "curso", "left")
    return t.select(*CLASS_KEYS,
                    S.course_initials("nome").alias("iniciais"),
                    S.subject_course_code("disciplina", "nome", "curso").alias("cod_disciplina"),
                    S.offering_code("disciplina", "turma", "ano", "semestre").alias("cod_oferta"),
                    S.offering_type("turma").alias("tipo_oferta"),
                    S.map_shift("turno").alias("turno_mapa"),
                    S.composite_key("curso", "turma", "turno").alias("chave"),
                    S.period_text("ano", "semestre").alias("periodo"))


# --------------------------------------------------------------------------- V1-V16

_V2 = f"regexp_replace({strip('cpf')}, '[.\\-]', '', 'g')"
_V3 = "regexp_replace(coalesce(cpf, ''), '\\D', '', 'g')"
_INST = " OR ".join(f"suffix(lower({strip('e_mail')}), {q(d)})" for d in K.INSTITUTIONAL_DOMAINS)


@register("rule_flags", with_views(f"""
SELECT pessoa, {email_ok('e_mail')} AS v1_email,
  coalesce({present('cpf')} AND regexp_matches({_V2}, '^[0-9]{{11}}$') AND {_V2} <> repeat(substr({_V2}, 1, 1), 11), false) AS v2_cpf,
  coalesce(length({_V3}) = 11 AND {_V3} <> '00000000000', false) AS v3_cpf,
  coalesce({present('nome_social')} AND length({strip('nome_social')}) > 0, false) AS v4_nome,
  coalesce(NOT {present('fone')} OR length(regexp_replace({strip('fone')}, '[^\\d]', '', 'g')) BETWEEN 10 AND 11, false) AS v6_fone,
  coalesce(NOT {present('cep')} OR length(regexp_replace({strip('cep')}, '[^\\d]', '', 'g')) = 8, false) AS v7_cep,
  CASE WHEN NOT {email_ok('e_mail')} THEN {q(K.MSG_BAD_EMAIL)} WHEN NOT coalesce({_INST}, false) THEN {q(K.MSG_NOT_INSTITUTIONAL)} END AS v10_email,
  {within('nome_compl', 18)} AS v14_nome
FROM person"""))
def q_rule_flags(spark, sf):
    p = domain(spark, sf).person
    return p.select("pessoa", R.is_email("e_mail").alias("v1_email"), R.is_national_id("cpf").alias("v2_cpf"),
                    R.is_national_id_lenient("cpf").alias("v3_cpf"), R.is_non_blank("nome_social").alias("v4_nome"),
                    R.is_phone("fone").alias("v6_fone"), R.is_postcode("cep").alias("v7_cep"),
                    R.institutional_email_message("e_mail").alias("v10_email"),
                    R.is_text_within("nome_compl", 18).alias("v14_nome"))


_N = "TRY_CAST(CAST(serie AS VARCHAR) AS DOUBLE)"


@register("rule_flags_student", with_views(f"""
SELECT aluno, coalesce({present('dt_ingresso')} AND try_strptime(dt_ingresso, '%Y-%m-%d') IS NOT NULL, false) AS v5_data,
  CASE WHEN NOT {present('nome_social')} THEN {q(K.MSG_REQUIRED_MISSING.format(field='nome_social'))}
       WHEN length({strip('nome_social')}) = 0 THEN {q(K.MSG_REQUIRED_BLANK.format(field='nome_social'))} END AS v8_obrigatorio,
  CASE WHEN length(nome_compl) > 18 THEN {q(K.MSG_MAX_LENGTH.format(field='nome', n=18))} END AS v9_tamanho,
  coalesce(CASE WHEN NOT {present('sit_aluno')} THEN true ELSE {strip('upper(sit_aluno)')} IN ({', '.join(q(v) for v in K.STUDENT_STATUS_VALUES)}) END, false) AS v11_situacao,
  coalesce({present('representante_turma')} AND {strip('upper(representante_turma)')} IN ({', '.join(q(v) for v in K.ACTIVE_FLAG_VALUES)}), false) AS v11_ativo,
  coalesce(CASE WHEN NOT {present('turno')} THEN true ELSE {strip('upper(turno)')} IN ({', '.join(q(v) for v in K.GENDER_VALUES)}) END, false) AS v11_genero,
  coalesce(representante_turma IN ('C', 'P'), false) AS v11_papel,
  CASE WHEN serie IS NULL THEN NULL WHEN {_N} IS NULL THEN {q(K.MSG_NOT_NUMBER.format(field='serie'))}
       WHEN {_N} < 1 THEN {q(K.MSG_MIN_VALUE.format(field='serie', v=1))}
       WHEN {_N} > 5 THEN {q(K.MSG_MAX_VALUE.format(field='serie', v=5))} END AS v12_numero,
  coalesce({present('curso')} AND regexp_matches({strip('upper(curso)')}, '^[A-Z0-9]{{2,10}}$'), false) AS v13_sigla,
  coalesce(TRY_CAST(CAST(serie AS VARCHAR) AS BIGINT) BETWEEN 1 AND 99, false) AS v15_periodo
FROM student"""))
def q_rule_flags_student(spark, sf):
    s = domain(spark, sf).student
    return s.select("aluno", R.is_date("dt_ingresso").alias("v5_data"),
                    R.required_message("nome_social", "nome_social").alias("v8_obrigatorio"),
                    R.max_length_message("nome_compl", 18, "nome").alias("v9_tamanho"),
                    R.is_student_status("sit_aluno").alias("v11_situacao"),
                    R.is_active_flag("representante_turma").alias("v11_ativo"),
                    R.is_gender("turno").alias("v11_genero"),
                    R.is_user_role("representante_turma").alias("v11_papel"),
                    R.numeric_message("serie", "serie", 1, 5).alias("v12_numero"),
                    R.is_course_acronym("curso").alias("v13_sigla"),
                    R.is_period("serie").alias("v15_periodo"))


_E1 = f"CASE WHEN NOT {present('a.aluno')} THEN {q(K.MSG_REQUIRED_MISSING.format(field='matricula'))} END"
_E2 = f"CASE WHEN NOT {present('a.nome_social')} THEN {q(K.MSG_REQUIRED_MISSING.format(field='nome'))} END"
_E3 = f"CASE WHEN {present('p.e_mail')} AND NOT {email_ok('p.e_mail')} THEN 'Email inválido: ' || p.e_mail END"
_E4 = (f"CASE WHEN {present('a.dt_ingresso')} AND try_strptime(a.dt_ingresso, '%Y-%m-%d') IS NULL "
       f"THEN 'Data de nascimento inválida: ' || a.dt_ingresso END")


@register("record_errors", with_views(f"""
SELECT aluno, erros, n_erros, n_erros = 0 AS valido FROM (
  SELECT a.aluno, concat_ws(' | ', {_E1}, {_E2}, {_E3}, {_E4}) AS erros,
    CAST(({_E1}) IS NOT NULL AS BIGINT) + CAST(({_E2}) IS NOT NULL AS BIGINT) + CAST(({_E3}) IS NOT NULL AS BIGINT)
      + CAST(({_E4}) IS NOT NULL AS BIGINT) AS n_erros
  FROM student a LEFT JOIN person p ON a.pessoa = p.pessoa) x"""))
def q_record_errors(spark, sf):
    d = domain(spark, sf)
    j = d.student.join(d.person.select("pessoa", "e_mail"), "pessoa", "left")
    errs = R.record_errors({"matricula": F.col("aluno"), "nome": F.col("nome_social")},
                           email=F.col("e_mail"), birth_date=F.col("dt_ingresso"))
    j = j.select("aluno", errs.alias("e"))
    return j.select("aluno", F.array_join("e", " | ").alias("erros"), F.size("e").cast("bigint").alias("n_erros"),
                    (F.size("e") == 0).alias("valido"))


# --------------------------------------------------------------------------- A1-A6, A9

@register("table_profile", with_views("""
SELECT count(*) AS total_rows, count(DISTINCT aluno) AS distinct_aluno, count(DISTINCT turma) AS distinct_turma,
  count(DISTINCT disciplina) AS distinct_disciplina, count(*) FILTER (WHERE sit_matricula = 'Matriculado') AS matriculados,
  max(ano) AS max_ano FROM enrol"""))
def q_table_profile(spark, sf):
    e = domain(spark, sf).enrol
    return A.profile(e, ["aluno", "turma", "disciplina"], {"matriculados": F.col("sit_matricula") == "Matriculado"}, "ano")


@register("frequency_top", with_views(f"""
SELECT coalesce(CAST(curso AS VARCHAR), {q(K.NOT_INFORMED)}) AS valor, count(*) AS quantidade FROM student
GROUP BY 1 ORDER BY quantidade DESC, valor LIMIT 10"""))
def q_frequency_top(spark, sf):
    return A.frequency_top(domain(spark, sf).student, "curso", 10)


@register("distribution", with_views(f"""
SELECT coalesce(CAST(serie_ideal AS VARCHAR), {q(K.NOT_INFORMED)}) AS valor, count(*) AS quantidade FROM grid GROUP BY 1"""))
def q_distribution(spark, sf):
    return A.frequency_top(domain(spark, sf).grid, "serie_ideal", None)


@register("active_split", with_views("""
SELECT count(*) FILTER (WHERE ativo = 'S') AS ativos, count(*) FILTER (WHERE ativo IS NULL OR ativo <> 'S') AS inativos
FROM teacher"""))
def q_active_split(spark, sf):
    return A.active_split(domain(spark, sf).teacher, "ativo")


@register("duplicate_audit", with_views("""
SELECT count(*) AS total_registros, count(DISTINCT cpf) + max(CASE WHEN cpf IS NULL THEN 1 ELSE 0 END) AS chaves_distintas,
  count(*) - (count(DISTINCT cpf) + max(CASE WHEN cpf IS NULL THEN 1 ELSE 0 END)) AS duplicados FROM person"""))
def q_duplicate_audit(spark, sf):
    return A.duplicate_audit(domain(spark, sf).person, ["cpf"])


@register("duplicate_members", with_views("""
SELECT p.cpf, p.pessoa, p.nome_compl, g.tamanho_grupo FROM person p
JOIN (SELECT cpf, count(*) AS tamanho_grupo FROM person GROUP BY cpf HAVING count(*) > 1) g ON g.cpf = p.cpf"""))
def q_duplicate_members(spark, sf):
    return A.duplicate_members(domain(spark, sf).person, "cpf", ["pessoa", "nome_compl"])


# --------------------------------------------------------------------------- W2-W7, W10, O*

_ENR = "SELECT aluno, ano, semestre, turma, disciplina, sit_matricula FROM enrol"


def _enr(spark, sf):
    return domain(spark, sf).enrol.select("aluno", "ano", "semestre", "turma", "disciplina", "sit_matricula")


@register("latest_per_key", with_views(f"""
SELECT aluno, ano, semestre, turma, disciplina, sit_matricula FROM (SELECT *, row_number() OVER (PARTITION BY aluno
  ORDER BY ano DESC, semestre DESC, turma DESC, disciplina DESC, sit_matricula DESC) AS rn FROM ({_ENR}) e) x WHERE rn = 1"""))
def q_latest_per_key(spark, sf):
    return O.pick_per_key(_enr(spark, sf), ["aluno"], ["ano", "semestre"], keep="last")


@register("dedupe_first", with_views(f"""
SELECT aluno, ano, semestre, turma, disciplina, sit_matricula FROM (SELECT *, row_number() OVER (PARTITION BY aluno, disciplina
  ORDER BY ano, semestre, turma, sit_matricula) AS rn FROM ({_ENR}) e) x WHERE rn = 1"""))
def q_dedupe_first(spark, sf):
    return O.pick_per_key(_enr(spark, sf), ["aluno", "disciplina"], ["ano", "semestre", "turma"], keep="first")


@register("dedupe_last", with_views(f"""
SELECT aluno, ano, semestre, turma, disciplina, sit_matricula FROM (SELECT *, row_number() OVER (PARTITION BY aluno, disciplina
  ORDER BY ano DESC, semestre DESC, turma DESC, sit_matricula DESC) AS rn FROM ({_ENR}) e) x WHERE rn = 1"""))
def q_dedupe_last(spark, sf):
    return O.pick_per_key(_enr(spark, sf), ["aluno", "disciplina"], ["ano", "semestre", "turma"], keep="last")


@register("dedupe_priority", with_views("""
SELECT ano, semestre, turma, disciplina, sit_turma FROM (SELECT *, row_number() OVER (PARTITION BY disciplina, ano, semestre
  ORDER BY CASE WHEN lower(sit_turma) = 'aberta' THEN 0 ELSE 1 END, turma, sit_turma) AS rn FROM class) x WHERE rn = 1"""))
def q_dedupe_priority(spark, sf):
    t = domain(spark, sf).view("class").select(*CLASS_KEYS, "sit_turma")
    t = t.withColumn("prio", F.when(S.ci_equals("sit_turma", "aberta"), 0).otherwise(1))
    return O.pick_per_key(t, ["disciplina", "ano", "semestre"], ["prio", "turma"], keep="first").drop("prio")


@register("global_ids", with_views("""
SELECT aluno, nome_compl, CAST(row_number() OVER (ORDER BY aluno) AS BIGINT) AS id,
  CAST((row_number() OVER (ORDER BY aluno) - 1) // 100 AS BIGINT) AS lote FROM student"""))
def q_global_ids(spark, sf):
    s = domain(spark, sf).student.select("aluno", "nome_compl")
    return O.batch_numbers(O.sequential_ids(s, [F.col("aluno").asc()], "id"), "id", 100, "lote")


@register("prefix_filter", with_views("SELECT * FROM class WHERE turma LIKE 'T0%'"))
def q_prefix_filter(spark, sf):
    return domain(spark, sf).view("class").where(F.col("turma").startswith("T0"))


@register("recent_rows", with_views("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type,
  (SELECT count(*) FROM events) AS total_linhas FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 5"""))
def q_recent_rows(spark, sf):
    """K8: the table's row count beside its five latest rows."""
    e = domain(spark, sf).events
    top = e.orderBy(F.desc("ts"), F.desc("event_id")).limit(5)
    return top.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id", "event_type",
                      F.lit(e.count()).cast("bigint").alias("total_linhas"))


@register("latest_state", with_views("""
SELECT chave, ano, periodo, turma, disciplina, num_func FROM class_teacher ORDER BY chave DESC LIMIT 1"""))
def q_latest_state(spark, sf):
    return domain(spark, sf).class_teacher.orderBy(F.desc("chave")).limit(1)


@register("distinct_pairs", with_views("SELECT DISTINCT disciplina, curso FROM class"))
def q_distinct_pairs(spark, sf):
    return domain(spark, sf).view("class").select("disciplina", "curso").distinct()


@register("first_valid", with_views(f"""
SELECT * FROM grid WHERE {present('disciplina')} AND {present('curso')} AND {present('curriculo')}
ORDER BY disciplina, curso, curriculo LIMIT 1"""))
def q_first_valid(spark, sf):
    g = domain(spark, sf).grid
    ok = S.present("disciplina") & S.present("curso") & S.present("curriculo")
    return g.where(ok).orderBy("disciplina", "curso", "curriculo").limit(1)


@register("report_columns", with_views("""
SELECT a.aluno AS "Matrícula", a.nome_compl AS "Nome", p.cpf AS "CPF", c.nome AS "Curso"
FROM student a LEFT JOIN person p ON a.pessoa = p.pessoa LEFT JOIN course c ON a.curso = c.curso"""))
def q_report_columns(spark, sf):
    from acadlake.plans.products import student_report
    df = student_report(domain(spark, sf))
    names = [("matricula", "Matrícula"), ("nome", "Nome"), ("cpf", "CPF"), ("curso_nome", "Curso"), ("telefone", "Telefone")]
    return df.select([F.col(c).alias(n) for c, n in names if c in df.columns])


@register("dup_rejects", with_views("""
SELECT codigoUnidade, count(*) AS rejeitados FROM (
  SELECT codigoUnidade, row_number() OVER (PARTITION BY codigoUnidade ORDER BY codigoDisciplina) AS rn FROM au) x
WHERE rn > 1 GROUP BY codigoUnidade""", *ASSESS_CTES, f"au AS ({ASSESS_SELECT})"))
def q_dup_rejects(spark, sf):
    kept, rejects = assessment_units_keyed(domain(spark, sf))
    return rejects


# --------------------------------------------------------------------------- D17-D24

_FEED = f"""SELECT aluno AS externalEnrollmentId, {q(K.FEED_CLASS_SUBJECT_ID)} AS externalClassSubjectId,
  {q(K.FEED_CURRICULUM_ID)} AS externalCurriculumId, {q(K.FEED_PERIOD_ID)} AS externalPeriodId, '' AS startDate, '' AS endDate,
  {q(K.FEED_ENROLMENT_STATUS_ID)} AS externalEnrollmentClassSubjectStatusId, '' AS externalEnrollmentTypeId, '' AS "ext.info.tags"
FROM student WHERE unidade_ensino = '002' AND """


@register("enrol_feed", with_views(_FEED + "lower(sit_aluno) = 'ativo'"))
def q_enrol_feed(spark, sf):
    return WL.enrol_feed(domain(spark, sf))


@register("unenrol_feed", with_views(_FEED + "lower(sit_aluno) <> 'ativo'"))
def q_unenrol_feed(spark, sf):
    return WL.unenrol_feed(domain(spark, sf))


_TV = f"""tv AS (SELECT num_func, situacao,
    CASE WHEN situacao = 'valido' THEN dig ELSE cpf END AS cpf,
    CASE WHEN mail_ok THEN lower({strip('mailbox')}) ELSE mailbox END AS email,
    situacao = 'valido' AND NOT mail_ok AND {present('mailbox')} AS email_invalido, ativo, depto
  FROM (SELECT t.*, CASE WHEN {strip('CAST(num_func AS VARCHAR)')} = '1' THEN 'descartado_padrao'
      WHEN NOT ({present('cpf')} AND num_func IS NOT NULL AND num_func <> 0) THEN 'descartado_obrigatorio'
      WHEN length(dig) <> 11 THEN 'descartado_cpf' ELSE 'valido' END AS situacao
    FROM (SELECT *, CASE WHEN NOT {present('cpf')} THEN '' ELSE regexp_replace(cpf, '\\D', '', 'g') END AS dig,
      coalesce({present('mailbox')} AND suffix(lower({strip('mailbox')}), '@{K.TEACHER_DOMAIN}'), false) AS mail_ok
      FROM teacher) t) x)"""


@register("teacher_validation", with_views("SELECT * FROM tv", _TV))
def q_teacher_validation(spark, sf):
    return WL.teacher_validation(domain(spark, sf))


@register("teacher_stats", with_views("""
SELECT count(*) AS total, count(*) FILTER (WHERE ativo = 'S') AS ativos,
  count(*) FILTER (WHERE ativo IS NULL OR ativo <> 'S') AS inativos,
  count(*) FILTER (WHERE cpf IS NOT NULL AND cpf <> '' AND num_func IS NOT NULL AND num_func <> 0) AS chaves,
  count(DISTINCT CASE WHEN cpf IS NOT NULL AND cpf <> '' AND num_func IS NOT NULL AND num_func <> 0
        THEN cpf || '-' || CAST(num_func AS VARCHAR) END) AS chaves_unicas
FROM tv WHERE situacao = 'valido'""", _TV))
def q_teacher_stats(spark, sf):
    return WL.teacher_stats(domain(spark, sf))


@register("teacher_departments", with_views(f"""
SELECT coalesce(depto, {q(K.NOT_INFORMED)}) AS depto, count(*) AS quantidade FROM tv WHERE situacao = 'valido'
GROUP BY 1 ORDER BY quantidade DESC, depto LIMIT 5""", _TV))
def q_teacher_departments(spark, sf):
    return WL.teacher_departments(domain(spark, sf))


@register("invalid_values", with_views("SELECT num_func, cpf, email FROM tv WHERE email_invalido", _TV))
def q_invalid_values(spark, sf):
    return WL.teacher_validation(domain(spark, sf)).where("email_invalido").select("num_func", "cpf", "email")


@register("pending_persons", with_views("""
SELECT a.pessoa FROM student a LEFT JOIN person p ON a.pessoa = p.pessoa WHERE p.pessoa IS NULL AND a.pessoa IS NOT NULL
UNION
SELECT d.pessoa FROM teacher d LEFT JOIN person p ON d.pessoa = p.pessoa WHERE p.pessoa IS NULL AND d.pessoa IS NOT NULL"""))
def q_pending_persons(spark, sf):
    return WL.pending_persons(domain(spark, sf))


_CLEAN = "regexp_replace(coalesce(cpf, ''), '\\D', '', 'g')"


@register("id_audit", with_views(f"""
SELECT pessoa, nome_compl, cpf, 'invalido' AS problema, CAST(NULL AS BIGINT) AS tamanho_grupo FROM person
WHERE NOT coalesce(length({_CLEAN}) = 11 AND {_CLEAN} <> '00000000000', false)
UNION ALL
SELECT v.pessoa, v.nome_compl, v.c AS cpf, 'duplicado' AS problema, g.n AS tamanho_grupo
FROM (SELECT pessoa, nome_compl, {_CLEAN} AS c FROM person WHERE coalesce(length({_CLEAN}) = 11 AND {_CLEAN} <> '00000000000', false)) v
JOIN (SELECT {_CLEAN} AS c, count(*) AS n FROM person WHERE coalesce(length({_CLEAN}) = 11 AND {_CLEAN} <> '00000000000', false)
      GROUP BY 1 HAVING count(*) > 1) g ON g.c = v.c"""))
def q_id_audit(spark, sf):
    return WL.id_audit(domain(spark, sf))


@register("exam_worklist", with_views("""
SELECT ano, semestre, turma, disciplina, prova, seq, CAST((seq - 1) // 50 AS BIGINT) AS lote FROM (
  SELECT ano, semestre, turma, disciplina, prova,
    CAST(row_number() OVER (ORDER BY ano, semestre, turma, disciplina, prova) AS BIGINT) AS seq
  FROM (SELECT t.ano, t.semestre, t.turma, t.disciplina, unnest(['AVF', 'AVS', 'AVSB']) AS prova
        FROM class t WHERE lower(t.sit_turma) = 'aberta') e) x"""))
def q_exam_worklist(spark, sf):
    return WL.exam_worklist(domain(spark, sf))


@register("key_trace", with_views(f"""
SELECT '1_turma_docente' AS etapa, count(*) AS linhas FROM s1
UNION ALL SELECT '2_join_turma', count(*) FROM s2
UNION ALL SELECT '3_turma_aberta', count(*) FROM s3
UNION ALL SELECT '4_faculdade', count(*) FROM s4
UNION ALL SELECT '5_join_docente', count(*) FROM s5
UNION ALL SELECT '6_email_valido', count(*) FROM s5 WHERE {email_ok('mailbox')}""",
    "s1 AS (SELECT * FROM class_teacher WHERE num_func = 2)",
    "s2 AS (SELECT s1.*, t.sit_turma, t.curso FROM s1 JOIN class t ON t.ano = s1.ano AND t.semestre = s1.periodo AND t.turma = s1.turma AND t.disciplina = s1.disciplina)",
    "s3 AS (SELECT * FROM s2 WHERE lower(sit_turma) = 'aberta')",
    "s4 AS (SELECT s3.* FROM s3 LEFT JOIN course c ON c.curso = s3.curso WHERE s3.curso IS NULL OR c.faculdade IN ('001'))",
    "s5 AS (SELECT s4.*, d.mailbox FROM s4 JOIN teacher d ON d.num_func = s4.num_func)"))
def q_key_trace(spark, sf):
    return WL.key_trace(domain(spark, sf))


@register("syllabus_text", with_views("""
SELECT doc_id, regexp_replace(source || ':' || lang || '/' || CAST(doc_id AS VARCHAR) || '.pdf', '[\\\\/*?:"<>|]', '_', 'g') AS arquivo,
  regexp_replace(replace(text, chr(10), '<br/>'), '[\\s\\x{0B}\\x{85}\\p{Z}]+', ' ', 'g') AS texto FROM documents"""))
def q_syllabus_text(spark, sf):
    return WL.syllabus_text(domain(spark, sf))


@register("subject_first_course", with_views("""
SELECT g.disciplina, min(g.curso) AS curso, arg_min(c.nome, g.curso) AS nome_curso
FROM grid g JOIN course c ON c.curso = g.curso GROUP BY g.disciplina"""))
def q_subject_first_course(spark, sf):
    return WL.subject_first_course(domain(spark, sf))


@register("assessment_units_kept", with_views("""
SELECT codigoUnidade, nomeUnidade, codigoCurso, codigoDisciplina, ordemExibicao, codigoAgrupamento FROM (
  SELECT *, row_number() OVER (PARTITION BY codigoUnidade ORDER BY codigoDisciplina, ordemExibicao, nomeUnidade,
    codigoCurso, codigoAgrupamento) AS rn FROM au) x WHERE rn = 1""", *ASSESS_CTES, f"au AS ({ASSESS_SELECT})"))
def q_assessment_units_kept(spark, sf):
    kept, _ = assessment_units_keyed(domain(spark, sf))
    return kept


# --------------------------------------------------------------------------- J11

_CLASS = "t.ano, t.semestre, t.turma, t.disciplina"


@register("course_by_class", with_views(f"SELECT {_CLASS}, t.curso FROM class t WHERE t.disciplina IN (SELECT disciplina FROM subject)"))
def q_course_by_class(spark, sf):
    d = domain(spark, sf)
    classes = d.view("class").select("ano", "semestre", "turma", "disciplina", "curso")
    return J.class_course(classes, d.subject, d.grid)


@register("course_by_subject", with_views(
    f"SELECT {_CLASS}, s.curso FROM class t JOIN (SELECT disciplina, min(curso) AS curso FROM grid GROUP BY disciplina) s "
    "ON s.disciplina = t.disciplina"))
def q_course_by_subject(spark, sf):
    d = domain(spark, sf)
    classes = d.view("class").select("ano", "semestre", "turma", "disciplina")
    subjects = d.grid.groupBy("disciplina").agg(F.min("curso").alias("curso"))
    return J.class_course(classes, subjects, d.grid)


@register("course_by_grid", with_views(
    f"SELECT {_CLASS}, g.curso FROM class t JOIN grid g ON g.disciplina = t.disciplina "
    "WHERE t.disciplina IN (SELECT disciplina FROM subject)"))
def q_course_by_grid(spark, sf):
    d = domain(spark, sf)
    classes = d.view("class").select("ano", "semestre", "turma", "disciplina")
    return J.class_course(classes, d.subject, d.grid)
