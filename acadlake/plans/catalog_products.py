"""Registered product queries (D1-D16) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from acadlake.functions import constants as K
from acadlake.plans import products as P
from acadlake.plans.oracle_sql import (ci, course_map_cte, email_ok, exam_labels_case,
                                       mailbox_user, non_blank, offering_code, offering_type, present, q,
                                       shift, strip, subject_code, to_int_via_float, trunc, with_views,
                                       within)
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


KEYS4 = "{a}.ano = {b}.ano AND {a}.semestre = {b}.semestre AND {a}.turma = {b}.turma AND {a}.disciplina = {b}.disciplina"


def keys4(a, b):
    return KEYS4.format(a=a, b=b)


def unify_sql(src: str, code: str, blank_as: str | None = None, name_fallback: str | None = None) -> str:
    """SELECT src.*, k, cu, cn with the course map."""
    k = strip(code)
    if blank_as is not None:
        k = f"CASE WHEN {code} IS NULL OR {strip(code)} = '' THEN {q(blank_as)} ELSE {strip(code)} END"
    fb = name_fallback or "u.k"
    return (f"(SELECT u.*, coalesce(m.unified_code, u.k) AS cu, coalesce(m.unified_name, {fb}) AS cn "
            f"FROM (SELECT s.*, {k} AS k FROM {src} s) u LEFT JOIN cmap m ON m.map_code = u.k)")


# --------------------------------------------------------------------------- D1-D5

STUDENT_VIEW_CTE = f"""sv AS (
  WITH mu AS (SELECT aluno, ano, semestre, turma, disciplina, sit_matricula FROM (
     SELECT *, row_number() OVER (PARTITION BY aluno, ano, semestre, turma ORDER BY disciplina, sit_matricula) AS rn
     FROM enrol) x WHERE rn = 1)
  SELECT CAST(row_number() OVER (ORDER BY a.aluno, mu.ano DESC NULLS LAST, mu.semestre DESC NULLS LAST,
                                 mu.turma ASC NULLS FIRST) AS BIGINT) AS id,
    p.cpf AS pes_nu_cpf_cgc, c.decreto AS hab_mec, a.pessoa AS pes_id_pessoa, p.nome_compl AS pes_nm_pessoa,
    p.nome_social AS pes_nm_registro, a.aluno AS alu_nu_matricula, c.nome AS curso, c.titulo AS crr_nm_titulo,
    a.curriculo AS id_curriculo_atual_aluno, a.serie AS rcr_nu_periodo_aluno,
    CAST(mu.ano AS VARCHAR) || '/' || CAST(mu.semestre AS VARCHAR) AS semestre_oca,
    a.sit_aluno AS ds_situacao, mu.sit_matricula AS situacao_matricula, a.dt_ingresso AS his_dt_ingresso,
    CAST(NULL AS VARCHAR) AS his_dt_saida, CAST(NULL AS VARCHAR) AS rcr_dt_colacao_grau,
    a.unidade_ensino AS tpc_ds_tp_curso, a.turno AS turno,
    CAST(a.ano_ingresso AS VARCHAR) || '/' || CAST(a.sem_ingresso AS VARCHAR) AS pering,
    cr.regime AS ds_periodicidade, c.tipo AS modalidade_ensino, a.unidade_fisica AS instituicao_ensino,
    a.tipo_ingresso AS tipo_ingresso
  FROM student a
  LEFT JOIN person p ON a.pessoa = p.pessoa
  LEFT JOIN course c ON a.curso = c.curso
  LEFT JOIN curriculum cr ON a.curriculo = cr.curriculo AND a.curso = cr.curso
  LEFT JOIN mu ON a.aluno = mu.aluno)"""

ACTIVE_FILTER = f"{ci('ds_situacao', 'Ativo')} AND {ci('situacao_matricula', 'Matriculado')}"


@register("student_view", with_views("SELECT * FROM sv", STUDENT_VIEW_CTE))
def q_student_view(spark, sf):
    return P.student_view(domain(spark, sf))


@register("active_intake", with_views(f"SELECT * FROM sv WHERE pering = '2026/2' AND {ACTIVE_FILTER}", STUDENT_VIEW_CTE))
def q_active_intake(spark, sf):
    return P.active_intake(domain(spark, sf))


@register("course_totals", with_views(
    f"""SELECT curso, count(*) AS total_por_curso, CAST(sum(count(*)) OVER () AS BIGINT) AS total_geral
    FROM sv WHERE pering IN ('2026/23', '2026/2') AND {ACTIVE_FILTER} GROUP BY curso""", STUDENT_VIEW_CTE))
def q_course_totals(spark, sf):
    return P.course_totals(domain(spark, sf))


@register("student_report", with_views("""
SELECT *, row_number() OVER (ORDER BY curso_nome NULLS FIRST, nome NULLS FIRST, matricula NULLS FIRST, cpf NULLS FIRST,
  email NULLS FIRST, situacao NULLS FIRST) AS ordem
FROM (SELECT a.aluno AS matricula, a.nome_compl AS nome, p.cpf, p.e_mail AS email, c.nome AS curso_nome, a.sit_aluno AS situacao
  FROM student a LEFT JOIN person p ON a.pessoa = p.pessoa LEFT JOIN course c ON a.curso = c.curso) x"""))
def q_student_report(spark, sf):
    return P.numbered_student_report(domain(spark, sf))


@register("contact_report", with_views(f"""
SELECT l.aluno AS cod_aluno, coalesce(l.nome_social, l.nome_compl, '') AS nome_aluno, coalesce(l.sit_aluno, '') AS sit_aluno,
  l.pessoa AS cod_pessoa, coalesce(l.cod_curso, '') AS cod_curso, coalesce(c.nome, '') AS nome_curso,
  coalesce(p.fone, '') AS fone, coalesce(p.e_mail, '') AS e_mail, coalesce(p.e_mail_com, '') AS e_mail_com,
  coalesce(p.e_mail_interno, '') AS e_mail_interno, coalesce(p.ddd_fone_celular, '') AS ddd_fone_celular,
  coalesce(p.ddd_fone, '') AS ddd_fone, coalesce(p.celular, '') AS celular, coalesce(l.sit_matricula, '') AS sit_matricula
FROM latest l LEFT JOIN person p ON l.pessoa = p.pessoa LEFT JOIN course c ON c.curso = l.cod_curso""",
    f"""mt AS (SELECT m.aluno, m.ano, m.semestre, m.turma, m.disciplina, m.sit_matricula,
      coalesce(a.curso, t.curso) AS cod_curso, a.nome_social, a.nome_compl, a.sit_aluno, a.pessoa
    FROM enrol m JOIN class t ON {keys4('m', 't')} JOIN student a ON m.aluno = a.aluno
    WHERE t.unidade_responsavel = '001')""",
    """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY aluno ORDER BY ano DESC, semestre DESC,
      turma DESC, disciplina DESC, sit_matricula DESC, cod_curso DESC, nome_social DESC, nome_compl DESC,
      sit_aluno DESC, pessoa DESC) AS rn FROM mt) x WHERE rn = 1)"""))
def q_contact_report(spark, sf):
    return P.contact_report(domain(spark, sf))


# --------------------------------------------------------------------------- D6-D8

@register("load_courses", with_views(f"""
SELECT codigoCurso, nomeCurso, quantPeriodos, codigoUnidadeOrganizacional FROM (
  SELECT {trunc('codigo', 30)} AS codigoCurso, {trunc('coalesce(nome_mapa, nome_primeiro)', 64)} AS nomeCurso,
    CASE WHEN TRY_CAST(CAST(prazo AS VARCHAR) AS BIGINT) = 0 THEN CAST(1 AS BIGINT)
         WHEN TRY_CAST(CAST(prazo AS VARCHAR) AS BIGINT) BETWEEN 1 AND 99 THEN TRY_CAST(CAST(prazo AS VARCHAR) AS BIGINT) END AS quantPeriodos,
    '{K.ORG_UNIT_CODE}' AS codigoUnidadeOrganizacional, codigo
  FROM g) x
WHERE {within('codigo', 30)} AND {within('nomeCurso', 64)} AND quantPeriodos IS NOT NULL""",
    course_map_cte(),
    "mc AS (SELECT curso, max(curriculo) AS curriculo FROM curriculum GROUP BY curso)",
    """src AS (SELECT c.curso, c.nome, cr.prazo_ideal FROM course c JOIN mc ON mc.curso = c.curso
      JOIN curriculum cr ON cr.curso = mc.curso AND cr.curriculo = mc.curriculo
      WHERE c.ativo = 'S' AND c.faculdade IN ('001'))""",
    f"""g AS (SELECT cu AS codigo, max(m_name) AS nome_mapa, arg_min(nome, curso) AS nome_primeiro, max(prazo_ideal) AS prazo
      FROM (SELECT u.*, m.unified_name AS m_name FROM {unify_sql('src', 'curso')} u
            LEFT JOIN cmap m ON m.map_code = u.k) z GROUP BY cu)"""))
def q_load_courses(spark, sf):
    return P.load_courses(domain(spark, sf))


OPEN = ci("t.sit_turma", "aberta")


@register("load_subjects", with_views(f"""
SELECT codigoDisciplina, nomeDisciplina, codigoCurso, periodo FROM (
  SELECT {subject_code('disciplina', 'cn', 'cu')} AS codigoDisciplina,
    CASE WHEN {present('nome_disciplina')} THEN {trunc('nome_disciplina', 100)} ELSE {trunc('disciplina', 100)} END AS nomeDisciplina,
    {trunc('cu', 30)} AS codigoCurso, CAST(CASE WHEN p0 = 0 THEN 1 ELSE p0 END AS BIGINT) AS periodo, disciplina, cu
  FROM (SELECT *, CASE WHEN p_min IS NULL THEN 1 ELSE {to_int_via_float('p_min')} END AS p0 FROM g) r) x
WHERE {within('disciplina', 30)} AND periodo IS NOT NULL AND periodo >= 1 AND (cu = '999' OR {within('cu', 30)})""",
    course_map_cte(),
    f"""base AS (SELECT DISTINCT t.disciplina, t.curso FROM enrol m JOIN class t ON {keys4('m', 't')}
      WHERE {OPEN} AND m.aluno IN (SELECT aluno FROM student a WHERE {ci('a.sit_aluno', 'Ativo')}))""",
    """b2 AS (SELECT b.disciplina, d.nome AS nome_disciplina, b.curso, g.serie_ideal FROM base b
      LEFT JOIN course c ON c.curso = b.curso LEFT JOIN subject d ON d.disciplina = b.disciplina
      LEFT JOIN grid g ON g.disciplina = b.disciplina AND g.curso = b.curso
      WHERE b.curso IS NULL OR c.faculdade IN ('001'))""",
    f"""g AS (SELECT disciplina, cu, first(nome_disciplina) FILTER (WHERE nome_disciplina IS NOT NULL) AS nome_disciplina,
      max(CASE WHEN cu = '999' THEN 'COMPARTILHADA' ELSE cn END) AS cn, min(serie_ideal) AS p_min
      FROM {unify_sql('b2', 'curso', blank_as='999')} z GROUP BY disciplina, cu)"""))
def q_load_subjects(spark, sf):
    return P.load_subjects(domain(spark, sf))


AREAS = ", ".join(q(a) for a in K.KNOWLEDGE_AREAS)


@register("load_offerings", with_views(f"""
SELECT codigoOferta, nomeOferta, codigoDisciplina, semestreOferta, codigoTipoOferta, codigoOfertaOrigem, turno, codigoIdentificacaoAVA
FROM (SELECT *, row_number() OVER (PARTITION BY codigoOferta ORDER BY _d DESC, _t DESC, nomeOferta DESC, codigoDisciplina DESC,
        semestreOferta DESC, codigoTipoOferta DESC, codigoOfertaOrigem DESC, turno DESC, _n DESC) AS rn
      FROM z WHERE {within('_d', 30)} AND {present('_n')} AND codigoTipoOferta IS NOT NULL AND codigoOferta IS NOT NULL) w
WHERE rn = 1""",
    course_map_cte(),
    f"t AS (SELECT * FROM class t WHERE {OPEN})",
    "sub AS (SELECT * FROM subject WHERE faculdade IN ('001'))",
    f"""offered AS (SELECT t.disciplina, t.turma, t.ano, t.semestre, t.turno, t.curso, d.nome_compl, c.nome AS nome_curso
      FROM t JOIN sub d ON d.disciplina = t.disciplina JOIN course c ON c.curso = t.curso
      WHERE d.area_conhecimento IN ({AREAS}, '') OR d.area_conhecimento IS NULL)""",
    f"""reg AS (SELECT disciplina, ano, semestre, cu, min(turma) AS turma_regular FROM {unify_sql(
        "(SELECT t.* FROM t JOIN sub d ON d.disciplina = t.disciplina JOIN course c ON c.curso = t.curso WHERE t.turma LIKE 'T0%')",
        'curso')} r GROUP BY disciplina, ano, semestre, cu)""",
    f"""x AS (SELECT o.*, r.turma_regular, {offering_type('o.turma')} AS tipo0
      FROM {unify_sql('offered', 'curso', name_fallback=f"CASE WHEN {present('u.nome_curso')} THEN {strip('u.nome_curso')} ELSE u.k END")} o
      LEFT JOIN reg r ON r.disciplina = o.disciplina AND r.ano = o.ano AND r.semestre = o.semestre AND r.cu = o.cu)""",
    f"""y AS (SELECT x.*, CASE WHEN tipo0 IN ('REC', 'REP') AND turma_regular IS NOT NULL
      THEN {offering_code('disciplina', 'turma_regular', 'ano', 'semestre')} END AS origem FROM x)""",
    f"""z AS (SELECT {offering_code('disciplina', 'turma', 'ano', 'semestre')} AS codigoOferta, {trunc('turma', 100)} AS nomeOferta,
      {subject_code('disciplina', 'cn', 'cu')} AS codigoDisciplina,
      {trunc("CAST(ano AS VARCHAR) || '.' || CAST(semestre AS VARCHAR)", 6)} AS semestreOferta,
      CASE WHEN tipo0 IN ('REC', 'REP') AND NOT {present('origem')} THEN 'REG' ELSE tipo0 END AS codigoTipoOferta,
      coalesce(origem, '') AS codigoOfertaOrigem,
      CASE WHEN {shift('turno')} IN ('M', 'T', 'N', 'I') THEN {shift('turno')} ELSE 'M' END AS turno,
      '' AS codigoIdentificacaoAVA, disciplina AS _d, nome_compl AS _n, turma AS _t FROM y)"""))
def q_load_offerings(spark, sf):
    return P.load_offerings(domain(spark, sf))


# --------------------------------------------------------------------------- D9-D11

@register("load_users", with_views(f"""
SELECT {trunc('CAST(num_func AS VARCHAR)', 20)} AS matriculaUsuario, {trunc(mailbox_user('mailbox'), 24)} AS codigoUsuario,
  {trunc('lower(mailbox)', 100)} AS emailUsuario, {trunc('nome', 64)} AS nomeUsuario
FROM (SELECT num_func, mailbox, coalesce(nome_social, nome_compl) AS nome FROM teacher
      WHERE num_func IN (SELECT td.num_func FROM class_teacher td
        JOIN class t ON t.ano = td.ano AND t.semestre = td.periodo AND t.turma = td.turma AND t.disciplina = td.disciplina
        LEFT JOIN course c ON c.curso = t.curso
        WHERE {OPEN} AND (t.curso IS NULL OR c.faculdade IN ('001')))) u
WHERE {email_ok('mailbox')} AND {non_blank('nome')}"""))
def q_load_users(spark, sf):
    return P.load_users(domain(spark, sf))


@register("load_users_courses", with_views(f"""
SELECT codigoCurso, emailUsuario, min(papel) AS papelUsuario FROM (
  SELECT {trunc('l.cu', 30)} AS codigoCurso, {trunc('lower(l.mailbox)', 100)} AS emailUsuario,
    CASE WHEN k.k_func IS NOT NULL THEN 'C' ELSE 'P' END AS papel
  FROM {unify_sql('links', 'curso', blank_as='')} l
  LEFT JOIN coord k ON CAST(l.num_func AS VARCHAR) = k.k_func AND l.cu = k.k_cu
  WHERE {within('l.cu', 30)} AND {email_ok('l.mailbox')}) j
GROUP BY codigoCurso, emailUsuario""",
    course_map_cte(),
    """links AS (SELECT DISTINCT td.num_func, d.mailbox, g.curso FROM (SELECT DISTINCT num_func, disciplina FROM class_teacher) td
      JOIN teacher d ON d.num_func = td.num_func JOIN grid g ON g.disciplina = td.disciplina WHERE d.ativo = 'S')""",
    f"coord AS (SELECT DISTINCT num_func AS k_func, cu AS k_cu FROM {unify_sql('coordination', 'curso', blank_as='')} c)"))
def q_load_users_courses(spark, sf):
    return P.load_users_courses(domain(spark, sf))


def committee_ctes(p: str = "", sheet: str = "committee_sheet") -> list[str]:
    """Committee product (D16) as CTEs named ``{p}sh``, ``{p}cc`` (courses), ``{p}cm`` (members)."""
    cols = ['codigoCurso', 'nomeCurso', 'Coordenador', 'emailCoordenador', 'nomeMembro', 'emailMembro']
    return [
        f"""{p}sh AS (SELECT linha, {', '.join(f"CASE WHEN {strip(c)} = '' THEN NULL ELSE {strip(c)} END AS {c}" for c in cols)}
      FROM {sheet})""",
        f"{p}sh2 AS (SELECT *, coalesce(codigoCurso, nomeCurso) AS chave FROM {p}sh WHERE nomeCurso IS NOT NULL)",
        f"""{p}cf AS (SELECT chave, arg_min(codigoCurso, linha) AS codigoCurso, arg_min(nomeCurso, linha) AS nomeCurso,
      min(linha) AS pos, arg_min(Coordenador, linha) FILTER (WHERE Coordenador IS NOT NULL) AS Coordenador,
      arg_min(emailCoordenador, linha) FILTER (WHERE emailCoordenador IS NOT NULL) AS emailCoordenador
      FROM {p}sh2 GROUP BY chave)""",
        f"""{p}cg AS (SELECT b.*, coalesce(b.codigoCurso, list_filter(list_transform(range(0, sq + 1 + len(dados)),
          lambda i: CASE WHEN i = 0 THEN base ELSE base || format('{{:02d}}', i) END),
          lambda n: NOT list_contains(dados, n))[sq + 1]) AS code
      FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY pos) - 1 AS sq FROM (
        SELECT *, CASE WHEN codigoCurso IS NULL THEN coalesce(nullif(upper(substr(array_to_string(
          list_transform(string_split_regex(nomeCurso, '\\s+'), lambda w: substr(w, 1, 1)), ''), 1, 3)), ''), 'XXX') END AS base
        FROM {p}cf) a) b, (SELECT coalesce(list(codigoCurso) FILTER (codigoCurso IS NOT NULL), []) AS dados FROM {p}cf) z)""",
        f"""{p}cc AS (SELECT code AS codigoCurso, {trunc('nomeCurso', 64)} AS nomeCurso, coalesce({trunc('Coordenador', 100)}, '') AS coordenador,
      {trunc('emailCoordenador', 100)} AS emailCoordenador, 'S' AS status FROM {p}cg
      WHERE {within('code', 30)} AND {within(trunc('nomeCurso', 64), 64)})""",
        f"""{p}cm AS (SELECT DISTINCT g.code AS codigoCurso, {trunc('h.nomeMembro', 100)} AS nomeMembro,
      {trunc('h.emailMembro', 100)} AS emailMembro, 'S' AS status
      FROM {p}sh2 h JOIN {p}cg g ON g.chave = h.chave WHERE h.nomeMembro IS NOT NULL
        AND g.code IN (SELECT codigoCurso FROM {p}cc))""",
    ]


COMMITTEE_CTES = committee_ctes()


@register("committee_courses", with_views("SELECT * FROM cc", *COMMITTEE_CTES))
def q_committee_courses(spark, sf):
    return P.committee(domain(spark, sf))[0]


@register("committee_members", with_views("SELECT * FROM cm", *COMMITTEE_CTES))
def q_committee_members(spark, sf):
    return P.committee(domain(spark, sf))[1]


# the sheet with a course name that is too long in every third course: its members have no course to belong to
_LONG_SHEET = """long_sheet AS (SELECT linha, codigoCurso || CASE WHEN TRY_CAST(codigoCurso AS BIGINT) % 3 = 0
    THEN repeat('x', 30) ELSE '' END AS codigoCurso, nomeCurso, Coordenador, emailCoordenador, nomeMembro, emailMembro FROM committee_sheet)"""


@register("committee_orphans", with_views(f"""
SELECT DISTINCT g.code AS codigoCurso, {trunc('h.nomeMembro', 100)} AS nomeMembro, {trunc('h.emailMembro', 100)} AS emailMembro, 'S' AS status
FROM osh2 h JOIN ocg g ON g.chave = h.chave WHERE h.nomeMembro IS NOT NULL AND g.code NOT IN (SELECT codigoCurso FROM occ)""",
    _LONG_SHEET, *committee_ctes("o", "long_sheet")))
def q_committee_orphans(spark, sf):
    """Members that are not loaded, since their course was refused."""
    d = domain(spark, sf)
    code = F.col("codigoCurso")
    sheet = d.committee_sheet.withColumn("codigoCurso", F.when(code.try_cast("bigint") % 3 == 0, F.concat(code, F.lit("x" * 30)))
                                         .otherwise(code))
    return P.committee_with_orphans(d, sheet)[2]


@register("load_users_subjects", with_views(f"""
SELECT DISTINCT {subject_code('disciplina', 'cn', 'cu')} AS codigoDisciplina, {trunc('lower(email)', 100)} AS emailUsuario
FROM {unify_sql('rws', 'curso', blank_as='')} r WHERE {present('disciplina')} AND {present('cu')}""",
    course_map_cte(), *COMMITTEE_CTES,
    "td AS (SELECT * FROM class_teacher WHERE disciplina IN (SELECT disciplina FROM subject WHERE faculdade IN ('001')))",
    f"""teaching AS (SELECT DISTINCT td.disciplina, t.curso, d.mailbox AS email FROM td JOIN teacher d ON d.num_func = td.num_func
      JOIN class t ON t.ano = td.ano AND t.semestre = td.periodo AND t.turma = td.turma AND t.disciplina = td.disciplina
      WHERE d.ativo = 'S' AND {present('d.mailbox')})""",
    "grd AS (SELECT DISTINCT x.disciplina, g.curso FROM (SELECT DISTINCT disciplina FROM td) x JOIN grid g ON g.disciplina = x.disciplina)",
    f"""nde AS (SELECT codigoCurso AS curso, emailCoordenador AS email FROM cc WHERE {present('emailCoordenador')} AND status = 'S'
      UNION SELECT codigoCurso AS curso, emailMembro AS email FROM cm WHERE {present('emailMembro')} AND status = 'S')""",
    f"""rws AS (SELECT * FROM (SELECT disciplina, curso, email FROM teaching
        WHERE {present('disciplina')} AND {present('curso')} AND {present('email')}
      UNION SELECT grd.disciplina, grd.curso, nde.email FROM grd JOIN nde ON nde.curso = grd.curso) u WHERE {email_ok('email')})"""))
def q_load_users_subjects(spark, sf):
    return P.load_users_subjects(domain(spark, sf))


# --------------------------------------------------------------------------- D12-D15

@register("load_teacher_offerings", with_views(f"""
SELECT codigoOferta, emailProfessor, codigoCurso FROM (
  SELECT *, row_number() OVER (PARTITION BY codigoOferta, emailProfessor ORDER BY _d DESC, _t DESC, _m DESC, codigoCurso DESC) AS rn
  FROM (SELECT {offering_code('disciplina', 'turma', 'ano', 'semestre')} AS codigoOferta, {trunc('lower(mailbox)', 100)} AS emailProfessor,
          {trunc('cu', 30)} AS codigoCurso, disciplina AS _d, turma AS _t, mailbox AS _m
        FROM {unify_sql('j', 'curso', blank_as='')} u WHERE {within('disciplina', 30)} AND {email_ok('mailbox')}) z) w
WHERE rn = 1""",
    course_map_cte(),
    f"""j AS (SELECT DISTINCT t.disciplina, t.turma, t.ano, t.semestre, d.mailbox, t.curso FROM class t
      JOIN class_teacher td ON td.disciplina = t.disciplina AND td.turma = t.turma AND td.ano = t.ano AND td.periodo = t.semestre
      JOIN teacher d ON d.num_func = td.num_func
      WHERE {OPEN} AND d.ativo = 'S' AND {present('d.mailbox')} AND t.disciplina IN (SELECT disciplina FROM subject
        WHERE faculdade IN ('001') AND (area_conhecimento IN ({AREAS}) OR area_conhecimento IS NULL OR area_conhecimento = '')))"""))
def q_load_teacher_offerings(spark, sf):
    return P.load_teacher_offerings(domain(spark, sf))


STUDENT_OFFERINGS_CTES = [
    course_map_cte(),
    f"""so_j AS (SELECT DISTINCT m.aluno, m.ano, m.semestre, m.turma, m.disciplina, a.curso FROM enrol m
      JOIN class t ON {keys4('m', 't')} JOIN student a ON m.aluno = a.aluno WHERE {OPEN})""",
    f"""so AS (SELECT codigoOferta, matriculaAluno, codigoCurso FROM (
      SELECT *, row_number() OVER (PARTITION BY codigoOferta, matriculaAluno ORDER BY aluno DESC, ano DESC, semestre DESC,
        turma DESC, disciplina DESC, codigoCurso DESC) AS rn FROM (
        SELECT {offering_code('disciplina', 'turma', 'ano', 'semestre')} AS codigoOferta, {trunc('aluno', 20)} AS matriculaAluno,
          CASE WHEN {present('cu')} THEN {trunc('cu', 30)} END AS codigoCurso, aluno, ano, semestre, turma, disciplina
        FROM {unify_sql('so_j', 'curso', blank_as='')} u
        WHERE {non_blank('aluno')} AND (NOT {present('cu')} OR {within('cu', 30)})) z) w WHERE rn = 1)""",
]


@register("load_student_offerings", with_views("SELECT * FROM so", *STUDENT_OFFERINGS_CTES))
def q_load_student_offerings(spark, sf):
    return P.load_student_offerings(domain(spark, sf))


@register("load_students", with_views(f"""
SELECT DISTINCT {trunc('aluno', 20)} AS matriculaAluno, {trunc('nome_compl', 140)} AS nomeAluno,
  {trunc(f"lower(aluno || CASE WHEN unidade_ensino = {q(K.TECH_UNIT)} THEN {q(K.STUDENT_DOMAIN_TECH)} ELSE {q(K.STUDENT_DOMAIN_DEFAULT)} END)", 100)} AS emailAluno,
  {trunc('curso', 30)} AS codigoCurso, {shift('turno')} AS turno, '' AS codigoIdentificacaoAVA
FROM student WHERE {ci('sit_aluno', 'Ativo')} AND aluno IN (SELECT matriculaAluno FROM so)
  AND {non_blank('aluno')} AND {non_blank('nome_compl')} AND {within('curso', 30)}""", *STUDENT_OFFERINGS_CTES))
def q_load_students(spark, sf):
    return P.load_students(domain(spark, sf))


ASSESS_SELECT = f"""
SELECT substr(code || '-' || pv, 1, 200) AS codigoUnidade, {trunc(exam_labels_case('pv'), 64)} AS nomeUnidade,
  {trunc('cu', 30)} AS codigoCurso, code AS codigoDisciplina, coalesce({to_int_via_float('ordem')}, 0) AS ordemExibicao,
  substr(code || '-' || pv, 1, 200) AS codigoAgrupamento
FROM (SELECT *, {trunc(subject_code('d', 'cn2', 'cu'), 30)} AS code FROM (
  SELECT *, CASE WHEN {present('cn')} THEN cn ELSE coalesce(nome_curso, cu) END AS cn2
  FROM {unify_sql('j2', 'co')} u) a) b"""

ASSESS_CTES = [
    course_map_cte(),
    f"""j2 AS (SELECT * FROM (SELECT p.*, t.curso, c.nome AS nome_curso, {strip("coalesce(p.disciplina, '')")} AS d,
        {strip("coalesce(t.curso, '')")} AS co, {strip("coalesce(p.prova, '')")} AS pv
      FROM exam p JOIN class t ON {keys4('p', 't')} JOIN course c ON c.curso = t.curso
      WHERE p.prova IS NOT NULL AND p.nome IS NOT NULL AND t.curso IS NOT NULL) x WHERE d <> '' AND co <> '' AND pv <> '')""",
]


@register("load_assessment_units", with_views(ASSESS_SELECT, *ASSESS_CTES))
def q_load_assessment_units(spark, sf):
    return P.load_assessment_units(domain(spark, sf))
