"""Data products (D1-D16): student view, reports and the contract-shaped load tables.

Each function takes the domain tables (``acadlake.views.Domain``) and returns
one lazily planned DataFrame.  Filters sit directly on the scans so they are
pushed into the Parquet readers; dimensions (course, subject, teacher, the
fixed code map) are small and become broadcast joins (AQE, size-checked);
facts (enrolments, classes, class-teacher links) meet in sort-merge joins on
their composite keys.  No product collects to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadlake.functions import constants as K
from acadlake.functions import rules as R
from acadlake.functions import scalars as S
from acadlake.operators import aggregates as A
from acadlake.operators import ordering as O
from acadlake.operators import relational as J
from acadlake.operators.pairs import Pairs
from acadlake.views import Domain

CLASS_KEYS = ["ano", "semestre", "turma", "disciplina"]


@dataclass(frozen=True)
class Period:
    """Academic period filter; ``None`` means every year / every semester."""

    year: int | None = None
    semesters: tuple | None = None

    def on(self, df: DataFrame, year_col: str = "ano", sem_col: str = "semestre") -> DataFrame:
        return J.optional_filters(df, {year_col: self.year, sem_col: list(self.semesters) if self.semesters else None})


ALL_PERIODS = Period()


# --------------------------------------------------------------------------- D1-D5

def representative_enrolment(enrol: DataFrame) -> DataFrame:
    """One row per (student, year, semester, class): the smallest subject."""
    e = enrol.select("aluno", "ano", "semestre", "turma", "disciplina", "sit_matricula")
    return O.pick_per_key(e, ["aluno", "ano", "semestre", "turma"], ["disciplina"], keep="first")


def student_view(d: Domain, with_id: bool = True) -> DataFrame:
    """Student view, 24 columns, with a global sequential id."""
    a = d.student.alias("a")
    p = d.person.select("pessoa", "cpf", "nome_compl", "nome_social").alias("p")
    c = d.course.select("curso", "decreto", "nome", "titulo", "tipo").alias("c")
    cr = d.curriculum.select("curso", "curriculo", "regime").alias("cr")
    # only the sort key (and the status, which filters use) is numbered and written; the 24 columns join afterwards
    mu = d.student.select("aluno").join(representative_enrolment(d.enrol), "aluno", "left") \
        .select("aluno", "ano", "semestre", "turma", "sit_matricula")
    if with_id:
        mu = O.sequential_ids(mu, [F.col("aluno").asc(), F.col("ano").desc_nulls_last(),
                                   F.col("semestre").desc_nulls_last(), F.col("turma").asc_nulls_first()], "id")
    mu = mu.alias("mu")
    j = (a.join(mu, F.col("a.aluno") == F.col("mu.aluno"))
         .join(p, F.col("a.pessoa") == F.col("p.pessoa"), "left")
         .join(c, F.col("a.curso") == F.col("c.curso"), "left")
         .join(cr, (F.col("a.curriculo") == F.col("cr.curriculo")) & (F.col("a.curso") == F.col("cr.curso")), "left"))
    out = j.select(
        F.col("p.cpf").alias("pes_nu_cpf_cgc"),
        F.col("c.decreto").alias("hab_mec"),
        F.col("a.pessoa").alias("pes_id_pessoa"),
        F.col("p.nome_compl").alias("pes_nm_pessoa"),
        F.col("p.nome_social").alias("pes_nm_registro"),
        F.col("a.aluno").alias("alu_nu_matricula"),
        F.col("c.nome").alias("curso"),
        F.col("c.titulo").alias("crr_nm_titulo"),
        F.col("a.curriculo").alias("id_curriculo_atual_aluno"),
        F.col("a.serie").alias("rcr_nu_periodo_aluno"),
        S.period_text(F.col("mu.ano"), F.col("mu.semestre")).alias("semestre_oca"),
        F.col("a.sit_aluno").alias("ds_situacao"),
        F.col("mu.sit_matricula").alias("situacao_matricula"),
        F.col("a.dt_ingresso").alias("his_dt_ingresso"),
        F.lit(None).cast("string").alias("his_dt_saida"),
        F.lit(None).cast("string").alias("rcr_dt_colacao_grau"),
        F.col("a.unidade_ensino").alias("tpc_ds_tp_curso"),
        F.col("a.turno").alias("turno"),
        S.period_text(F.col("a.ano_ingresso"), F.col("a.sem_ingresso")).alias("pering"),
        F.col("cr.regime").alias("ds_periodicidade"),
        F.col("c.tipo").alias("modalidade_ensino"),
        F.col("a.unidade_fisica").alias("instituicao_ensino"),
        F.col("a.tipo_ingresso").alias("tipo_ingresso"),
        *([F.col("mu.id").alias("id")] if with_id else []),
    )
    return out


def active_intake(d: Domain, intake: str = "2026/2") -> DataFrame:
    """Active students of one intake with a current enrolment."""
    v = student_view(d)
    return v.where((F.col("pering") == intake) & S.ci_equals("ds_situacao", K.ACTIVE_STUDENT_STATUS)
                   & S.ci_equals("situacao_matricula", "Matriculado"))


def course_totals(d: Domain, intakes: tuple = ("2026/23", "2026/2")) -> DataFrame:
    """Rows per course beside the grand total, same filter."""
    v = student_view(d, with_id=False)
    f = v.where(F.col("pering").isin(list(intakes)) & S.ci_equals("ds_situacao", K.ACTIVE_STUDENT_STATUS)
                & S.ci_equals("situacao_matricula", "Matriculado"))
    return A.count_with_total(f, ["curso"], "total_por_curso", "total_geral")


def student_report(d: Domain) -> DataFrame:
    """Student report rows (order: course name, student name)."""
    a = d.student.alias("a")
    p = d.person.select("pessoa", "cpf", "e_mail").alias("p")
    c = d.course.select("curso", "nome").alias("c")
    return (a.join(p, F.col("a.pessoa") == F.col("p.pessoa"), "left")
            .join(c, F.col("a.curso") == F.col("c.curso"), "left")
            .select(F.col("a.aluno").alias("matricula"), F.col("a.nome_compl").alias("nome"),
                    F.col("p.cpf").alias("cpf"), F.col("p.e_mail").alias("email"),
                    F.col("c.nome").alias("curso_nome"), F.col("a.sit_aluno").alias("situacao"))
            .orderBy(F.col("curso_nome").asc_nulls_first(), F.col("nome").asc_nulls_first()))


def numbered_student_report(d: Domain) -> DataFrame:
    """D4/O1 with its order as column ``ordem`` (W2): course name, student name, then the other columns."""
    report = student_report(d)
    order = ["curso_nome", "nome", *[c for c in report.columns if c not in ("curso_nome", "nome")]]
    return O.sequential_ids(report, [F.col(c).asc_nulls_first() for c in order], "ordem")


def contact_report(d: Domain, years=None, semesters=None, unit: str | None = "001", course: str | None = None,
                   intake_years=None, intake_semesters=None) -> DataFrame:
    """One row per student at the latest enrolment (W3), optional filters (P6), NULL -> ''."""
    m = d.enrol.select("aluno", "ano", "semestre", "turma", "disciplina", "sit_matricula")
    t = J.optional_filters(d.view("class"),
                           {"ano": years, "semestre": semesters, "unidade_responsavel": unit})
    t = t.select(*CLASS_KEYS, F.col("curso").alias("t_curso"))
    a = d.student.select("aluno", "nome_social", "nome_compl", "sit_aluno", "pessoa", "ano_ingresso",
                         "sem_ingresso", F.col("curso").alias("a_curso"))
    a = J.optional_filters(a, {"ano_ingresso": intake_years, "sem_ingresso": intake_semesters})
    mt = m.join(t, CLASS_KEYS, "inner").join(a, "aluno", "inner")
    mt = mt.withColumn("cod_curso", F.coalesce("a_curso", "t_curso"))
    if course:
        mt = mt.where(F.col("cod_curso") == course)
    # latest enrolment per student: (year, semester) desc, ties broken by (class, subject) desc
    latest = O.pick_per_key(
        mt.select("aluno", "ano", "semestre", "turma", "disciplina", "sit_matricula", "cod_curso",
                  "nome_social", "nome_compl", "sit_aluno", "pessoa"),
        ["aluno"], ["ano", "semestre", "turma", "disciplina"], keep="last")
    p = d.person.select("pessoa", "fone", "e_mail", "e_mail_com", "e_mail_interno", "ddd_fone_celular",
                        "ddd_fone", "celular")
    c = d.course.select(F.col("curso").alias("cod_curso"), F.col("nome").alias("nome_curso"))
    out = (latest.join(p, "pessoa", "left").join(c, "cod_curso", "left")
           .select(F.col("aluno").alias("cod_aluno"),
                   F.coalesce("nome_social", "nome_compl", F.lit("")).alias("nome_aluno"),
                   "sit_aluno", F.col("pessoa").alias("cod_pessoa"), "cod_curso", "nome_curso", "fone",
                   "e_mail", "e_mail_com", "e_mail_interno", "ddd_fone_celular", "ddd_fone", "celular",
                   "sit_matricula"))
    return out.na.fill("")


# --------------------------------------------------------------------------- D6-D8

def load_courses(d: Domain) -> DataFrame:
    """D6 (imp_001): active courses of the included faculties at their latest curriculum,
    unified by the code map, collapsed per unified code (A7), validated."""
    cr = J.latest_version(d.curriculum.select("curso", "curriculo", "prazo_ideal"), "curso", "curriculo")
    c = d.course.where((F.col("ativo") == "S") & F.col("faculdade").isin(K.INCLUDED_FACULTIES)) \
        .select("curso", "nome")
    src = c.join(cr, "curso", "inner")
    src = J.unify_course(src, "curso", d.spark, out_code="codigo", out_name="nome_mapa",
                         name_fallback=F.lit(None).cast("string"))
    g = src.groupBy("codigo").agg(
        F.max("nome_mapa").alias("nome_mapa"),
        F.min_by("nome", "curso").alias("nome_primeiro"),
        F.max("prazo_ideal").alias("prazo"),
        F.count(F.lit(1)).alias("quantidade"))
    nome = S.truncate(F.coalesce("nome_mapa", "nome_primeiro"), 64)
    out = g.select(S.truncate("codigo", 30).alias("codigoCurso"), nome.alias("nomeCurso"),
                   S.clamp_periods("prazo").alias("quantPeriodos"),
                   F.lit(K.ORG_UNIT_CODE).alias("codigoUnidadeOrganizacional"), F.col("codigo").alias("_c"))
    return out.where(R.is_text_within("_c", 30) & R.is_text_within("nomeCurso", 64)
                     & F.col("quantPeriodos").isNotNull()).drop("_c")


def _open_classes(d: Domain, period: Period) -> DataFrame:
    t = period.on(d.view("class"))
    return t.where(S.ci_equals("sit_turma", K.OPEN_CLASS_STATUS))


def load_subjects(d: Domain, period: Period = ALL_PERIODS) -> DataFrame:
    """D7 (imp_002): subject x unified course with the minimum ideal period."""
    m = period.on(d.enrol).select(*CLASS_KEYS, "aluno")
    t = _open_classes(d, period).select(*CLASS_KEYS, "curso")
    a = d.student.where(S.ci_equals("sit_aluno", K.ACTIVE_STUDENT_STATUS)).select("aluno")
    c = d.course.select(F.col("curso").alias("c_curso"), "faculdade")
    sub = d.subject.select(F.col("disciplina").alias("s_disc"), F.col("nome").alias("nome_disciplina"))
    g = d.grid.select(F.col("disciplina").alias("g_disc"), F.col("curso").alias("g_curso"), "serie_ideal")
    base = (m.join(t, CLASS_KEYS, "inner").join(a, "aluno", "left_semi")
            .select("disciplina", "curso").distinct())
    base = (base.join(c, base["curso"] == c["c_curso"], "left")
            .where(J.unassigned_or_allowed("curso", "faculdade", K.INCLUDED_FACULTIES))
            .join(sub, base["disciplina"] == sub["s_disc"], "left")
            .join(g, (base["disciplina"] == g["g_disc"]) & (base["curso"] == g["g_curso"]), "left")
            .select("disciplina", "nome_disciplina", "curso", "serie_ideal"))
    u = J.unify_course(base, "curso", d.spark, out_code="cu", out_name="cn", blank_as=K.SHARED_COURSE)
    u = u.withColumn("cn", F.when(F.col("cu") == K.SHARED_COURSE, F.lit(K.SHARED_COURSE_NAME)).otherwise(F.col("cn")))
    agg = u.groupBy("disciplina", "cu").agg(
        F.first("nome_disciplina", ignorenulls=True).alias("nome_disciplina"),
        F.max("cn").alias("cn"),
        F.min("serie_ideal").alias("p_min"))
    periodo = F.when(F.col("p_min").isNull(), F.lit(1)).otherwise(S.to_int_via_float("p_min"))
    periodo = F.when(periodo == 0, F.lit(1)).otherwise(periodo).cast("bigint")
    nome = F.when(S.present("nome_disciplina"), S.truncate("nome_disciplina", 100)).otherwise(S.truncate("disciplina", 100))
    out = agg.select(
        S.subject_course_code("disciplina", "cn", "cu").alias("codigoDisciplina"),
        nome.alias("nomeDisciplina"), S.truncate("cu", 30).alias("codigoCurso"), periodo.alias("periodo"),
        F.col("disciplina").alias("_d"), F.col("cu").alias("_cu"))
    ok = (R.is_text_within("_d", 30) & F.col("periodo").isNotNull() & (F.col("periodo") >= 1)
          & ((F.col("_cu") == K.SHARED_COURSE) | R.is_text_within("_cu", 30)))
    return out.where(ok).drop("_d", "_cu")


def load_offerings(d: Domain, period: Period = ALL_PERIODS) -> DataFrame:
    """D8 (imp_005): offerings of open classes with type, origin and shift rules."""
    t = _open_classes(d, period).select(*CLASS_KEYS, "curso", "turno")
    sub = d.subject.where(F.col("faculdade").isin(K.INCLUDED_FACULTIES))
    # unified code and code suffix are made once a course
    c = J.unify_course(d.course.select(F.col("curso").alias("c_curso"), F.col("nome").alias("nome_curso")), "c_curso", d.spark,
                       out_code="cu", out_name="cn",
                       name_fallback=F.when(S.present("nome_curso"), S.pystrip("nome_curso")).otherwise(S.pystrip("c_curso")))
    c = c.select("c_curso", "cu", S.subject_suffix("cn").alias("sufixo"))
    offered = (t.join(sub.where(J.in_or_null("area_conhecimento", K.KNOWLEDGE_AREAS, blank=True))
                      .select("disciplina", "nome_compl"), "disciplina", "inner")
               .join(c, F.col("curso") == F.col("c_curso"), "inner").drop("c_curso"))
    # F16: first regular (T0*) class of the same subject, period and unified course
    reg = (t.where(F.col("turma").startswith("T0"))
           .join(sub.select("disciplina"), "disciplina", "inner")
           .join(c.select("c_curso", "cu"), F.col("curso") == F.col("c_curso"), "inner"))
    reg = reg.groupBy("disciplina", "ano", "semestre", "cu").agg(F.min("turma").alias("turma_regular"))
    o = offered.join(reg, ["disciplina", "ano", "semestre", "cu"], "left")
    # what several columns need is a column of its own, worked out once a row
    o = o.withColumn("tipo", S.offering_type("turma")).withColumn("turno", S.map_shift("turno"))
    o = o.withColumn("origem", F.when(F.col("tipo").isin("REC", "REP") & F.col("turma_regular").isNotNull(),
                                      S.offering_code("disciplina", "turma_regular", "ano", "semestre")))
    tipo = F.when(F.col("tipo").isin("REC", "REP") & ~S.present("origem"), F.lit("REG")).otherwise(F.col("tipo"))
    out = o.select(
        S.offering_code("disciplina", "turma", "ano", "semestre").alias("codigoOferta"),
        S.truncate("turma", 100).alias("nomeOferta"),
        S.suffixed_subject_code("disciplina", "sufixo", "cu").alias("codigoDisciplina"),
        S.truncate(F.concat(F.col("ano").cast("string"), F.lit("."), F.col("semestre").cast("string")), 6).alias("semestreOferta"),
        tipo.alias("codigoTipoOferta"),
        F.coalesce("origem", F.lit("")).alias("codigoOfertaOrigem"),
        F.when(F.col("turno").isin(K.VALID_SHIFTS), F.col("turno")).otherwise(F.lit(K.DEFAULT_OFFERING_SHIFT)).alias("turno"),
        F.lit("").alias("codigoIdentificacaoAVA"),
        F.col("disciplina").alias("_d"), F.col("nome_compl").alias("_n"), F.col("turma").alias("_t"))
    out = out.where(R.is_text_within("_d", 30) & S.present("_n") & F.col("codigoTipoOferta").isNotNull()
                    & F.col("codigoOferta").isNotNull())
    # PK codigoOferta: last row wins in the source order (subject, class)
    out = O.pick_per_key(out, ["codigoOferta"], ["_d", "_t"], keep="last")
    return out.drop("_d", "_n", "_t")


# --------------------------------------------------------------------------- D9-D11

def _teacher_links_open(d: Domain, period: Period) -> DataFrame:
    """class_teacher x open class (4 keys), course faculty admitted."""
    td = period.on(d.class_teacher, "ano", "periodo").select(
        "num_func", "ano", F.col("periodo").alias("semestre"), "turma", "disciplina")
    t = _open_classes(d, period).select(*CLASS_KEYS, "curso")
    c = d.course.select(F.col("curso").alias("c_curso"), "faculdade")
    j = td.join(t, CLASS_KEYS, "inner")
    return (j.join(c, j["curso"] == c["c_curso"], "left")
            .where(J.unassigned_or_allowed("curso", "faculdade", K.INCLUDED_FACULTIES)))


def load_users(d: Domain, period: Period = ALL_PERIODS) -> DataFrame:
    """D9 (imp_006): one user per teacher teaching an open class; valid mailbox and name."""
    links = _teacher_links_open(d, period).select("num_func").distinct()
    tch = d.teacher.select("num_func", "mailbox", F.coalesce("nome_social", "nome_compl").alias("nome"))
    u = tch.join(links, "num_func", "left_semi").where(R.is_email("mailbox") & R.is_non_blank("nome"))
    return u.select(S.truncate(F.col("num_func").cast("string"), 20).alias("matriculaUsuario"),
                    S.truncate(S.mailbox_user("mailbox"), 24).alias("codigoUsuario"),
                    S.truncate(F.lower("mailbox"), 100).alias("emailUsuario"),
                    S.truncate("nome", 64).alias("nomeUsuario"))


def load_users_courses(d: Domain, period: Period = ALL_PERIODS) -> DataFrame:
    """D10 (imp_007): teacher mailbox x unified course of the subjects taught (grid fan-out, J9),
    role C when the teacher coordinates that course (F18), C beats P (W6)."""
    td = period.on(d.class_teacher, "ano", "periodo").select("num_func", "disciplina")
    tch = d.teacher.where(F.col("ativo") == "S").select("num_func", "mailbox")
    g = d.grid.where(F.col("curso").isNotNull()).select("disciplina", "curso")
    links = J.linked_values(td, g, "num_func", "disciplina", "curso").join(tch, "num_func", "inner")
    links = J.unify_course(links, "curso", d.spark, out_code="cu", out_name=None, blank_as="")
    coord = J.unify_course(d.coordination.select("num_func", "curso"), "curso", d.spark,
                           out_code="cu", out_name=None, blank_as="")
    coord = coord.select(F.col("num_func").alias("k_func"), F.col("cu").alias("k_cu"), F.lit("C").alias("papel")).distinct()
    j = links.join(coord, (links["num_func"].cast("string") == coord["k_func"]) & (links["cu"] == coord["k_cu"]), "left")
    j = j.where(R.is_text_within("cu", 30) & R.is_email("mailbox"))
    j = j.select(S.truncate("cu", 30).alias("codigoCurso"), S.truncate(F.lower("mailbox"), 100).alias("emailUsuario"),
                 F.coalesce("papel", F.lit("P")).alias("papelUsuario"))
    # 'C' < 'P': the minimum role per key is the coordinator one
    return j.groupBy("codigoCurso", "emailUsuario").agg(F.min("papelUsuario").alias("papelUsuario"))


def load_users_subjects(d: Domain, period: Period = ALL_PERIODS) -> DataFrame:
    """D11 (imp_008): subject x mailbox from teaching links union committee mailboxes of the
    subject's grid courses (O6), coded like D7 (F13)."""
    return users_subjects(d, period).rows()


def users_subjects(d: Domain, period: Period = ALL_PERIODS, keep=lambda df, part: df) -> Pairs:
    """D11 as the sides of its pairs; ``keep`` may store a part before the next one reads it."""
    td = period.on(d.class_teacher, "ano", "periodo").select(
        "num_func", "ano", F.col("periodo").alias("semestre"), "turma", "disciplina")
    dsc = d.subject.where(F.col("faculdade").isin(K.INCLUDED_FACULTIES)).select("disciplina")
    td = td.join(dsc, "disciplina", "left_semi")
    tch = d.teacher.where((F.col("ativo") == "S") & J.non_blank("mailbox")).select("num_func", "mailbox")
    t = d.view("class").select(*CLASS_KEYS, "curso")
    teaching = (td.join(tch, "num_func", "inner").join(t, CLASS_KEYS, "inner")
                .select("disciplina", "curso", F.col("mailbox").alias("email")))
    teaching = teaching.where(S.present("disciplina") & S.present("curso") & S.present("email"))
    grid = (td.select("disciplina").distinct().join(d.grid.select("disciplina", "curso"), "disciplina", "inner")
            .distinct())
    courses, members = committee(d)
    nde = (courses.where(J.non_blank("emailCoordenador") & (F.col("status") == "S"))
           .select(F.col("codigoCurso").alias("curso"), F.col("emailCoordenador").alias("email"))
           .unionByName(members.where(J.non_blank("emailMembro") & (F.col("status") == "S"))
                        .select(F.col("codigoCurso").alias("curso"), F.col("emailMembro").alias("email")))
           .distinct())
    def coded(rows: DataFrame, *more: str) -> DataFrame:
        rows = J.unify_course(rows, "curso", d.spark, out_code="cu", out_name="cn", blank_as="")
        rows = rows.where(S.present("disciplina") & S.present("cu"))
        return rows.select(S.subject_course_code("disciplina", "cn", "cu").alias("codigoDisciplina"), *more)

    mail = S.truncate(F.lower("email"), 100).alias("emailUsuario")
    taught = coded(teaching.where(R.is_email("email")), mail).distinct()
    members_of = nde.where(R.is_email("email")).select("curso", mail).distinct()
    return _code_member_pairs(coded(grid, "curso"), members_of, taught, keep)


def _code_member_pairs(codes: DataFrame, members: DataFrame, taught: DataFrame, keep=lambda df, part: df) -> Pairs:
    """Distinct (codigoDisciplina, emailUsuario) of ``codes`` (codigoDisciplina, curso) joined with ``members`` (curso,
    emailUsuario), and of ``taught``.

    The join has as many rows as subjects times members, so only its sides are made distinct; a taught pair that the join
    gives is left out by comparing the code's courses with the member's."""
    courses_of = keep(codes.where(F.col("curso").isNotNull()).groupBy("codigoDisciplina")
                      .agg(F.sort_array(F.collect_set("curso")).alias("__left")), "left")
    homes_of = keep(members.where(F.col("curso").isNotNull()).groupBy("emailUsuario")
                    .agg(F.sort_array(F.collect_set("curso")).alias("__right")), "right")
    more = taught.join(courses_of, "codigoDisciplina", "left").join(homes_of, "emailUsuario", "left")
    more = more.where(~F.coalesce(F.arrays_overlap("__left", "__right"), F.lit(False)))
    return Pairs(courses_of, homes_of, keep(more.select("codigoDisciplina", "emailUsuario"), "more"))


def _codes_by_members(codes: DataFrame, members: DataFrame, taught: DataFrame) -> DataFrame:
    return _code_member_pairs(codes, members, taught).rows()


# --------------------------------------------------------------------------- D12-D15

def load_teacher_offerings(d: Domain, period: Period = ALL_PERIODS) -> DataFrame:
    """D12 (imp_009): offering code x teacher mailbox for open classes (P3, P9), last wins."""
    t = _open_classes(d, period).select(*CLASS_KEYS, "curso")
    dsc = d.subject.where(F.col("faculdade").isin(K.INCLUDED_FACULTIES)
                          & J.in_or_null("area_conhecimento", K.KNOWLEDGE_AREAS, blank=True)).select("disciplina")
    td = d.class_teacher.select("num_func", "ano", F.col("periodo").alias("semestre"), "turma", "disciplina")
    tch = d.teacher.where((F.col("ativo") == "S") & J.non_blank("mailbox") & R.is_email("mailbox")) \
        .select("num_func", F.col("mailbox").alias("_m"), S.truncate(F.lower("mailbox"), 100).alias("emailProfessor"))
    # codes are made once a class, mailboxes once a teacher; repeated rows have one key and are picked once
    t = t.where(R.is_text_within("disciplina", 30)).join(dsc, "disciplina", "left_semi")
    t = J.unify_course(t, "curso", d.spark, out_code="cu", out_name=None, blank_as="")
    t = t.select(*CLASS_KEYS, S.offering_code("disciplina", "turma", "ano", "semestre").alias("codigoOferta"),
                 S.truncate("cu", 30).alias("codigoCurso"))
    out = t.join(td, CLASS_KEYS, "inner").join(tch, "num_func", "inner").select(
        "codigoOferta", "emailProfessor", "codigoCurso", F.col("disciplina").alias("_d"), F.col("turma").alias("_t"), "_m")
    # mailboxes first: rows are sorted by key, and the first signs of all offering codes are alike
    out = O.pick_per_key(out, ["emailProfessor", "codigoOferta"], ["_d", "_t", "_m"], keep="last")
    return out.drop("_d", "_t", "_m")


def load_student_offerings(d: Domain, period: Period = ALL_PERIODS) -> DataFrame:
    """D14 (imp_011): offering code x student (unified course), last wins per key."""
    m = period.on(d.enrol).select("aluno", *CLASS_KEYS)
    # codes are made once a class, courses once a student; repeated rows have one key and are picked once
    t = _open_classes(d, period).select(*CLASS_KEYS, S.offering_code("disciplina", "turma", "ano", "semestre").alias("codigoOferta"))
    a = d.student.where(R.is_non_blank("aluno")).select("aluno", "curso")
    a = J.unify_course(a, "curso", d.spark, out_code="cu", out_name=None, blank_as="")
    a = a.where(~S.present("cu") | R.is_text_within("cu", 30))
    a = a.select("aluno", F.when(S.present("cu"), S.truncate("cu", 30)).alias("codigoCurso"))
    out = m.join(t, CLASS_KEYS, "inner").join(a, "aluno", "inner").select(
        "codigoOferta", S.truncate("aluno", 20).alias("matriculaAluno"), "codigoCurso",
        "aluno", "ano", "semestre", "turma", "disciplina")
    # students first: rows are sorted by key, and the first signs of all offering codes are alike
    out = O.pick_per_key(out, ["matriculaAluno", "codigoOferta"], ["aluno", "ano", "semestre", "turma", "disciplina"],
                         keep="last")
    return out.select("codigoOferta", "matriculaAluno", "codigoCurso")


def load_students(d: Domain, period: Period = ALL_PERIODS, intake_year=None, intake_semester=None,
                  unit=None, offerings: DataFrame | None = None) -> DataFrame:
    """D13 (imp_010): active students that have an offering in D14 (J5, J14), mailbox (F17); ``offerings``: D14 of the
    period if it is stored already."""
    offers = load_student_offerings(d, period) if offerings is None else offerings
    offers = offers.select(F.col("matriculaAluno").alias("aluno")).distinct()
    a = d.student.where(S.ci_equals("sit_aluno", K.ACTIVE_STUDENT_STATUS))
    a = J.optional_filters(a, {"ano_ingresso": intake_year, "sem_ingresso": intake_semester,
                               "unidade_ensino": unit})
    a = a.select("aluno", "nome_compl", "unidade_ensino", "curso", "turno").join(offers, "aluno", "left_semi").distinct()
    a = a.where(R.is_non_blank("aluno") & R.is_non_blank("nome_compl") & R.is_text_within("curso", 30))
    return a.select(S.truncate("aluno", 20).alias("matriculaAluno"),
                    S.truncate("nome_compl", 140).alias("nomeAluno"),
                    S.truncate(F.lower(F.concat("aluno", F.when(F.col("unidade_ensino") == K.TECH_UNIT,
                                                                 F.lit(K.STUDENT_DOMAIN_TECH))
                                                  .otherwise(F.lit(K.STUDENT_DOMAIN_DEFAULT)))), 100).alias("emailAluno"),
                    S.truncate("curso", 30).alias("codigoCurso"),
                    S.map_shift("turno").alias("turno"),
                    F.lit("").alias("codigoIdentificacaoAVA"))


def load_assessment_units(d: Domain) -> DataFrame:
    """D15 (imp_013): exam x class x course -> assessment units; duplicate codes kept once."""
    p = d.exam.where(F.col("prova").isNotNull() & F.col("nome").isNotNull()).select(
        *CLASS_KEYS, "prova", "nome", "ordem")
    # all that a course gives is made once a course, and codes once a class; unmapped codes: the unified "name" is the code
    # itself (then the course name as fallback)
    c = d.course.select(F.col("curso").alias("c_curso"), F.col("nome").alias("nome_curso"), S.pystrip("curso").alias("co"))
    c = J.unify_course(c.where(F.col("co") != ""), "co", d.spark, out_code="cu", out_name="cn")
    c = c.withColumn("cn", F.when(S.present("cn"), F.col("cn")).otherwise(F.coalesce("nome_curso", "cu")))
    c = c.select("c_curso", "cu", S.subject_suffix("cn").alias("sufixo"))
    t = d.view("class").where(F.col("curso").isNotNull()).select(*CLASS_KEYS, "curso", S.pystrip("disciplina").alias("d"))
    t = t.where(F.col("d") != "").join(c, F.col("curso") == F.col("c_curso"), "inner")
    t = t.select(*CLASS_KEYS, "cu", S.truncate(S.suffixed_subject_code("d", "sufixo", "cu"), 30).alias("code"))
    p = p.withColumn("pv", S.pystrip("prova")).where(F.col("pv") != "")
    j, code = p.join(t, CLASS_KEYS, "inner"), F.col("code")
    unit = S.truncate(F.concat(code, F.lit("-"), F.col("pv")), 200)
    ordem = F.coalesce(S.to_int_via_float("ordem"), F.lit(0)).cast("bigint")
    return j.select(unit.alias("codigoUnidade"),
                    S.truncate(S.label_or_code("pv", K.EXAM_LABELS), 64).alias("nomeUnidade"),
                    S.truncate("cu", 30).alias("codigoCurso"), code.alias("codigoDisciplina"),
                    ordem.alias("ordemExibicao"), unit.alias("codigoAgrupamento"))


def assessment_units_keyed(d: Domain) -> tuple[DataFrame, DataFrame]:
    """W7 on D15: first row per codigoUnidade is inserted, the rest are PK violations."""
    u = load_assessment_units(d)
    return O.keep_first_with_rejects(u, ["codigoUnidade"], ["codigoDisciplina", "ordemExibicao", "nomeUnidade", "codigoCurso"])


# --------------------------------------------------------------------------- D16

def committee(d: Domain, sheet: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Committee courses and members from the committee sheet (see ``committee_with_orphans``)."""
    return committee_with_orphans(d, sheet)[:2]


def committee_with_orphans(d: Domain, sheet: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Committee courses, their members, and the members whose course was not loaded (J6 rejects).

    Courses keyed by code (or by name when the code is blank); coordinator name
    and mailbox are the first non-blank values in sheet order (A14); generated
    codes for code-less courses get 01, 02 ... suffixes (W9).  Every row
    present in the sheet has status 'S' (M8 marks the others 'N').
    """
    sh = d.committee_sheet if sheet is None else sheet
    cols = ["codigoCurso", "nomeCurso", "Coordenador", "emailCoordenador", "nomeMembro", "emailMembro"]
    sh = sh.select("linha", *[S.blank_to_null(c).alias(c) for c in cols]).where(F.col("nomeCurso").isNotNull())
    sh = sh.withColumn("chave", F.coalesce("codigoCurso", "nomeCurso"))
    first = sh.groupBy("chave").agg(
        F.min_by("codigoCurso", "linha").alias("codigoCurso"),
        F.min_by("nomeCurso", "linha").alias("nomeCurso"),
        F.min("linha").alias("pos"))
    coord = A.first_non_blank(sh, ["chave"], "Coordenador", "linha")
    mail = A.first_non_blank(sh, ["chave"], "emailCoordenador", "linha")
    courses = first.join(coord, "chave", "left").join(mail, "chave", "left")
    # code-less courses: initials of the name, suffixed when the base repeats
    initials = F.upper(F.substring(F.array_join(F.transform(F.split(F.col("nomeCurso"), r"(?U)\s+"),
                                                            lambda w: F.substring(w, 1, 1)), ""), 1, 3))
    initials = F.when(initials == "", F.lit("XXX")).otherwise(initials)
    # only code-less courses are ordered inside their base; codes that are given are skipped
    coded = courses.where(F.col("codigoCurso").isNotNull())
    blank = courses.where(F.col("codigoCurso").isNull()).withColumn("base", initials).drop("codigoCurso")
    blank = O.free_codes(blank, coded, "base", F.col("pos"), "codigoCurso")
    courses = coded.unionByName(blank.select(*coded.columns))
    members = (sh.where(F.col("nomeMembro").isNotNull())
               .join(courses.select("chave", F.col("codigoCurso").alias("cc")), "chave", "inner")
               .select(F.col("cc").alias("codigoCurso"), S.truncate("nomeMembro", 100).alias("nomeMembro"),
                       S.truncate("emailMembro", 100).alias("emailMembro"))
               .distinct().withColumn("status", F.lit("S")))
    nome = S.truncate("nomeCurso", 64)
    courses = courses.select(
        "codigoCurso", nome.alias("nomeCurso"),
        F.coalesce(S.truncate("Coordenador", 100), F.lit("")).alias("coordenador"),
        S.truncate("emailCoordenador", 100).alias("emailCoordenador"),
        F.lit("S").alias("status"))
    courses = courses.where(R.is_text_within("codigoCurso", 30) & R.is_text_within("nomeCurso", 64))
    # Members are loaded only when their course exists among the loaded courses
    members, orphans = J.keep_with_parent(members, courses, ["codigoCurso"])
    return courses, members, orphans
