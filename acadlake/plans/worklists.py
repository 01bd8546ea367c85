"""Feeds, validation pipelines and work lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadlake.functions import constants as K
from acadlake.functions import rules as R
from acadlake.functions import scalars as S
from acadlake.operators import aggregates as A
from acadlake.operators import ordering as O
from acadlake.operators import relational as J
from acadlake.plans.products import CLASS_KEYS
from acadlake.views import Domain

SENTINEL_TEACHER = "1"
REQUIRED_TEACHER_FIELDS = ["cpf", "num_func"]
EXAM_TYPES = ["AVF", "AVS", "AVSB"]


def _feed(students: DataFrame) -> DataFrame:
    """Feed rows, constant columns as literals, NULL -> ''."""
    return students.select(
        F.col("aluno").alias("externalEnrollmentId"),
        F.lit(K.FEED_CLASS_SUBJECT_ID).alias("externalClassSubjectId"),
        F.lit(K.FEED_CURRICULUM_ID).alias("externalCurriculumId"),
        F.lit(K.FEED_PERIOD_ID).alias("externalPeriodId"),
        F.lit("").alias("startDate"), F.lit("").alias("endDate"),
        F.lit(K.FEED_ENROLMENT_STATUS_ID).alias("externalEnrollmentClassSubjectStatusId"),
        F.lit("").alias("externalEnrollmentTypeId"),
        F.lit("").alias("ext.info.tags"),
    ).na.fill("")


def enrol_feed(d: Domain) -> DataFrame:
    """Active students of the feed unit (CI status compare)."""
    s = d.student.where(S.ci_equals("sit_aluno", K.ACTIVE_STUDENT_STATUS) & (F.col("unidade_ensino") == K.FEED_UNIT))
    return _feed(s).orderBy("externalEnrollmentId")


def unenrol_feed(d: Domain) -> DataFrame:
    """The complement: status <> 'Ativo' (NULL status is excluded, as in SQL)."""
    s = d.student.where(~S.ci_equals("sit_aluno", K.ACTIVE_STUDENT_STATUS) & (F.col("unidade_ensino") == K.FEED_UNIT))
    return _feed(s).orderBy("externalEnrollmentId")


def teacher_validation(d: Domain) -> DataFrame:
    """Per teacher, the discard reason (sentinel, missing required, bad id) or 'valido',
    the cleaned id, the mailbox (normalised when in the teacher domain) and an invalid-mailbox flag."""
    t = d.teacher
    cpf_digits = S.digits_only("cpf")
    ok_mail, mail_norm = R.teacher_mailbox("mailbox")
    status = (F.when(~J.not_sentinel("num_func", SENTINEL_TEACHER), F.lit("descartado_padrao"))
              .when(~(S.present("cpf") & S.present("num_func", numeric=True)), F.lit("descartado_obrigatorio"))
              .when(F.length(cpf_digits) != 11, F.lit("descartado_cpf"))
              .otherwise(F.lit("valido")))
    return t.select(
        "num_func", status.alias("situacao"),
        F.when(status == "valido", cpf_digits).otherwise(F.col("cpf")).alias("cpf"),
        F.when(ok_mail, mail_norm).otherwise(F.col("mailbox")).alias("email"),
        ((status == "valido") & ~ok_mail & S.present("mailbox")).alias("email_invalido"),
        "ativo", "depto")


def teacher_stats(d: Domain) -> DataFrame:
    """D20 statistics over the valid teachers: totals, active split (A4), key audit (A5)."""
    v = teacher_validation(d).where(F.col("situacao") == "valido")
    has_key = S.present("cpf") & S.present("num_func", numeric=True)
    key = F.when(has_key, F.concat_ws("-", "cpf", F.col("num_func").cast("string")))
    return v.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("ativo") == "S").cast("bigint").alias("ativos"),
                 F.count_if(~(F.col("ativo") == "S") | F.col("ativo").isNull()).cast("bigint").alias("inativos"),
                 F.count_if(has_key).cast("bigint").alias("chaves"),
                 F.count_distinct(key).cast("bigint").alias("chaves_unicas"))


def teacher_departments(d: Domain, n: int = 5) -> DataFrame:
    """D20 top departments of the valid teachers (A2)."""
    v = teacher_validation(d).where(F.col("situacao") == "valido")
    return A.frequency_top(v, "depto", n, name="depto")


def pending_persons(d: Domain) -> DataFrame:
    """Person ids referenced by students or teachers but missing from person (J3 + O5)."""
    st = J.anti_keys(d.student.select("pessoa"), d.person, ["pessoa"])
    te = J.anti_keys(d.teacher.select("pessoa"), d.person, ["pessoa"])
    return O.union_distinct(st, te)


def id_audit(d: Domain) -> DataFrame:
    """D21 audit: persons with an invalid id (V3) and persons sharing an id (A6), long form."""
    p = d.person.select("pessoa", "nome_compl", "cpf")
    clean = F.regexp_replace(F.coalesce(F.col("cpf"), F.lit("")), r"\D", "")
    invalid = p.where(~R.is_national_id_lenient("cpf")).select(
        "pessoa", "nome_compl", F.col("cpf").alias("cpf"), F.lit("invalido").alias("problema"),
        F.lit(None).cast("bigint").alias("tamanho_grupo"))
    valid = p.where(R.is_national_id_lenient("cpf")).withColumn("cpf_limpo", clean)
    dups = A.duplicate_members(valid, "cpf_limpo", ["pessoa", "nome_compl"]).select(
        "pessoa", "nome_compl", F.col("cpf_limpo").alias("cpf"), F.lit("duplicado").alias("problema"),
        F.col("tamanho_grupo").cast("bigint").alias("tamanho_grupo"))
    return invalid.unionByName(dups)


def exam_worklist(d: Domain, units: list | None = None, batch: int = 50) -> DataFrame:
    """Open classes (P7) x exam types (J10, an exploded literal list, not a join),
    numbered in a global order (W2) and cut into fixed-size lots (W10)."""
    t = d.view("class").where(S.ci_equals("sit_turma", "aberta"))
    if units:
        t = t.where(F.col("unidade_responsavel").isin(units))
    t = t.select(*CLASS_KEYS).withColumn("prova", F.explode(F.array(*[F.lit(x) for x in EXAM_TYPES])))
    order = [F.col(c).asc() for c in CLASS_KEYS] + [F.col("prova").asc()]
    numbered = O.sequential_ids(t, order, "seq")
    return O.batch_numbers(numbered, "seq", batch, "lote")


def key_trace(d: Domain, num_func: int = 2) -> DataFrame:
    """For one teacher id, row counts after each stage of the user load."""
    # the joined keys are unique on their side, so one pass with presence marks counts every stage
    td = d.class_teacher.where(F.col("num_func") == num_func)
    t = d.view("class").select("ano", F.col("semestre").alias("periodo"), "turma", "disciplina", "sit_turma", "curso",
                               F.lit(True).alias("__t"))
    c = d.course.select("curso", "faculdade")
    p = d.teacher.select("num_func", "mailbox", F.lit(True).alias("__d"))
    j = td.join(t, ["ano", "periodo", "turma", "disciplina"], "left").join(c, "curso", "left").join(p, "num_func", "left")
    stages = [("1_turma_docente", F.lit(True)), ("2_join_turma", F.col("__t").isNotNull()),
              ("3_turma_aberta", S.ci_equals("sit_turma", K.OPEN_CLASS_STATUS)),
              ("4_faculdade", J.unassigned_or_allowed("curso", "faculdade", K.INCLUDED_FACULTIES)),
              ("5_join_docente", F.col("__d").isNotNull()), ("6_email_valido", R.is_email("mailbox"))]
    reached, counts = F.lit(True), []
    for i, (_, passes) in enumerate(stages):
        reached = reached & F.coalesce(passes, F.lit(False))
        counts.append(F.count_if(reached).cast("bigint").alias(f"s{i}"))
    stack = ", ".join(f"'{name}', s{i}" for i, (name, _) in enumerate(stages))
    return j.agg(*counts).selectExpr(f"stack({len(stages)}, {stack}) AS (etapa, linhas)")


def syllabus_text(d: Domain) -> DataFrame:
    """One cleaned document per row plus a safe file name (whole texts)."""
    return d.documents.select(
        "doc_id",
        S.safe_file_name(F.concat(F.col("source"), F.lit(":"), F.col("lang"), F.lit("/"),
                                  F.col("doc_id").cast("string"), F.lit(".pdf"))).alias("arquivo"),
        S.document_text("text").alias("texto"))


def subject_first_course(d: Domain) -> DataFrame:
    """First related course of each subject (the source query had no order; ours is the
    smallest course code), with the course name - a left join to a per-key minimum."""
    g = d.grid.select("disciplina", "curso").join(d.course.select("curso", "nome"), "curso", "inner")
    return g.groupBy("disciplina").agg(F.min("curso").alias("curso"), F.min_by("nome", "curso").alias("nome_curso"))
