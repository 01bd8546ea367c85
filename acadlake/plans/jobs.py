"""End-to-end mirror refresh (the studied system's main flow, one table):
landing pages -> declared read (S1/S8) -> normalise (F1) -> required split (P1)
-> full refresh (M4/M5) -> profile (A1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.functions import scalars as S
from acadlake.operators import aggregates as A
from acadlake.operators import maintenance as M
from acadlake.plans.products import CLASS_KEYS
from acadlake.session import scratch_path
from acadlake.sources import landing as L
from acadlake.views import Domain

CLASS_API = T.StructType([
    T.StructField("ano", T.LongType()), T.StructField("semestre", T.LongType()),
    T.StructField("turma", T.StringType()), T.StructField("disciplina", T.StringType()),
    T.StructField("curso", T.StringType()), T.StructField("sit_turma", T.StringType()),
    T.StructField("unidade_responsavel", T.StringType()), T.StructField("turno", T.StringType())])
CLASS_REQUIRED = ["ano", "semestre", "turma", "disciplina"]


def landed_classes(d: Domain, page_size: int = 500) -> DataFrame:
    """The class extract as landed and read back, normalised."""
    spark = d.spark
    root = scratch_path(spark, "class-landing")
    api = d.view("class").select(*[f.name for f in CLASS_API.fields])
    L.land_pages(api, root, [F.col(c).asc() for c in CLASS_KEYS], page_size)
    return S.normalize_frame(L.read_pages(spark, root, CLASS_API).drop(L.PAGE_COL))


def publish_classes(d: Domain) -> tuple[DataFrame, dict]:
    """The class mirror as a versioned table: one job writes valid rows and rejects and counts them, and the version is
    published with these counts; returns the table as readers see it, and the counts."""
    mirror = M.VersionedTable(d.spark, scratch_path(d.spark, "class-mirror"))
    stats = mirror.refresh(landed_classes(d), CLASS_REQUIRED, numeric=("ano", "semestre"), empty_policy="keep")
    return mirror.read(), stats


def class_profile(state: DataFrame) -> DataFrame:
    return A.profile(state, ["turma", "disciplina"], {"abertas": S.ci_equals("sit_turma", "aberta")}, "ano")


STUDENT_ROLES = {"integer": ("serie", "ano_ingresso", "sem_ingresso"), "flag": ("representante_turma",),
                 "stamp": ("stamp_atualizacao",)}
STUDENT_COLS = ["aluno", "nome_compl", "sit_aluno", "serie", "representante_turma", "stamp_atualizacao"]


def student_extract(d: Domain) -> DataFrame:
    """The student extract typed by column role."""
    return S.normalize_by_roles(d.student.select(*STUDENT_COLS), **STUDENT_ROLES)


def sync_students(d: Domain, last_intake_year: int = 2025) -> tuple[DataFrame, dict]:
    """Student mirror sync: the stored mirror holds the students known up to an intake year;
    the new extract (every student, typed by role) is filtered to active ones (CI compare),
    upserted (M1), and keys no longer active are removed under the 50% guard (M6)."""
    stored = S.normalize_by_roles(
        d.student.where(F.col("ano_ingresso") <= last_intake_year).select(*STUDENT_COLS), **STUDENT_ROLES)
    active = student_extract(d).where(S.ci_equals("sit_aluno", "Ativo"))
    merged = M.upsert(stored, active, ["aluno"])
    return M.guarded_delete(merged, active.select("aluno"), ["aluno"])
