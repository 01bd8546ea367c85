"""The ten produced load tables, each computed once per application and state of the source.

Checks, exports and deactivations read the stored products; a product is cut to Parquet in the
shared checkpoint folder when it is first asked for.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from acadlake.operators.pairs import Pairs
from acadlake.plans import products as P
from acadlake.plans.catalog_products import ORACLES as PRODUCT_ORACLES
from acadlake.session import cut_lineage
from acadlake.views import Domain

# (contract, product query, builder)
PRODUCED = [
    ("imp_001_cursos", "load_courses", P.load_courses),
    ("imp_002_disciplina", "load_subjects", P.load_subjects),
    ("imp_005_ofertas", "load_offerings", P.load_offerings),
    ("imp_006_usuarios", "load_users", P.load_users),
    ("imp_007_usuarios_cursos", "load_users_courses", P.load_users_courses),
    ("imp_008_usuarios_disciplinas", "load_users_subjects", P.load_users_subjects),
    ("imp_009_professores_ofertas", "load_teacher_offerings", P.load_teacher_offerings),
    ("imp_010_alunos", "load_students", P.load_students),
    ("imp_011_alunos_ofertas", "load_student_offerings", P.load_student_offerings),
    ("imp_013_unidades_avaliacao", "load_assessment_units", P.load_assessment_units),
]
BUILDERS = {table: fn for table, _, fn in PRODUCED}
PAIRED = {"imp_008_usuarios_disciplinas": P.users_subjects}
STUDENTS, OFFERINGS = "imp_010_alunos", "imp_011_alunos_ofertas"      # the students are built from the stored offerings
AT_ONCE = 3


def produced_form(d: Domain, table: str) -> DataFrame | Pairs:
    """The stored product of a contract; one of pairs is stored as its sides, since its rows are their products."""
    key = ("product", table)
    if key not in d._frames:
        if table in PAIRED:
            d._frames[key] = PAIRED[table](d, keep=lambda df, part: cut_lineage(df, f"product-{table}-{part}"))
        else:
            read = {"offerings": produced_form(d, OFFERINGS)} if table == STUDENTS else {}
            d._frames[key] = cut_lineage(BUILDERS[table](d, **read), f"product-{table}")
    return d._frames[key]


def produced_forms(d: Domain) -> dict[str, DataFrame | Pairs]:
    """The stored products of all contracts; missing ones are built a few at once, so that one's short jobs and last tasks
    leave no core idle.  The students come last, since they read another product."""
    build = inheritable_thread_target(d.spark)(lambda t: produced_form(d, t))
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(build, [t for t in BUILDERS if t != STUDENTS]))
    return {t: produced_form(d, t) for t in BUILDERS}


def produced(d: Domain, table: str) -> DataFrame:
    """The rows of the stored product of a contract."""
    form = produced_form(d, table)
    return form.rows() if isinstance(form, Pairs) else form


def product_ctes() -> list[str]:
    """Oracle CTEs p0 .. p9 with the products in the order of ``PRODUCED``."""
    return [f"p{i} AS ({PRODUCT_ORACLES[name]})" for i, (_, name, _) in enumerate(PRODUCED)]


def union(frames) -> DataFrame:
    out = None
    for df in frames:
        out = df if out is None else out.unionByName(df)
    return out
