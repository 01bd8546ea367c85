"""Domain tables of the academic mirror, derived from the driver tables.

The driver ships TPC-H-like tables; the products of this package read the
mirror tables of an academic ERP (students, persons, courses, classes,
enrolments, teachers, grids, exams ...).  Each domain table is one SQL text
with ``{table}`` placeholders.  Spark binds the placeholders to DataFrames
(``spark.sql(text, customer=df)``), the DuckDB oracle renders them as CTE
names, so both engines read identical inputs.  The texts inject NULLs,
blanks, mixed case, orphans and duplicates that the raw tables lack.

Every table keeps all rows of its source: subsets (orphans, coordinators,
grid lines) are expressed with CASE / GROUP BY, never by filtering rows away.
Integer columns are cast to BIGINT so both engines agree on types.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from acadlake.functions import constants as K
from acadlake.session import source_state

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Ordered: a view may read the views defined above it.
VIEW_SQL: dict[str, str] = {}

VIEW_SQL["student"] = """
SELECT CAST(c_custkey AS STRING) AS aluno,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey END AS pessoa,
  CASE WHEN c_custkey % 7 = 0 THEN '  ' || c_name || ' ' WHEN c_custkey % 11 = 0 THEN 'NULL' ELSE c_name END AS nome_compl,
  CASE WHEN c_custkey % 5 = 0 THEN c_name || ' S' END AS nome_social,
  lpad(CAST(c_nationkey AS STRING), 3, '0') AS curso,
  CAST(2020 + c_custkey % 5 AS STRING) AS curriculo,
  CAST(1 + c_custkey % 10 AS BIGINT) AS serie,
  CASE WHEN c_custkey % 4 = 0 THEN 'Trancado' WHEN c_custkey % 4 = 1 THEN 'ATIVO' ELSE 'Ativo' END AS sit_aluno,
  CASE WHEN c_custkey % 3 = 0 THEN '002' WHEN c_custkey % 10 = 1 THEN '007' ELSE '001' END AS unidade_ensino,
  CASE WHEN c_custkey % 6 = 0 THEN 'Manhã' WHEN c_custkey % 6 = 1 THEN 'noite' WHEN c_custkey % 6 = 2 THEN 'INT'
       WHEN c_custkey % 6 = 3 THEN 'EAD' WHEN c_custkey % 6 = 4 THEN '' END AS turno,
  CAST(2020 + c_custkey % 7 AS BIGINT) AS ano_ingresso,
  CAST(1 + c_custkey % 2 AS BIGINT) AS sem_ingresso,
  CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN '2021-13-40'
       ELSE CAST(2020 + c_custkey % 7 AS STRING) || '-' || CAST(1 + c_custkey % 12 AS STRING) || '-' || CAST(1 + c_custkey % 28 AS STRING) END AS dt_ingresso,
  CASE WHEN c_custkey % 9 = 0 THEN 1600000000 + c_custkey * 86400 ELSE 1600000000000 + c_custkey * 86400000 END AS stamp_atualizacao,
  CASE WHEN c_custkey % 2 = 0 THEN 'Campus Norte' ELSE 'Campus Sul' END AS unidade_fisica,
  c_mktsegment AS tipo_ingresso,
  CASE WHEN c_custkey % 3 = 0 THEN 's' WHEN c_custkey % 3 = 1 THEN 'N' ELSE 'x' END AS representante_turma
FROM {customer}
"""

VIEW_SQL["person"] = """
SELECT CASE WHEN c_custkey % 13 = 0 THEN c_custkey + 1000000000 ELSE c_custkey END AS pessoa,
  c_name AS nome_compl,
  CASE WHEN c_custkey % 6 = 0 THEN 'Social ' || c_name END AS nome_social,
  CASE WHEN c_custkey % 19 = 0 THEN '00000000000' WHEN c_custkey % 23 = 0 THEN '111.111.111-11'
       ELSE lpad(CAST((c_custkey % 500) * 7919 + 10000000 AS STRING), 11, '0') END AS cpf,
  CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN 'no-at.example'
       WHEN c_custkey % 9 = 2 THEN ' A' || CAST(c_custkey AS STRING) || '@X.EDU.BR '
       ELSE 'u' || CAST(c_custkey AS STRING) || '@x.edu.br' END AS e_mail,
  CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '(24) 9' || lpad(CAST(c_custkey % 100000000 AS STRING), 8, '0')
       ELSE CAST(100000000 + c_custkey AS STRING) END AS fone,
  CASE WHEN c_custkey % 10 = 3 THEN CAST(1000000 + c_custkey AS STRING)
       ELSE lpad(CAST(27000000 + c_custkey AS STRING), 8, '0') END AS cep,
  CASE WHEN c_custkey % 5 = 0 THEN 'c' || CAST(c_custkey AS STRING) || '@mail.com' END AS e_mail_com,
  'i' || CAST(c_custkey AS STRING) || '@STUDENT_DOMAIN@' AS e_mail_interno,
  '24' AS ddd_fone,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '21' END AS ddd_fone_celular,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '9' || lpad(CAST(c_custkey % 100000000 AS STRING), 8, '0') END AS celular
FROM {customer}
"""

VIEW_SQL["course"] = """
SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS curso,
  n_name AS nome,
  'Bacharelado em ' || n_name AS titulo,
  CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'Portaria ' || CAST(100 + n_nationkey AS STRING) END AS decreto,
  CASE WHEN n_regionkey % 2 = 0 THEN 'Presencial' ELSE 'EAD' END AS tipo,
  CASE WHEN n_nationkey % 3 = 0 THEN '002' ELSE '001' END AS faculdade,
  CASE WHEN n_nationkey % 8 = 0 THEN 'N' ELSE 'S' END AS ativo,
  CASE WHEN n_nationkey < 20 THEN lpad(CAST(n_nationkey % 10 AS STRING), 3, '0') END AS curso_unificado
FROM {nation}
"""

VIEW_SQL["enrol"] = """
SELECT CAST(o_custkey AS STRING) AS aluno,
  CAST(year(o_orderdate) AS BIGINT) AS ano,
  CAST(CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS BIGINT) AS semestre,
  CASE WHEN l_linenumber % 4 = 0 THEN 'T0' WHEN l_linenumber % 4 = 1 THEN 'T2' WHEN l_linenumber % 4 = 2 THEN 'T3' ELSE 'E' END
    || CAST(l_suppkey % 3 AS STRING) AS turma,
  'D' || lpad(CAST(CAST((l_partkey - l_partkey % 10) / 10 AS BIGINT) AS STRING), 9, '0') AS disciplina,
  CASE WHEN l_linestatus = 'O' THEN 'Matriculado' ELSE 'Cancelado' END AS sit_matricula,
  l_suppkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

VIEW_SQL["class"] = """
SELECT ano, semestre, turma, disciplina,
  CASE WHEN min(l_suppkey) % 6 = 0 THEN NULL ELSE lpad(CAST(min(l_suppkey) % 25 AS STRING), 3, '0') END AS curso,
  CASE WHEN min(l_suppkey) % 3 = 0 THEN 'Fechada' WHEN min(l_suppkey) % 3 = 1 THEN 'aberta' ELSE 'Aberta' END AS sit_turma,
  CASE WHEN max(l_suppkey) % 2 = 0 THEN '001' ELSE '002' END AS unidade_responsavel,
  CASE WHEN max(l_suppkey) % 4 = 0 THEN 'Tarde' WHEN max(l_suppkey) % 4 = 1 THEN 'X' WHEN max(l_suppkey) % 4 = 2 THEN 'N' END AS turno
FROM {enrol} GROUP BY ano, semestre, turma, disciplina
"""

VIEW_SQL["curriculum"] = """
SELECT curso, curriculo,
  CASE WHEN (CAST(curso AS BIGINT) + CAST(curriculo AS BIGINT)) % 4 = 0 THEN NULL
       ELSE (CAST(curso AS BIGINT) + CAST(curriculo AS BIGINT)) % 11 END AS prazo_ideal,
  CASE WHEN CAST(curriculo AS BIGINT) % 2 = 0 THEN 'Semestral' ELSE 'Anual' END AS regime,
  CASE WHEN CAST(curso AS BIGINT) % 4 = 0 THEN NULL WHEN CAST(curso AS BIGINT) % 4 = 1 THEN 'N' ELSE 'M' END AS turno
FROM (SELECT DISTINCT curso, curriculo FROM {student}) s
"""

VIEW_SQL["subject"] = """
SELECT DISTINCT 'D' || lpad(CAST(n AS STRING), 9, '0') AS disciplina,
  'Subject ' || CAST(n AS STRING) AS nome,
  CASE WHEN n % 11 = 0 THEN NULL WHEN n % 11 = 1 THEN '   '
       ELSE '  Disciplina ' || CAST(n AS STRING) || ' completa ' END AS nome_compl,
  CASE WHEN n % 5 = 0 THEN '002' ELSE '001' END AS faculdade,
  CASE WHEN n % 7 = 0 THEN NULL WHEN n % 7 = 1 THEN '' WHEN n % 7 = 2 THEN 'Outra' ELSE 'Optativa' END AS area_conhecimento,
  CASE WHEN n % 9 = 0 THEN 'N' ELSE 'S' END AS ativo
FROM (SELECT CAST((p_partkey - p_partkey % 10) / 10 AS BIGINT) AS n FROM {part}) p
"""

VIEW_SQL["teacher"] = """
SELECT s_suppkey AS num_func,
  CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 10 = 1 THEN 'bad mail@x'
       ELSE 'T' || CAST(s_suppkey AS STRING) || '@TEACHER_DOMAIN_MIXED@' END AS mailbox,
  s_name AS nome_compl,
  CASE WHEN s_suppkey % 6 = 0 THEN 'Prof ' || s_name END AS nome_social,
  CASE WHEN s_suppkey % 12 = 0 THEN NULL WHEN s_suppkey % 12 = 5 THEN '123.456.789-0' WHEN s_suppkey % 12 = 7 THEN ''
       ELSE lpad(CAST(s_suppkey * 7907 AS STRING), 11, '0') END AS cpf,
  s_suppkey + 500000 AS pessoa,
  CASE WHEN s_suppkey % 4 = 0 THEN 'N' ELSE 'S' END AS ativo,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'DEP' || CAST(s_nationkey % 6 AS STRING) END AS depto
FROM {supplier}
"""

VIEW_SQL["class_teacher"] = """
SELECT min(l_orderkey * 8 + l_linenumber) AS chave, ano, semestre AS periodo, turma, disciplina, l_suppkey AS num_func
FROM {enrol} GROUP BY ano, semestre, turma, disciplina, l_suppkey
"""

VIEW_SQL["grid"] = """
SELECT disciplina, curso,
  CAST(2020 + (CAST(substr(disciplina, 2) AS BIGINT) + CAST(curso AS BIGINT)) % 3 AS STRING) AS curriculo,
  CASE WHEN (CAST(substr(disciplina, 2) AS BIGINT) + CAST(curso AS BIGINT)) % 9 = 8 THEN NULL
       ELSE (CAST(substr(disciplina, 2) AS BIGINT) + CAST(curso AS BIGINT)) % 9 END AS serie_ideal,
  CASE WHEN (CAST(substr(disciplina, 2) AS BIGINT) + CAST(curso AS BIGINT)) % 2 = 0 THEN 'S' ELSE 'N' END AS obrigatoria
FROM (SELECT DISTINCT disciplina, curso FROM {class} WHERE curso IS NOT NULL) c
"""

VIEW_SQL["coordination"] = """
SELECT CAST(min(l_suppkey) AS STRING) AS num_func, lpad(CAST(l_suppkey % 25 AS STRING), 3, '0') AS curso, 'Titular' AS tipo_coord
FROM {enrol} GROUP BY lpad(CAST(l_suppkey % 25 AS STRING), 3, '0')
UNION ALL
SELECT CAST(max(l_suppkey) AS STRING) AS num_func, lpad(CAST(l_suppkey % 25 AS STRING), 3, '0') AS curso, 'Adjunto' AS tipo_coord
FROM {enrol} GROUP BY lpad(CAST(l_suppkey % 25 AS STRING), 3, '0')
"""

VIEW_SQL["exam"] = """
SELECT ano, semestre, turma, disciplina, 'AVF' AS prova, 'Prova AVF' AS nome, CAST(0 AS BIGINT) AS ordem, curso FROM {class}
UNION ALL
SELECT ano, semestre, turma, disciplina, 'AVS' AS prova, 'Prova AVS' AS nome, CAST(1 AS BIGINT) AS ordem, curso FROM {class}
UNION ALL
SELECT ano, semestre, turma, disciplina, 'ZZ' AS prova, 'Prova ZZ' AS nome, CAST(2 AS BIGINT) AS ordem, curso FROM {class}
"""

VIEW_SQL["formula"] = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 10 = 0 THEN '' WHEN o_orderkey % 10 = 1 THEN '(1)A, x, (1)B'
       ELSE '(' || CAST(1 + o_custkey % 2 AS STRING) || ')M' || CAST(o_custkey % 50 AS STRING) || ', (1)N'
            || CAST(o_orderkey % 9 AS STRING) || ',(2)P' END AS formula
FROM {orders}
"""

# Committee sheet (all text): one line per member, course from the member's nation; some courses have no code,
# some codes are what would be generated for others.
VIEW_SQL["committee_sheet"] = """
SELECT s_suppkey AS linha,
  CASE WHEN n_nationkey % 4 = 3 THEN NULL WHEN n_nationkey IN (9, 10) THEN ' ' WHEN n_nationkey = 2 THEN 'N'
       WHEN n_nationkey = 12 THEN 'N02' ELSE lpad(CAST(n_nationkey AS STRING), 3, '0') END AS codigoCurso,
  n_name AS nomeCurso,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Coord ' || n_name END AS Coordenador,
  CASE WHEN s_suppkey % 4 = 0 THEN '' WHEN s_suppkey % 4 = 1 THEN NULL
       ELSE 'coord' || CAST(n_nationkey AS STRING) || '@TEACHER_DOMAIN@' END AS emailCoordenador,
  s_name AS nomeMembro,
  CASE WHEN s_suppkey % 10 = 3 THEN NULL ELSE 'M' || CAST(s_suppkey AS STRING) || '@TEACHER_DOMAIN_MIXED@' END AS emailMembro
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

# Institution names typed by hand: year suffixes, case and spacing variants.
VIEW_SQL["institution"] = """
SELECT p_partkey AS linha,
  CASE WHEN p_partkey % 6 = 0 THEN p_brand || ' ' || p_type || ' - ' || CAST(2015 + p_partkey % 9 AS STRING)
       WHEN p_partkey % 6 = 1 THEN upper(p_brand || ' ' || p_type) || ' ' || CAST(2018 + p_partkey % 5 AS STRING)
       WHEN p_partkey % 6 = 2 THEN p_brand || ' ' || p_type || 'S'
       WHEN p_partkey % 6 = 3 THEN replace(p_brand || '  ' || p_type, 'E', 'e')
       WHEN p_partkey % 6 = 4 THEN p_name
       ELSE p_type || ' ' || p_brand END AS nome_instituicao
FROM {part}
"""

# fixture mailboxes use the configured domains (mixed case where lower-casing is exercised)
_DOMAINS = {"@STUDENT_DOMAIN@": "@" + K.STUDENT_DOMAIN_DEFAULT.lstrip("@"), "@TEACHER_DOMAIN@": "@" + K.TEACHER_DOMAIN,
            "@TEACHER_DOMAIN_MIXED@": "@" + K.TEACHER_DOMAIN.capitalize()}
for _name, _text in VIEW_SQL.items():
    for _k, _v in _DOMAINS.items():
        _text = _text.replace(_k, _v)
    VIEW_SQL[_name] = _text

VIEWS = tuple(VIEW_SQL)


def _placeholders() -> dict[str, str]:
    return {name: name for name in RAW_TABLES + VIEWS}


def render_for_duckdb(text: str) -> str:
    """Render a ``{table}`` template with plain names (CTEs / driver views)."""
    return text.format(**_placeholders())


def oracle_cte(query: str) -> str:
    """Prefix an oracle query with every domain view as a CTE (unused ones cost nothing)."""
    ctes = ",\n".join(f"{name} AS ({render_for_duckdb(sql)})" for name, sql in VIEW_SQL.items())
    return f"WITH {ctes}\n{query}"


@dataclass
class Domain:
    """Raw and domain DataFrames for one data directory (lazily planned)."""

    spark: SparkSession
    sf_dir: str
    stored_mirrors: bool = True      # class-keyed mirrors stored bucketed (acadlake.sources.mirror)
    _frames: dict = field(default_factory=dict)

    def raw(self, name: str) -> DataFrame:
        key = ("raw", name)
        if key not in self._frames:
            self._frames[key] = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        return self._frames[key]

    def view(self, name: str) -> DataFrame:
        key = ("view", name)
        if key not in self._frames:
            text = VIEW_SQL[name]
            deps = {}
            for dep in RAW_TABLES:
                if "{" + dep + "}" in text:
                    deps[dep] = self.raw(dep)
            for dep in VIEWS:
                if "{" + dep + "}" in text:
                    deps[dep] = self.view(dep)
            df = self.spark.sql(text, **deps)
            from acadlake.sources import mirror
            if self.stored_mirrors and name in mirror.LAYOUT:
                df = mirror.store(self.spark, name, df, source_state(self.spark, self.sf_dir, *RAW_TABLES))
            self._frames[key] = df
        return self._frames[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in VIEW_SQL:
            return self.view(name)
        if name in RAW_TABLES:
            return self.raw(name)
        raise AttributeError(name)


_lock = threading.Lock()
_domains: dict[tuple, Domain] = {}


def domain(spark: SparkSession, sf_dir: str) -> Domain:
    # a changed input file, another application or checkpoint folder gets frames of its own
    key = source_state(spark, sf_dir, *RAW_TABLES)
    with _lock:
        if key not in _domains:
            _domains[key] = Domain(spark, sf_dir)
        return _domains[key]
