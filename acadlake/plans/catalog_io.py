"""Registered source / sink / streaming queries.

Each query writes its input to a fresh folder under the session's shared
checkpoint directory (``spark.checkpoint.dir``), runs the operator and
returns what Spark reads back, so the oracle compares the round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.functions import constants as K
from acadlake.operators import contracts as C
from acadlake.plans import products as P
from acadlake.plans import worklists as WL
from acadlake.plans.catalog_products import ORACLES as PRODUCT_ORACLES
from acadlake.plans.load_tables import PRODUCED, product_ctes, produced_forms
from acadlake.plans.oracle_sql import q, strip, with_views
from acadlake.session import scratch_path, source_state
from acadlake.sources import landing as L
from acadlake.sources import sinks as KS
from acadlake.streaming.paged import PagedLoad
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


PAGE_SIZE = 100

# records as the API ships them: camelCase, an optional preferred type, extra fields
API_EVENT = T.StructType([
    T.StructField("eventId", T.LongType()), T.StructField("userId", T.LongType()),
    T.StructField("eventType", T.StringType()), T.StructField("tipoPref", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("ts", T.StringType()),
    T.StructField("canal", T.StringType())])
RENAMES = {"eventId": "event_id", "userId": "user_id", "value": "valor", "ts": "momento"}


def _api_events(d):
    e = d.events
    return e.select(F.col("event_id").alias("eventId"), F.col("user_id").alias("userId"),
                    F.col("event_type").alias("eventType"),
                    F.when(F.col("event_id") % 7 == 0, F.upper("event_type")).alias("tipoPref"),
                    F.col("value"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.col("props"))


_LANDED: dict = {}


def _land(spark, d):
    """Stage the events extract as landing pages once per application and state of the source
    (it stands for the API extract; loads never modify it).  A page behind the end, with a key
    that no event has, lands first."""
    key = source_state(spark, d.sf_dir, "events")
    if key not in _LANDED:
        root = scratch_path(spark, "landing")
        L.land_pages(_api_events(d), root, [F.col("eventId").asc()], PAGE_SIZE, bare_every=5,
                     stray_after_end={"eventId": 1 << 40, "eventType": "click"})
        _LANDED[key] = root
    return _LANDED[key]


_EVENTS_ORACLE = """SELECT event_id, user_id, CASE WHEN event_id % 7 = 0 THEN upper(event_type) ELSE event_type END AS event_type,
  value AS valor, strftime(ts, '%Y-%m-%d %H:%M:%S') AS momento, CAST(NULL AS VARCHAR) AS canal FROM events"""


@register("paged_landing", with_views(_EVENTS_ORACLE))
def q_paged_landing(spark, sf):
    d = domain(spark, sf)
    root = _land(spark, d)
    rows = L.read_pages(spark, root, API_EVENT)          # declared schema: 'props' dropped, 'canal' NULL (S8)
    rows = L.rename_fields(rows, RENAMES, fallbacks={"event_type": ["tipoPref", "eventType"]})   # S9
    return rows.select("event_id", "user_id", "event_type", "valor", "momento", "canal")


@register("paged_source_scan", with_views(_EVENTS_ORACLE))
def q_paged_source_scan(spark, sf):
    """S1 through the ``paged`` data source."""
    rows = L.read_source_pages(spark, _land(spark, domain(spark, sf)), API_EVENT)
    rows = L.rename_fields(rows, RENAMES, fallbacks={"event_type": ["tipoPref", "eventType"]})
    return rows.select("event_id", "user_id", "event_type", "valor", "momento", "canal")


SHEET_NAMES = ["codigoCurso", "nomeCurso", "Coordenador", "emailCoordenador", "nomeMembro", "emailMembro"]


@register("sheet_ingest", with_views(
    "SELECT " + ", ".join(f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END AS {c}" for c in SHEET_NAMES) + " FROM committee_sheet"))
def q_sheet_ingest(spark, sf):
    d = domain(spark, sf)
    path = scratch_path(spark, "sheet")
    sheet = d.committee_sheet.select(*[F.col(c).alias(f"Coluna {i + 1}") for i, c in enumerate(SHEET_NAMES)])
    sheet.write.mode("overwrite").option("header", True).csv(path)
    return L.read_sheet(spark, path, SHEET_NAMES)


_BY_PERIOD: dict = {}


def enrol_by_period(spark, sf):
    """Enrolments by period folder, sorted by student, with Bloom filters on the student: stored once per application."""
    d = domain(spark, sf)
    key = source_state(spark, d.sf_dir, "orders", "lineitem")
    if key not in _BY_PERIOD:
        path = scratch_path(spark, "enrol_by_period")
        L.write_partitioned(d.enrol, path, ["ano", "semestre"], ["aluno"])
        _BY_PERIOD[key] = path
    return L.pruned_scan(spark, _BY_PERIOD[key], d.enrol.schema)


@register("pruned_scan", with_views("SELECT * FROM enrol WHERE ano = 1998 AND semestre = 2"))
def q_pruned_scan(spark, sf):
    d = domain(spark, sf)
    return enrol_by_period(spark, sf).where((F.col("ano") == 1998) & (F.col("semestre") == 2)).select(*d.enrol.columns)


_ENROL_KEYED = "aluno, ano, semestre, turma, disciplina, sit_matricula"


@register("keyed_lookup", with_views(f"""SELECT {_ENROL_KEYED} FROM enrol
WHERE aluno IN (SELECT aluno FROM (SELECT DISTINCT aluno FROM enrol) ORDER BY aluno LIMIT 5)"""))
def q_keyed_lookup(spark, sf):
    """S3: a few students' rows, found through row group ranges and Bloom filters."""
    e = enrol_by_period(spark, sf)
    keys = e.select("aluno").distinct().orderBy("aluno").limit(5)
    return L.keyed_lookup(e, keys, ["aluno"]).select(*_ENROL_KEYED.split(", "))


@register("period_lookup", with_views(f"""SELECT {_ENROL_KEYED} FROM enrol
WHERE (ano, semestre) IN (SELECT (ano, semestre) FROM class WHERE unidade_responsavel = '001' AND ano >= 1998)"""))
def q_period_lookup(spark, sf):
    """The periods come from a key table; only their folders are read."""
    held = domain(spark, sf).view("class")
    keys = held.where((F.col("unidade_responsavel") == "001") & (F.col("ano") >= 1998)).select("ano", "semestre")
    return L.keyed_lookup(enrol_by_period(spark, sf), keys, ["ano", "semestre"]).select(*_ENROL_KEYED.split(", "))


@register("keyed_scan", with_views("""
SELECT aluno, ano, semestre, turma, disciplina, sit_matricula FROM enrol
WHERE aluno IN (SELECT aluno FROM student WHERE unidade_ensino = '007')"""))
def q_keyed_scan(spark, sf):
    d = domain(spark, sf)
    keys = d.student.where(F.col("unidade_ensino") == K.TECH_UNIT).select("aluno")
    e = d.enrol.select("aluno", "ano", "semestre", "turma", "disciplina", "sit_matricula")
    return L.keyed_scan(e, keys, ["aluno"], order=["aluno", "ano", "semestre", "turma", "disciplina"])


@register("active_scan", with_views("SELECT * FROM course WHERE ativo = 'S'"))
def q_active_scan(spark, sf):
    return L.active_scan(domain(spark, sf).course)


@register("key_set", with_views("SELECT DISTINCT aluno FROM enrol"))
def q_key_set(spark, sf):
    return L.key_set(domain(spark, sf).enrol, "aluno")


# --------------------------------------------------------------------------- sinks

_FEED_ROWS = f"""SELECT aluno || ';' || {q(K.FEED_CLASS_SUBJECT_ID)} || ';' || {q(K.FEED_CURRICULUM_ID)} || ';' || {q(K.FEED_PERIOD_ID)}
  || ';;;' || {q(K.FEED_ENROLMENT_STATUS_ID)} || ';;' AS linha FROM student WHERE unidade_ensino = '002' AND lower(sit_aluno) = 'ativo'"""


@register("csv_feed", with_views(
    f"SELECT 1 AS n, {q(';'.join(K.FEED_COLUMNS))} AS linha UNION ALL "
    f"SELECT 1 + row_number() OVER (ORDER BY split_part(linha, ';', {K.FEED_COLUMNS.index('externalEnrollmentId') + 1}), linha), linha "
    f"FROM ({_FEED_ROWS}) x"))
def q_csv_feed(spark, sf):
    path = scratch_path(spark, "feed_csv")
    KS.write_csv_feed(WL.enrol_feed(domain(spark, sf)), path, K.FEED_COLUMNS, order=["externalEnrollmentId"])
    return KS.read_document(spark, path)


REPORT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                              ["matricula", "nome", "cpf", "email", "curso_nome", "situacao"]])


@register("xml_export", with_views("""
SELECT a.aluno AS matricula, a.nome_compl AS nome, p.cpf, p.e_mail AS email, c.nome AS curso_nome, a.sit_aluno AS situacao
FROM student a LEFT JOIN person p ON a.pessoa = p.pessoa LEFT JOIN course c ON a.curso = c.curso"""))
def q_xml_export(spark, sf):
    path = scratch_path(spark, "report_xml")
    KS.write_xml(P.student_report(domain(spark, sf)), path, "dados", "aluno")
    return KS.read_xml(spark, path, REPORT_SCHEMA, "aluno")


HTML_COLS = [("cod_aluno", "Matrícula"), ("nome_aluno", "Nome"), ("e_mail", "E-mail"), ("celular", "Celular"),
             ("sit_matricula", "Situação")]


def _esc(x: str) -> str:
    return f"replace(replace(replace(replace(coalesce(CAST({x} AS VARCHAR), ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


_HEAD = "".join(f"<th>{label}</th>" for _, label in HTML_COLS)


@register("html_report", with_views(f"""
SELECT row_number() OVER (ORDER BY k, g NULLS FIRST, p NULLS FIRST, nome NULLS FIRST, cod NULLS FIRST, linha) AS n, linha FROM (
SELECT 0 AS k, NULL AS g, NULL AS p, NULL AS nome, NULL AS cod,
  '<html><head><meta charset="utf-8"><title>Relatório de Contatos</title></head><body><h1>Relatório de Contatos</h1>' AS linha
UNION ALL SELECT 2, NULL, NULL, NULL, NULL, '</body></html>'
UNION ALL SELECT 1, g, 0, NULL, NULL, '<h2>' || {_esc('g')} || ' (' || CAST(count(*) AS VARCHAR) || ')</h2><table><tr>{_HEAD}</tr>' FROM cr GROUP BY g
UNION ALL SELECT 1, g, 2, NULL, NULL, '</table>' FROM cr GROUP BY g
UNION ALL SELECT 1, g, 1, CAST(nome_aluno AS VARCHAR), CAST(cod_aluno AS VARCHAR),
  '<tr>' || {' || '.join("'<td>' || " + _esc(c) + " || '</td>'" for c, _ in HTML_COLS)} || '</tr>' FROM cr) x""",
    f"cr AS (SELECT *, coalesce(nome_curso, '') AS g FROM {'(' + PRODUCT_ORACLES['contact_report'] + ')'} x)"))
def q_html_report(spark, sf):
    path = scratch_path(spark, "report_html")
    rows = P.contact_report(domain(spark, sf))
    KS.write_lines(KS.html_report_lines(rows, "nome_curso", HTML_COLS, ["nome_aluno", "cod_aluno"]), path)
    return KS.read_document(spark, path)


def _sheet_sql(table: str, alias: str) -> str:
    c = C.CONTRACTS[table]
    pre = [f"Tipo de Carga:;{c.load_type}", f"Escopo da Carga:;{c.scope}", "Limite do Escopo:;",
           f"Conteúdo da Carga:;{c.sheet}", "", ";".join(c.columns)]
    head = " UNION ALL ".join(f"SELECT {q(table)} AS tabela, {n} AS k, {q(x)} AS linha" for n, x in enumerate(pre))
    body = " || ';' || ".join(f"coalesce(CAST(\"{col}\" AS VARCHAR), '')" for col in c.columns)
    return f"{head} UNION ALL SELECT {q(table)}, 6, {body} FROM {alias}"


def _numbered(parts) -> str:
    return ("SELECT tabela, row_number() OVER (PARTITION BY tabela ORDER BY k, linha) AS n, linha FROM ("
            + " UNION ALL ".join(parts) + ") x")


@register("load_sheets", with_views(_numbered([_sheet_sql(t, f"p{i}") for i, (t, _, _) in enumerate(PRODUCED)]), *product_ctes()))
def q_load_sheets(spark, sf):
    d = domain(spark, sf)
    tables = produced_forms(d)
    tables["imp_999_desconhecida"] = d.course            # not a contract: skipped and reported (K5)
    lines, skipped = KS.export_tables(tables)
    assert skipped == ["imp_999_desconhecida"]
    path = scratch_path(spark, "load_sheets")
    KS.write_lines(lines, path, "tabela")
    return KS.read_document(spark, path, "tabela")


def _insert_sql(table: str, alias: str) -> str:
    c = C.CONTRACTS[table]
    value = " || ', ' || ".join(
        f"coalesce(CAST(\"{f.name}\" AS VARCHAR), 'NULL')" if f.is_integer
        else f"coalesce(chr(39) || replace(\"{f.name}\", chr(39), chr(39) || chr(39)) || chr(39), 'NULL')" for f in c.fields)
    return (f"SELECT {q(table)} AS tabela, 0 AS k, '-- Tabela: {table} (' || CAST(count(*) AS VARCHAR) || ' registros)' AS linha FROM {alias}"
            f" UNION ALL SELECT {q(table)}, 1, 'INSERT INTO {table} ({', '.join(c.columns)}) VALUES (' || {value} || ');' FROM {alias}")


@register("insert_script", with_views(_numbered([_insert_sql(t, f"p{i}") for i, (t, _, _) in enumerate(PRODUCED)]), *product_ctes()))
def q_insert_script(spark, sf):
    d = domain(spark, sf)
    lines = KS.insert_script({t: form.select(*C.CONTRACTS[t].columns) for t, form in produced_forms(d).items()})
    path = scratch_path(spark, "insert_script")
    KS.write_lines(lines, path, "tabela")
    return KS.read_document(spark, path, "tabela")


@register("run_log_json", with_views("""
SELECT user_id AS modulo, count(*) AS execucoes, count(*) FILTER (WHERE event_type <> 'error') AS sucessos,
  count(*) FILTER (WHERE event_type = 'error') AS falhas FROM events GROUP BY user_id"""))
def q_run_log_json(spark, sf):
    from acadlake.operators.quality import run_summary
    e = domain(spark, sf).events
    log = e.select(F.col("user_id").alias("modulo"),
                   F.when(F.col("event_type") == "error", "erro").otherwise("sucesso").alias("status"),
                   F.col("value").alias("segundos"))
    path = scratch_path(spark, "run_log")
    KS.write_json_log(run_summary(log, "modulo", "status", "segundos"), path)
    schema = "modulo bigint, execucoes bigint, sucessos bigint, falhas bigint"
    return spark.read.schema(schema).json(path)


@register("run_step_log", with_views("SELECT event_type AS modulo, event_id AS execucao, value AS segundos FROM events"))
def q_run_step_log(spark, sf):
    """K7: the records of each step in its own folder beside the consolidated log."""
    e = domain(spark, sf).events
    path = scratch_path(spark, "run_steps")
    KS.write_json_log(e.select(F.col("event_type").alias("modulo"), F.col("event_id").alias("execucao"),
                               F.col("value").alias("segundos")), path, step="modulo")
    return spark.read.schema("execucao bigint, segundos double, modulo string").json(path)


# --------------------------------------------------------------------------- streaming

STREAM_ORACLE = """SELECT event_id, user_id, CASE WHEN event_id % 7 = 0 THEN upper(event_type) ELSE event_type END AS event_type,
  value AS valor FROM events WHERE event_type <> 'error'"""


def _paged(spark, root, target, checkpoint):
    keep = F.lower(F.coalesce(F.col("tipoPref"), F.col("eventType"))) != F.lit("error")   # in-flight filter (CI)
    return PagedLoad(spark, root, target, checkpoint, API_EVENT, "eventId", keep)


def _loader(spark, root, label):
    return _paged(spark, root, scratch_path(spark, label), scratch_path(spark, label + "-ckpt"))


def _stream_rows(df):
    df = L.rename_fields(df, RENAMES, fallbacks={"event_type": ["tipoPref", "eventType"]})
    return df.select("event_id", "user_id", "event_type", "valor")


_LOADED: dict = {}


def _loaded(spark, d):
    """The events table as the stream has loaded it, once per application and state of the source."""
    key = source_state(spark, d.sf_dir, "events")
    if key not in _LOADED:
        load = _loader(spark, _land(spark, d), "stream-target")
        load.run()
        _LOADED[key] = load
    return _LOADED[key]


@register("paged_stream", with_views(STREAM_ORACLE))
def q_paged_stream(spark, sf):
    load = _loaded(spark, domain(spark, sf))
    load.run()                     # resume: nothing new, nothing duplicated
    return _stream_rows(load.result())


@register("paged_source_stream", with_views(STREAM_ORACLE))
def q_paged_source_stream(spark, sf):
    """T1 through the ``paged`` data source: a few bounded batches, then a second run that finds nothing new."""
    d = domain(spark, sf)
    load = _loader(spark, _land(spark, d), "source-target")
    load.run_in_order(pages_per_batch=d.events.count() // PAGE_SIZE // 4 + 1)
    load.run_in_order()
    return _stream_rows(load.result())


@register("paged_reset", with_views(STREAM_ORACLE))
def q_paged_reset(spark, sf):
    """The source changes between two loads; after a reset nothing of the first one is left, for any process."""
    d = domain(spark, sf)
    target, checkpoint = scratch_path(spark, "reset-target"), scratch_path(spark, "reset-ckpt")
    old = _api_events(d).withColumn("eventId", F.col("eventId") + 10 ** 9).withColumn("value", F.lit(-1.0))
    earlier = scratch_path(spark, "earlier-landing")
    L.land_pages(old, earlier, [F.col("eventId").asc()], PAGE_SIZE)
    first = _paged(spark, earlier, target, checkpoint)
    first.run()
    _paged(spark, _land(spark, d), target, checkpoint).run(reset=True)
    return _stream_rows(first.result())             # the first loader looks the new state up


@register("bounded_increment", with_views(STREAM_ORACLE))
def q_bounded_increment(spark, sf):
    d = domain(spark, sf)
    load = _loader(spark, _land(spark, d), "bounded-target")
    n_pages = d.events.count() // PAGE_SIZE + 3
    step = n_pages // 4 + 1
    last = -1
    while True:                    # a few bounded runs; each resumes from the stored state
        new_last = load.run_pages(step)
        if new_last == last:
            break
        last = new_last
    return _stream_rows(load.result())


@register("high_water", with_views("SELECT max(event_id) AS ultima_chave FROM events WHERE event_type <> 'error'"))
def q_high_water(spark, sf):
    return _loaded(spark, domain(spark, sf)).high_water()


@register("mirror_refresh", with_views("""
SELECT count(*) AS total_rows, count(DISTINCT turma) AS distinct_turma, count(DISTINCT disciplina) AS distinct_disciplina,
  count(*) FILTER (WHERE lower(sit_turma) = 'aberta') AS abertas, max(ano) AS max_ano FROM class"""))
def q_mirror_refresh(spark, sf):
    from acadlake.plans.jobs import class_profile, publish_classes
    state, _ = publish_classes(domain(spark, sf))
    return class_profile(state)


_TYPED = f"""SELECT aluno, {strip('nome_compl')} AS nome_compl, {strip('sit_aluno')} AS sit_aluno,
  TRY_CAST(trim(CAST(serie AS VARCHAR)) AS BIGINT) AS serie,
  CASE WHEN representante_turma IS NULL THEN NULL WHEN upper(representante_turma) = 'S' THEN 'S' ELSE 'N' END AS representante_turma,
  strftime(make_timestamp(CAST(CASE WHEN stamp_atualizacao > 1e12 THEN stamp_atualizacao / 1000 ELSE stamp_atualizacao END
    * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS stamp_atualizacao, ano_ingresso FROM student"""


@register("student_sync", with_views("""
SELECT m.* FROM merged m
WHERE m.aluno IN (SELECT aluno FROM active)
   OR (SELECT count(*) FROM merged WHERE aluno NOT IN (SELECT aluno FROM active)) > (SELECT count(*) FROM merged) * 0.5
   OR NOT EXISTS (SELECT 1 FROM active)""",
    f"typed AS ({_TYPED})",
    "stored AS (SELECT * EXCLUDE (ano_ingresso) FROM typed WHERE ano_ingresso <= 2025)",
    "active AS (SELECT * EXCLUDE (ano_ingresso) FROM typed WHERE lower(sit_aluno) = 'ativo')",
    """merged AS (SELECT coalesce(t.aluno, s.aluno) AS aluno,
      CASE WHEN s.aluno IS NOT NULL THEN s.nome_compl ELSE t.nome_compl END AS nome_compl,
      CASE WHEN s.aluno IS NOT NULL THEN s.sit_aluno ELSE t.sit_aluno END AS sit_aluno,
      CASE WHEN s.aluno IS NOT NULL THEN s.serie ELSE t.serie END AS serie,
      CASE WHEN s.aluno IS NOT NULL THEN s.representante_turma ELSE t.representante_turma END AS representante_turma,
      CASE WHEN s.aluno IS NOT NULL THEN s.stamp_atualizacao ELSE t.stamp_atualizacao END AS stamp_atualizacao,
      CASE WHEN s.aluno IS NOT NULL AND t.aluno IS NOT NULL THEN 'update' WHEN s.aluno IS NOT NULL THEN 'insert' ELSE 'keep' END AS acao
    FROM stored t FULL OUTER JOIN active s ON t.aluno = s.aluno)"""))
def q_student_sync(spark, sf):
    from acadlake.plans.jobs import sync_students
    state, _ = sync_students(domain(spark, sf))
    return state
