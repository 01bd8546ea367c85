"""Registered quality / analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from acadlake.operators import aggregates as A
from acadlake.operators import contracts as C
from acadlake.operators import ordering as O
from acadlake.operators import quality as Q
from acadlake.functions import constants as K
from acadlake.plans.catalog_products import ORACLES as PRODUCT_ORACLES
from acadlake.plans.load_tables import PRODUCED, produced, product_ctes, produced_forms, union
from acadlake.plans.oracle_sql import (mailbox_user, offering_code, offering_type, q, shift, strip, subject_code,
                                       to_int_via_float, trunc, with_views)
from acadlake.session import scratch_path
from acadlake.tables.keyed import KeyedTable
from acadlake.views import VIEWS, domain, render_for_duckdb

QUERIES = {}
ORACLES = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def nested(name: str) -> str:
    """A product oracle as a sub-query (DuckDB accepts WITH inside a CTE)."""
    return f"({PRODUCT_ORACLES[name]})"


def _predicates(c) -> list[tuple[str, str, str]]:
    parts = []
    for f in c.fields:
        col = f'"{f.name}"'
        if f.required and f.is_integer:
            parts.append((f.name, "obrigatorio", f"NOT ({col} IS NOT NULL AND {col} <> 0)"))
        elif f.required:
            parts.append((f.name, "obrigatorio",
                          f"{col} IS NULL OR {col} = '' OR length(regexp_replace({col}, '^\\s+|\\s+$', '', 'g')) = 0"))
        if f.is_integer:
            parts.append((f.name, f"INTEGER({f.limit})",
                          f"{col} IS NOT NULL AND (TRY_CAST(CAST({col} AS VARCHAR) AS DOUBLE) IS NULL OR "
                          f"abs(TRY_CAST(CAST({col} AS VARCHAR) AS DOUBLE)) > {10 ** f.limit - 1})"))
        else:
            parts.append((f.name, f"CHAR({f.limit})", f"length(CAST({col} AS VARCHAR)) > {f.limit}"))
    return parts


def _violation_sql(table: str, alias: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT {q(table)} AS tabela, {q(col)} AS coluna, {q(rule)} AS regra, "
        f"count(*) FILTER (WHERE coalesce({pred}, false)) AS violacoes FROM {alias}"
        for col, rule, pred in _predicates(C.CONTRACTS[table]))


def _keys(contract) -> str:
    return ", ".join(f'"{k}"' for k in contract.key)


def _key_text(keys) -> str:
    return " || '|' || ".join(f"coalesce(CAST(\"{k}\" AS VARCHAR), '')" for k in keys)


@register("contract_violations", with_views(
    "\nUNION ALL ".join(_violation_sql(t, f"p{i}") for i, (t, _, _) in enumerate(PRODUCED)), *product_ctes()))
def q_contract_violations(spark, sf):
    d = domain(spark, sf)
    return union(C.violations(form, C.CONTRACTS[t]) for t, form in produced_forms(d).items())


def _raised(table: str, alias: str) -> str:
    """Rows with at least one broken rule; the rules of a row in contract order."""
    c = C.CONTRACTS[table]
    rules = ", ".join(f"CASE WHEN coalesce({pred}, false) THEN {q(col + ':' + rule)} END" for col, rule, pred in _predicates(c))
    return (f"SELECT {q(table)} AS tabela, {_key_text(c.key)} AS chave, "
            f"array_to_string(list_filter([{rules}], lambda x: x IS NOT NULL), ',') AS regras FROM {alias}")


@register("contract_rejects", with_views(
    "SELECT * FROM (" + "\nUNION ALL ".join(_raised(t, f"p{i}") for i, (t, _, _) in enumerate(PRODUCED)) + ") x WHERE regras <> ''",
    *product_ctes()))
def q_contract_rejects(spark, sf):
    d = domain(spark, sf)
    return union(C.row_rejects(form, C.CONTRACTS[t]).select(
        F.lit(t).alias("tabela"), C.key_text(C.CONTRACTS[t].key).alias("chave"),
        F.array_join("violacoes", ",").alias("regras")) for t, form in produced_forms(d).items())


@register("key_uniqueness", with_views(
    "\nUNION ALL ".join(
        f"SELECT {q(t)} AS tabela, CAST(sum(n) AS BIGINT) AS linhas, count(*) AS chaves, count(*) FILTER (WHERE n > 1) AS chaves_repetidas "
        f"FROM (SELECT count(*) AS n FROM p{i} GROUP BY {_keys(C.CONTRACTS[t])}) g" for i, (t, _, _) in enumerate(PRODUCED)),
    *product_ctes()))
def q_key_uniqueness(spark, sf):
    d = domain(spark, sf)
    return union(C.key_uniqueness(form, C.CONTRACTS[t]) for t, form in produced_forms(d).items())


@register("duplicate_keys", with_views(
    "\nUNION ALL ".join(
        f"SELECT {q(t)} AS tabela, {_key_text(C.CONTRACTS[t].key)} AS chave, count(*) AS linhas FROM p{i} "
        f"GROUP BY {_keys(C.CONTRACTS[t])} HAVING count(*) > 1" for i, (t, _, _) in enumerate(PRODUCED)), *product_ctes()))
def q_duplicate_keys(spark, sf):
    d = domain(spark, sf)
    return union(C.duplicate_keys(form, C.CONTRACTS[t]) for t, form in produced_forms(d).items())


# sources of the contract transforms, as the contracts name their columns (the same text for both engines)
_SOURCES = {
    "imp_001_cursos": """SELECT c.curso, c.nome, cr.prazo_ideal FROM {course} c JOIN {curriculum} cr ON cr.curso = c.curso
      JOIN (SELECT curso, max(curriculo) AS ultimo FROM {curriculum} GROUP BY curso) u ON u.curso = c.curso AND u.ultimo = cr.curriculo""",
    "imp_002_disciplina": """SELECT g.disciplina, s.nome_compl, g.curso, c.nome AS nome_curso, CAST(g.serie_ideal AS STRING) AS serie_ideal
      FROM {grid} g JOIN {subject} s ON s.disciplina = g.disciplina LEFT JOIN {course} c ON c.curso = g.curso""",
    "imp_005_ofertas": """SELECT t.disciplina, t.turma, t.ano, t.semestre, t.turno, t.curso, c.nome AS nome_curso,
      CASE WHEN t.turma LIKE 'T2%' THEN 'T0' || substr(t.turma, 3) END AS turma_origem
      FROM {class} t LEFT JOIN {course} c ON c.curso = t.curso""",
    "imp_006_usuarios": "SELECT CAST(num_func AS STRING) AS matricula, mailbox AS email, nome_compl FROM {teacher}",
    "imp_007_usuarios_cursos": """SELECT t.curso, p.mailbox AS email, k.num_func AS coordenador FROM {class_teacher} ct
      JOIN {class} t ON t.ano = ct.ano AND t.semestre = ct.periodo AND t.turma = ct.turma AND t.disciplina = ct.disciplina
      JOIN {teacher} p ON p.num_func = ct.num_func
      LEFT JOIN {coordination} k ON k.curso = t.curso AND k.num_func = CAST(ct.num_func AS STRING) AND k.tipo_coord = 'Titular'""",
    "imp_008_usuarios_disciplinas": """SELECT ct.disciplina, t.curso, c.nome AS nome_curso, p.mailbox AS email FROM {class_teacher} ct
      JOIN {class} t ON t.ano = ct.ano AND t.semestre = ct.periodo AND t.turma = ct.turma AND t.disciplina = ct.disciplina
      JOIN {teacher} p ON p.num_func = ct.num_func LEFT JOIN {course} c ON c.curso = t.curso""",
    "imp_009_professores_ofertas": """SELECT ct.disciplina, ct.turma, ct.ano, ct.periodo AS semestre, p.mailbox AS email
      FROM {class_teacher} ct JOIN {teacher} p ON p.num_func = ct.num_func""",
    "imp_010_alunos": "SELECT aluno, nome_compl, unidade_ensino, curso, turno FROM {student}",
    "imp_011_alunos_ofertas": """SELECT e.disciplina, e.turma, e.ano, e.semestre, e.aluno, a.curso FROM {enrol} e
      LEFT JOIN {student} a ON a.aluno = e.aluno""",
    "imp_012_alunos_periodo": "SELECT CAST(serie AS STRING) AS periodo, aluno FROM {student}",
    "imp_013_unidades_avaliacao": """SELECT x.disciplina || '-' || x.prova AS codigo, x.nome, x.curso, x.disciplina,
      CAST(x.ordem AS STRING) AS ordem, x.prova AS agrupamento FROM {exam} x""",
}


def _transformed(field_) -> str:
    src, name = (f'"{field_.source}"' if field_.source else "NULL"), field_.transform
    known = {
        None: f"CAST({src} AS VARCHAR)", "truncar_texto": trunc(src, field_.limit), "converter_inteiro": to_int_via_float(src),
        "converter_minusculas": f"lower({strip(src)})", "extrair_usuario_email": mailbox_user(src), "mapear_turno": shift(src),
        "gerar_codigo_disciplina_curso": subject_code("disciplina", "nome_curso", "curso"),
        "gerar_codigo_oferta": offering_code("disciplina", "turma", "ano", "semestre"),
        "gerar_codigo_oferta_origem": offering_code("disciplina", "turma_origem", "ano", "semestre"),
        "gerar_codigo_tipo_oferta": offering_type("turma"),
        "gerar_email_aluno": f"lower({strip('aluno')} || CASE WHEN unidade_ensino = {q(K.TECH_UNIT)} THEN "
                             f"{q(K.STUDENT_DOMAIN_TECH)} ELSE {q(K.STUDENT_DOMAIN_DEFAULT)} END)",
        "determinar_papel_usuario": "CASE WHEN coordenador IS NOT NULL THEN 'C' ELSE 'P' END",
        "valor_fixo_vazio": "''"}
    sql = known[name] if name in known else q(name[len(C.FIXED):])
    return f"coalesce(CAST({sql} AS VARCHAR), '<nulo>')"


def _transform_sql(table: str) -> str:
    body = " || '|' || ".join(_transformed(f) for f in C.CONTRACTS[table].fields)
    return f"SELECT {q(table)} AS tabela, {body} AS linha FROM ({render_for_duckdb(_SOURCES[table])}) s"


@register("contract_transform", with_views("\nUNION ALL ".join(_transform_sql(t) for t in _SOURCES)))
def q_contract_transform(spark, sf):
    """Every contract that has source tables here, all rows, as one line of text per row."""
    d, out = domain(spark, sf), []
    for table, text in _SOURCES.items():
        src = spark.sql(text, **{v: d.view(v) for v in VIEWS if "{" + v + "}" in text})
        c = C.CONTRACTS[table]
        line = F.concat_ws("|", *[F.coalesce(F.col(x).cast("string"), F.lit("<nulo>")) for x in c.columns])
        out.append(C.apply_contract(src, c).select(F.lit(table).alias("tabela"), line.alias("linha")))
    return union(out)


# --------------------------------------------------------------------------- Q5

LEVELS = ["click", "error", "purchase", "signup", "view"]


@register("run_report", with_views(
    "SELECT user_id AS modulo, " + ", ".join(f"count(*) FILTER (WHERE nivel = {q(v)}) AS {v}" for v in LEVELS)
    + ", count(*) AS total FROM (SELECT user_id, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'debug' "
    "ELSE event_type END AS nivel FROM events) e GROUP BY user_id"))
def q_run_report(spark, sf):
    # some records have no level or one that the report does not list: they count in the total
    level = F.when(F.col("event_id") % 13 == 0, None).when(F.col("event_id") % 17 == 0, "debug").otherwise(F.col("event_type"))
    e = domain(spark, sf).events.select(F.col("user_id").alias("modulo"), level.alias("nivel"))
    return A.pivot_counts(e, "modulo", "nivel", LEVELS)


@register("run_summary", with_views("""
SELECT user_id AS modulo, count(*) AS execucoes, count(*) FILTER (WHERE event_type <> 'error') AS sucessos,
  count(*) FILTER (WHERE event_type = 'error') AS falhas, round(sum(value), 4) AS segundos,
  CASE WHEN round(sum(value), 4) > 0 THEN round(count(*) / round(sum(value), 4), 4) END AS execucoes_por_segundo
FROM events GROUP BY user_id"""))
def q_run_summary(spark, sf):
    e = domain(spark, sf).events
    log = e.select(F.col("user_id").alias("modulo"),
                   F.when(F.col("event_type") == "error", "erro").otherwise("sucesso").alias("status"),
                   F.col("value").alias("segundos"))
    return Q.run_summary(log, "modulo", "status", "segundos")


# --------------------------------------------------------------------------- Q6, W8, M11

_TOKENS = ("WITH toks AS (SELECT id, unnest(string_split(regexp_replace(formula, '[\\r\\n ]', '', 'g'), ',')) AS t, "
           "generate_subscripts(string_split(regexp_replace(formula, '[\\r\\n ]', '', 'g'), ','), 1) AS p FROM formula) ")
FORMULA_ITEMS_CTE = f"""items AS (
  SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY p) - 1 AS BIGINT) AS pos, tipo, disc FROM (
    SELECT id, p, CASE WHEN strpos(t, ')') > 1 THEN TRY_CAST(substr(t, 2, strpos(t, ')') - 2) AS INTEGER) END AS tipo,
      regexp_replace(substr(t, strpos(t, ')') + 1), '^\\s+|\\s+$', '', 'g') AS disc
    FROM ({_TOKENS} SELECT * FROM toks) x WHERE t <> '' AND strpos(t, ')') > 0) y
  WHERE tipo IS NOT NULL AND disc <> '')"""
FORMULA_GROUPS_CTE = """grp AS (SELECT *, CAST(sum(chg) OVER (PARTITION BY id ORDER BY pos) - 1 AS BIGINT) AS grupo FROM (
  SELECT *, CASE WHEN lag(tipo) OVER (PARTITION BY id ORDER BY pos) IS NULL
    OR lag(tipo) OVER (PARTITION BY id ORDER BY pos) <> tipo THEN 1 ELSE 0 END AS chg FROM items) z)"""
FORMULA_NEW_CTE = """novas AS (SELECT f.id, f.formula, coalesce(r.nova, '') AS formula_nova FROM formula f LEFT JOIN (
  SELECT id, string_agg(parte, ' OU ' ORDER BY grupo) AS nova FROM (
    SELECT id, grupo, CASE WHEN count(*) = 1 THEN min(disc) ELSE '(' || string_agg(disc, ' E ' ORDER BY pos) || ')' END AS parte
    FROM grp GROUP BY id, grupo) g GROUP BY id) r ON r.id = f.id)"""


@register("formula_rewrite", with_views("SELECT * FROM novas", FORMULA_ITEMS_CTE, FORMULA_GROUPS_CTE, FORMULA_NEW_CTE))
def q_formula_rewrite(spark, sf):
    f = domain(spark, sf).formula
    return f.select("id", "formula", Q.rewrite_formula("formula").alias("formula_nova"))


@register("formula_items", with_views("SELECT id, pos, CAST(tipo AS BIGINT) AS tipo, disc AS disciplina, grupo FROM grp",
                                      FORMULA_ITEMS_CTE, FORMULA_GROUPS_CTE))
def q_formula_items(spark, sf):
    return Q.formula_items(domain(spark, sf).formula, "id", "formula")


@register("formula_writeback", with_views("""
SELECT f.id, CASE WHEN n.id IS NOT NULL THEN n.formula_nova ELSE f.formula END AS formula,
  CASE WHEN n.id IS NOT NULL AND n.formula IS DISTINCT FROM n.formula_nova THEN 'update' ELSE 'keep' END AS acao
FROM formula f LEFT JOIN novas n ON n.id = f.id AND n.formula IS NOT DISTINCT FROM f.formula""",
    FORMULA_ITEMS_CTE, FORMULA_GROUPS_CTE, FORMULA_NEW_CTE))
def q_formula_writeback(spark, sf):
    f = domain(spark, sf).formula
    upd = f.select("id", F.col("formula").alias("valor_antigo"), Q.rewrite_formula("formula").alias("valor_novo"))
    table = KeyedTable(spark, scratch_path(spark, "formulas"), f.schema, ["id"])
    table.upsert(f)
    # only the buckets of formulas that change are read and written
    table.rewrite_if_unchanged(upd.where(~F.col("valor_antigo").eqNullSafe(F.col("valor_novo"))), "formula")
    return table.read_load()


# --------------------------------------------------------------------------- A1 by load

SKETCHED = ["aluno", "turma", "disciplina"]


@register("merged_profile", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS coluna, count(*) AS linhas, count({c}) AS preenchidas, count(DISTINCT {c}) AS distintos_exatos, true AS dentro_do_erro "
    "FROM enrol WHERE ano >= 1996" for c in SKETCHED)))
def q_merged_profile(spark, sf):
    """A1/A5: sketches stored by load (a year each), merged for a range of loads; the estimate keeps its stated error."""
    e = domain(spark, sf).enrol
    path = scratch_path(spark, "sketches")
    A.sketches(e, "ano", SKETCHED).write.parquet(path)
    merged = A.merged_profile(spark.read.parquet(path).where("ano >= 1996"))
    exact = A.profile(e.where("ano >= 1996"), SKETCHED)
    exact = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"distinct_{c}").alias("distintos_exatos"))
                                             for c in SKETCHED])).alias("x")).select("x.*")
    near = F.abs(F.col("distintos") - F.col("distintos_exatos")) <= F.lit(A.SKETCH_ERROR) * F.col("distintos_exatos")
    return merged.join(exact, F.col("coluna") == F.col("c")).select(
        "coluna", "linhas", "preenchidas", "distintos_exatos", near.alias("dentro_do_erro"))


# --------------------------------------------------------------------------- Q8

PAGE = 100
_GONE = f"(event_type = 'error' AND (event_id // {PAGE}) % 7 = 0)"


@register("snapshot_diff", with_views(f"""
SELECT coalesce(c.pagina, p.pagina) AS pagina, len(coalesce(c.k, [])) AS tamanho_atual, len(coalesce(p.k, [])) AS tamanho_anterior,
  len(list_filter(coalesce(c.k, []), lambda x: NOT list_contains(coalesce(p.k, []), x)))
    + len(list_filter(coalesce(p.k, []), lambda x: NOT list_contains(coalesce(c.k, []), x))) = 0 AS identica,
  array_to_string(list_sort(list_filter(coalesce(c.k, []), lambda x: NOT list_contains(coalesce(p.k, []), x))), ',') AS chaves_adicionadas,
  array_to_string(list_sort(list_filter(coalesce(p.k, []), lambda x: NOT list_contains(coalesce(c.k, []), x))), ',') AS chaves_removidas
FROM (SELECT pagina, list(event_id) AS k FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // {PAGE} AS pagina
      FROM events WHERE event_type <> 'error') a GROUP BY pagina) c
FULL OUTER JOIN (SELECT pagina, list(event_id) AS k FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // {PAGE} AS pagina
      FROM events) b GROUP BY pagina) p ON c.pagina = p.pagina"""))
def q_snapshot_diff(spark, sf):
    e = domain(spark, sf).events.select("event_id", "event_type")
    before = O.sequential_ids(e.select("event_id"), [F.col("event_id").asc()], "pos")
    now = O.sequential_ids(e.where(F.col("event_type") != "error").select("event_id"), [F.col("event_id").asc()], "pos")
    page = lambda df: df.withColumn("pagina", F.floor((F.col("pos") - 1) / PAGE).cast("bigint"))
    store = Q.SnapshotStore(spark, scratch_path(spark, "snapshot"))
    store.save(page(before), "event_id", "pagina")
    return store.compare(page(now), "event_id", "pagina")


@register("snapshot_stability", with_views(f"""
SELECT c.pagina, coalesce(n.k, 0) AS tamanho_atual, c.k AS tamanho_anterior, coalesce(n.k, 0) = c.k AS identica,
  '' AS chaves_adicionadas, coalesce(g.r, '') AS chaves_removidas
FROM (SELECT event_id // {PAGE} AS pagina, count(*) AS k FROM events GROUP BY 1) c
LEFT JOIN (SELECT event_id // {PAGE} AS pagina, count(*) AS k FROM events WHERE NOT {_GONE} GROUP BY 1) n USING (pagina)
LEFT JOIN (SELECT event_id // {PAGE} AS pagina, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS r
           FROM events WHERE {_GONE} GROUP BY 1) g USING (pagina)"""))
def q_snapshot_stability(spark, sf):
    """Q8 on fixed pages: the errors of every seventh page are gone, so only these pages' keys are read again."""
    e = domain(spark, sf).events.select("event_id", "event_type", F.floor(F.col("event_id") / PAGE).cast("bigint").alias("pagina"))
    store = Q.SnapshotStore(spark, scratch_path(spark, "stability"))
    store.save(e, "event_id", "pagina")
    return store.compare(e.where(F.expr(f"NOT {_GONE.replace('//', 'DIV')}")), "event_id", "pagina")


# --------------------------------------------------------------------------- Q9

@register("referential_audit", with_views("""
SELECT 'imp_009.codigoOferta->imp_005' AS verificacao, chave FROM (
  SELECT DISTINCT codigoOferta AS chave FROM r9 WHERE codigoOferta IS NOT NULL
  EXCEPT SELECT codigoOferta FROM r5) a
UNION ALL
SELECT 'imp_011.codigoOferta->imp_005', chave FROM (
  SELECT DISTINCT codigoOferta AS chave FROM r11 WHERE codigoOferta IS NOT NULL
  EXCEPT SELECT codigoOferta FROM r5) b
UNION ALL
SELECT 'imp_010.codigoCurso->imp_001', chave FROM (
  SELECT DISTINCT codigoCurso AS chave FROM r10 WHERE codigoCurso IS NOT NULL
  EXCEPT SELECT codigoCurso FROM r1) c""",
    f"r1 AS {nested('load_courses')}", f"r5 AS {nested('load_offerings')}",
    f"r9 AS {nested('load_teacher_offerings')}", f"r10 AS {nested('load_students')}",
    f"r11 AS {nested('load_student_offerings')}"))
def q_referential_audit(spark, sf):
    d = domain(spark, sf)
    offers = produced(d, "imp_005_ofertas")
    return Q.referential_audit([
        ("imp_009.codigoOferta->imp_005", produced(d, "imp_009_professores_ofertas"), "codigoOferta", offers, "codigoOferta"),
        ("imp_011.codigoOferta->imp_005", produced(d, "imp_011_alunos_ofertas"), "codigoOferta", offers, "codigoOferta"),
        ("imp_010.codigoCurso->imp_001", produced(d, "imp_010_alunos"), "codigoCurso",
         produced(d, "imp_001_cursos"), "codigoCurso"),
    ])


# --------------------------------------------------------------------------- F23, F24, J13, Q7

THRESHOLD = 90
_NAMES = ["""nomes AS (SELECT linha, nome_instituicao, """ + strip("regexp_replace(regexp_replace("
          + strip("coalesce(nome_instituicao, 'nan')") + ", '\\s*-\\s*\\d{4}$', ''), '\\s*\\d{4}$', '')")
          + " AS limpo FROM institution)",
          "chaves AS (SELECT *, " + strip("lower(regexp_replace(limpo, '[^\\p{L}\\p{N}]', ' ', 'g'))") + " AS chave FROM nomes)"]
# longest common subsequence by bit vectors: positions of each character of one key, folded over the other key
_PAIRS = _NAMES + [
    "kk AS (SELECT chave, min(linha) AS pos, length(chave) AS n, (CAST(1 AS HUGEINT) << length(chave)) - 1 AS cheio "
    "FROM chaves GROUP BY chave)",
    """mm AS (SELECT pos, map_from_entries(list((ch, bits))) AS mapa FROM (
      SELECT pos, ch, sum(CAST(1 AS HUGEINT) << (i - 1)) AS bits FROM (
        SELECT pos, unnest(range(1, n + 1)) AS i, unnest(string_split(chave, '')) AS ch FROM kk WHERE n > 0) GROUP BY pos, ch) GROUP BY pos)""",
    f"""pares AS (SELECT a.pos AS a_pos, b.pos AS b_pos, a.n AS la, b.n AS lb, a.n - bit_count(list_reduce(
        list_prepend(a.cheio, list_transform(string_split(b.chave, ''), lambda c: coalesce(CAST(mm.mapa[c] AS HUGEINT), 0))),
        lambda s, x: ((s + (s & x)) | (s - (s & x))) & a.cheio)) AS lcs
      FROM kk a JOIN mm ON mm.pos = a.pos JOIN kk b ON a.pos < b.pos AND b.n > 0
        AND abs(a.n - b.n) <= floor({100 - THRESHOLD} * (a.n + b.n) / 100))""",
    f"arestas AS (SELECT a_pos, b_pos FROM pares WHERE 200 * lcs >= {THRESHOLD} * (la + lb))"]
# the sequential pass, folded over the keys in input order
_GROUPS = _PAIRS + [
    "viz AS (SELECT kk.pos, coalesce(list(a_pos) FILTER (a_pos IS NOT NULL), []) AS nb FROM kk LEFT JOIN arestas ON b_pos = kk.pos GROUP BY kk.pos)",
    """lid AS (SELECT unnest(list_reduce(list_prepend({'pos': CAST(-1 AS BIGINT), 'nb': CAST([] AS BIGINT[]), 'lead': CAST([] AS BIGINT[])},
        list({'pos': pos, 'nb': nb, 'lead': CAST([] AS BIGINT[])} ORDER BY pos)),
        lambda acc, x: {'pos': x.pos, 'nb': CAST([] AS BIGINT[]), 'lead': CASE WHEN len(list_intersect(acc.lead, x.nb)) = 0
          THEN list_append(acc.lead, x.pos) ELSE acc.lead END}).lead) AS pos FROM viz)""",
    """cabeca AS (SELECT kk.pos, CASE WHEN kk.pos IN (SELECT pos FROM lid) THEN kk.pos ELSE
        (SELECT min(a_pos) FROM arestas WHERE b_pos = kk.pos AND a_pos IN (SELECT pos FROM lid)) END AS lider FROM kk)""",
    "numeros AS (SELECT lider, row_number() OVER (ORDER BY lider) AS id FROM (SELECT DISTINCT lider FROM cabeca) t)"]


def _institutions(spark, sf):
    return domain(spark, sf).institution


@register("name_keys", with_views("SELECT linha, limpo, chave FROM chaves", *_NAMES))
def q_name_keys(spark, sf):
    from acadlake.operators.entity import named_keys
    return named_keys(_institutions(spark, sf), "linha", "nome_instituicao").select("linha", "limpo", "chave")


@register("similar_pairs", with_views("SELECT a_pos, b_pos FROM arestas", *_PAIRS))
def q_similar_pairs(spark, sf):
    from acadlake.operators.entity import distinct_keys, named_keys, similar_pairs
    return similar_pairs(distinct_keys(named_keys(_institutions(spark, sf), "linha", "nome_instituicao"), "linha"), THRESHOLD)


@register("fuzzy_groups", with_views("""
SELECT c.linha, c.nome_instituicao, numeros.id,
  first_value(c.limpo) OVER (PARTITION BY numeros.id ORDER BY length(c.limpo) DESC, c.linha) AS sugerido
FROM chaves c JOIN kk ON kk.chave = c.chave JOIN cabeca ON cabeca.pos = kk.pos JOIN numeros ON numeros.lider = cabeca.lider""",
    *_GROUPS))
def q_fuzzy_groups(spark, sf):
    from acadlake.operators.entity import fuzzy_groups
    return fuzzy_groups(_institutions(spark, sf), "linha", "nome_instituicao", THRESHOLD)
