"""SQL text builders for the DuckDB oracle (independent re-statement of the rules).

Only used to produce ``oracle_sql()`` strings; the Spark side never runs them.
"""

from __future__ import annotations

from acadlake.functions import constants as K
from acadlake.views import oracle_cte


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def present(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


def trunc(x: str, n: int) -> str:
    return f"substr({x}, 1, {n})"


def email_ok(x: str) -> str:
    return f"coalesce({present(x)} AND regexp_matches({strip(x)}, '^[^@ ]+@[^@ ]*\\.[^@ ]*$'), false)"


def within(x: str, n: int) -> str:
    return f"coalesce({present(x)} AND length({strip(x)}) BETWEEN 1 AND {n}, false)"


def non_blank(x: str) -> str:
    return f"coalesce({present(x)} AND length({strip(x)}) > 0, false)"


def initials(name: str) -> str:
    words = f"string_split_regex({strip(name)}, '\\s+')"
    cleaned = f"list_transform({words}, lambda w: regexp_replace(w, '[^a-zA-ZÀ-ÿ]', '', 'g'))"
    kept = f"list_filter({cleaned}, lambda w: w <> '')"
    return f"array_to_string(list_transform({kept}, lambda w: upper(substr(w, 1, 3))), '')"


def subject_code(subj: str, name: str, code: str) -> str:
    ini = initials(f"coalesce({name}, 'None')")
    bare = ", ".join(q(c) for c in K.BARE_SUBJECT_CODE_COURSES)
    return (f"(CASE WHEN {code} IN ({bare}) THEN {trunc(subj, 30)} "
            f"WHEN {ini} <> '' THEN {trunc(f'{subj} || ' + q('-') + f' || {ini}', 30)} ELSE {trunc(subj, 30)} END)")


def offering_code(subj: str, klass: str, year: str, sem: str) -> str:
    ok = f"{present(subj)} AND {present(klass)} AND {year} IS NOT NULL AND {year} <> 0 AND {sem} IS NOT NULL AND {sem} <> 0"
    return (f"(CASE WHEN {ok} THEN {trunc(f'{subj} || ' + q('_') + f' || {klass} || ' + q('_') + f' || CAST({year} AS VARCHAR) || CAST({sem} AS VARCHAR)', 30)} END)")


def offering_type(klass: str) -> str:
    s = strip(f"upper({klass})")
    return (f"(CASE WHEN NOT {present(klass)} THEN NULL WHEN starts_with({s}, 'T0') OR starts_with({s}, 'E') THEN 'REG' "
            f"WHEN starts_with({s}, 'T2') THEN 'REC' WHEN starts_with({s}, 'T3') THEN 'REP' END)")


def shift(x: str) -> str:
    s = strip(f"upper({x})")
    parts = " ".join(f"WHEN {s} IN ({', '.join(q(n) for n in names)}) THEN {q(code)}" for code, names in K.SHIFT_SYNONYMS)
    return f"(CASE WHEN NOT {present(x)} THEN NULL {parts} ELSE 'O' END)"


def mailbox_user(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN NOT {present(x)} THEN NULL WHEN strpos({s}, '@') > 1 "
            f"THEN lower(split_part({s}, '@', 1)) ELSE lower({s}) END)")


def to_int_via_float(x: str) -> str:
    return f"CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS BIGINT)"


def ci(x: str, v: str) -> str:
    return f"lower({x}) = {q(v.lower())}"


def course_map_cte() -> str:
    rows = ", ".join(f"({q(a)}, {q(b)}, {q(c)})" for a, b, c in K.COURSE_CODE_MAP)
    return f"cmap AS (SELECT * FROM (VALUES {rows}) v(map_code, unified_code, unified_name))"


def exam_labels_case(x: str) -> str:
    parts = " ".join(f"WHEN {x} = {q(k)} THEN {q(v)}" for k, v in K.EXAM_LABELS)
    return f"(CASE {parts} ELSE {x} END)"


def with_views(query: str, *extra_ctes: str) -> str:
    """Domain views (+ extra CTEs) then the query; ``query`` may start with more CTEs (', name AS (...)')."""
    extra = "".join(",\n" + c for c in extra_ctes)
    return oracle_cte_with(extra, query)


def oracle_cte_with(extra: str, query: str) -> str:
    base = oracle_cte("SELECT 1")
    head = base[: base.rfind("\nSELECT 1")]
    return head + extra + "\n" + query
