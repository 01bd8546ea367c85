"""Scalar functions (F1-F32) as native Spark ``Column`` expressions.

All of them are JVM expressions (no Python UDF), so they run inside
whole-stage code generation and are pushed through projections by Catalyst.
Helpers take and return ``Column``; strings are accepted as column names.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.functions import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------- basics

def pystrip(x) -> Column:
    """Strip leading/trailing Unicode whitespace (Python ``str.strip``)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def blank_to_null(x) -> Column:
    s = pystrip(x)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)


def present(x, numeric: bool = False) -> Column:
    """Python truthiness: not NULL, not '' and (for numbers) not 0."""
    c = _c(x)
    if numeric:
        return c.isNotNull() & (c != 0)
    return c.isNotNull() & (c != "")


def ci_equals(x, value: str) -> Column:
    """Case-insensitive equality (the source database collation)."""
    return F.lower(_c(x)) == value.lower()


def _looked_up(x: Column, pairs: list[tuple[str, str]]) -> Column:
    """The value of a small fixed map, else NULL; ``x`` stands in the expression once, however many keys there are."""
    return F.try_element_at(F.create_map(*[F.lit(v) for pair in pairs for v in pair]), x)


# --------------------------------------------------------------------------- F1-F5

def normalize_value(x, dtype: T.DataType, null_words: bool = True) -> Column:
    """F1 (and F3 with ``null_words=False``): generic value normalisation.

    text: stripped; '' (and case-insensitive 'null'/'none' under F1) -> NULL;
    boolean -> 'S'/'N' (F3 keeps Python's 'True'/'False'); numbers unchanged;
    nested values -> NULL (F2).
    """
    c = _c(x)
    if isinstance(dtype, T.StringType):
        s = pystrip(c)
        bad = F.lower(s).isin("null", "none", "") if null_words else (s == "")
        return F.when(bad, F.lit(None).cast("string")).otherwise(s)
    if isinstance(dtype, T.BooleanType):
        if null_words:
            return F.when(c, F.lit("S")).when(~c, F.lit("N"))
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):
        return F.lit(None).cast("string")
    return c


def normalize_frame(df: DataFrame, null_words: bool = True) -> DataFrame:
    """Apply F1/F2/F3 to every column by its declared type, one projection."""
    return df.select([normalize_value(f.name, f.dataType, null_words).alias(f.name)
                      for f in df.schema.fields])


def epoch_to_text(x) -> Column:
    """epoch seconds or milliseconds (> 10^12) -> 'yyyy-MM-dd HH:mm:ss' (UTC)."""
    c = _c(x).cast("double")
    secs = F.when(c > 1e12, c / 1000).otherwise(c)
    return F.date_format(F.timestamp_seconds(secs), "yyyy-MM-dd HH:mm:ss")


def typed_integer(x) -> Column:
    """F4 integer role: Python ``int(value)``; text must be an integer literal."""
    return F.trim(_c(x).cast("string")).try_cast("bigint")


def typed_flag(x) -> Column:
    """F4 flag role: text 'S'/'s' -> 'S', any other text -> 'N'; NULL stays NULL."""
    c = _c(x)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(F.upper(c) == "S", "S").otherwise("N")


def typed_stamp(x, dtype: T.DataType) -> Column:
    """F4 timestamp role: numbers -> F5 text, text -> stripped."""
    if isinstance(dtype, T.StringType):
        return pystrip(x)
    return epoch_to_text(x)


# --------------------------------------------------------------------------- F6-F11

def mailbox_user(x) -> Column:
    """part before the first '@' when it is not at position 0; lower-cased."""
    c = _c(x)
    s = pystrip(c)
    return (F.when(c.isNull() | (c == ""), F.lit(None).cast("string"))
            .when(F.instr(s, "@") > 1, F.lower(F.substring_index(s, "@", 1)))
            .otherwise(F.lower(s)))


def lower_text(x) -> Column:
    """F7."""
    return F.lower(_c(x))


def to_int_via_float(x) -> Column:
    """F8: ``int(float(v))`` — truncates toward zero, bad input -> NULL."""
    return _c(x).try_cast("double").try_cast("bigint")


def format_national_id(x) -> Column:
    """11 digits -> 000.000.000-00, otherwise the cleaned text; blank -> NULL."""
    c = _c(x)
    s = pystrip(F.regexp_replace(c.cast("string"), r"[.\-]", ""))
    formatted = F.concat(F.substring(s, 1, 3), F.lit("."), F.substring(s, 4, 3), F.lit("."),
                         F.substring(s, 7, 3), F.lit("-"), F.substring(s, 10, 2))
    return (F.when(c.isNull() | (c.cast("string") == ""), F.lit(None).cast("string"))
            .when(s.rlike(r"^[0-9]{11}$"), formatted).otherwise(s))


def truncate(x, n: int = 100) -> Column:
    """first ``n`` characters."""
    return F.substring(_c(x), 1, n)


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters -> base letter, built by rule from Unicode NFD."""
    src, dst = [], []
    for block in (range(0x00C0, 0x0250), range(0x1E00, 0x1F00)):
        for cp in block:
            ch = chr(cp)
            base = "".join(b for b in unicodedata.normalize("NFD", ch) if ord(b) < 128)
            if len(base) == 1 and base != ch:
                src.append(ch)
                dst.append(base)
    return "".join(src), "".join(dst)


_ACCENT_SRC, _ACCENT_DST = _accent_table()


def strip_accents(x) -> Column:
    """NFD decomposition then drop non-ASCII."""
    return F.regexp_replace(F.translate(_c(x), _ACCENT_SRC, _ACCENT_DST), r"[^\x00-\x7F]", "")


# --------------------------------------------------------------------------- F12-F21

_LETTERS = "a-zA-ZÀ-ÿ"
# a word up to the next one: its first three letters, whatever stands between them, and the rest
_WORD = rf"(?U)[^\s{_LETTERS}]*([{_LETTERS}]?)[^\s{_LETTERS}]*([{_LETTERS}]?)[^\s{_LETTERS}]*([{_LETTERS}]?)\S*\s*"


def course_initials(name, limit: int | None = 30) -> Column:
    """first three letters (upper) of each blank-separated word, concatenated."""
    out = F.coalesce(F.upper(F.regexp_replace(_c(name), _WORD, "$1$2$3")), F.lit(""))
    return truncate(out, limit) if limit else out


def subject_suffix(course_name) -> Column:
    """what a course adds to its subjects' codes: '-INITIALS', or '' without initials."""
    initials = course_initials(F.coalesce(_c(course_name).cast("string"), F.lit("None")), limit=None)
    return F.rtrim(F.concat(F.lit("-"), initials), F.lit("-"))


def suffixed_subject_code(subject, suffix, course_code) -> Column:
    """F13 with the course's suffix (``subject_suffix``) given, so that it can be made once a course."""
    subj = _c(subject).cast("string")
    return (F.when(_c(course_code).isin(K.BARE_SUBJECT_CODE_COURSES), truncate(subj, 30))
            .otherwise(truncate(F.concat(subj, _c(suffix)), 30)))


def subject_course_code(subject, course_name, course_code) -> Column:
    """'subject-INITIALS' capped at 30; some courses keep the bare subject code."""
    return suffixed_subject_code(subject, subject_suffix(course_name), course_code)


def offering_code(subject, klass, year, semester) -> Column:
    """'subject_class_YYYYS' capped at 30; NULL when any part is falsy."""
    ok = (present(subject) & present(klass) & present(year, numeric=True) & present(semester, numeric=True))
    code = F.concat(_c(subject), F.lit("_"), _c(klass), F.lit("_"),
                    _c(year).cast("string"), _c(semester).cast("string"))
    return F.when(ok, truncate(code, 30))


def offering_type(klass) -> Column:
    """T0*/E* -> REG, T2* -> REC, T3* -> REP, else NULL."""
    kind = F.regexp_extract(F.upper(_c(klass)), r"(?U)^\s*(T0|E|T2|T3)", 1)
    return _looked_up(kind, [("T0", "REG"), ("E", "REG"), ("T2", "REC"), ("T3", "REP")])


def student_mailbox(student, unit) -> Column:
    """student id + domain by teaching unit, lower-cased."""
    dom = F.when(_c(unit) == K.TECH_UNIT, F.lit(K.STUDENT_DOMAIN_TECH)).otherwise(F.lit(K.STUDENT_DOMAIN_DEFAULT))
    return F.when(present(student), F.lower(F.concat(pystrip(student), dom)))


def map_shift(x) -> Column:
    """shift synonyms -> M/T/N/I, other non-blank -> 'O', blank -> NULL."""
    codes = [(name, code) for code, names in K.SHIFT_SYNONYMS for name in names]
    return F.when(present(x), F.coalesce(_looked_up(pystrip(F.upper(_c(x))), codes), F.lit("O")))


def composite_key(*parts) -> Column:
    """'a_b_c' with blank / NULL parts as 'N'."""
    normed = [F.coalesce(blank_to_null(_c(p).cast("string")), F.lit("N")) for p in parts]
    return F.concat_ws("_", *normed)


def digits_only(x) -> Column:
    """keep digits; blank -> ''."""
    c = _c(x).cast("string")
    return F.when(~present(c), F.lit("")).otherwise(F.regexp_replace(c, r"\D", ""))


# --------------------------------------------------------------------------- F23-F32

def strip_year_suffix(x) -> Column:
    """drop a trailing ' - 2023' / ' 2023' / '2023' from a stripped name."""
    s = pystrip(_c(x).cast("string"))
    s = F.regexp_replace(s, r"\s*-\s*\d{4}$", "")
    s = F.regexp_replace(s, r"\s*\d{4}$", "")
    return pystrip(s)


def comparison_key(x) -> Column:
    """lower-case, non-alphanumerics -> blank, trimmed."""
    return pystrip(F.lower(F.regexp_replace(_c(x), r"(?U)[^\p{Alnum}]", " ")))


def safe_file_name(x) -> Column:
    r"""characters \ / * ? : " < > | -> '_'."""
    return F.regexp_replace(_c(x).cast("string"), r'[\\/*?:"<>|]', "_")


def document_text(x) -> Column:
    """newline -> '<br/>', whitespace runs -> one blank."""
    return F.regexp_replace(F.replace(_c(x).cast("string"), F.lit("\n"), F.lit("<br/>")), r"(?U)\s+", " ")


def period_text(year, semester) -> Column:
    """'year/semester', NULL if either part is NULL."""
    return F.concat(_c(year).cast("string"), F.lit("/"), _c(semester).cast("string"))


def label_or_code(x, pairs: list[tuple[str, str]]) -> Column:
    """lookup with identity fallback (small fixed map, inlined as CASE)."""
    expr = None
    for k, v in pairs:
        expr = (F.when(_c(x) == k, F.lit(v)) if expr is None else expr.when(_c(x) == k, F.lit(v)))
    return expr.otherwise(_c(x)) if expr is not None else _c(x)


def clamp_periods(x) -> Column:
    """integer 0..99 with 0 -> 1; anything else -> NULL."""
    n = _c(x).cast("string").try_cast("bigint")
    return F.when(n == 0, F.lit(1).cast("bigint")).when(n.between(1, 99), n)


def clean_subject_name(x) -> Column:
    """stripped, blank -> NULL, capped at 100."""
    return truncate(blank_to_null(x), 100)


def sql_literal(x, dtype: T.DataType) -> Column:
    """value as a T-SQL literal: NULL, bare numbers, quoted text (quotes doubled)."""
    c = _c(x)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                          T.FloatType, T.DoubleType, T.DecimalType)):
        body = c.cast("string")
    elif isinstance(dtype, T.BooleanType):
        body = F.when(c, "1").otherwise("0")
    elif isinstance(dtype, T.TimestampType):
        body = F.concat(F.lit("'"), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("'"))
    else:
        body = F.concat(F.lit("'"), F.replace(c.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(c.isNull(), F.lit("NULL")).otherwise(body)


def fixed(value) -> Column:
    """F32: constant value."""
    return F.lit(value)


def normalize_by_roles(df: DataFrame, integer: tuple = (), flag: tuple = (), stamp: tuple = ()) -> DataFrame:
    """F4 for a whole record: integer / flag / timestamp roles, other text stripped ('' kept)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in integer:
            out = typed_integer(c)
        elif f.name in flag:
            out = typed_flag(c)
        elif f.name in stamp:
            out = typed_stamp(c, f.dataType)
        elif isinstance(f.dataType, T.StringType):
            out = pystrip(c)
        else:
            out = c
        cols.append(out.alias(f.name))
    return df.select(*cols)
