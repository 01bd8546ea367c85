"""Validation rules (V1-V17) as Boolean / message ``Column`` expressions.

Blank policy follows the studied rules: some rules fail on a blank value,
others pass it; that policy is stated per rule.  All rules are NULL-safe
(never return NULL), so they can be combined with ``&`` / ``~`` directly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acadlake.functions import constants as K
from acadlake.functions.scalars import _c, present, pystrip


def _true_or_false(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def is_email(x) -> Column:
    """V1: one '@', non-empty local part, '.' in the domain, no blank. Blank fails."""
    s = pystrip(_c(x))
    return _true_or_false(present(x) & s.rlike(r"^[^@ ]+@[^@ ]*\.[^@ ]*$"))


def is_national_id(x) -> Column:
    """V2: dots/dashes removed, 11 digits, not all equal. Blank fails."""
    s = F.regexp_replace(pystrip(_c(x).cast("string")), r"[.\-]", "")
    return _true_or_false(present(x) & s.rlike(r"^[0-9]{11}$") & ~s.rlike(r"^(\d)\1{10}$"))


def is_national_id_lenient(x) -> Column:
    """V3: digits only, exactly 11, not all zeros."""
    d = F.regexp_replace(_c(x).cast("string"), r"\D", "")
    return _true_or_false((F.length(d) == 11) & (d != "00000000000"))


def is_non_blank(x) -> Column:
    """V4: registration / name present after stripping."""
    return _true_or_false(present(x) & (F.length(pystrip(x)) > 0))


def is_date(x, fmt: str = "yyyy-M-d") -> Column:
    """V5: parses as a date (unpadded parts accepted, like strptime). Blank fails."""
    return _true_or_false(present(x) & F.try_to_timestamp(_c(x), F.lit(fmt)).isNotNull())


def is_phone(x) -> Column:
    """V6: 10-11 digits after removing non-digits. Blank passes."""
    n = F.length(F.regexp_replace(pystrip(x), r"[^\d]", ""))
    return _true_or_false(~present(x) | n.between(10, 11))


def is_postcode(x) -> Column:
    """V7: 8 digits after removing non-digits. Blank passes."""
    n = F.length(F.regexp_replace(pystrip(x), r"[^\d]", ""))
    return _true_or_false(~present(x) | (n == 8))


def required_message(x, field: str) -> Column:
    """V8: message when a required value is missing / blank; NULL when fine."""
    return (F.when(~present(x), F.lit(K.MSG_REQUIRED_MISSING.format(field=field)))
            .when(F.length(pystrip(x)) == 0, F.lit(K.MSG_REQUIRED_BLANK.format(field=field))))


def max_length_message(x, n: int, field: str) -> Column:
    """V9: message when longer than ``n`` characters; NULL passes."""
    return F.when(F.length(_c(x).cast("string")) > n, F.lit(K.MSG_MAX_LENGTH.format(field=field, n=n)))


def institutional_email_message(x) -> Column:
    """V1 and one of the institutional domains."""
    s = F.lower(pystrip(x))
    inst = None
    for d in K.INSTITUTIONAL_DOMAINS:
        inst = s.endswith(d) if inst is None else (inst | s.endswith(d))
    return (F.when(~is_email(x), F.lit(K.MSG_BAD_EMAIL))
            .when(~_true_or_false(inst), F.lit(K.MSG_NOT_INSTITUTIONAL)))


def in_set(x, values, blank_passes: bool) -> Column:
    """Upper-cased, stripped value in a set, blank policy as argument."""
    v = pystrip(F.upper(_c(x)))
    return _true_or_false(F.when(~present(x), F.lit(blank_passes)).otherwise(v.isin(values)))


def is_active_flag(x) -> Column:
    return in_set(x, K.ACTIVE_FLAG_VALUES, blank_passes=False)


def is_gender(x) -> Column:
    return in_set(x, K.GENDER_VALUES, blank_passes=True)


def is_student_status(x) -> Column:
    return in_set(x, K.STUDENT_STATUS_VALUES, blank_passes=True)


def is_user_role(x) -> Column:
    """V11 (role): exact 'C' or 'P'; NULL fails."""
    return _true_or_false(_c(x).isin(K.USER_ROLE_VALUES))


def numeric_message(x, field: str, vmin=None, vmax=None) -> Column:
    """Numeric with optional bounds; NULL passes."""
    n = _c(x).cast("string").try_cast("double")
    expr = F.when(_c(x).isNull(), F.lit(None).cast("string")).when(
        n.isNull(), F.lit(K.MSG_NOT_NUMBER.format(field=field)))
    if vmin is not None:
        expr = expr.when(n < vmin, F.lit(K.MSG_MIN_VALUE.format(field=field, v=vmin)))
    if vmax is not None:
        expr = expr.when(n > vmax, F.lit(K.MSG_MAX_VALUE.format(field=field, v=vmax)))
    return expr


def is_course_acronym(x) -> Column:
    """Upper-cased, stripped, ^[A-Z0-9]+$ with 2-10 characters. Blank fails."""
    s = pystrip(F.upper(_c(x)))
    return _true_or_false(present(x) & s.rlike(r"^[A-Z0-9]{2,10}$"))


def is_text_within(x, n: int) -> Column:
    """Stripped length in 1..n (course code 30, course name 64, subject code 30)."""
    return _true_or_false(present(x) & F.length(pystrip(_c(x).cast("string"))).between(1, n))


def is_period(x) -> Column:
    """Integer in 1..99."""
    n = _c(x).cast("string").try_cast("bigint")
    return _true_or_false(n.between(1, 99))


def record_errors(required: dict, email=None, birth_date=None) -> Column:
    """List of messages per record (valid iff empty), in rule order.

    ``required`` maps a field label to a column; ``email`` / ``birth_date``
    are checked only when present.
    """
    msgs = [F.when(~present(c), F.lit(K.MSG_REQUIRED_MISSING.format(field=name)))
            for name, c in required.items()]
    if email is not None:
        msgs.append(F.when(present(email) & ~is_email(email),
                           F.concat(F.lit("Email inválido: "), _c(email))))
    if birth_date is not None:
        msgs.append(F.when(present(birth_date) & ~is_date(birth_date, "yyyy-M-d"),
                           F.concat(F.lit("Data de nascimento inválida: "), _c(birth_date))))
    return F.filter(F.array(*msgs), lambda m: m.isNotNull())


def teacher_mailbox(x) -> tuple[Column, Column]:
    """(ok, normalised-or-original) for the teacher domain; '' when blank."""
    s = F.lower(pystrip(x))
    ok = _true_or_false(present(x) & s.endswith("@" + K.TEACHER_DOMAIN))
    value = F.when(~present(x), F.lit("")).otherwise(s)
    return ok, value
