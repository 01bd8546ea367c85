"""Property tests: Spark expressions vs plain-Python twins of the source rules, on random text.

Each property draws a batch of strings and checks them in one Spark job."""

import bruteforce as B
from hypothesis import given, settings
from hypothesis import strategies as st

from acadlake.functions import rules as R
from acadlake.functions import scalars as S
from acadlake.operators.quality import rewrite_formula

TEXT = st.text(alphabet=list("abcXYZ019 @.-_()ãÉç\t") , max_size=24)
FORMULA = st.lists(st.one_of(
    st.builds(lambda k, s: f"({k}){s}", st.sampled_from(["1", "2", "3", "01", "x", ""]),
              st.text(alphabet=list("MATFIS "), max_size=4)),
    st.text(alphabet=list("ab()1 "), max_size=5)), max_size=6).map(lambda xs: ",".join(xs))
BATCH = st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None)


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", expr("x").alias("y")).orderBy("i").collect()]


@SETTINGS
@given(BATCH)
def test_email_rule(spark, values):
    assert run(spark, values, R.is_email) == [B.py_email_ok(v) for v in values]


@SETTINGS
@given(BATCH)
def test_mailbox_user(spark, values):
    assert run(spark, values, S.mailbox_user) == [B.py_mailbox_user(v) for v in values]


@SETTINGS
@given(BATCH)
def test_course_initials(spark, values):
    assert run(spark, values, S.course_initials) == [B.py_initials(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["manhã", " Noite ", "int", "EAD", "", "t", "TARDE"]), TEXT),
                min_size=1, max_size=40))
def test_shift_map(spark, values):
    assert run(spark, values, S.map_shift) == [B.py_shift(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["T01", " e9", "t21", "T3x", "X"]), TEXT), min_size=1, max_size=40))
def test_offering_type(spark, values):
    assert run(spark, values, S.offering_type) == [B.py_offering_type(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet=list("0123456789.- "), max_size=16)), min_size=1, max_size=40))
def test_format_national_id(spark, values):
    assert run(spark, values, S.format_national_id) == [B.py_format_id(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXT.map(lambda s: s + " - 2021"), TEXT.map(lambda s: s + "2019"), TEXT),
                min_size=1, max_size=40))
def test_year_suffix(spark, values):
    assert run(spark, values, S.strip_year_suffix) == [B.clean_name(v) if v is not None else None for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), FORMULA), min_size=1, max_size=40))
def test_formula_rewrite(spark, values):
    assert run(spark, values, rewrite_formula) == [B.py_formula(v) for v in values]
