"""Scalar functions (F) and rules (V) on literal edge cases worked by hand."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.functions import constants as K
from acadlake.functions import rules as R
from acadlake.functions import scalars as S
from acadlake.operators.quality import rewrite_formula


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("value,expected", [(" x ", "x"), ("NULL", None), ("None", None), ("", None), ("abc", "abc")])
def test_f1_text(spark, value, expected):
    assert one(spark, lambda c: S.normalize_value(c, T.StringType()), value) == expected


@pytest.mark.parametrize("value,expected", [(True, "S"), (False, "N"), (None, None)])
def test_f1_bool(spark, value, expected):
    assert one(spark, lambda c: S.normalize_value(c, T.BooleanType()), value, "boolean") == expected


def test_f3_keeps_null_word(spark):
    assert one(spark, lambda c: S.normalize_value(c, T.StringType(), null_words=False), "null") == "null"
    assert one(spark, lambda c: S.normalize_value(c, T.StringType(), null_words=False), "  ") is None


@pytest.mark.parametrize("value", [1700000000000, 1700000000])
def test_f5_epoch(spark, value):
    assert one(spark, S.epoch_to_text, value, "bigint") == "2023-11-14 22:13:20"


@pytest.mark.parametrize("value,expected", [("MARIA.SILVA@EXEMPLO.ORG.BR", "maria.silva"), ("@x", "@x"), (None, None), ("A.B", "a.b")])
def test_f6_mailbox_user(spark, value, expected):
    assert one(spark, S.mailbox_user, value) == expected


@pytest.mark.parametrize("value,expected", [("1.9", 1), ("x", None), (None, None), ("-2.7", -2), ("12", 12)])
def test_f8_int_via_float(spark, value, expected):
    assert one(spark, S.to_int_via_float, value) == expected


@pytest.mark.parametrize("value,expected", [("12345678901", "123.456.789-01"), ("123.456.789-01", "123.456.789-01"),
                                            ("1234", "1234"), ("", None)])
def test_f9_format_id(spark, value, expected):
    assert one(spark, S.format_national_id, value) == expected


def test_f11_accents(spark):
    assert one(spark, S.strip_accents, "Ação Çedilha Über") == "Acao Cedilha Uber"


def test_f12_initials(spark):
    assert one(spark, S.course_initials, "ENGENHARIA DE PRODUÇÃO") == "ENGDEPRO"
    assert one(spark, S.course_initials, None) == ""


def test_f13_subject_code(spark):
    df = spark.createDataFrame([("D1", "ENGENHARIA CIVIL", "006"), ("D1", "MEDICINA", "014"), ("D1", "123", "003")],
                               "d string, n string, c string")
    got = [r[0] for r in df.select(S.subject_course_code("d", "n", "c")).collect()]
    assert got == ["D1-ENGCIV", "D1", "D1"]


def test_f14_offering_code(spark):
    df = spark.createDataFrame([("D1", "T01", 2026, 2), ("D1", "", 2026, 2), ("D1", "T01", 0, 2), (None, "T", 1, 1)],
                               "d string, t string, a bigint, s bigint")
    got = [r[0] for r in df.select(S.offering_code("d", "t", "a", "s")).collect()]
    assert got == ["D1_T01_20262", None, None, None]


@pytest.mark.parametrize("value,expected", [("T01", "REG"), ("e253", "REG"), ("T21", "REC"), ("T3A", "REP"), ("X", None),
                                            (None, None)])
def test_f15_offering_type(spark, value, expected):
    assert one(spark, S.offering_type, value) == expected


def test_f17_student_mailbox(spark):
    df = spark.createDataFrame([("A1", "007"), ("A2", "001")], "a string, u string")
    got = [r[0] for r in df.select(S.student_mailbox("a", "u")).collect()]
    assert got == ["a1" + K.STUDENT_DOMAIN_TECH, "a2" + K.STUDENT_DOMAIN_DEFAULT]


@pytest.mark.parametrize("value,expected", [("manhã", "M"), ("EAD", "O"), ("", None), (" noite ", "N"), ("Integral", "I")])
def test_f19_shift(spark, value, expected):
    assert one(spark, S.map_shift, value) == expected


def test_f21_composite_key(spark):
    df = spark.createDataFrame([("006", "20262", None), ("006", " ", "M")], "a string, b string, c string")
    assert [r[0] for r in df.select(S.composite_key("a", "b", "c")).collect()] == ["006_20262_N", "006_N_M"]


@pytest.mark.parametrize("value,expected", [("ABC - 2023", "ABC"), ("ABC 2023", "ABC"), ("ABC2023", "ABC"), ("ABC", "ABC")])
def test_f23_year_suffix(spark, value, expected):
    assert one(spark, S.strip_year_suffix, value) == expected


def test_f24_f25_f26(spark):
    assert one(spark, S.comparison_key, "  Univ. São-Paulo! ") == "univ  são paulo"
    assert one(spark, S.safe_file_name, 'a/b:c*?"<>|') == "a_b_c______"
    assert one(spark, S.document_text, "a\nb   c") == "a<br/>b c"


@pytest.mark.parametrize("value,expected", [("0", 1), ("99", 99), ("100", None), ("x", None)])
def test_f29_periods(spark, value, expected):
    assert one(spark, S.clamp_periods, value) == expected


def test_f31_sql_literal(spark):
    df = spark.createDataFrame([("O'Brien", 3, None)], "s string, n bigint, z string")
    got = df.select(S.sql_literal(F.col("s"), T.StringType()), S.sql_literal(F.col("n"), T.LongType()),
                    S.sql_literal(F.col("z"), T.StringType())).first()
    assert tuple(got) == ("'O''Brien'", "3", "NULL")


@pytest.mark.parametrize("value,ok", [("a@b.c", True), ("a@b", False), ("a@@b.c", False), ("a b@c.d", False),
                                      (None, False), (" a@b.c ", True)])
def test_v1_email(spark, value, ok):
    assert one(spark, R.is_email, value) is ok


@pytest.mark.parametrize("value,ok", [("123.456.789-01", True), ("11111111111", False), ("1234567890", False)])
def test_v2_national_id(spark, value, ok):
    assert one(spark, R.is_national_id, value) is ok


@pytest.mark.parametrize("value,ok", [("00000000000", False), ("123.456.789-01", True), (None, False)])
def test_v3_lenient(spark, value, ok):
    assert one(spark, R.is_national_id_lenient, value) is ok


def test_v5_date(spark):
    assert one(spark, R.is_date, "2021-2-2") is True
    assert one(spark, R.is_date, "2021-13-40") is False
    assert one(spark, R.is_date, None) is False


@pytest.mark.parametrize("rule,value,ok", [(R.is_phone, None, True), (R.is_phone, "123456789", False),
                                           (R.is_phone, "(24) 99999-9999", True), (R.is_postcode, None, True),
                                           (R.is_postcode, "1234567", False), (R.is_postcode, "27.000-000", True)])
def test_v6_v7(spark, rule, value, ok):
    assert one(spark, rule, value) is ok


def test_v11_v13_v15(spark):
    assert one(spark, R.is_student_status, " ativo ") is True
    assert one(spark, R.is_student_status, None) is True
    assert one(spark, R.is_active_flag, None) is False
    assert one(spark, R.is_course_acronym, "ab1") is True
    assert one(spark, R.is_course_acronym, "A") is False
    assert one(spark, R.is_period, "0") is False
    assert one(spark, R.is_period, "12") is True


def test_v12_numeric_messages(spark):
    assert one(spark, lambda c: R.numeric_message(c, "n", 1, 5), "9") == "Campo 'n' deve ser menor ou igual a 5"
    assert one(spark, lambda c: R.numeric_message(c, "n", 1, 5), "x") == "Campo 'n' deve ser um número"
    assert one(spark, lambda c: R.numeric_message(c, "n", 1, 5), None) is None


def test_v16_record_errors(spark):
    df = spark.createDataFrame([("", "Ana", "bad", "2020-1-1"), ("1", "B", None, "2020-13-1")],
                               "m string, n string, e string, d string")
    errs = df.select(R.record_errors({"matricula": F.col("m"), "nome": F.col("n")}, F.col("e"), F.col("d"))).collect()
    assert errs[0][0] == ["Campo obrigatório 'matricula' não informado", "Email inválido: bad"]
    assert errs[1][0] == ["Data de nascimento inválida: 2020-13-1"]


@pytest.mark.parametrize("value,expected", [("(1)MAT, (1)FIS, (2)QUI", "(MAT E FIS) OU QUI"), ("(1)A,x,(1)B", "(A E B)"),
                                            ("", ""), (None, ""), ("(1)A,(2)B,(1)C", "A OU B OU C"), ("x,y", "")])
def test_q6_formula(spark, value, expected):
    assert one(spark, rewrite_formula, value) == expected
