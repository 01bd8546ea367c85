"""Every registered query against its DuckDB oracle on the smoke tables (sf0.001)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck_con

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con(sf):
    return duck_con(sf)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "id" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
        return
    assert compare(name, df, sql, con, verbose=False)


NON_EMPTY = ["student_view", "contact_report", "load_courses", "load_subjects", "load_offerings", "load_users",
             "load_users_courses", "load_users_subjects", "load_teacher_offerings", "load_students",
             "load_student_offerings", "load_assessment_units", "committee_courses", "committee_members",
             "merge_upsert", "formula_rewrite", "fuzzy_groups", "paged_stream"]


@pytest.mark.parametrize("name", NON_EMPTY)
def test_products_not_empty(spark, sf, name):
    # both engines read the same domain views, so an input mistake would not show as a mismatch
    assert not E.queries()[name](spark, sf).isEmpty(), name
