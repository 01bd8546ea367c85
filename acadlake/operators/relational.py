"""Filters, predicates and joins (P1-P14, J1-J14) as DataFrame functions.

Joins are written as equi-joins so Catalyst plans them as sort-merge or
(AQE, size-checked at run time) broadcast-hash joins.  Explicit ``broadcast``
hints are used only for inputs with a proven size bound (fixed lookup tables).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acadlake.functions import constants as K
from acadlake.functions.scalars import _c, present, pystrip
from acadlake.operators.ordering import sequential_ids


# --------------------------------------------------------------------------- predicates

def conj(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def split_required(df: DataFrame, required: list[str], numeric: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """(rows whose required fields are all truthy, rejected rows)."""
    ok = conj(present(c, numeric=c in numeric) for c in required)
    return df.where(ok), df.where(~ok)


def optional_filters(df: DataFrame, filters: dict) -> DataFrame:
    """Absent -> no predicate, scalar -> '=', list -> IN."""
    preds = []
    for name, value in filters.items():
        if value is None or (isinstance(value, (list, tuple)) and not value):
            continue
        c = _c(name) if isinstance(name, str) else name
        preds.append(c.isin(list(value)) if isinstance(value, (list, tuple)) else c == value)
    return df.where(conj(preds)) if preds else df


def in_or_null(c, values, blank: bool = True) -> Column:
    """Value IN (...) OR value IS NULL [OR value = '']."""
    col = _c(c)
    pred = col.isin(list(values)) | col.isNull()
    return pred | (col == "") if blank else pred


def unassigned_or_allowed(fact_key, dim_attr, values) -> Column:
    """Passes when the left-joined fact key is NULL or the dimension attribute is allowed."""
    return _c(fact_key).isNull() | _c(dim_attr).isin(list(values))


def non_blank(c) -> Column:
    """IS NOT NULL AND != ''."""
    return _c(c).isNotNull() & (_c(c) != "")


def not_sentinel(c, sentinel: str = "1") -> Column:
    """Reject the placeholder record."""
    return ~(pystrip(_c(c).cast("string")) == sentinel)


# --------------------------------------------------------------------------- joins

def fixed_lookup(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed configuration table (bounded, so it is broadcast)."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def course_map(spark) -> DataFrame:
    """F20 map as a broadcast table: code -> (unified code, unified name)."""
    return fixed_lookup(spark, K.COURSE_CODE_MAP, "map_code string, unified_code string, unified_name string")


def unify_course(df: DataFrame, code_col: str, spark, out_code: str = "curso_unificado",
                 out_name: str | None = "nome_unificado", blank_as: str | None = None,
                 name_fallback: Column | None = None) -> DataFrame:
    """left join to the code map; unmapped codes keep themselves.

    ``blank_as`` replaces a NULL/blank code before the lookup ('999' or '');
    ``name_fallback`` is the unified name when the code is unmapped.
    """
    code = pystrip(F.col(code_col).cast("string"))
    if blank_as is not None:
        code = F.when(F.col(code_col).isNull() | (code == ""), F.lit(blank_as)).otherwise(code)
    tmp = df.withColumn("__code", code)
    m = course_map(spark)
    out = tmp.join(m, tmp["__code"] == m["map_code"], "left")
    out = out.withColumn(out_code, F.coalesce(F.col("unified_code"), F.col("__code")))
    if out_name:
        fb = name_fallback if name_fallback is not None else F.col("__code")
        out = out.withColumn(out_name, F.coalesce(F.col("unified_name"), fb))
    return out.drop("map_code", "unified_code", "unified_name", "__code")


def linked_values(facts: DataFrame, links: DataFrame, key: str, by: str, value: str) -> DataFrame:
    """The distinct (key, value) of ``facts`` (key, by) joined with ``links`` (by, value; value not NULL).

    The join has a row for each fact and value of its link.  Values are numbered, and the values of a link are kept as the
    bits of numbers, 64 values in each, so that a fact joins one row for every 64 values at most, and what a key has is the
    bitwise or of its facts' numbers; the bits become values again when keys are distinct."""
    links = links.distinct()
    numbers = sequential_ids(links.select(value).distinct(), [F.col(value)], "__n")
    numbers = numbers.select(value, F.shiftright(F.col("__n") - 1, 6).alias("__word"),
                             F.expr("shiftleft(1L, CAST((__n - 1) % 64 AS INT))").alias("__bit"))
    sets = links.join(numbers, value).groupBy(by, "__word").agg(F.bit_or("__bit").alias("__bits"))
    found = facts.join(sets, by).groupBy(key, "__word").agg(F.bit_or("__bits").alias("__bits"))
    found = found.join(numbers.withColumnRenamed("__word", "__w"), (F.col("__word") == F.col("__w"))
                       & (F.col("__bits").bitwiseAND(F.col("__bit")) != 0))
    return found.select(key, value)


def anti_keys(a: DataFrame, b: DataFrame, keys: list[str], drop_null: bool = True) -> DataFrame:
    """Distinct keys of ``a`` missing from ``b`` (NULL keys dropped)."""
    k = a.select(*keys)
    if drop_null:
        k = k.dropna(subset=keys)
    return k.join(b.select(*keys), keys, "left_anti").distinct()


def keep_with_parent(child: DataFrame, parent: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(children with a parent, rejected orphans)."""
    p = parent.select(*keys).distinct()
    return child.join(p, keys, "left_semi"), child.join(p, keys, "left_anti")


def latest_version(df: DataFrame, key: str, version: str) -> DataFrame:
    """Rows at the (lexicographic) MAX version of their key."""
    mx = df.groupBy(key).agg(F.max(version).alias("__v"))
    return df.join(mx, (df[key] == mx[key]) & (df[version] == mx["__v"]), "inner").drop(mx[key]).drop("__v")


def class_course(classes: DataFrame, subjects: DataFrame, grid: DataFrame, column: str = "curso") -> DataFrame:
    """The course of every class from the first table that has the column: the class itself, else its
    subject, else the grid (one row for each grid line of the subject).  Classes keep their other columns."""
    rest = [c for c in classes.columns if c != column]
    if column in classes.columns:
        source = subjects.select("disciplina").distinct()
        return classes.join(source, "disciplina").select(*rest, column)
    if column in subjects.columns:
        return classes.join(subjects.select("disciplina", column), "disciplina").select(*rest, column)
    subjects = subjects.select("disciplina").distinct()
    return classes.join(subjects, "disciplina").join(grid.select("disciplina", column), "disciplina").select(*rest, column)
