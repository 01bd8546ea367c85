"""Aggregations.

Everything is one ``groupBy``/``agg`` pass with partial (map-side)
aggregation; no group is collected into a list.  Counts are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acadlake.functions import constants as K
from acadlake.session import cut_lineage


def profile(df: DataFrame, distinct_cols: list[str], conditions: dict[str, Column] | None = None,
            max_col: str | None = None, approx: bool = False) -> DataFrame:
    """A1: table profile (rows, distinct per column, conditional counts, max stamp).

    Rows, conditions and maximum are one pass.  Each exact distinct count is a two-level aggregate over its own column
    alone: no row is copied once a column (as several distinct counts in one aggregate would), and on columnar files
    each column is read once.  ``approx=True`` takes HyperLogLog estimates in the one pass instead.
    """
    aggs = {"total_rows": F.count(F.lit(1))}
    for name, cond in (conditions or {}).items():
        aggs[name] = F.count_if(cond).cast("bigint")
    if max_col:
        aggs[f"max_{max_col}"] = F.max(max_col)
    if approx:
        aggs |= {f"distinct_{c}": F.approx_count_distinct(c).cast("bigint") for c in distinct_cols}
    parts = [df.agg(*[v.alias(k) for k, v in aggs.items()])]
    if not approx:
        parts += [df.select(F.col(c).alias("v")).where(F.col("v").isNotNull()).distinct()
                  .agg(F.count(F.lit(1)).alias(f"distinct_{c}")) for c in distinct_cols]
    out = parts[0]
    for p in parts[1:]:                     # rows of one value each: they meet in one row, without a join
        out = out.unionByName(p, allowMissingColumns=True)
    names = ["total_rows", *[f"distinct_{c}" for c in distinct_cols], *(conditions or {}),
             *([f"max_{max_col}"] if max_col else [])]
    return out.agg(*[F.max(n).alias(n) for n in names])


LG_K = 14               # sketches of 2^14 registers: a standard error of 0.8 / 2^7
SKETCH_ERROR = 3 * 0.8 / 2 ** (LG_K / 2)        # three standard errors


def sketches(df: DataFrame, load: str, cols: list[str]) -> DataFrame:
    """A1/A5 by load: one row for each load and column, with its rows, the non-NULL ones and a mergeable sketch.

    A load's sketches are written once with it; profiles of any range of loads need no row of it again."""
    one = df.groupBy(load).agg(F.count(F.lit(1)).alias("linhas"),
                               *[F.count(F.col(c)).alias(f"n_{c}") for c in cols],
                               *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"s_{c}") for c in cols])
    packed = F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(f"n_{c}").alias("preenchidas"),
                                          F.col(f"s_{c}").alias("esboco")) for c in cols]))
    return one.select(F.col(load), "linhas", packed.alias("x")).select(load, "linhas", "x.*")


def merged_profile(stored: DataFrame) -> DataFrame:
    """Rows, non-NULL rows and estimated distinct values of each column over the loads in ``stored``; duplicates (A5)
    are the non-NULL rows beyond the distinct values."""
    out = stored.groupBy("coluna").agg(
        F.sum("linhas").alias("linhas"), F.sum("preenchidas").alias("preenchidas"),
        F.hll_sketch_estimate(F.hll_union_agg("esboco")).alias("distintos"))
    return out.withColumn("duplicados", F.greatest(F.lit(0).cast("bigint"), F.col("preenchidas") - F.col("distintos")))


def frequency_top(df: DataFrame, col: str, n: int | None = None, label: str = K.NOT_INFORMED,
                  name: str = "valor") -> DataFrame:
    """A2 (top n) / A3 (n=None): value counts, NULL shown as a label, ties by value."""
    out = (df.groupBy(F.coalesce(F.col(col).cast("string"), F.lit(label)).alias(name))
           .agg(F.count(F.lit(1)).alias("quantidade")))
    if n is None:
        return out
    return out.orderBy(F.desc("quantidade"), F.asc(name)).limit(n)


def active_split(df: DataFrame, flag: str, active_value: str = "S") -> DataFrame:
    """A4: active / inactive counts in one pass."""
    return df.agg(F.count_if(F.col(flag) == active_value).cast("bigint").alias("ativos"),
                  F.count_if(~(F.col(flag) == active_value) | F.col(flag).isNull()).cast("bigint").alias("inativos"))


def duplicate_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """A5: rows, distinct keys, duplicates = rows - distinct keys.

    Two-level aggregation (per key, then total) so a hot key is reduced map-side.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.sum("__n").cast("bigint").alias("total_registros"),
                       F.count(F.lit(1)).cast("bigint").alias("chaves_distintas")) \
        .withColumn("duplicados", F.col("total_registros") - F.col("chaves_distintas"))


def duplicate_members(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Members of groups sharing ``key`` (size > 1), long form with the group size.

    Group sizes are a partial aggregate; members are joined back, so no group is
    ever materialised as a list (AQE splits a skewed key on the join).
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("tamanho_grupo")).where("tamanho_grupo > 1")
    return df.select(key, *cols).join(sizes, key, "inner")


def count_with_total(df: DataFrame, keys: list[str], name: str = "total_por_grupo",
                     total: str = "total_geral") -> DataFrame:
    """Count per group beside the grand total, which is the sum of the group counts: the input is read once."""
    g = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), "group-counts")
    everything = g.agg(F.coalesce(F.sum(name), F.lit(0))).first()[0]
    return g.withColumn(total, F.lit(everything).cast("bigint"))


def pivot_counts(df: DataFrame, row: str, col: str, values: list[str]) -> DataFrame:
    """A10: row x level matrix of counts (one pass); the total counts every row, also those
    whose level is NULL or not listed."""
    return df.groupBy(row).agg(*[F.count_if(F.col(col) == v).cast("bigint").alias(v) for v in values],
                               F.count(F.lit(1)).cast("bigint").alias("total"))


def first_non_blank(df: DataFrame, keys: list[str], value: str, pos: str, name: str | None = None) -> DataFrame:
    """Value of the first row (by position) where it is not blank."""
    ok = F.col(value).isNotNull() & (F.trim(F.col(value)) != "")
    return (df.where(ok).groupBy(*keys)
            .agg(F.min_by(F.col(value), F.col(pos)).alias(name or value)))
