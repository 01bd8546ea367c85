"""Table maintenance (M1-M15): merge, refresh, sweep, evolve, version swap.

Plain Parquet tables have no MERGE.  Here are the pure functions
``(target, source, ...) -> new state`` (plus an ``acao`` column or a one-row
statistics frame) on whole DataFrames; a stored table is merged by
``acadlake.tables.keyed.KeyedTable``, which rewrites touched buckets only, or is
replaced as a new version (``VersionedTable``), so a failed run leaves the old one.

Presence of a side in a merge is decided by a marker column, never by the
nullness of data, so an update may legitimately write NULLs (M1) or keep the
old value where the source is NULL (M2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.operators import ordering as O
from acadlake.operators import relational as J
from acadlake.operators.pairs import Pairs
from acadlake.session import cut_lineage
from acadlake.tables.generations import Generations
from acadlake.tables.keys import key_is_whole


def split_by_key(source: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key columns are all present, the others): a record without a whole key never enters a merge."""
    whole = F.coalesce(key_is_whole(source.schema, keys), F.lit(False))
    return source.where(whole), source.where(~whole)


def _merge(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None,
           null_preserving: bool, created: str | None, updated: str | None, run_ts) -> DataFrame:
    cols = [c for c in target.columns if c not in keys and c not in (created, updated)]
    source, _ = split_by_key(source, keys)
    src = source.select(*keys, *[c for c in cols if c in source.columns], *(order or []))
    if order:
        src = O.pick_per_key(src, keys, order, keep="last")   # source applied in order: last wins
    src = src.select(*keys, *[F.col(c).alias("__s_" + c) for c in cols if c in source.columns]) \
        .withColumn("__s", F.lit(True))
    tgt = target.withColumn("__t", F.lit(True))
    j = tgt.join(src, keys, "full_outer")
    s_on, t_on = F.col("__s").isNotNull(), F.col("__t").isNotNull()
    out = []
    for c in cols:
        if c not in source.columns:
            out.append(F.col(c).alias(c))
            continue
        new = F.coalesce(F.col("__s_" + c), F.col(c)) if null_preserving else F.col("__s_" + c)
        out.append(F.when(s_on, new).otherwise(F.col(c)).alias(c))
    action = F.when(s_on & t_on, F.lit("update")).when(s_on, F.lit("insert")).otherwise(F.lit("keep"))
    stamps = []
    if created:
        stamps.append(F.when(t_on, F.col(created)).otherwise(F.lit(run_ts)).alias(created))
    if updated:
        stamps.append(F.when(s_on, F.lit(run_ts)).otherwise(F.col(updated)).alias(updated))
    return j.select(*keys, *out, *stamps, action.alias("acao"))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None,
           created: str | None = None, updated: str | None = None, run_ts=None) -> DataFrame:
    """M1: insert new keys, overwrite every non-key column of matched keys (NULL included)."""
    return _merge(target, source, keys, order, False, created, updated, run_ts)


def upsert_keep_old(target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None,
                    created: str | None = None, updated: str | None = None, run_ts=None) -> DataFrame:
    """M2: as M1, but a NULL source field keeps the stored value."""
    return _merge(target, source, keys, order, True, created, updated, run_ts)


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """M3: source rows whose key is absent from the target (first per key) are appended."""
    source, _ = split_by_key(source, keys)
    new = source.join(target.select(*keys), keys, "left_anti")
    new = O.pick_per_key(new, keys, order, keep="first").select(*target.columns)
    return target.withColumn("acao", F.lit("keep")).unionByName(new.withColumn("acao", F.lit("insert")))


def merge_statistics(merged: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """One row of counts: rows read, inserted, updated, kept, processed; ignored (read rows that a later
    row of their key replaced) and errors (read rows without a whole key)."""
    counts = merged.agg(
        F.count_if(F.col("acao") == "insert").cast("bigint").alias("inseridos"),
        F.count_if(F.col("acao") == "update").cast("bigint").alias("atualizados"),
        F.count_if(F.col("acao") == "keep").cast("bigint").alias("mantidos"),
        F.count_if(F.col("acao") != "keep").cast("bigint").alias("processados"))
    whole = F.coalesce(key_is_whole(source.schema, keys), F.lit(False))
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    read = per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("lidos"),
                       F.coalesce(F.sum(F.when(whole, F.col("__n") - 1)), F.lit(0)).cast("bigint").alias("ignorados"),
                       F.coalesce(F.sum(F.when(~whole, F.col("__n"))), F.lit(0)).cast("bigint").alias("erros")).first()
    return counts.select("*", *[F.lit(read[c]).cast("bigint").alias(c) for c in ("lidos", "ignorados", "erros")])


def full_refresh(target: DataFrame, source: DataFrame, required: list[str], numeric: tuple = (),
                 empty_policy: str = "keep") -> tuple[DataFrame, DataFrame]:
    """M4/M5: new state = valid source rows; reject counts; empty source -> keep or clear.

    The emptiness test is one ``limit(1)`` probe; statistics are one aggregate.
    """
    source = cut_lineage(source, "refresh-source")       # probed, counted and written: computed once
    valid, _ = J.split_required(source, required, numeric)
    ok = J.conj(J.present(c, numeric=c in numeric) for c in required) if required else F.lit(True)
    stats = source.agg(F.count(F.lit(1)).alias("lidos"),
                       F.count_if(ok).cast("bigint").alias("validos"),
                       F.count_if(~ok).cast("bigint").alias("rejeitados"))
    if source.isEmpty():
        state = target if empty_policy == "keep" else target.limit(0)
    else:
        state = valid.select(*target.columns)
    return state, stats


def guarded_delete(target: DataFrame, live_keys: DataFrame, keys: list[str], max_fraction: float = 0.5
                   ) -> tuple[DataFrame, dict]:
    """Drop target rows whose key is not live, unless they exceed ``max_fraction``
    of the table (abort: nothing deleted) or the live set is empty (nothing to compare)."""
    live = live_keys.select(*keys).distinct().withColumn("__live", F.lit(True))
    marked = cut_lineage(target.join(live, keys, "left"), "guarded-delete")     # counted and returned: computed once
    row = marked.agg(F.count(F.lit(1)).alias("total"),
                     F.count_if(F.col("__live").isNull()).alias("obsoletos")).first()
    total, obsolete = int(row["total"]), int(row["obsoletos"])
    live_empty = live_keys.isEmpty()
    aborted = live_empty or (total > 0 and obsolete > total * max_fraction)
    stats = {"total": total, "obsoletos": obsolete, "abortado": aborted,
             "removidos": 0 if aborted else obsolete}
    state = (marked if aborted else marked.where(F.col("__live").isNotNull())).select(*target.columns)
    return state, stats


def changed_by_stamp(target: DataFrame, source: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """M7: source rows that are new or whose (normalised) change stamp differs (NULL-safe).

    A marker column tells a new key from a stored row without stamp."""
    t = target.select(*keys, F.col(stamp).alias("__old"), F.lit(True).alias("__t"))
    j = source.join(t, keys, "left")
    new = F.col("__t").isNull()
    return (j.where(new | ~F.col(stamp).eqNullSafe(F.col("__old")))
            .withColumn("acao", F.when(new, "insert").otherwise("update")).drop("__old", "__t"))


def mark_and_sweep(target: DataFrame, source: DataFrame, keys: list[str], null_safe: tuple = (),
                   status: str = "status") -> DataFrame:
    """M8: every stored row becomes 'N', rows seen in the source 'S', new rows inserted as 'S'.

    Key parts listed in ``null_safe`` are compared with ``<=>`` (P8)."""
    t = target.select(*keys).withColumn("__t", F.lit(True))
    s = source.select(*keys).distinct().select(*[F.col(k).alias("__s_" + k) for k in keys]).withColumn("__s", F.lit(True))
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col("__s_" + k)) if k in null_safe else (F.col(k) == F.col("__s_" + k))
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    return j.select(*[F.when(F.col("__t").isNotNull(), F.col(k)).otherwise(F.col("__s_" + k)).alias(k) for k in keys],
                    F.when(F.col("__s").isNotNull(), "S").otherwise("N").alias(status))


def class_course_update(classes: DataFrame, grid: DataFrame, shared: str = "999") -> tuple[DataFrame, DataFrame]:
    """M9: class course from the grid: one course -> it, several -> shared code; classes in a
    (subject, year, semester) group with more than one class are skipped, subjects absent
    from the grid keep their course, unchanged courses are not rewritten."""
    per_subject = (grid.where(F.col("disciplina").isNotNull() & F.col("curso").isNotNull())
                   .groupBy("disciplina").agg(F.count_distinct("curso").alias("__n"), F.min("curso").alias("__c"))
                   .select("disciplina", F.when(F.col("__n") > 1, F.lit(shared)).otherwise(F.col("__c")).alias("curso_novo")))
    base = classes.where(F.col("disciplina").isNotNull() & F.col("ano").isNotNull()
                         & F.col("semestre").isNotNull() & F.col("turma").isNotNull())
    sizes = base.groupBy("disciplina", "ano", "semestre").agg(F.count(F.lit(1)).alias("__g"))
    j = base.join(sizes, ["disciplina", "ano", "semestre"]).join(per_subject, "disciplina", "left")
    upd = (F.col("__g") == 1) & F.col("curso_novo").isNotNull() & ~F.col("curso").eqNullSafe(F.col("curso_novo"))
    state = j.select(*classes.columns, upd.alias("__u"), "curso_novo") \
        .withColumn("curso", F.when(F.col("__u"), F.col("curso_novo")).otherwise(F.col("curso"))) \
        .withColumn("acao", F.when(F.col("__u"), "update").otherwise("keep")).drop("__u", "curso_novo")
    stats = j.agg(F.count_if(F.col("__g") > 1).cast("bigint").alias("ignorados"),
                  F.count_if(F.col("__g") == 1).cast("bigint").alias("processados"),
                  F.count_if(upd).cast("bigint").alias("atualizados"))
    return state, stats


def flag_update(target: DataFrame, facts: DataFrame, key: str, fact_key: str, flag: str, value: str) -> DataFrame:
    """Set ``flag`` from the fact table where an answer exists; others untouched."""
    f = facts.select(F.col(fact_key).alias(key), F.col(value).alias("__new"))
    base = target if flag in target.columns else target.withColumn(flag, F.lit(None).cast("string"))
    j = base.join(f, key, "left")
    return j.withColumn(flag, F.coalesce(F.col("__new"), F.col(flag))).drop("__new")


def rewrite_if_unchanged(target: DataFrame, updates: DataFrame, keys: list[str], col: str,
                         old: str = "valor_antigo", new: str = "valor_novo") -> DataFrame:
    """Write ``new`` only where the stored value still equals ``old`` (optimistic match)."""
    u = updates.select(*keys, F.col(old).alias("__old"), F.col(new).alias("__new"))
    j = target.join(u, keys, "left")
    j = j.withColumn("__hit", F.col("__old").isNotNull() & F.col(col).eqNullSafe(F.col("__old")))
    return j.withColumn("acao", F.when(F.col("__hit") & ~F.col("__old").eqNullSafe(F.col("__new")), "update")
                        .otherwise("keep")) \
        .withColumn(col, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(col))) \
        .drop("__old", "__new", "__hit")


def evolve(df: DataFrame, schema: T.StructType, defaults: dict | None = None, required: tuple = ()) -> DataFrame:
    """Conform to ``schema``: add missing columns (default or NULL), widen/cast existing ones,
    drop unknown ones (declared-column projection, S8).  A stored table that lacks a ``required``
    column cannot be carried over: it is rebuilt empty, to be loaded anew."""
    defaults = defaults or {}
    if any(c not in df.columns for c in required):
        return df.sparkSession.createDataFrame([], schema)
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def rekey(df: DataFrame, parts: list[str], name: str = "id", drop: tuple = ()) -> DataFrame:
    """Replace an identity key by the deterministic composite key."""
    from acadlake.functions.scalars import composite_key
    return df.drop(*drop).withColumn(name, composite_key(*parts)).select(name, *[c for c in df.columns if c not in drop and c != name])


def deactivation_keys(system: DataFrame | Pairs, load: DataFrame | Pairs, keys: list[str], null_safe: tuple = ()) -> DataFrame:
    """Keys present in the system but absent from a complete load (pairs with the same right side: without shuffling
    their rows)."""
    if isinstance(system, Pairs) and isinstance(load, Pairs) and system.right is load.right and keys == system.columns and not null_safe:
        return system.absent(load)
    system, load = (x.rows() if isinstance(x, Pairs) else x for x in (system, load))
    # one shuffle for both: a key is grouped with its mark; a load's NULL equals none, unless the column is null-safe
    ld = load.select(*keys).dropna(subset=[k for k in keys if k not in null_safe])
    marked = system.select(*keys, F.lit(0).alias("__load")).unionByName(ld.withColumn("__load", F.lit(1)))
    return marked.groupBy(*keys).agg(F.max("__load").alias("__load")).where("__load = 0").drop("__load")


VALID, REJECTED = "situacao=valido", "situacao=rejeitado"


class VersionedTable:
    """Each write goes to a new version folder, and a numbered commit (``Generations``) makes it the current one.

    A write that fails, or whose stored rows do not add up (M4), leaves readers on the previous version; of two
    writers that started from the same version one wins, the other gets ``Conflict``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.generations = Generations(spark, self.root)

    def number(self) -> int:
        return self.generations.current()[0]

    def current(self) -> str | None:
        folder = self.generations.current()[1].get("pasta")
        return f"{self.root}/dados/{folder}" if folder else None

    def _scan(self, part: str = "") -> DataFrame:
        content = self.generations.current()[1]
        if "esquema" not in content:
            raise FileNotFoundError(f"no version under {self.root}")
        schema = T.StructType.fromJson(content["esquema"])
        if not content["pasta"] or (part and part not in content["partes"]):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.current()}{'/' + part if part else ''}")

    def read(self) -> DataFrame:
        return self._scan(VALID if self.generations.current()[1].get("partes") is not None else "")

    def rejects(self) -> DataFrame:
        """The records that the last ``refresh`` did not take."""
        return self._scan(REJECTED)

    def stats(self) -> dict:
        """The counts of the last ``refresh``."""
        return self.generations.current()[1].get("contagem", {})

    def refresh(self, source: DataFrame, required: list[str], numeric: tuple = (), empty_policy: str = "keep") -> dict:
        """M4/M5: the valid rows of ``source`` become the table.  One job writes valid rows and rejects apart and counts
        them; an extract without rows keeps the table or clears it."""
        base, content = self.generations.current()
        ok = F.coalesce(J.conj(J.present(c, numeric=c in numeric) for c in required), F.lit(False))
        folder, seen = self.generations.new_folder(), Observation()
        part, value = VALID.split("=")
        tagged = source.withColumn(part, F.when(ok, value).otherwise(REJECTED.split("=")[1])).observe(
            seen, F.count(F.lit(1)).alias("lidos"), F.count_if(F.col(part) == value).alias("validos"),
            F.count_if(F.col(part) != value).alias("rejeitados"))
        tagged.write.partitionBy(part).parquet(f"{self.root}/dados/{folder}")
        counts = {k: int(v) for k, v in seen.get.items()}
        new = {"pasta": folder, "linhas": counts["validos"], "esquema": source.schema.jsonValue(),
               "partes": [p for p, n in ((VALID, counts["validos"]), (REJECTED, counts["rejeitados"])) if n]}
        if not counts["lidos"]:
            kept = {"pasta": None, "linhas": 0, "esquema": source.schema.jsonValue(), "partes": []}
            new = content if content and empty_policy == "keep" else kept
        self.generations.publish(base, new | {"contagem": counts})
        return counts

    def write(self, df: DataFrame, partition_by: list[str] | None = None, expected: int | None = None,
              base: int | None = None) -> str:
        """``expected``: rows that must be stored (the valid rows of the load), counted by the write itself, else the
        version is not published.  ``base``: the generation that ``df`` was made from (now, if not given)."""
        base = self.number() if base is None else base
        folder, seen = self.generations.new_folder(), Observation()
        w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        version = f"{self.root}/dados/{folder}"
        w.parquet(version)
        if expected is not None and seen.get["n"] != expected:
            raise ValueError(f"{version}: {seen.get['n']} rows stored, {expected} valid rows expected")
        self.generations.publish(base, {"pasta": folder, "linhas": int(seen.get["n"]), "esquema": df.schema.jsonValue()})
        return version

    def expire(self, keep_seconds: float, now: float | None = None) -> list[str]:
        """Remove versions that were superseded more than ``keep_seconds`` ago."""
        return self.generations.expire(keep_seconds, "dados", lambda c: {c.get("pasta")}, now)
