"""Keyed tables: merges that read and rewrite only the buckets that a load touches.

A row lives in bucket ``hash(key) mod buckets``; every bucket is a partition folder ``dados/versao=<load>/balde=<bucket>`` and
the current generation (``Generations``) says which load holds a bucket.  A load

1. prepares its rows once: one row a key (a key on a third of the rows is reduced by partial aggregates), or one row
   for each record without a whole key, which is a reject;
2. reads the touched buckets of the table, groups them with the load's rows by one shuffle on the bucket, and writes
   the new buckets with the same partitioning, one task a bucket;
3. takes its counts from that write (``observe``), and publishes: read = inserted + updated + kept by the load's
   rules + ignored + rejected.

Rejects are written by the same job, as bucket -1, dealt over many tasks.  Readers see the old generation until the
commit; of two loads from one generation one wins (``Conflict``).  Buckets double when the table outgrows them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.session import cut_lineage
from acadlake.tables.generations import Generations
from acadlake.tables.keys import key_is_whole

BUCKET, VERSION, ACTION, LOAD = "balde", "versao", "acao", "carga"
REJECTS = -1
REJECT_SALTS = 64
ROWS_PER_BUCKET = 2_000_000


class KeyedTable:
    """A table with unique keys under ``root``; see the module text."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], buckets: int = 8,
                 rows_per_bucket: int = ROWS_PER_BUCKET, zero_is_blank: bool = False):
        reserved = {BUCKET, VERSION, ACTION, LOAD} & set(schema.names)
        if reserved:
            raise ValueError(f"columns of a keyed table may not be named {sorted(reserved)}")
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self.columns = [c for c in schema.names if c not in keys]
        self.first_buckets, self.rows_per_bucket = buckets, rows_per_bucket
        self.zero_is_blank = zero_is_blank
        self.generations = Generations(spark, root)
        self._stored = T.StructType([*schema.fields, T.StructField(ACTION, T.StringType()), T.StructField(LOAD, T.LongType()),
                                     T.StructField(VERSION, T.StringType()), T.StructField(BUCKET, T.IntegerType())])

    # ------------------------------------------------------------------ readers
    def _folder(self, version: str, bucket: int) -> str:
        return f"{self.root}/dados/{version}/{BUCKET}={bucket}"

    def _scan(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).option("basePath", f"{self.root}/dados").parquet(*folders)

    def _state(self, generation: int | None = None) -> tuple[int, dict]:
        number, content = self.generations.current()
        if generation is not None:
            number, content = generation, self.generations.content(generation)
        return number, content or {"baldes": {}, "n": self.first_buckets, "linhas": 0}

    def scan(self, content: dict, buckets: set[int] | None = None) -> DataFrame:
        """The stored rows of some buckets: the other folders are not even listed, and the filter reaches the scan."""
        held = {int(b): v for b, v in content["baldes"].items()}
        df = self._scan([self._folder(v, b) for b, v in sorted(held.items()) if buckets is None or b in buckets])
        return df if buckets is None else df.where(F.col(BUCKET).isin(sorted(buckets)))

    def read(self, generation: int | None = None) -> DataFrame:
        return self.scan(self._state(generation)[1]).select(*self.schema.names)

    def read_load(self) -> DataFrame:
        """The table with what the last load did to each row (``acao``)."""
        number, content = self._state()
        acted = F.when(F.col(LOAD) == number, F.col(ACTION)).otherwise("keep")
        return self.scan(content).select(*self.schema.names, acted.alias(ACTION))

    def rejects(self) -> DataFrame:
        """The last load's records without a whole key."""
        held = self._state()[1].get("rejeitos")
        return self._scan([self._folder(held, REJECTS)] if held else []).select(*self.schema.names)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of a key set; only the buckets of these keys are read."""
        content = self._state()[1]
        wanted = keys.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys]).distinct()
        wanted = cut_lineage(wanted.withColumn(BUCKET, self._bucket(content["n"])), "keyed-lookup")
        touched = {r[0] for r in wanted.select(BUCKET).distinct().collect()}        # at most the number of buckets
        return self.scan(content, touched).join(wanted, [*self.keys, BUCKET], "left_semi").select(*self.schema.names)

    def rows(self) -> int:
        """The number of stored rows, without reading any."""
        return self._state()[1]["linhas"]

    def load_stats(self) -> dict:
        """The last load's counts."""
        return self._state()[1].get("contagem", {})

    # ------------------------------------------------------------------ loads
    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int")

    def _prepared(self, source: DataFrame, order: list[str], pick: str, n: int) -> DataFrame:
        """(keys, balde, sal, rejeito, s, n): the load's rows, one a key; rejects one a record."""
        typed = {f.name: f.dataType for f in self.schema.fields}
        src = source.select(*[F.col(c).cast(typed[c]).alias(c) if c in typed else F.col(c) for c in source.columns])
        rest = [c for c in source.columns if c not in self.keys and c not in order]
        whole = F.coalesce(key_is_whole(self.schema, self.keys, self.zero_is_blank), F.lit(False))
        number = F.when(~whole, F.monotonically_increasing_id())
        src = src.withColumn("rejeito", number).withColumn(
            BUCKET, F.when(F.col("rejeito").isNull(), self._bucket(n)).otherwise(F.lit(REJECTS))).withColumn(
            "sal", F.when(whole, 0).otherwise(F.pmod(F.xxhash64("rejeito"), F.lit(REJECT_SALTS))).cast("int"))
        row = F.struct(F.lit(True).alias("__s"), *[F.col(c) for c in [*order, *rest]])
        best = (F.max if pick == "last" else F.min)(row)
        return src.groupBy(*self.keys, BUCKET, "sal", "rejeito").agg(best.alias("s"), F.count("*").alias("lidos"))

    def _apply(self, source: DataFrame, order: list[str], pick: str, change: Callable[[Column, Column, str], Column],
               action: Column, note: dict | None = None) -> dict:
        """``change(t, s, column)`` gives a column's new value from the stored row ``t`` and the load's row ``s`` (both
        may be NULL); ``action`` what happens to a key: insert, update, keep, none (no row) or delete.  ``note`` is
        published with the load (progress of the loader, say) and kept by later loads."""
        number, content = self._state()
        n = content["n"]
        prepared = cut_lineage(self._prepared(source, order, pick, n), "keyed-load")
        touched = {r[0] for r in prepared.select(BUCKET).distinct().collect()}      # at most buckets + 1 numbers
        rows = content["linhas"] or prepared.count()
        while rows > n * self.rows_per_bucket:
            n *= 2
        if n != content["n"]:                       # outgrown: every row is dealt anew
            touched = set(range(n)) | touched & {REJECTS}
            prepared = prepared.withColumn(BUCKET, F.when(F.col(BUCKET) != REJECTS, self._bucket(n)).otherwise(REJECTS))
            stored = self.scan(content).withColumn(BUCKET, self._bucket(n))
        else:
            stored = self.scan(content, touched - {REJECTS})
        row = F.struct(*self.columns, ACTION, LOAD) if self.columns else F.struct(ACTION, LOAD)
        stored = stored.select(*self.keys, BUCKET, F.lit(0).alias("sal"), F.lit(None).cast("bigint").alias("rejeito"),
                               row.alias("t"))
        both = stored.unionByName(prepared, allowMissingColumns=True)
        # one shuffle, by bucket: the grouping and the partitioned write both follow it
        group = [BUCKET, "sal", *self.keys, "rejeito"]
        both = both.repartition(BUCKET, "sal").groupBy(*group).agg(
            F.max("t").alias("t"), F.max("s").alias("s"), F.max("lidos").alias("lidos"))
        t, s = F.col("t"), F.col("s")
        acted = (F.when(F.col("rejeito").isNotNull(), "reject").when(s.isNull(), "stay").otherwise(action))
        payload = set(prepared.schema["s"].dataType.names)
        new = []
        for c in self.columns:
            given = s[c] if c in payload else F.lit(None).cast(self.schema[c].dataType)
            changed = change(t, s, c)
            new.append(F.when(F.col("a") == "stay", t[c]).when(F.col("a") == "reject", given).otherwise(changed).alias(c))
        both = both.withColumn("a", acted)
        seen = Observation()
        read, one = F.col("lidos"), F.col("a")

        def total(condition: Column, value: Column) -> Column:
            return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

        both = both.observe(
            seen, total(read.isNotNull(), read).alias("lidos"), F.count_if(one == "insert").alias("inseridos"),
            F.count_if(one == "update").alias("atualizados"), F.count_if(one == "delete").alias("removidos"),
            F.count_if(one.isin("keep", "none")).alias("inalterados"),
            total((one != "reject") & read.isNotNull(), read - 1).alias("ignorados"),
            total(one == "reject", read).alias("rejeitados"))
        both = both.where(~one.isin("delete", "none"))
        did = F.when(one.isin("stay", "keep"), F.col(f"t.{ACTION}")).otherwise(one)
        when = F.when(one.isin("stay", "keep"), F.col(f"t.{LOAD}")).otherwise(F.lit(number + 1)).cast("bigint")
        out = both.select(*self.keys, *new, did.alias(ACTION), when.alias(LOAD), BUCKET)
        out = out.select(*self.schema.names, ACTION, LOAD, BUCKET)
        version = self.generations.new_folder(VERSION)
        out.write.partitionBy(BUCKET).parquet(f"{self.root}/dados/{version}")
        counts = {k: int(v) for k, v in seen.get.items()}
        return self._publish(number, content, version, touched, n, counts, note)

    def _publish(self, number: int, content: dict, version: str, touched: set[int], n: int, counts: dict,
                 note: dict | None = None) -> dict:
        prefix = f"{BUCKET}="
        written = {int(f.getPath().getName().removeprefix(prefix)) for f in self.generations._listed(f"dados/{version}")
                   if f.getPath().getName().startswith(prefix)}
        held = {b: v for b, v in content["baldes"].items() if int(b) not in touched and n == content["n"]}
        held |= {str(b): version for b in written if b != REJECTS}
        rows = content["linhas"] + counts["inseridos"] - counts["removidos"]
        self.generations.publish(number, {
            "baldes": held, "n": n, "linhas": rows, "contagem": counts, "tocados": sorted(touched - {REJECTS}),
            "rejeitos": version if REJECTS in written else None, "nota": content.get("nota", {}) | (note or {})})
        return counts

    def note(self) -> dict:
        """What loads have noted, the last value of each name."""
        return self._state()[1].get("nota", {})

    def add_note(self, note: dict) -> None:
        """A generation with the same rows and one more note."""
        number, content = self._state()
        self.generations.publish(number, content | {"nota": content.get("nota", {}) | note})

    def upsert(self, source: DataFrame, order: list[str] | None = None, keep_old: bool = False) -> dict:
        """M1: the last row of a key is inserted or overwrites every column; ``keep_old`` (M2): its NULLs do not."""
        given = set(source.columns)

        def change(t: Column, s: Column, c: str) -> Column:
            if c not in given:
                return t[c]
            return F.coalesce(s[c], t[c]) if keep_old else s[c]

        action = F.when(F.col("t").isNull(), "insert").otherwise("update")
        return self._apply(source, order or [], "last", change, action)

    def insert_absent(self, source: DataFrame, order: list[str] | None = None) -> dict:
        """M3: the first row of a key that is not stored yet."""
        given = set(source.columns)

        def change(t: Column, s: Column, c: str) -> Column:
            new = s[c] if c in given else F.lit(None)
            return F.when(F.col("t").isNull(), new).otherwise(t[c])

        return self._apply(source, order or [], "first", change, F.when(F.col("t").isNull(), "insert").otherwise("keep"))

    def lowest_wins(self, source: DataFrame, order: list[str], note: dict | None = None) -> dict:
        """T5: of all rows of a key ever loaded, the lowest by ``order`` (stored columns) stays, however late it comes."""
        place = lambda x: F.struct(*[x[c] for c in order])
        lower = F.col("t").isNull() | (place(F.col("s")) < place(F.col("t")))

        def change(t: Column, s: Column, c: str) -> Column:
            return F.when(lower, s[c]).otherwise(t[c])

        action = F.when(F.col("t").isNull(), "insert").when(lower, "update").otherwise("keep")
        return self._apply(source, order, "first", change, action, note)

    def delete(self, keys: DataFrame, note: dict | None = None) -> dict:
        """Remove the rows of a key set."""
        action = F.when(F.col("t").isNull(), "none").otherwise("delete")
        return self._apply(keys.select(*self.keys), [], "last", lambda t, s, c: t[c], action, note)

    def guarded_delete(self, live: DataFrame, max_fraction: float = 0.5) -> dict:
        """M6: remove rows whose key is not live, unless they are more than ``max_fraction`` of the table or nothing is
        live.  The comparison reads key columns only; the removal rewrites the buckets of the removed keys."""
        content = self._state()[1]
        gone = cut_lineage(self.read().select(*self.keys).join(live.select(*self.keys).distinct(), self.keys, "left_anti"),
                           "keyed-obsolete")
        total, obsolete = content["linhas"], gone.count()
        aborted = live.isEmpty() or obsolete > total * max_fraction
        if obsolete and not aborted:
            self.delete(gone)
        return {"total": total, "obsoletos": obsolete, "abortado": aborted, "removidos": 0 if aborted else obsolete}

    def rewrite_if_unchanged(self, updates: DataFrame, column: str, old: str = "valor_antigo", new: str = "valor_novo") -> dict:
        """``new`` goes into ``column`` where the stored value still equals ``old``."""
        t, s = F.col("t"), F.col("s")
        hit = t.isNotNull() & s[old].isNotNull() & t[column].eqNullSafe(s[old])
        changed = hit & ~s[old].eqNullSafe(s[new])

        def change(t: Column, s: Column, c: str) -> Column:
            return F.when(hit, s[new]).otherwise(t[c]) if c == column else t[c]

        action = F.when(t.isNull(), "none").when(changed, "update").otherwise("keep")
        return self._apply(updates.select(*self.keys, old, new), [], "last", change, action)

    # ------------------------------------------------------------------ generations
    def reset(self) -> int:
        """An empty generation; every process that opens the table finds it empty."""
        number, content = self._state()
        return self.generations.publish(number, {"baldes": {}, "n": content["n"], "linhas": 0})

    def expire(self, keep_seconds: float, now: float | None = None) -> list[str]:
        """Remove versions that were superseded more than ``keep_seconds`` ago."""
        def named(content: dict) -> set[str]:
            return {*content.get("baldes", {}).values(), content.get("rejeitos")}

        return self.generations.expire(keep_seconds, "dados", named, now)
