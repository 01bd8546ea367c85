"""Data-quality and analysis jobs: formula rewrite (Q6), run report (Q5),
snapshot stability (Q8), referential audit (Q9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadlake.functions.scalars import _c, pystrip
from acadlake.operators import ordering as O
from acadlake.session import cut_lineage
from acadlake.tables.generations import Generations


# --------------------------------------------------------------------------- Q6

def _formula_items(x) -> Column:
    """Tokens '(tipo)SUBJECT' -> array<struct<tipo:int, disc:string>>, malformed tokens skipped."""
    clean = F.regexp_replace(_c(x), r"[\r\n ]", "")
    tokens = F.filter(F.split(clean, ","), lambda t: t != "")
    parsed = F.transform(tokens, lambda t: F.struct(
        F.when(F.instr(t, ")") > 1, F.substring(t, F.lit(2), F.instr(t, ")") - 2).try_cast("int")).alias("tipo"),
        pystrip(F.substring(t, F.instr(t, ")") + 1, F.length(t))).alias("disc"),
        (F.instr(t, ")") > 0).alias("ok")))
    return F.filter(parsed, lambda it: it["ok"] & it["tipo"].isNotNull() & (it["disc"] != ""))


def rewrite_formula(x) -> Column:
    """Q6: '(1)MAT, (1)FIS, (2)QUI' -> '(MAT E FIS) OU QUI'; malformed tokens skipped; blank -> ''.

    Consecutive items of the same type form one group (a per-row fold, no shuffle).
    """
    items = _formula_items(x)
    init = F.struct(F.lit(None).cast("int").alias("tipo"),
                    F.array().cast("array<array<string>>").alias("grupos"))

    def step(acc, it):
        same = acc["tipo"].isNotNull() & (acc["tipo"] == it["tipo"])
        n = F.size(acc["grupos"])
        extended = F.concat(F.slice(acc["grupos"], 1, n - 1),
                            F.array(F.concat(F.element_at(acc["grupos"], -1), F.array(it["disc"]))))
        appended = F.concat(acc["grupos"], F.array(F.array(it["disc"])))
        return F.struct(it["tipo"].alias("tipo"), F.when(same, extended).otherwise(appended).alias("grupos"))

    groups = F.aggregate(items, init, step)["grupos"]
    parts = F.transform(groups, lambda g: F.when(F.size(g) == 1, g[0])
                        .otherwise(F.concat(F.lit("("), F.array_join(g, " E "), F.lit(")"))))
    out = F.array_join(parts, " OU ")
    blank = _c(x).isNull() | (pystrip(_c(x)) == "")
    return F.when(blank, F.lit("")).otherwise(out)


def formula_items(df: DataFrame, key: str, col: str) -> DataFrame:
    """Q6 long form: one row per valid item with its position and group (W8 islands)."""
    items = df.select(key, F.posexplode(_formula_items(col)).alias("pos", "it"))
    items = items.select(key, F.col("pos").cast("bigint").alias("pos"), F.col("it.tipo").cast("bigint").alias("tipo"),
                         F.col("it.disc").alias("disciplina"))
    return O.islands(items, [key], "pos", "tipo", "grupo")


# --------------------------------------------------------------------------- Q5

def run_summary(log: DataFrame, module: str, status: str, seconds: str, rows: str | None = None) -> DataFrame:
    """Per step: runs, successes, failures, elapsed and throughput."""
    aggs = [F.count(F.lit(1)).alias("execucoes"),
            F.count_if(F.col(status) == "sucesso").cast("bigint").alias("sucessos"),
            F.count_if(F.col(status) != "sucesso").cast("bigint").alias("falhas"),
            F.round(F.sum(seconds), 4).alias("segundos")]
    out = log.groupBy(module).agg(*aggs)
    return out.withColumn("execucoes_por_segundo",
                          F.when(F.col("segundos") > 0, F.round(F.col("execucoes") / F.col("segundos"), 4)))


# --------------------------------------------------------------------------- Q8

def page_snapshot(df: DataFrame, key: str, page: str) -> DataFrame:
    """Keys per page (a page holds a bounded number of keys, e.g. 100)."""
    return df.groupBy(page).agg(F.array_sort(F.collect_set(key)).alias("chaves"))


def snapshot_diff(current: DataFrame, previous: DataFrame, page: str = "pagina") -> DataFrame:
    """Per page, sizes now / before and keys added / removed (sorted, comma-joined)."""
    c = current.select(page, F.col("chaves").alias("atual"))
    p = previous.select(page, F.col("chaves").alias("anterior"))
    j = c.join(p, page, "full_outer")
    a = F.coalesce("atual", F.array().cast("array<bigint>"))
    b = F.coalesce("anterior", F.array().cast("array<bigint>"))
    added, removed = F.array_except(a, b), F.array_except(b, a)
    return j.select(page, F.size(a).cast("bigint").alias("tamanho_atual"),
                    F.size(b).cast("bigint").alias("tamanho_anterior"),
                    (F.size(added) + F.size(removed) == 0).alias("identica"),
                    _joined(added).alias("chaves_adicionadas"), _joined(removed).alias("chaves_removidas"))


PAGES_PER_FOLDER = 256


def page_digests(df: DataFrame, key: str, page: str) -> DataFrame:
    """(page, n, soma, mistura): an order-free digest of the distinct keys of each page."""
    h = F.xxhash64(key)
    return df.select(page, key).where(F.col(key).isNotNull()).distinct().groupBy(page).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.pmod(h, F.lit(1 << 40))).alias("soma"), F.bit_xor(h).alias("mistura"))


class SnapshotStore:
    """Stored snapshots of the keys of pages.

    A snapshot holds a digest a page and the keys themselves, in a folder for each range of pages.  A comparison joins
    digests, which are narrow; keys are read only for pages whose digest differs, and only from the folders of these."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.generations = spark, Generations(spark, root)

    def _folder(self, name: str) -> str:
        return f"{self.generations.root}/dados/{self.generations.current()[1]['pasta']}/{name}"

    @staticmethod
    def _pages(df: DataFrame, key: str, page: str) -> DataFrame:
        return df.select(F.col(page).alias("pagina"), F.col(key).alias("chave"),
                         F.floor(F.col(page) / PAGES_PER_FOLDER).cast("bigint").alias("faixa"))

    def save(self, df: DataFrame, key: str, page: str) -> None:
        """Store the keys of ``df`` by page as the snapshot to compare with."""
        base, folder = self.generations.current()[0], self.generations.new_folder()
        path = f"{self.generations.root}/dados/{folder}"
        keys = self._pages(df, key, page).where(F.col("chave").isNotNull()).distinct()
        keys.hint("rebalance", F.col("faixa")).sortWithinPartitions("faixa", "pagina").write.partitionBy("faixa").parquet(f"{path}/chaves")
        page_digests(self.spark.read.parquet(f"{path}/chaves"), "chave", "pagina").write.parquet(f"{path}/resumo")
        self.generations.publish(base, {"pasta": folder})

    def stored_keys(self, changed: DataFrame) -> DataFrame:
        """The stored keys of changed pages (pagina, faixa, mudou = 1)."""
        return self.spark.read.parquet(self._folder("chaves")).join(changed, ["faixa", "pagina"], "left_semi")

    def compare(self, df: DataFrame, key: str, page: str) -> DataFrame:
        """Pages of ``df`` against the stored snapshot, in the columns of ``snapshot_diff``."""
        now = self._pages(df, key, page)
        a = page_digests(now, "chave", "pagina").alias("a")
        b = self.spark.read.parquet(self._folder("resumo")).alias("b")
        j = a.join(b, F.col("a.pagina") == F.col("b.pagina"), "full_outer")
        same = F.struct("a.n", "a.soma", "a.mistura").eqNullSafe(F.struct("b.n", "b.soma", "b.mistura"))
        pages = cut_lineage(j.select(
            F.coalesce("a.pagina", "b.pagina").alias("pagina"), F.coalesce("a.n", F.lit(0)).alias("tamanho_atual"),
            F.coalesce("b.n", F.lit(0)).alias("tamanho_anterior"), F.when(same, 0).otherwise(1).alias("mudou")), "snapshot-pages")
        changed = pages.where(F.col("mudou") == 1).select(
            "pagina", F.floor(F.col("pagina") / PAGES_PER_FOLDER).cast("bigint").alias("faixa"), "mudou")
        new = now.join(changed, ["faixa", "pagina"], "left_semi").where(F.col("chave").isNotNull())
        sides = new.select("pagina", "chave", F.lit(1).alias("lado")).unionByName(
            self.stored_keys(changed).select("pagina", "chave", F.lit(2).alias("lado")))
        found = sides.groupBy("pagina", "chave").agg(F.bit_or("lado").alias("lado")).where("lado < 3")
        # a page holds a bounded number of keys
        diff = found.groupBy("pagina").agg(*[F.collect_list(F.when(F.col("lado") == n, F.col("chave"))).alias(name)
                                             for n, name in ((1, "novas"), (2, "idas"))])
        none = F.array().cast(diff.schema["novas"].dataType)
        out = pages.join(diff.withColumnRenamed("pagina", "p"), F.col("pagina") == F.col("p"), "left")
        return out.select("pagina", F.col("tamanho_atual").cast("bigint"), F.col("tamanho_anterior").cast("bigint"),
                          (F.col("mudou") == 0).alias("identica"), _joined(F.coalesce("novas", none)).alias("chaves_adicionadas"),
                          _joined(F.coalesce("idas", none)).alias("chaves_removidas"))


def _joined(arr: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(arr), lambda x: x.cast("string")), ",")


# --------------------------------------------------------------------------- Q9

def referential_audit(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Q9: for each (name, child, child column, parent, parent column): orphan keys."""
    out = None
    for name, child, ccol, parent, pcol in checks:
        keys = child.select(F.col(ccol).alias("chave")).where(F.col("chave").isNotNull()).distinct()
        orphans = keys.join(parent.select(F.col(pcol).alias("chave")).distinct(), "chave", "left_anti")
        part = orphans.select(F.lit(name).alias("verificacao"), "chave")
        out = part if out is None else out.unionByName(part)
    return out
