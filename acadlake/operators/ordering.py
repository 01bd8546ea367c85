"""Per-key selection, sequencing and set operations.

"First / last row per key" is computed with a partial aggregate of a struct
(``min``/``max`` over (order columns, payload)) instead of a window: the map
side reduces every key to one row before the shuffle, so a key holding a third
of the table costs no more than any other key.  Windows are used only where
the rank itself is the output (W7, W9), and they are partitioned by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acadlake.session import cut_lineage


def pick_per_key(df: DataFrame, keys: list[str], order: list[str], keep: str = "first",
                 tiebreak_all: bool = True) -> DataFrame:
    """One row per key, smallest (``first``) or largest (``last``) by ``order``.

    Ties in ``order`` are broken by the remaining columns (a total order), so
    the result is deterministic.  NULLs sort first ascending / last descending.
    """
    rest = [c for c in df.columns if c not in keys and c not in order] if tiebreak_all else []
    payload = [c for c in df.columns if c not in keys and c not in order and c not in rest]
    fields = order + rest + payload
    st = F.struct(*[F.col(c) for c in fields])
    agg = F.min(st) if keep == "first" else F.max(st)
    out = df.groupBy(*keys).agg(agg.alias("__r"))
    return out.select(*keys, *[F.col("__r." + c).alias(c) for c in fields]).select(*df.columns)


def keep_first_with_rejects(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """First row per key is kept, every other row of the key is a key violation.

    Both sides are partial aggregates (no per-key sort in one task): the kept row
    is ``min(struct(order..., rest...))`` and the rejects are ``count - 1`` per key.
    """
    kept = pick_per_key(df, keys, order, keep="first")
    rejects = (df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("rejeitados"))
               .where(F.col("rejeitados") > 0))
    return kept, rejects


def sequential_ids(df: DataFrame, order: list[Column], name: str = "id", partitions: int | None = None) -> DataFrame:
    """Global 1..n id by a total sort order, without a single-partition window.

    Rows are range-partitioned and sorted by ``order``; each row's position in
    its partition comes from ``monotonically_increasing_id`` (partition index in
    the upper bits), partition sizes are counted (one row per partition) and
    turned into offsets.  Range boundaries come from sampling, so the positioned
    rows are checkpointed (reliable, shared checkpoint folder) before the sizes
    are counted: both uses then read the same materialised partitions, and a
    lost executor re-reads the checkpoint instead of re-sampling.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("__mid", F.monotonically_increasing_id())
    ranged = cut_lineage(ranged.withColumn("__pid", F.shiftright(F.col("__mid"), 33)))
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: the unpartitioned window only sees ``n`` rows
    offsets = sizes.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    out = ranged.join(F.broadcast(offsets), "__pid")
    pos = F.col("__mid") - F.shiftleft(F.col("__pid"), 33)
    return out.withColumn(name, (F.col("__off") + pos + 1).cast("bigint")).drop("__mid", "__pid", "__off")


def batch_numbers(df: DataFrame, index_col: str, size: int, name: str = "lote") -> DataFrame:
    """Fixed-size chunk number (0-based) from a 1-based sequential id."""
    return df.withColumn(name, F.floor((F.col(index_col) - 1) / size).cast("bigint"))


def key_runs(df: DataFrame, keys: list[str], order: list[Column], value: str | None = None,
             partitions: int | None = None) -> DataFrame:
    """Adds ``__pos``, the 0-based place of a row inside its key, and ``__run``, the 0-based number of its run of equal
    consecutive values (of ``value``; NULL differs from everything), in two levels, so that a hot key is many tasks' work.

    Rows are range-partitioned by key and order, so one key may lie in many partitions.  Places and run numbers are
    counted inside each partition first; a partition then needs from the ones before it only the last row, where that
    row's key began and how many runs there were: one small row a partition, summed up in order.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k) for k in keys]
    ranged = df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
    ranged = ranged.withColumn("__mid", F.monotonically_increasing_id())
    ranged = cut_lineage(ranged.withColumn("__pid", F.shiftright(F.col("__mid"), 33)), "key-runs")
    key = F.struct(*keys)
    val = F.col(value) if value else F.lit(0)
    place = F.col("__mid") - F.shiftleft(F.col("__pid"), 33)
    ends = cut_lineage(ranged.groupBy("__pid").agg(
        F.count(F.lit(1)).alias("n"), F.max_by(key, "__mid").alias("k"), F.max_by(F.struct(val.alias("v")), "__mid").alias("v")),
        "key-ends")
    by_pid = Window.orderBy("__pid")                      # one row a partition
    before = ends.select("__pid", (F.sum("n").over(by_pid) - F.col("n")).alias("__off"),
                         F.lag("k").over(by_pid).alias("__pk"), F.lag("v").over(by_pid).alias("__pv"))
    w = Window.partitionBy("__pid").orderBy("__mid")
    rows = ranged.join(F.broadcast(before), "__pid")
    rows = rows.withColumn("__lk", F.coalesce(F.lag(key).over(w), F.col("__pk"))).withColumn(
        "__lv", F.coalesce(F.lag(F.struct(val.alias("v"))).over(w), F.col("__pv")))
    starts = F.col("__lk").isNull() | ~key.eqNullSafe(F.col("__lk"))
    differs = F.coalesce(val != F.col("__lv.v"), F.lit(True))
    rows = rows.withColumn("__start", starts).withColumn("__new", (F.col("__start") | differs).cast("int"))
    rows = rows.withColumn("__g", F.col("__off") + place).withColumn("__c", F.sum("__new").over(w))
    begin = F.when(F.col("__start"), F.struct(F.col("__g").alias("g"), F.col("__c").alias("c")))
    rows = cut_lineage(rows.withColumn("__begin", F.last(begin, ignorenulls=True).over(w))
                       .drop("__lk", "__lv", "__pk", "__pv", "__start", "__new", "__off"), "key-counts")
    totals = rows.groupBy("__pid").agg(F.max("__c").alias("c"), F.max("__begin").alias("b"))
    ahead = by_pid.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__coff", F.coalesce(F.sum("c").over(ahead), F.lit(0)))
    # where the key that runs into a partition began, in positions and runs of the whole table
    last = F.when(F.col("b").isNotNull(), F.struct(F.col("b.g").alias("g"), (F.col("__coff") + F.col("b.c")).alias("c")))
    carry = totals.select("__pid", "__coff", F.last(last, ignorenulls=True).over(ahead).alias("__carry"))
    out = rows.join(F.broadcast(carry), "__pid")
    here = F.struct(F.col("__begin.g").alias("g"), (F.col("__coff") + F.col("__begin.c")).alias("c"))
    begin = F.when(F.col("__begin").isNotNull(), here).otherwise(F.col("__carry"))
    out = out.withColumn("__pos", F.col("__g") - begin["g"]).withColumn("__run", F.col("__coff") + F.col("__c") - begin["c"])
    return out.drop("__mid", "__pid", "__g", "__c", "__begin", "__coff", "__carry")


def islands(df: DataFrame, keys: list[str], pos: str, value: str, name: str = "grupo") -> DataFrame:
    """Consecutive equal values (per key, by position) form one group (0-based)."""
    runs = key_runs(df, keys, [F.col(pos)], value)
    return runs.withColumn(name, F.col("__run").cast("bigint")).drop("__pos", "__run")


def repeat_suffix(df: DataFrame, key: str, order: list[Column], name: str = "seq") -> DataFrame:
    """0 for the first row of a repeated base key, 1, 2 ... for the next ones."""
    return key_runs(df, [key], order).withColumn(name, F.col("__pos").cast("bigint")).drop("__pos", "__run")


def free_codes(blank: DataFrame, given: DataFrame, key: str, order: Column, code: str, width: int = 2) -> DataFrame:
    """W9 with codes given beforehand: the rows of ``blank`` get, by base ``key`` and in ``order``, the codes base,
    base01, base02 ... that are not in ``given`` (column ``code``).

    Nothing is listed: the j-th taken number t leaves t - j free ones below it, so it stands in front of the rows from
    t - j on; sorting taken numbers and rows together gives each row its number as its place."""
    def named(base: Column, i: Column) -> Column:
        return F.when(i == 0, base).otherwise(F.concat(base, F.format_string(f"%0{width}d", i)))

    # every way to read a given code as a base and a number
    codes = given.select(F.col(code).alias("c")).where(F.col("c").isNotNull()).distinct()
    split = codes.select("c", F.explode(F.sequence(F.lit(1), F.length("c"))).alias("n")).where(F.length("c") > 0)
    split = split.select("c", F.expr("left(c, n)").alias(key), F.expr("substring(c, n + 1)").alias("rest"))
    number = F.when(F.col("rest") == "", F.lit(0)).when(F.col("rest").rlike(r"^\d{1,18}$"), F.col("rest").try_cast("bigint"))
    taken = split.withColumn("t", number).where(F.col("c") == named(F.col(key), F.col("t")))
    taken = taken.join(blank.select(key).distinct(), key, "left_semi").select(key, "t")
    taken = repeat_suffix(taken, key, [F.col("t")], "j").select(key, (F.col("t") - F.col("j")).alias("__at"), F.lit(0).alias("__kind"))
    rows = repeat_suffix(blank, key, [order], "__at").withColumn("__kind", F.lit(1))
    both = rows.unionByName(taken, allowMissingColumns=True)
    both = key_runs(both, [key], [F.col("__at"), F.col("__kind")]).where(F.col("__kind") == 1)
    return both.withColumn(code, named(F.col(key), F.col("__pos"))).drop("__pos", "__run", "__at", "__kind")


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION (distinct) by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()
