"""Sources and scans.

Landing data arrives as pages: one text line per page, the page number, a tab
and the body (an envelope ``{"data": [...]}`` or a bare JSON list); a file holds
up to ``PAGES_PER_FILE`` consecutive pages, in a folder per such range.  The end
of the table is the first empty page, whatever order pages arrive in.  Everything is read with a declared schema (never inferred),
so unknown fields are dropped and absent ones are NULL (S8).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.operators import ordering as O
from acadlake.sources.paged_source import BODY_COL, scan_pages

PAGE_COL = "pagina"
RANGE_COL = "faixa"
PAGES_PER_FILE = 256
FEW_KEYS = 10            # as many values of a filter Spark hands to a Parquet scan one by one
LANDED = T.StructType([T.StructField("value", T.StringType()), T.StructField(RANGE_COL, T.LongType())])


def land_pages(df: DataFrame, root: str, order: list, page_size: int = 100, bare_every: int = 0,
               stray_after_end: dict | None = None) -> int:
    """Write ``df`` as landing pages (used to stage API extracts and in tests).

    Pages hold ``page_size`` records in ``order``; every ``bare_every``-th page is a bare
    list, the others an envelope; an empty page closes the table.  ``stray_after_end`` maps
    columns to values of one more record, on a page behind the end that lands before all
    others: readers must leave it out.
    Page contents are bounded by ``page_size``, so collecting a page is safe.
    Returns the number of data pages.
    """
    numbered = O.sequential_ids(df, order, "__seq")
    paged = numbered.withColumn(PAGE_COL, F.floor((F.col("__seq") - 1) / page_size).cast("bigint"))
    rec = F.struct(*[F.col(c) for c in df.columns])
    pages = paged.groupBy(PAGE_COL).agg(F.sort_array(F.collect_list(F.struct(F.col("__seq"), rec.alias("r"))))
                                        .alias("__rows"))
    pages = pages.select(PAGE_COL, F.transform("__rows", lambda x: x["r"]).alias("data"))
    bare = (F.col(PAGE_COL) % bare_every == bare_every - 1) if bare_every else F.lit(False)
    text = F.when(bare, F.to_json(F.col("data"))).otherwise(F.to_json(F.struct("data")))
    total = int(df.agg(F.count(F.lit(1))).first()[0])
    n_pages = -(-total // page_size)
    spark = df.sparkSession

    def write(lines: DataFrame) -> None:
        out = lines.select(F.floor(F.col(PAGE_COL) / PAGES_PER_FILE).alias(RANGE_COL),
                           F.concat(F.col(PAGE_COL).cast("string"), F.lit("\t"), F.col("value")).alias("value"))
        out.repartition(RANGE_COL).write.mode("append").partitionBy(RANGE_COL).text(root)

    if stray_after_end:
        body = json.dumps({"data": [stray_after_end]})
        write(spark.createDataFrame([(n_pages + 1, body)], f"{PAGE_COL} bigint, value string"))
    end = spark.createDataFrame([(n_pages, '{"data": []}')], f"{PAGE_COL} bigint, value string")
    write(pages.select(PAGE_COL, text.alias("value")).unionByName(end))
    return n_pages


def parse_pages(pages: DataFrame, schema: T.StructType, body: str = "body") -> DataFrame:
    """(page number, body, ...) -> the body column becomes ``data``, its records (envelope or bare list)."""
    env = T.StructType([T.StructField("data", T.ArrayType(schema))])
    data = F.when(F.ltrim(body).startswith("["), F.from_json(body, T.ArrayType(schema))).otherwise(F.from_json(body, env)["data"])
    return pages.select(*[c for c in pages.columns if c != body], data.alias("data"))


def split_pages(lines: DataFrame, schema: T.StructType, *more) -> DataFrame:
    """Landing lines -> (page number, records); ``more`` columns are taken from the line."""
    at = F.locate("\t", F.col("value"))
    body = F.expr("substring(value, locate('\t', value) + 1)")
    number = F.substring(F.col("value"), F.lit(1), at - 1).cast("bigint")
    return parse_pages(lines.select(number.alias(PAGE_COL), body.alias("body"), *more), schema)


def records(pages: DataFrame) -> DataFrame:
    """The records of pages (page number, data) in front of the first empty page."""
    # the first empty page ends the table (one scalar, computed once)
    end = pages.where(F.size("data") == 0).agg(F.min(PAGE_COL)).first()[0]
    if end is not None:
        pages = pages.where(F.col(PAGE_COL) < end)
    return pages.select(PAGE_COL, F.explode("data").alias("r")).select(PAGE_COL, "r.*")


def read_pages(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Read landed pages (envelope or bare list), stop at the first empty page."""
    return records(split_pages(spark.read.schema(LANDED).text(root), schema))


def read_source_pages(spark: SparkSession, root: str, schema: T.StructType, first: int = 0, until: int | None = None) -> DataFrame:
    """S1/S8 through the ``paged`` data source: a range of pages, whose other folders are not opened."""
    return records(parse_pages(scan_pages(spark, root, first, until), schema, BODY_COL))


def rename_fields(df: DataFrame, mapping: dict[str, str], fallbacks: dict | None = None,
                  alternates: dict | None = None) -> DataFrame:
    """Rename API fields; ``fallbacks`` = {target: [preferred, ...]} (first non-blank wins);
    ``alternates`` = {target: alternate} used only when the target is absent / blank."""
    out = df
    for target, sources in (fallbacks or {}).items():
        present = [s for s in sources if s in out.columns]
        if present:
            out = out.withColumn(target, F.coalesce(*[F.nullif(F.col(s), F.lit("")) for s in present]))
            out = out.drop(*[s for s in present if s != target])
    for src, dst in mapping.items():
        if src in out.columns and src != dst:
            out = out.withColumnRenamed(src, dst)
    for target, alt in (alternates or {}).items():
        if alt in out.columns:
            cur = F.nullif(F.col(target), F.lit("")) if target in out.columns else F.lit(None).cast("string")
            out = out.withColumn(target, F.coalesce(cur, F.col(alt))).drop(alt)
    return out


def read_sheet(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> DataFrame:
    """Delimited sheet, all text, positional rename, blank cells -> NULL."""
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
    df = spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)
    df = df.toDF(*names)
    return df.select(*[F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(F.col(c)).alias(c) for c in names])


def pruned_scan(spark: SparkSession, path: str, schema: T.StructType, **filters) -> DataFrame:
    """Partitioned Parquet scan; equality filters on partition columns prune folders."""
    df = spark.read.schema(schema).parquet(path)
    for k, v in filters.items():
        if v is not None:
            df = df.where(F.col(k).isin(list(v)) if isinstance(v, (list, tuple)) else F.col(k) == v)
    return df


def write_partitioned(df: DataFrame, path: str, by: list[str], keys: list[str] = ()) -> None:
    """A folder for each value of ``by``.  Rows are rebalanced, so a large value is written by as many tasks as its
    size asks for and a small one by one.  Files are sorted by ``keys`` and carry Bloom filters on them, so a scan for
    given keys skips row groups by their ranges and filters (S3)."""
    out = df.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by, *keys)
    writer = out.write.mode("overwrite").partitionBy(*by)
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.parquet(path)


def keyed_lookup(df: DataFrame, keys: DataFrame, on: list[str], few: int = FEW_KEYS) -> DataFrame:
    """S3/S4 on a stored table: the rows of a key set.

    A single-column set of at most ``few`` keys becomes a filter that reaches the scan (ranges and Bloom filters of row
    groups).  A larger one is a semi join; if ``on`` holds partition columns, Spark reads only the folders of the keys'
    partitions (dynamic partition pruning), provided the key side is filtered and small enough to be sent to all tasks."""
    keys = keys.select(*on).distinct()
    if len(on) == 1:
        found = keys.limit(few + 1).collect()           # few + 1 keys at most
        if len(found) <= few:
            return df.where(F.col(on[0]).isin([r[0] for r in found if r[0] is not None]))
    return df.join(keys, on, "left_semi")


def keyed_scan(df: DataFrame, keys: DataFrame, on: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows whose key is in a key set (semi join; AQE broadcasts a small key set), ordered."""
    out = df.join(keys.select(*on).distinct(), on, "left_semi")
    return out.orderBy(*order) if order else out


def active_scan(df: DataFrame, flag: str = "ativo", value: str = "S") -> DataFrame:
    """S5."""
    return df.where(F.col(flag) == value)


def key_set(df: DataFrame, key: str) -> DataFrame:
    """S7."""
    return df.select(key).distinct()
