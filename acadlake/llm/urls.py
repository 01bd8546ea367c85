"""URL filters: host suffixes and path prefixes meet the rules on short hash prefixes.

A URL is expanded into the expressions host suffix + path prefix that a rule could have (only suffixes with as many
labels, and prefixes as long, as some rule has).  Expressions and rules are equi-joined on the first four bytes of
their SHA-256; the whole digest confirms a hit, and the longest rule wins (ties: longer host, then block).

Defined results: a null URL, or one without ``://``, has an empty host and path; equal URLs are judged once and
reported for each row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadlake.llm.common import ascii_lower, table

# (host, path, verdict): a rule fits its host and all subdomains, and paths that start with its path
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DEFAULT_VERDICT = "allow"   # a block list lets pass what no rule names

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """(host, path, verdict) -> digests; ``rule`` is host and path together."""
    df = rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    df = df.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))  # block over allow
    df = df.withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
    return df.withColumn("short", F.substring("digest", 1, 8))


def _shapes(rules: DataFrame) -> tuple[list[int], list[int]]:
    """Label counts of the rules' hosts and lengths of their paths (at most a few hundred small numbers)."""
    row = rules.agg(F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels"),
                    F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths")).first()
    return list(row.labels), list(row.lengths)


def expand(keys: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """(host, path) -> one row for each expression, with its digest and hash prefix."""
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in labels]), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")),
        lambda n: F.col("path").substr(F.lit(1), n))
    df = keys.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
    df = df.withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
    return df.select("host", "path", "digest", F.substring("digest", 1, 8).alias("short"))


def judge(urls: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """Adds rule and verdict to (..., host, path)."""
    spark = urls.sparkSession
    table_ = rule_table(rules)
    labels, lengths = _shapes(table_)
    if not labels:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keys = urls.select("host", "path").distinct()
    spread = expand(keys, labels, lengths).alias("e")
    near = spread.join(table_.alias("r"), F.col("e.short") == F.col("r.short"))       # may hold false hits
    sure = near.filter(F.col("e.digest") == F.col("r.digest"))
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"),
                    F.col("r.verdict").alias("verdict"), F.concat("rule_host", "rule_path").alias("rule"))
    best = sure.groupBy("host", "path").agg(F.max(rank).alias("best"))
    out = urls.join(best, ["host", "path"], "left")
    return out.select(*[urls[c] for c in urls.columns], F.col("best.rule").alias("rule"),
                      F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


# ------------------------------------------------------------------------------------------ registered query

def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge(urls, rules)


ORACLE = """
WITH u AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
rules(rh, rp, v) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES) + """),
hit AS (SELECT r, rh || rp AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
        FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM hit WHERE k = 1) h USING (r)
"""
