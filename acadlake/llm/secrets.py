"""Secret scans over a blob ledger (native expressions only).

Every version of a text is a blob named by its SHA-256.  The ledger holds one row for each (blob, rule version) that
has been scanned, with its findings; a run scans only blobs that the ledger does not have for the current rules, and
findings are joined back to every path that carries the blob.

Defined results: a null text is the empty blob; repeated rows and copies are scanned once and reported for each row;
an empty table gives no rows; other columns are kept out of the way by fixed column names.  Offsets are code points,
ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadlake.llm.common import table
from acadlake.llm.folds import before, chunks, let, without
from acadlake.session import cut_lineage

FINDINGS = "array<struct<start:bigint,kind_no:int,kind:string,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern``; a match stays if group ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         1, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    # a maximal run of hex digits: the same matches as one or more digits with shorter ones dropped
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULE_VERSION = "2"


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Findings of one rule: pieces between matches and the matches themselves give every offset."""
    pattern = F.lit(rule.pattern)
    pieces = F.split(text, rule.pattern, -1)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else hits
    sizes = F.zip_with(F.zip_with(pieces, hits, lambda p, h: F.struct(F.length(p).alias("gap"), F.length(h).alias("n"))),
                       groups, lambda x, g: F.struct(x["gap"].alias("gap"), x["n"].alias("n"),
                                                     F.length(g).alias("own")))
    sizes = F.filter(sizes, lambda x: x["n"].isNotNull())
    none = F.lit(None).cast(FINDINGS)

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["n"]
        one = F.array(F.struct(begin.alias("start"), F.lit(number).alias("kind_no"), F.lit(rule.kind).alias("kind"),
                               end.alias("end")))
        found = F.when(x["own"] >= rule.least, F.concat(acc["found"], one)).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def found(parts: Column) -> Column:
        lengths = F.transform(parts, lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x["gap"] + x["n"]))
        return F.flatten(F.zip_with(parts, before(lengths, lambda a, x: a + x), lambda c, at: F.aggregate(
            c, F.struct(at.alias("at"), F.array().cast(FINDINGS).alias("found")), step, lambda a: a["found"])))

    spans = let(sizes, lambda own: let(chunks(own), found))
    return F.when(text.rlike(rule.pattern), spans).otherwise(none)


def scan_blobs(blobs: DataFrame, rules=RULES, version: str = RULE_VERSION) -> DataFrame:
    """(blob, rule_version, findings) of (blob, text); findings sort by start, then rule."""
    found = [F.coalesce(_spans(F.col("text"), r, i), F.array().cast(FINDINGS)) for i, r in enumerate(rules)]
    return blobs.select("blob", F.lit(version).alias("rule_version"),
                        F.array_sort(F.concat(*found)).cast(FINDINGS).alias("findings"))


def with_blobs(versions: DataFrame, path_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return versions.select(F.col(path_col).alias("path"), text.alias("text"), F.sha2(text, 256).alias("blob"))


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES,
                  version: str = RULE_VERSION) -> DataFrame:
    """Ledger rows for the blobs of ``versions`` (path, text, blob) that ``ledger`` lacks for this rule version.

    Copies collapse before the shuffle; the texts of blobs that were scanned before never reach a pattern.
    """
    if ledger is not None:
        seen = ledger.filter(F.col("rule_version") == version).select("blob")
        versions = versions.join(seen, "blob", "left_anti")
    unseen = versions.groupBy("blob").agg(F.first("text").alias("text"))
    return scan_blobs(unseen, rules, version)


def findings_by_path(versions: DataFrame, ledger: DataFrame, version: str = RULE_VERSION) -> DataFrame:
    """(path, blob, findings) of every row of ``versions``; blobs without findings have an empty list."""
    hit = ledger.filter((F.col("rule_version") == version) & (F.size("findings") > 0)).select("blob", "findings")
    out = versions.select("path", "blob").join(hit, "blob", "left")
    return out.select("path", "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings"))


def digest_spans(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every finding (overlapping ones merged) replaced by ``mark``."""
    return without(text, findings, mark)


# ------------------------------------------------------------------------------------------ registered query

def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = with_blobs(table(spark, sf_dir, "documents"), "doc_id", "text")
    ledger = cut_lineage(update_ledger(versions), "secret-ledger")
    out = findings_by_path(versions, ledger)
    base = F.filter("findings", lambda x: x["kind"].isin([r.kind for r in RULES if r.base]))
    out = out.select(F.col("path").alias("doc_id"), "findings", base.alias("base"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return out.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                      count("hex").alias("n_hex"), F.sha2(digest_spans(F.col("base")), 256).alias("base_sha256"),
                      digest_spans(F.col("findings")).alias("spans"))


def _duck_spans(kind: str, number: int, pattern: str, group: int, least: int) -> str:
    # positions: total length of what stands before the i-th match
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""
  SELECT r, {number} AS kind_no, '{kind}' AS kind, i,
         list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0) AS s,
         length(h[i]) AS n, length(g[i]) AS own, {least} AS least
  FROM (SELECT r, p, h, g, unnest(range(1, len(h) + 1)) AS i FROM (
    SELECT r, string_split_regex(text, {p}) AS p, regexp_extract_all(text, {p}) AS h,
           regexp_extract_all(text, {p}, {group}) AS g FROM d WHERE regexp_matches(text, {p})))"""


ORACLE = ("WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents), f AS ("
          + " UNION ALL ".join(_duck_spans(r.kind, i, r.pattern, r.group, r.least) for i, r in enumerate(RULES))
          + """), ok AS (SELECT r, kind_no, kind, s, kind || ':' || cast(s AS BIGINT) || ':' || cast(s + n AS BIGINT) AS say
                        FROM f WHERE own >= least)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(say, ',' ORDER BY s, kind_no) FILTER (kind_no < 3), '')) AS base_sha256,
       coalesce(string_agg(say, ',' ORDER BY s, kind_no), '') AS spans
FROM d LEFT JOIN ok USING (r) GROUP BY d.r, d.doc_id""")
