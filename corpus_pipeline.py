"""Corpus pipeline over ``documents``: five stages, each a call of one training-data operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
stage's ``docs``.  All but the last return the columns of ``documents``; the last one returns the mix.

1. toxicity: documents whose score is 0.5 or more go.
2. simhash_dedup: one document of each group of near copies stays, the one with the smallest id (rows are told apart by
   id and text, rows without id come last; of equal ids in a group the one with the smallest text hash stays).
3. decontamination: contaminated documents go; in the others, benchmark passages of 13 words or more are cut out.
4. secret_scans: every finding is replaced by ``[SECRET]``.
5. mixing: every document with its whole number of copies (0 to 3); sources reach their targets.

Each stage handles null texts, ids and sources, empty and long texts, repeated rows, empty tables and further columns
as the operators state; further columns are kept up to the mix.  n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from acadlake.llm import decontam, mixing, secrets, simhash, toxicity
from acadlake.llm.common import table
from acadlake.session import cut_lineage


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rest): further columns in one struct, so that their names cannot meet a stage's own."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias("_")).alias("rest"))


def _unpacked(df: DataFrame, columns: list[str], text=None) -> DataFrame:
    """The columns of the stage's input, with a new text if one is given."""
    new = F.col("text") if text is None else text
    df = df.select("doc_id", F.col("text").alias("old"), new.alias("text"), "rest")
    out = []
    for c in columns:
        col = F.col(c if c in ("doc_id", "text") else f"rest.`{c}`")
        if c == "n_chars" and text is not None:
            same = F.col("text").eqNullSafe(F.col("old"))
            col = F.when(same, col).otherwise(F.length("text").cast(df.schema["rest"].dataType[c].dataType))
        out.append(col.alias(c))
    return df.select(*out)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = _packed(docs)
    lexicon = toxicity.learn_lexicon(own, table(spark, sf_dir, "labels"), toxicity.may_learn())
    scored = toxicity.with_features(own, lexicon)
    return _unpacked(scored.filter(F.col("f.score") < 0.5), docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows without id come after all ids; rows of one id are told apart by their texts
    nameless = F.col("doc_id").isNull()
    key = F.struct(nameless.alias("nameless"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                   F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"))
    parts = ["nameless", "id", "text_hash"]
    own = _packed(docs).withColumn("key", key)
    groups = simhash.near_duplicates(own, "key")
    named = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id.*").distinct()
    # flat keys and one kind of join at every size: texts are shuffled once, and the window needs no other exchange
    kept = own.select("doc_id", "text", "rest", "key.*").join(
        cut_lineage(named, "pipeline-kept").hint("merge"), parts, "left_semi")
    turn = F.row_number().over(W.partitionBy(*parts).orderBy("text", F.to_json("rest")))
    return _unpacked(kept.withColumn("turn", turn).filter(F.col("turn") == 1), docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.automata(table(spark, sf_dir, "benchmark"))
    marked = decontam.annotate(_packed(docs), found)
    clean = marked.filter(~F.coalesce(decontam.contaminated(), F.lit(False)))
    # the text is cut before the projection drops the spans
    cut = decontam.without_spans(F.col("text"), F.col("decontamination.spans"))
    return _unpacked(clean, docs.columns, cut)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the texts' own ledger: each different text is scanned once, and its findings meet every row that has it
    blobs = _packed(docs).withColumn("blob", F.sha2(F.coalesce("text", F.lit("")), 256))
    versions = blobs.select("blob", F.coalesce("text", F.lit("")).alias("text"))
    ledger = cut_lineage(secrets.update_ledger(versions).filter(F.size("findings") > 0), "pipeline-ledger")
    met = blobs.join(ledger.select("blob", "findings"), "blob", "left")
    findings = F.coalesce("findings", F.array().cast(secrets.FINDINGS))
    return _unpacked(met, docs.columns, secrets.redact(F.col("text"), findings))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = mixing.mix(docs)
    return out.select("doc_id", "source", "size", "source_size", "target",
                      "copies", (F.col("copies") * F.col("size")).alias("taken"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("secret_scans", secrets_stage),
    ("mixing", mixing_stage),
]

# learned weights, XXH64 fingerprints and hash rounding have no SQL form; tests/llm compares with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
