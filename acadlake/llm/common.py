"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# words of the contracts: runs without ASCII white space
WORD = r"[^\x20\x09-\x0D]+"

# rows per Arrow batch sent to a Python task: whole texts travel in a batch, so a batch stays small
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def id_text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def crc_mod(col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(id_text(col)) % F.lit(modulus)


def hashed_share(order: Column, rows: int, total: int, slack: int = 3) -> Column:
    """Condition that about ``slack * rows`` of ``total`` rows meet, chosen by the hash ``order``: what is sorted for
    a sample of ``rows`` then no longer grows with the number of partitions."""
    return F.pmod(order, F.lit(1 << 30)) < F.lit(min(1 << 30, (slack * rows << 30) // max(1, total) + 1))


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch (texts may be long); keeps a smaller setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def sql_text(value: str) -> str:
    """A SQL string literal for DuckDB."""
    return "'" + value.replace("'", "''") + "'"


DUCK_LOWER = f"translate({{}}, '{UPPER}', '{LOWER}')"
