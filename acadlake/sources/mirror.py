"""Stored mirror tables laid out for co-located joins.

The enrolment, class, class-teacher and exam mirrors are joined with each
other on the class key (year, semester, class, subject) by most products.
They are stored once as Parquet tables bucketed (and sorted) by that key with
the same bucket count, so those joins read matching buckets side by side:
no exchange on either side, and the sort-merge join needs no extra sort.
The bucket count follows ``spark.sql.shuffle.partitions`` (``acadlake.mirror.buckets``
overrides it; size it so a bucket fits a task), but never so many that a bucket has
fewer than ``KEYS_PER_BUCKET`` keys: then a bucket of an unskewed table holds about
what the others hold, at any scale.  A bucketed scan gives a bucket to one task and
bypasses AQE's skew splitting, so a table with a key above ``HOT_FACTOR`` average
buckets is read as plain files instead, and its joins split that key.
Tables are external, under the shared checkpoint folder, one set for each state of
the source files.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acadlake.session import cut_lineage, scratch_path

# table -> bucket columns (the class key under each table's own column names)
LAYOUT = {
    "enrol": ["ano", "semestre", "turma", "disciplina"],
    "class": ["ano", "semestre", "turma", "disciplina"],
    "class_teacher": ["ano", "periodo", "turma", "disciplina"],
    "exam": ["ano", "semestre", "turma", "disciplina"],
}

_lock = threading.Lock()
_stored: dict = {}


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("acadlake.mirror.buckets", None) or spark.conf.get("spark.sql.shuffle.partitions"))


KEYS_PER_BUCKET = 4
HOT_FACTOR = 4


def layout(df: DataFrame, cols: list[str], most: int) -> tuple[int, bool]:
    """Bucket count, and whether one key makes a bucket hold more than ``HOT_FACTOR`` average buckets of rows.

    One aggregate by the rows' bucket numbers: a task sends one row a bucket, the keys are not shuffled (their number is
    an estimate, exact for buckets of few keys), and one row comes back."""
    per_bucket = df.groupBy(F.pmod(F.hash(*cols), F.lit(most)).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*cols)).alias("keys"))
    row = per_bucket.agg(F.sum("keys").alias("keys"), F.max("n").alias("top"), F.sum("n").alias("total")).first()
    keys = row["keys"] or 0
    n = max(1, min(most, keys // KEYS_PER_BUCKET))
    return n, keys > 0 and row["top"] > max(HOT_FACTOR * row["total"] / n, KEYS_PER_BUCKET * row["total"] / keys)


# mirrors made of another mirror's rows, with their class keys: from each row, or each group of rows of a key
DERIVED = {"class": "enrol", "class_teacher": "enrol", "exam": "class"}


def store(spark: SparkSession, name: str, df: DataFrame, source_id) -> DataFrame:
    """Write ``df`` once as a bucketed table and return a scan of it.

    A mirror derived from a stored table takes over its buckets.  It needs no count of its own, since it has the same keys
    and a bucket has a fixed number of rows at most for each row of the other's; nor a shuffle, since its rows come from
    tasks that hold whole buckets already.
    A source with joins or shuffles of its own is computed once, into plain files, that are counted and then bucketed."""
    def key_of(mirror: str) -> tuple:
        return (mirror, source_id, spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", None))

    key = key_of(name)
    with _lock:
        if key not in _stored:
            cols = LAYOUT[name]
            parent = _stored.get(key_of(DERIVED.get(name)), (None, None, 0))
            if parent[0] == "table":
                n, hot, dealt = parent[2], False, df
            else:
                df = cut_lineage(df, f"mirror-{name}")
                n, hot = layout(df, cols, buckets(spark))
                dealt = df.repartition(n, *cols)
            if hot:
                _stored[key] = ("files", df, 0)
            else:
                digest = hashlib.sha1(f"{source_id}|{name}|{n}".encode()).hexdigest()[:10]
                table = f"acadlake_mirror_{name}_{digest}"
                try:
                    (dealt.write.mode("overwrite").format("parquet").bucketBy(n, *cols).sortBy(*cols)
                     .option("path", scratch_path(spark, f"mirror-{name}")).saveAsTable(table))
                    _stored[key] = ("table", table, n)
                except AnalysisException:       # the catalog refuses tables; a failed write is raised
                    _stored[key] = ("frame", None, 0)
        kind, ref, _ = _stored[key]
        if kind == "table":
            return spark.table(ref)
        if kind == "files":             # no bucket spec: joins shuffle and AQE splits the hot key
            return ref
        return df
