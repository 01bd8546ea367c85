"""Language identification by rank-order profiles of character n-grams.

A language's profile is its ``PROFILE`` most frequent n-grams (1 to 3 letters, words padded with a blank) in rank
order.  A document's own most frequent n-grams are compared with each profile: an n-gram at rank i that the profile
has at rank j costs abs(i - j), one that it lacks costs the profile's length.  The language with the least sum is
predicted (ties: the smaller name); the score is 1 minus that sum over the largest possible sum.

Profiles are counted on at most ``FIT_ROWS`` texts of each language (those with the smallest hashes of their id, one
text an id, the smallest); every document is scored on its whole text, a piece at a time, so memory does not grow with the text.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if nothing could
be learned; null languages teach nothing; repeated rows are scored one by one; other columns are kept.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from acadlake.llm.common import crc_mod, small_batches, table
from acadlake.session import cut_lineage

PROFILE = 400
FIT_ROWS = 2000
PIECE = 1 << 18          # characters that are counted at once
UNKNOWN = "und"

# word characters that are not letters: numerals such as superscripts, fractions and enclosed numbers
_NUMERALS = {c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()}
_BLANKS = {ord(c): " " for c in _NUMERALS}
_NO_LETTER = re.compile(r"[\W\d_]+")


def grams(text: str):
    """Codes and counts of the 1- to 3-grams: three code points of 21 bits in one number."""
    import numpy as np

    text = text.lower()
    if not text.isascii() and not _NUMERALS.isdisjoint(set(text)):      # few texts have any
        text = text.translate(_BLANKS)
    clean = f" {_NO_LETTER.sub(' ', text).strip()} "
    if len(clean) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    total = None
    for at in range(0, max(1, len(clean) - 2), PIECE):
        part = clean[at:at + PIECE + 2]
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        c[c == 32] = 1
        first = len(c) if at + PIECE + 2 >= len(clean) else PIECE
        one = c[:first]
        two = (c[:-1] << 21 | c[1:])[:first]
        three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[:first]
        got = np.unique(np.concatenate([one[one != 1], two, three]), return_counts=True)
        if total is None:
            total = got
        else:
            codes, where = np.unique(np.concatenate([total[0], got[0]]), return_inverse=True)
            total = codes, np.bincount(where, np.concatenate([total[1], got[1]])).astype(np.int64)
    return total


def ranked(codes, counts, size: int = PROFILE):
    """The most frequent codes, most frequent first, ties by code."""
    import numpy as np

    return codes[np.lexsort((codes, -counts))[:size]]


class Profiles:
    """Sorted codes and ranks of each language."""

    def __init__(self, ranks: dict[str, list[int]], size: int = PROFILE):
        import numpy as np

        self.size, self.names, self.codes, self.ranks = size, sorted(ranks), [], []
        for name in self.names:
            codes = np.array(ranks[name], np.int64)
            order = np.argsort(codes)
            self.codes.append(codes[order])
            self.ranks.append(order.astype(np.int64))

    def predict(self, text: str | None) -> tuple[str, float]:
        import numpy as np

        own = ranked(*grams(text), self.size) if text else ()
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at, cost = np.arange(len(own)), []
        for codes, ranks in zip(self.codes, self.ranks):
            i = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            cost.append(int(np.where(codes[i] == own, np.abs(ranks[i] - at), self.size).sum()))
        best = int(np.argmin(cost))
        return self.names[best], 1 - cost[best] / (self.size * len(own))


def learn_profiles(docs: DataFrame, learn: Column, rows: int = FIT_ROWS, size: int = PROFILE) -> Profiles:
    """``docs`` (doc_id, text, lang); ``learn`` says which rows may be used.  ``size`` codes a language come back."""
    spark = docs.sparkSession
    small_batches(spark)
    known = docs.filter(learn & F.col("lang").isNotNull()).select("doc_id", "lang").distinct()
    held = known.groupBy("lang").agg(F.count("*").alias("n"))
    key = F.xxhash64(F.lit("language"), F.col("doc_id"))
    # about three times the rows that the sample of a language needs are ranked
    near = F.pmod(key, F.lit(1 << 30)) < F.least(F.lit(float(1 << 30)), F.lit(float(3 * rows << 30)) / F.col("n") + 1)
    order = W.partitionBy("lang").orderBy(key, "doc_id")
    # one number a language, as the profiles are: rows are filtered where they are, whatever share a language has
    ids = (known.join(F.broadcast(held), "lang").filter(near)
           .withColumn("k", F.row_number().over(order)).filter(F.col("k") <= rows).select("doc_id", "lang"))
    ids = cut_lineage(ids, "lang-sample")           # at most `rows` ids of each language
    sample = docs.join(ids, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")

    def count(batches):
        import numpy as np
        import pyarrow as pa

        held: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    held.setdefault(lang, []).append(grams(text))
        for lang, parts in sorted(held.items()):
            codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(where, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(n, pa.int64())],
                ["lang", "code", "n"])

    counts = sample.mapInArrow(count, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(
        F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.col("n").desc(), "code")))
    ranks: dict[str, list[int]] = {}
    for r in top.filter(F.col("rank") <= size).orderBy("lang", "rank").collect():
        ranks.setdefault(r.lang, []).append(r.code)
    return Profiles(ranks, size)


def predict(docs: DataFrame, profiles: Profiles, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out``: lang_pred, score."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop(out)
    held = spark.sparkContext.broadcast(profiles)     # a few hundred numbers for each language
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        own = held.value
        for batch in batches:
            got = [own.predict(t) for t in batch.column(at).to_pylist()]
            struct = pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()),
                                                 pa.array([g[1] for g in got], pa.float64())], ["lang_pred", "score"])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, out])

    kind = T._parse_datatype_string("struct<lang_pred:string,score:double>")
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + [T.StructField(out, kind)]))


# ------------------------------------------------------------------------------------------ registered query

def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    profiles = learn_profiles(docs, ~held_out)
    out = predict(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")
