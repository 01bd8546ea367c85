"""Toxicity from a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: homoglyphs and digit or sign substitutions become the letter they stand for, i, l, 1 and |
become one letter, invisible characters go, other signs become a space.  The lexicon holds folded words and word
beginnings, each with its log-odds weight, learned from document frequencies of labelled rows.  Matches inside an
exception phrase do not count.  The summed weight, normalised by the text's length in three ways, goes through a
logistic function that is fitted on the same rows.

The fit uses at most ``FIT_ROWS`` labelled rows of each label (those with the smallest hashes).  Near copies among
them count once: rows of a label that share the smallest hash of their word shingles are one row for the counts.

Defined results: null and empty texts have no match and get the score of an empty text; a label row that is null,
repeated or without document is ignored or counted once; with no labelled rows, or rows of one label only, the lexicon
is empty and scores are the share of toxic rows; repeated documents are scored one by one; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.llm.common import crc_mod, hashed_share, small_batches, table
from acadlake.session import cut_lineage

FIT_ROWS = 8000          # labelled rows of each label that the fit may use
LEXICON = 2000           # entries at most
MIN_SCORE = 25.0         # likelihood-ratio statistic that an entry needs
PREFIXES = (4, 5, 6)     # lengths of word beginnings
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "disgusting taste", "stupid mistake of mine")

# letters that look like Latin ones (fixed values)
_GLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ӏ": "l",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i",
}
# digits and signs used as letters (fixed values)
_SIGNS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "|": "l"}
_GONE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"


def fold_table() -> dict[int, str | None]:
    """For ``str.translate`` after lower-casing; full-width letters and digits are added by rule."""
    signs = {c: " " for c in map(chr, range(128)) if not c.isalnum()} | _SIGNS
    out = {ord(k): v for k, v in (_GLYPHS | signs).items()} | {ord(c): None for c in _GONE}
    out |= {cp: out.get(cp - 0xFEE0, chr(cp - 0xFEE0)) for cp in range(0xFF01, 0xFF5F)}
    out |= {cp: chr(cp + 32 - 0xFEE0) for cp in range(0xFF21, 0xFF3B)}
    return {k: (v.replace("l", "i") if v else v) for k, v in out.items()} | {ord("l"): "i"}


def fold(text: str, table_: dict) -> str:
    return f" {text.lower().translate(table_)} "


@dataclass
class Lexicon:
    """Weights of folded patterns: " word " is a whole word, " begin" a word beginning."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    coefficients: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def machine(self):
        import ahocorasick

        out, table_ = ahocorasick.Automaton(), fold_table()
        for p, w in self.weights.items():
            out.add_word(p, (len(p), w))
        for phrase in self.exceptions:
            p = fold(phrase, table_)
            out.add_word(p, (len(p), None))
        if len(out):
            out.make_automaton()
        return out, table_

    def features(self, text: str | None, machine) -> tuple[float, float, float]:
        """Summed weight as it is, over the root of the number of words, and over the number of words."""
        automaton, table_ = machine
        folded = fold(text or "", table_)
        words = max(1, len(folded.split()))
        best: dict[int, tuple[int, float]] = {}
        excused: list[tuple[int, int]] = []
        for end, (n, weight) in automaton.iter(folded) if len(automaton) else ():
            start = end - n + 1
            if weight is None:
                excused.append((start, end))
            elif start not in best or n > best[start][0]:      # the longest entry at a word counts
                best[start] = (n, weight)
        total = sum(w for s, (n, w) in best.items() if not any(a <= s and s + 1 < b for a, b in excused))
        return total, total / words ** 0.5, total / words

    def score(self, features) -> float:
        from math import exp

        z = self.coefficients[0] + sum(c * min(x, 50.0) for c, x in zip(self.coefficients[1:], features))
        return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def fit_sample(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = FIT_ROWS) -> DataFrame:
    """(label, text) of at most ``rows`` labelled documents of each label; ``learn`` says which ids may be used.

    An id that many rows have gives one text, the smallest, so the bound holds for rows too.  Ids are chosen on the narrow tables, so texts are read once, for the chosen ids only.
    """
    marks = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("label")).filter(learn)
    marks = marks.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    marks = cut_lineage(marks, "tox-marks")
    held = {r.label: r.n for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [marks.filter((F.col("label") == v) & hashed_share(order, rows, held.get(v, 0)))
             .orderBy(order, "doc_id").limit(rows) for v in (0, 1)]
    chosen = cut_lineage(parts[0].unionByName(parts[1]), "tox-sample")
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text")).select("label", "text")


def _patterns(text: str, table_: dict) -> tuple[set[str], int]:
    import zlib

    words = fold(text, table_).split()
    shingles = [" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))]
    found = {f" {w} " for w in words}
    found |= {f" {w[:n]}" for w in words for n in PREFIXES if len(w) > n}
    return found, min(zlib.crc32(s.encode()) for s in shingles)


def pattern_counts(sample: DataFrame) -> tuple[DataFrame, int, int]:
    """(pattern, toxic, clean): in how many groups of near copies of each label a pattern stands; all groups of each."""
    small_batches(sample.sparkSession)

    def keyed(batches):
        import pyarrow as pa

        table_ = fold_table()
        for batch in batches:
            found = [_patterns(t or "", table_) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for _, s in found], pa.int64()),
                 pa.array([sorted(p) for p, _ in found], pa.list_(pa.string()))], ["label", "group", "patterns"])

    rows = sample.select("label", "text").mapInArrow(keyed, "label int, group bigint, patterns array<string>")
    one = rows.groupBy("label", "group").agg(F.min("patterns").alias("patterns"))
    one = cut_lineage(one, "tox-groups")
    count = one.select("label", F.explode("patterns").alias("pattern")).groupBy("pattern").agg(
        F.sum(F.col("label")).alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    totals = one.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("all_toxic"),
                     F.coalesce(F.sum(1 - F.col("label")), F.lit(0)).alias("all_clean")).first()
    return count, totals.all_toxic, totals.all_clean


def learn_lexicon(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = FIT_ROWS,
                  entries: int = LEXICON) -> Lexicon:
    """Counts are distributed; at most ``entries`` patterns and 2 * ``rows`` feature rows reach the driver."""
    import numpy as np

    sample = cut_lineage(fit_sample(docs, labels, learn, rows), "tox-texts")
    counts, n_toxic, n_clean = pattern_counts(sample)
    rows_ = []
    if n_toxic and n_clean:
        a, b, na, nb = F.col("toxic").cast("double"), F.col("clean").cast("double"), float(n_toxic), float(n_clean)
        pooled = (a + b) / (na + nb)
        part = lambda x, n: F.when(x > 0, x * F.log(x / (n * pooled))).otherwise(0.0)
        weight = F.log((a + 0.5) / (na + 1)) - F.log((b + 0.5) / (nb + 1))
        rows_ = (counts.select("pattern", (2 * (part(a, na) + part(b, nb))).alias("gain"), weight.alias("weight"))
                 .filter((F.col("gain") >= MIN_SCORE) & (F.col("weight") >= 2))
                 .orderBy(F.col("gain").desc(), "pattern").limit(entries).collect())
    lexicon = Lexicon({r.pattern: round(r.weight, 6) for r in rows_})
    x, y = sample_features(sample, lexicon)
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
    start = float(np.log(share / (1 - share))) if 0 < share < 1 else -30.0
    if not rows_:
        lexicon.coefficients = (start, 0.0, 0.0, 0.0)
        return lexicon
    lexicon.coefficients = _logistic(x, y)
    return lexicon


def sample_features(sample: DataFrame, lexicon: Lexicon):
    """Features and labels of the bounded sample, as arrays in a fixed order."""
    import numpy as np

    scored = with_features(sample, lexicon).select("label", "f.*")
    rows = sorted(scored.collect(), key=lambda r: (r.label, r.total, r.by_root, r.by_words))
    return (np.array([[r.total, r.by_root, r.by_words] for r in rows], float).reshape(-1, 3),
            np.array([r.label for r in rows], float))


def _logistic(x, y, ridge: float = 0.1, steps: int = 50) -> tuple[float, ...]:
    """Newton's method for a small logistic regression; both labels weigh alike."""
    import numpy as np

    x = np.minimum(x, 50.0)
    scale = np.maximum(x.std(0), 1e-9)
    z = np.column_stack([np.ones(len(x)), x / scale])
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    w, penalty = np.zeros(4), np.diag([1e-6, ridge, ridge, ridge])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (share * (y - p)) - penalty @ w
        step = np.linalg.solve((z * (share * p * (1 - p))[:, None]).T @ z + penalty, grad)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return (float(w[0]), *(w[1:] / scale).tolist())


def with_features(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", out: str = "f") -> DataFrame:
    """``docs`` with a struct column ``out``: total, by_root, by_words, score."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop(out)
    held = spark.sparkContext.broadcast(lexicon)      # at most LEXICON entries
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        own = held.value
        machine = own.machine()
        for batch in batches:
            rows = [own.features(t, machine) for t in batch.column(at).to_pylist()]
            cols = [pa.array([r[i] for r in rows], pa.float64()) for i in range(3)]
            cols.append(pa.array([own.score(r) for r in rows], pa.float64()))
            struct = pa.StructArray.from_arrays(cols, ["total", "by_root", "by_words", "score"])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, out])

    kind = T._parse_datatype_string("struct<total:double,by_root:double,by_words:double,score:double>")
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + [T.StructField(out, kind)]))


def may_learn() -> Column:
    return crc_mod(F.col("doc_id"), 5) != 0


# ------------------------------------------------------------------------------------------ registered query

def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn_lexicon(docs, table(spark, sf_dir, "labels"), may_learn())
    out = with_features(docs, lexicon)
    return out.select("doc_id", (~may_learn()).alias("held_out"), F.col("f.score").alias("score"),
                      (F.col("f.score") >= 0.5).cast("int").alias("predicted"))
