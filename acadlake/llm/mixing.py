"""Mixing sources to target weights by entropy balancing (native expressions only).

Among all rates r of documents (words of a document count ``size * r``) that give every source its target, entropy
balancing takes those nearest to 1 in relative entropy, each word weighing alike.  The convex dual has one multiplier
per source; its Newton iterations start at 0 and read only per-source sums, which one distributed pass collects.  The
rates are exponential tilts exp(multiplier), limited to ``cap``, and are then rounded to whole copies:

1. documents of a source with equal size form a class; a class of n documents gets floor(n * rate + u) copies, u a hash
   of the class, so that each document's expected copies equal its rate;
2. what a source misses or has too much is given to or taken from whole documents, largest that still fit first, in a
   fixed number of passes over the class table (one running sum per pass), so a source ends near its target;
3. inside a class the extra copies go to the smallest hashes: classes are cut into hash buckets, counts give every
   bucket its share, and only the one bucket that is cut through is ranked.

No step gathers a source or a class in one task: running sums go over distinct sizes and over buckets.

Defined results: a null text has no words; null sources are one source, last in order; documents without words take
nothing; repeated rows are separate documents (the same rank is given in some order, so the rows as a whole do not
change); an empty table gives no rows; other columns are ignored; reruns agree, since only hashes of values decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from acadlake.llm.common import WORD, table
from acadlake.session import cut_lineage

CAP = 3
WEIGHTS = (1, 2, 3)
BUCKETS = 256
NEWTON_STEPS = 200
TOLERANCE = 1e-12
ROUNDING_PASSES = (6, 4)    # with copies next to the rate, then with any up to the limit


def targets(sources: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> adds weight and target.

    Targets share all words by weight; none passes ``cap`` times its source, and the excess is shared again by weight.
    Sources in the order in which they reach the limit make that a pair of running sums.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())       # one row per source
    df = sources.withColumn("k", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    df = df.withColumn("weight", weight).withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
    everything = W.partitionBy()
    df = df.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    df = df.withColumn("all_weight", F.sum("weight").over(everything))
    by_limit = W.orderBy((F.col("limit") / F.col("weight")), "k").rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("spent", F.coalesce(F.sum("limit").over(by_limit), F.lit(0.0)))
    df = df.withColumn("gone", F.coalesce(F.sum("weight").over(by_limit), F.lit(0.0)))
    level = (F.col("total") - F.col("spent")) / (F.col("all_weight") - F.col("gone"))
    df = df.withColumn("capped", F.col("limit") / F.col("weight") < level)
    # the first source that stays under its limit has the level of all that do
    first = F.min(F.when(~F.col("capped"), F.struct((F.col("limit") / F.col("weight")).alias("x"), F.col("k"),
                                                     level.alias("level")))).over(everything)
    target = F.when(F.col("capped"), F.col("limit")).otherwise(F.least("limit", F.col("weight") * first["level"]))
    return df.select("source", "source_size", "weight", target.alias("target"))


def balance(goals: DataFrame, cap: float = CAP, steps: int = NEWTON_STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds the dual multiplier and the rate of each source.

    The dual of source s is size_s * exp(m) - target_s * m; Newton's step is (target - size * exp(m)) / (size * exp(m)).
    From m = 0 the steps go down by less than 1 at a time or jump past a target above the size and come back, so they
    converge from anywhere.  The state is a table; one number comes back to the driver after each group of steps.
    """
    live = (F.col("source_size") > 0) & (F.col("target") > 0)
    state = goals.withColumn("multiplier", F.lit(0.0))
    done = 0
    while done < steps:
        for _ in range(5):
            now = F.col("source_size") * F.exp("multiplier")
            step = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("target") - now) / now))
            state = state.withColumn("multiplier", F.when(live, F.col("multiplier") + step).otherwise(F.lit(0.0)))
        done += 5
        state = cut_lineage(state, "mix-dual")
        gap = F.abs(F.col("source_size") * F.exp("multiplier") - F.col("target")) / F.col("target")
        worst = state.agg(F.max(F.when(live, gap)).alias("worst")).first().worst
        if worst is None or worst <= tolerance:
            break
    rate = F.when(live, F.least(F.lit(float(cap)), F.exp("multiplier"))).otherwise(F.lit(0.0))
    return state.withColumn("rate", rate)


def _uniform(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def class_copies(classes: DataFrame, goals: DataFrame, cap: int = CAP, passes=ROUNDING_PASSES) -> DataFrame:
    """(source, size, n) and (source, rate, target) -> adds ``copies`` of the whole class."""
    df = classes.join(goals.select("source", "rate", "target"), classes["source"].eqNullSafe(goals["source"]), "left")
    df = df.select(classes["source"], "size", "n", "rate", "target")
    drawn = F.floor(F.col("n") * F.col("rate") + _uniform(F.col("source"), F.col("size")))
    df = df.withColumn("copies", F.least(F.col("n") * cap, drawn).cast("long"))
    own = W.partitionBy("source")
    for near in [True] * passes[0] + [False] * passes[1]:
        low = F.col("n") * F.floor("rate") if near else F.lit(0)
        most = F.col("n") * (F.least(F.lit(cap), F.floor("rate") + 1) if near else F.lit(cap))
        df = df.withColumn("rest", F.col("target") - F.sum(F.col("copies") * F.col("size")).over(own))
        fits = F.col("size") <= F.abs("rest")
        room = F.when(fits, F.when(F.col("rest") > 0, most - F.col("copies")).otherwise(F.col("copies") - low)).otherwise(0)
        df = df.withColumn("room", F.greatest(F.lit(0), room))
        before = own.orderBy(F.col("size").desc()).rowsBetween(W.unboundedPreceding, -1)
        left = F.abs("rest") - F.coalesce(F.sum(F.col("room") * F.col("size")).over(before), F.lit(0))
        moved = F.greatest(F.lit(0), F.least(F.col("room"), F.floor(left / F.col("size"))))
        df = df.withColumn("copies", (F.col("copies") + F.signum("rest") * moved).cast("long"))
    return df.select("source", "size", "n", "copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) of every document."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    # texts are read once; the rest works on (id, source, size)
    sized = cut_lineage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                    words.alias("size")), "mix-sizes")
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    goals = cut_lineage(balance(goals, cap), "mix-rates")

    order = F.xxhash64(F.lit("mix"), F.col("doc_id"))
    sized = sized.withColumn("order", order).withColumn("bucket", F.pmod(F.col("order"), F.lit(BUCKETS)))
    has_words = sized.filter(F.col("size") > 0)
    cells = cut_lineage(has_words.groupBy("source", "size", "bucket").agg(F.count("*").alias("held")), "mix-cells")
    classes = cells.groupBy("source", "size").agg(F.sum("held").alias("n"))
    plan = class_copies(classes, goals, cap)
    # every document has `whole` copies and `extra` documents of the class have one more
    plan = plan.select("source", "size", F.floor(F.col("copies") / F.col("n")).alias("whole"),
                       (F.col("copies") % F.col("n")).alias("extra"))
    plan = cut_lineage(plan, "mix-classes")
    same = cells["source"].eqNullSafe(plan["source"]) & (cells["size"] == plan["size"])
    shares = cells.join(plan, same).select(cells["source"], cells["size"], "bucket", "held", "whole", "extra")
    ahead = W.partitionBy("source", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    left = F.col("extra") - F.coalesce(F.sum("held").over(ahead), F.lit(0))
    shares = shares.withColumn("more", F.greatest(F.lit(0), F.least(F.col("held"), left)))
    shares = cut_lineage(shares.select("source", "size", "bucket", "held", "whole", "more"), "mix-shares")

    on = (sized["source"].eqNullSafe(shares["source"]) & (sized["size"] == shares["size"])
          & (sized["bucket"] == shares["bucket"]))
    got = sized.join(shares, on, "left").select(sized["doc_id"], sized["source"], sized["size"], "order",
                                                sized["bucket"], "held", "whole", "more")
    cut = (F.col("more") > 0) & (F.col("more") < F.col("held"))
    easy = got.filter(~F.coalesce(cut, F.lit(False))).withColumn(
        "copies", F.coalesce(F.col("whole") + F.when(F.col("more") > 0, 1).otherwise(0), F.lit(0)))
    rank = F.row_number().over(W.partitionBy("source", "size", "bucket").orderBy("order", "doc_id"))
    hard = got.filter(cut).withColumn("copies", F.col("whole") + F.when(rank <= F.col("more"), 1).otherwise(0))
    cols = ["doc_id", "source", "size", F.col("copies").cast("long").alias("copies")]
    out = easy.select(*cols).unionByName(hard.select(*cols))
    goals = goals.select(F.col("source").alias("of"), "source_size", "target", "rate")
    out = out.join(goals, out["source"].eqNullSafe(goals["of"]), "left")
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "copies")


# ------------------------------------------------------------------------------------------ registered query

def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                      "copies", "rate")
