"""Fuzzy entity grouping (Q7, J13, F23, F24) — exact, without scoring all pairs.

Semantics (the studied job): names are cleaned (year suffix removed, F23);
walking the rows in input order, each row not yet grouped becomes a leader and
takes every ungrouped row whose similarity with it is >= the threshold; the
similarity is the normalised Indel ratio 100 * 2 * LCS / (|a| + |b|) of the
comparison keys (F24).  Groups are numbered in leader order and the suggested
name is the longest cleaned name of the group (first on ties).

Spark plan:
1. rows with the same comparison key always share a group (ratio 100), so the
   work runs on distinct keys, each carrying its first position;
2. candidate pairs by prefix filtering: an alignment with x deletions and y
   insertions (d = x + y) keeps at least la - 1 - 2x - y of the la - 1 bigrams,
   which is (la + lb) / 2 - 1 - 3d / 2, and a pair with ratio >= T has
   d <= floor((100 - T) * (la + lb) / 100) of the parity of la + lb.  A key takes
   the least such bound over every admissible partner length, and indexes its
   rarest bigrams up to it; two keys that match share one of them.  Token groups
   are further split by geometric length band (partners sit in the same or an
   adjacent band).  No candidate is dropped: the filters are proofs, not caps.
   (Keys whose bound is below 1 fall back to a length-band join.)
3. candidates must then share as many bigrams (counted with repeats) as their own
   two lengths ask for; what is left is verified with an exact LCS (bit-parallel,
   Arrow UDF) and an integer test 200 * LCS >= T * (la + lb);
4. the sequential greedy pass is the lexicographically first maximal independent
   set of the similarity graph in input order.  Components do not touch each
   other, so each component of at most ``COMPONENT_EDGES`` edges is walked in
   order inside one task.  Larger ones are solved in rounds: a key without an
   earlier neighbour left becomes a leader, a key whose earliest neighbour left is
   a leader joins it; a round keeps only undecided keys and their edges.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.functions.scalars import comparison_key, strip_year_suffix
from acadlake.operators import ordering as O
from acadlake.operators.graph import components
from acadlake.session import cut_lineage

Q = 2   # bigrams
COMPONENT_EDGES = 500_000      # edges of a component that one task walks

# the scorer below travels with its task, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence (bit-parallel, Hyyro 2004)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    s = full
    for ch in b:
        u = s & masks.get(ch, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - bin(s).count("1")


@F.pandas_udf(T.LongType())
def lcs_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(x, y) for x, y in zip(a, b)], dtype="int64")


def _max_ops(total, t: int):
    return F.floor(F.lit(100 - t) * total / 100)


def _least_overlap(total, t: int):
    """Bigrams that two keys of together ``total`` characters share if their ratio is >= t."""
    ops = _max_ops(total, t)
    ops = ops - (total - ops) % 2                       # as many operations as the lengths allow have their parity
    return F.ceil(total / 2 - 1 - 1.5 * ops)


def _numbered_bigrams(chave):
    """Bigrams with occurrence numbers: intersections of these sets count repeats."""
    gram = lambda i: F.substring(chave, i, Q)
    at = F.when(F.length(chave) >= Q, F.sequence(F.lit(1), F.length(chave) - Q + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat(gram(i), F.lit("#"), F.size(
        F.filter(F.sequence(F.lit(1), i), lambda j: gram(j) == gram(i))).cast("string")))


def similar_pairs(keys: DataFrame, threshold: int = 90) -> DataFrame:
    """Edges (a_pos < b_pos) between distinct keys with ratio >= threshold.

    ``keys``: columns ``chave`` (comparison key) and ``pos`` (first position).
    """
    k = keys.withColumn("len", F.length("chave")).withColumn("toks", _numbered_bigrams(F.col("chave")))
    low = F.greatest(F.lit(0), F.ceil(F.col("len") * threshold / (200 - threshold)).cast("int"))
    high = F.floor(F.col("len") * (200 - threshold) / threshold).cast("int")
    bound = F.array_min(F.transform(F.sequence(low, high), lambda n: _least_overlap(F.col("len") + n, threshold)))
    k = cut_lineage(k.withColumn("tau", bound))
    grams = k.select("pos", F.explode("toks").alias("tok"))
    freq = grams.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    # per key: the rarest tokens first; keep the prefix that the overlap bound requires
    ranked = grams.join(freq, "tok").withColumn(
        "r", F.row_number().over(Window.partitionBy("pos").orderBy("df", "tok")))
    prefix = ranked.join(k, "pos").where((F.col("tau") >= 1) & (F.col("r") <= F.col("len") - Q + 1 - F.col("tau") + 1)) \
        .select("tok", "pos", "chave", "len", "toks")
    # split each token group by geometric length band: partners differ in length by at most a
    # factor (200 - T) / T, i.e. sit in the same or an adjacent band, so a key registers under its
    # own band and probes the neighbouring ones (a hot token only pairs length-compatible keys)
    ratio = (200.0 - threshold) / threshold * (1 + 1e-6)   # margin: a pair at the exact ratio stays adjacent
    if ratio > 1.0 + 1e-6:
        band = F.floor(F.log(F.col("len").cast("double")) / math.log(ratio)).cast("int")
    else:
        band = F.col("len")
    near = lambda side: [F.col(f"{side}.{c}").alias(f"{side}_{c}") for c in ("pos", "chave", "len", "toks")]
    a = prefix.withColumn("band", band).alias("a")
    b = prefix.withColumn("probe", F.explode(F.array(band - 1, band, band + 1))).alias("b")
    cand = (a.join(b, (F.col("a.tok") == F.col("b.tok")) & (F.col("a.band") == F.col("b.probe"))
                   & (F.col("a.pos") < F.col("b.pos")) & _may_match(threshold, "a.", "b."))
            .select(*near("a"), *near("b")).drop("a_toks", "b_toks"))
    # keys whose bound is below 1: compare within the admissible length band
    weak = k.where(F.col("tau") < 1).select("chave", "pos", "len", "toks", F.explode(F.sequence(low, high)).alias("plen"))
    banded = (weak.alias("a").join(k.alias("b"), (F.col("a.plen") == F.col("b.len")) & (F.col("a.pos") != F.col("b.pos"))
                                   & _may_match(threshold, "a.", "b."))
              .select(*near("a"), *near("b")).drop("a_toks", "b_toks"))
    swap = F.col("a_pos") > F.col("b_pos")
    ordered = [F.when(swap, F.col(f"{y}_{c}")).otherwise(F.col(f"{x}_{c}")).alias(f"{x}_{c}")
               for x, y in (("a", "b"), ("b", "a")) for c in ("pos", "chave", "len")]
    cand = cand.unionByName(banded.select(*ordered)).dropDuplicates(["a_pos", "b_pos"])
    scored = cand.withColumn("lcs", lcs_udf("a_chave", "b_chave"))
    total = F.col("a_len") + F.col("b_len")
    return scored.where(200 * F.col("lcs") >= F.lit(threshold) * total).select("a_pos", "b_pos")


def _may_match(threshold: int, x: str, y: str):
    """Length difference and shared bigrams (with repeats) that a pair above the threshold must have."""
    total = F.col(f"{x}len") + F.col(f"{y}len")
    shared = F.size(F.array_intersect(f"{x}toks", f"{y}toks"))
    return ((F.abs(F.col(f"{x}len") - F.col(f"{y}len")) <= _max_ops(total, threshold))
            & (shared >= _least_overlap(total, threshold)))


def walk(a, b):
    """(positions, leader of each) of one component: edge ends a < b, walked in the order of positions."""
    import numpy as np

    leader: dict[int, int] = {}
    order = np.lexsort((b, a))
    for x, y in zip(a[order].tolist(), b[order].tolist()):
        if leader.setdefault(x, x) == x:          # ungrouped so far, or a leader: it takes its ungrouped neighbours
            leader.setdefault(y, x)
    # nodes that only end edges of grouped nodes lead themselves
    for y in np.unique(b).tolist():
        leader.setdefault(y, y)
    return list(leader), list(leader.values())


def greedy_leaders(nodes: DataFrame, edges: DataFrame, component_edges: int = COMPONENT_EDGES) -> DataFrame:
    """Sequential greedy grouping: ``nodes(pos)``, ``edges(a_pos < b_pos)`` -> ``(pos, lider)``, the leader's position.

    Small components cost one shuffle of their edges; only larger ones go through rounds."""
    ends = edges.select("a_pos", "b_pos")
    labels = components(ends.select(F.col("a_pos").alias("a"), F.col("b_pos").alias("b")))
    held = cut_lineage(ends.join(labels.withColumnRenamed("node", "a_pos"), "a_pos"), "greedy-edges")
    sizes = cut_lineage(held.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "greedy-sizes")
    large = sizes.where(F.col("n") > component_edges).select("label")

    def run(table):
        import pyarrow as pa

        pos, leader = walk(table["a_pos"].to_numpy(), table["b_pos"].to_numpy())
        return pa.table({"pos": pa.array(pos, pa.int64()), "lider": pa.array(leader, pa.int64())})

    small = held.join(large, "label", "left_anti").groupBy("label").applyInArrow(run, "pos bigint, lider bigint")
    done = cut_lineage(small, "greedy-small")
    rest = held.join(large, "label", "left_semi").select("a_pos", "b_pos")
    if not large.isEmpty():
        touched = rest.select(F.col("a_pos").alias("pos")).unionByName(rest.select(F.col("b_pos").alias("pos"))).distinct()
        done = done.unionByName(leaders_in_rounds(touched, rest))
    return nodes.select("pos").join(done, "pos", "left").select("pos", F.coalesce("lider", "pos").alias("lider"))


def leaders_in_rounds(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The same result for components of any size.

    A round decides at least the first node of every component that is left, and passes on only
    undecided nodes and the edges that can still decide them."""
    left = cut_lineage(nodes.select("pos"))
    open_ = edges.select("a_pos", "b_pos", F.lit(False).alias("a_lider"))
    done = None
    while not left.isEmpty():
        first = open_.groupBy("b_pos").agg(F.min(F.struct("a_pos", "a_lider")).alias("f"))
        state = left.join(first, left["pos"] == first["b_pos"], "left").select(
            "pos", F.when(F.col("f").isNull(), F.col("pos")).when(F.col("f.a_lider"), F.col("f.a_pos")).alias("lider"))
        state = cut_lineage(state)
        new = state.where(F.col("lider").isNotNull())
        done = new if done is None else done.unionByName(new)
        left = state.where(F.col("lider").isNull()).select("pos")
        still = open_.join(left.withColumnRenamed("pos", "b_pos"), "b_pos", "left_semi")
        now = new.select(F.col("pos").alias("a_pos"), (F.col("pos") == F.col("lider")).alias("leads"))
        # an edge from a member decides nothing; an edge from a leader may
        open_ = cut_lineage(still.join(now, "a_pos", "left").where(F.col("leads").isNull() | F.col("leads"))
                            .select("a_pos", "b_pos", (F.col("a_lider") | F.coalesce("leads", F.lit(False))).alias("a_lider")))
    return done if done is not None else nodes.select("pos", F.col("pos").alias("lider"))


def named_keys(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """cleaned name ``limpo`` and comparison key ``chave`` of every row."""
    rows = df.select(id_col, name_col).withColumn(
        "limpo", strip_year_suffix(F.coalesce(F.col(name_col).cast("string"), F.lit("nan"))))
    return rows.withColumn("chave", comparison_key("limpo"))


def distinct_keys(rows: DataFrame, id_col: str) -> DataFrame:
    """Distinct comparison keys with the position of their first row."""
    return rows.groupBy("chave").agg(F.min(id_col).alias("pos"))


def fuzzy_groups(df: DataFrame, id_col: str, name_col: str, threshold: int = 90) -> DataFrame:
    """Q7: every input row with its group id (1-based, leader order) and suggested name."""
    rows = named_keys(df, id_col, name_col)
    keys = cut_lineage(distinct_keys(rows, id_col))
    edges = cut_lineage(similar_pairs(keys, threshold))
    leaders = greedy_leaders(keys.select("pos"), edges)
    key_leader = keys.join(leaders, "pos").select("chave", "lider")
    numbered = O.sequential_ids(key_leader.select("lider").distinct(), [F.col("lider").asc()], "grupo")
    out = rows.join(key_leader, "chave").join(numbered, "lider")
    best = out.groupBy("grupo").agg(
        F.max_by("limpo", F.struct(F.length("limpo"), -F.col(id_col))).alias("sugerido"))
    return out.join(best, "grupo").select(id_col, name_col, F.col("grupo").alias("id"), "sugerido")
