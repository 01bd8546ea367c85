"""Exact top-k inner products by a three-phase uniform threshold.

Equal vectors are one object.  Every vector is cut into component groups; a node is one group, and its local score list
holds, for each query, the partial product of that group with every object.  A task holds a block of a node's rows and
of the queries, and computes their partial products as one matrix product.

1. Every node sends the k + 1 highest entries of its list for each query.  The exact scores of these few objects are
   looked up; the k-th highest of them is a lower bound t of the k-th best score.
2. Each of the m nodes gets the same share of it, t / m, and sends every entry that reaches the share: an object below
   it in all nodes scores less than t, so no answer is lost.
3. Objects that came from all nodes have their score; the k-th highest of these is a better bound.  Others miss only
   partial scores below t / m; those that could still reach the better bound are resolved exactly by a join.

Scores are integers.  If products could pass 2^53 there is one node, whose partial scores are the scores, computed on
Python integers; others are computed exactly in doubles.  Components and scores saturate at the limits of a long.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor do rows with a
null id; vectors of other lengths than the query's are not candidates of it; equal rows (id and vector) count once, an
id with several vectors counts with each as a query's best score per id; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from acadlake.llm.common import table
from acadlake.session import cut_lineage

TOP = 10
SCALE = 1024
ROW_BLOCK = 4096
QUERY_BLOCK = 2048
QUERY_STEP = 128         # queries whose scores against a row block are held at once
NODES = 2                # component groups a vector is cut into
EXACT = float(2 ** 53)   # doubles hold all integers up to here


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v, dim) with v = floor(scale * x) of every usable row, equal rows once."""
    vec = F.col(vec_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x))
    ok = F.col(id_col).isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, bad)
    return df.filter(ok).select(F.col(id_col).alias("vec_id"), v.alias("v")).distinct().withColumn("dim", F.size("v"))


def _product(q, x):
    import numpy as np

    most = float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1]
    if most < 2 ** 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, -1 << 63, (1 << 63) - 1).astype(np.int64)


def _matrix(column):
    import numpy as np

    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.asarray(flat.flatten()).reshape(len(flat), -1)


def _first(q, k: int):
    """Which rows are among the first ``k`` of their query; ``q`` is in order."""
    import numpy as np

    start = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
    return np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q)))) < k


def _parts(nodes: int) -> Column:
    """Columns ``g`` and ``part``, one row a node, of a vector ``v`` of ``dim`` components cut into ``m`` groups."""
    width = F.ceil(F.col("dim") / nodes).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.col("m") - 1),
                      lambda g: F.struct(g.alias("g"), F.slice("v", g * width + 1, width).alias("part")))
    return F.inline(cut)


def _node_count(nodes: int) -> Column:
    return F.ceil(F.col("dim") / F.ceil(F.col("dim") / nodes)).cast("int")


def _blocks(objects: DataFrame, queries: DataFrame, nodes: int, n_rows: int, n_queries: int) -> tuple[DataFrame, DataFrame]:
    """The nodes' rows and the queries' parts, each with the blocks it takes part in."""
    row_blocks = max(1, -(-n_rows // ROW_BLOCK) * 2)        # hashing is uneven: aim at half-full blocks
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK) * 2) if n_queries > QUERY_BLOCK else 1
    slot = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    left = objects.select("obj", "lead", "dim", slot("obj", row_blocks).alias("rb"), _parts(nodes))
    right = queries.select("q", "dim", "m", "cutoff", slot("q", query_blocks).alias("qb"), _parts(nodes))
    return left.select("*", every(query_blocks).alias("qb")), right.select("*", every(row_blocks).alias("rb"))


def _node_lists(left: DataFrame, right: DataFrame, body) -> DataFrame:
    keys = ["rb", "qb", "dim", "g"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        body, "q bigint, obj bigint, lead bigint, g int, part bigint")


def _entries(choose):
    """A task's entries: ``choose(scores, leads, queries)`` gives (query index, row index) of those that are sent."""
    def run(rows, queries):
        import numpy as np
        import pyarrow as pa

        out = [], [], [], []
        for at in range(0, len(queries) if len(rows) else 0, QUERY_STEP):
            part = queries.slice(at, QUERY_STEP)
            s = _product(_matrix(part["part"]), _matrix(rows["part"]))
            lead = rows["lead"].to_numpy()
            i, j = choose(s, lead, part)
            for held, x in zip(out, (part["q"].to_numpy()[i], rows["obj"].to_numpy()[j], lead[j], s[i, j])):
                held.append(x)
        q, obj, lead, score = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in out)
        g = rows["g"][0].as_py() if len(rows) else 0
        return pa.table({"q": q, "obj": obj, "lead": lead, "g": pa.array(np.full(len(q), g, np.int32)), "part": score})

    return run


def _highest(k: int):
    """The ``k`` highest entries of each query, one for a leading id."""
    def choose(s, lead, queries):
        import numpy as np

        if len(np.unique(lead)) == len(lead) and k < len(lead):
            j = np.argpartition(-s, k - 1, axis=1)[:, :k]
            return np.repeat(np.arange(len(s)), k), j.ravel()
        i, j = (x.ravel() for x in np.indices(s.shape))
        order = np.lexsort((-s.ravel(), lead[j], i))
        i, j = i[order], j[order]
        best = np.append(True, (i[1:] != i[:-1]) | (lead[j][1:] != lead[j][:-1]))
        i, j = i[best], j[best]
        order = np.lexsort((-s[i, j], i))
        order = order[_first(i[order], k)]
        return i[order], j[order]

    return choose


def _reaching(s, lead, queries):
    """All entries that reach the query's share of its cutoff; without a cutoff, all."""
    import numpy as np

    cutoff = queries["cutoff"].to_numpy(zero_copy_only=False) if queries["cutoff"].null_count == 0 else np.array(
        [-(1 << 63) if x is None else x for x in queries["cutoff"].to_pylist()], np.int64)
    m = queries["m"].to_numpy().astype(np.int64)
    least = (cutoff + (m - 1)) // m             # the least s with m * s >= cutoff
    return np.nonzero(s >= least[:, None])


def _scored(pairs: DataFrame, queries: DataFrame, objects: DataFrame) -> DataFrame:
    """(q, obj, lead, score) of pairs by exact look-up of both vectors."""
    both = pairs.select("q", "obj").join(queries.select("q", F.col("v").alias("qv")), "q").join(
        objects.select("obj", "lead", "v"), "obj")
    score = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return both.select("q", "obj", "lead", score.alias("score"))


def _kth(scored: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(q, bound): the k-th highest score over leading ids other than the query's own, where there are so many."""
    other = scored.join(queries.select("q", "query_id"), "q").filter(F.col("lead") != F.col("query_id"))
    best = other.groupBy("q", "lead").agg(F.max("score").alias("score"))
    high = W.partitionBy("q").orderBy(F.col("score").desc())
    best = best.withColumn("k", F.row_number().over(high)).filter(F.col("k") <= k)
    return best.groupBy("q").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))


def top_k(df: DataFrame, is_query: Column, k: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE, nodes: int = NODES) -> DataFrame:
    """(query_id, rank, vec_id, score); ``is_query`` is a condition on ``vec_id``."""
    vectors = integer_vectors(df, id_col, vec_col, scale)
    # of copies, the k + 1 smallest ids: one of them may be the query's own
    copies = W.partitionBy("v").orderBy("vec_id", "row").rowsBetween(W.unboundedPreceding, W.currentRow)
    held = vectors.withColumn("row", F.monotonically_increasing_id()).select(
        "vec_id", "v", "dim", F.row_number().over(W.partitionBy("v").orderBy("vec_id", "row")).alias("copy"),
        F.first("row").over(copies).alias("obj"), F.first("vec_id").over(copies).alias("lead"))
    held = cut_lineage(held.filter(F.col("copy") <= k + 1), "topk-vectors")
    objects = held.filter(F.col("copy") == 1)
    asked = vectors.filter(is_query).select(F.monotonically_increasing_id().alias("q"), F.col("vec_id").alias("query_id"), "v", "dim")
    queries = cut_lineage(asked, "topk-queries")
    most = objects.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("x"),
                       F.max("dim").alias("dim")).first()
    if not most.n or most.x ** 2 * most.dim * nodes >= EXACT:
        nodes = 1
    objects, queries = (x.withColumn("m", _node_count(nodes)) for x in (objects, queries))
    sizes = most.n, queries.count()

    # 1: the highest local entries, their exact scores, and a bound from these
    left, right = _blocks(objects, queries.withColumn("cutoff", F.lit(None).cast("bigint")), nodes, *sizes)
    local = _node_lists(left, right, _entries(_highest(k + 1)))
    local = local.groupBy("q", "g", "lead").agg(F.max(F.struct("part", "obj")).alias("e"))
    high = W.partitionBy("q", "g").orderBy(F.col("e.part").desc(), "lead")
    local = local.withColumn("k", F.row_number().over(high)).filter(F.col("k") <= k + 1)
    local = local.select("q", "e.obj", "lead", F.col("e.part").alias("score"))
    first = local if nodes == 1 else _scored(local.select("q", "obj").distinct(), queries, objects)
    cutoff = _kth(first, queries, k).withColumnRenamed("bound", "cutoff")
    queries = cut_lineage(queries.join(cutoff, "q", "left"), "topk-cutoffs")

    # 2: every entry that reaches an even share of the bound
    left, right = _blocks(objects, queries, nodes, *sizes)
    sent = _node_lists(left, right, _entries(_reaching)).groupBy("q", "obj", "lead").agg(
        F.sum("part").alias("score"), F.count("*").alias("c")) if nodes > 1 else _node_lists(
        left, right, _entries(_reaching)).select("q", "obj", "lead", F.col("part").alias("score"), F.lit(1).alias("c"))
    sent = cut_lineage(sent.join(queries.select("q", "query_id", "m", "cutoff"), "q"), "topk-entries")

    # 3: objects of all nodes give a better bound; others that could reach it are looked up
    whole = sent.filter(F.col("c") == F.col("m")).select("q", "obj", "lead", "score")
    better = _kth(whole, queries, k)
    out = whole
    if nodes > 1:
        rest = sent.filter(F.col("c") < F.col("m")).join(better, "q", "left")
        most_possible = F.col("m") * F.col("score") + (F.col("m") - F.col("c")) * F.col("cutoff")
        rest = rest.filter(most_possible >= F.col("m") * F.coalesce("bound", "cutoff"))
        out = out.unionByName(_scored(rest, queries, objects))
    out = out.join(better, "q", "left").filter(F.col("score") >= F.coalesce("bound", F.lit(-(1 << 63))))

    found = out.join(queries.select("q", "query_id"), "q").join(held.select("obj", "vec_id"), "obj")
    found = found.filter(F.col("vec_id") != F.col("query_id")).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


# ------------------------------------------------------------------------------------------ registered query

def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = f"""
WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (SELECT q.vec_id AS query_id, c.vec_id, max(cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT)) AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0 GROUP BY ALL),
r AS (SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
      FROM s)
SELECT * FROM r WHERE rank <= {TOP}
"""
