"""Vector codes by product quantisation, with distances shared along a trie of distinct parts.

Components become integers floor(scale * x).  A vector is cut into ``PARTS`` equal consecutive parts, each with a
codebook of up to ``ENTRIES`` entries.  Parts are counted once (distinct part, number of rows), range-partitioned and
sorted, so a task holds a run of a lexicographic trie.  The traversal is depth first: a node's vector of squared
distances from its prefix to the prefixes of all entries is computed once and shared by everything below it.  A
subtree (or a run of small siblings) of at most ``LEAVES`` leaves is finished level by level, still with one vector for
each node.  Leaves take the argmin, and each task adds up its entries' parts weighted by their numbers of rows.

A round sends at most ``PARTS * ENTRIES`` sums to the driver and as many entries back; that is all the driver sees, and
it does not grow with the rows.  The last assignment walks the trie of each batch of rows, so rows are not shuffled.

All arithmetic is exact: sums are decimals of 38 digits, and distances that could pass 2^62 use Python integers.

Defined results: rows whose vector is null or holds null or non-finite components are dropped; components saturate at
+-2^62 and errors at 2^63 - 1; the dimension is that of the first kept row (smallest id, then vector) whose length is
divisible by ``PARTS``, and rows of another length get null code and error and train nothing; of rows with one id the
smaller vector comes first; null ids come last; repeated rows count each; fewer rows than entries make a smaller
codebook; null labels are one label; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadlake.llm.common import table
from acadlake.session import cut_lineage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LEAVES = 256                # leaves of a subtree that is finished level by level
MOST_COMPONENT = 1 << 62
MOST_LONG = (1 << 63) - 1


# ------------------------------------------------------------------------------------------ the trie

def nearest(parts, book):
    """(entry, squared distance) of each row of ``parts``, which must be distinct and in lexicographic order."""
    import numpy as np

    n, width = parts.shape
    span = max(int(np.abs(x).max()) if x.size else 0 for x in (parts, book))
    if 4 * span * span * max(1, width) >= 1 << 62:
        parts, book = parts.astype(object), book.astype(object)
    code, error = np.zeros(n, np.int64), np.zeros(n, parts.dtype)
    columns = np.ascontiguousarray(book.T)

    def finish(lo: int, hi: int, depth: int, shared) -> None:
        """Leaves ``lo`` to ``hi``, below one node whose vector is ``shared``."""
        node = np.zeros(hi - lo, np.int64)                  # node of each leaf at the level reached
        vectors = shared[None, :]
        for level in range(depth, width):
            value = parts[lo:hi, level]
            new = np.append(True, (node[1:] != node[:-1]) | (value[1:] != value[:-1]))
            step = value[new][:, None] - columns[level][None, :]
            vectors = vectors[node[new]] + step * step
            node = np.cumsum(new) - 1
        best = np.argmin(vectors, axis=1)                   # the first of equals: ties go to the lower index
        code[lo:hi], error[lo:hi] = best[node], vectors[node, best[node]]

    stack = [(0, n, 0, np.zeros(len(book), parts.dtype))] if n else []
    while stack:
        lo, hi, depth, shared = stack.pop()
        if hi - lo <= LEAVES or depth == width:
            finish(lo, hi, depth, shared)
            continue
        value = parts[lo:hi, depth]
        starts = [lo, *(lo + 1 + np.flatnonzero(value[1:] != value[:-1])).tolist(), hi]
        run, below = lo, []
        for start, end in zip(starts, starts[1:]):
            if end - start > LEAVES:
                if run < start:
                    finish(run, start, depth, shared)
                step = parts[start, depth] - columns[depth]
                below.append((start, end, depth + 1, shared + step * step))
                run = end
            elif end - run > LEAVES:
                finish(run, start, depth, shared)
                run = start
        if run < hi:
            finish(run, hi, depth, shared)
        stack.extend(reversed(below))
    return code, error


def _matrix(column, width: int):
    import numpy as np

    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), width)


def _sums(parts, counts, code, entries: int):
    """(used entries, their rows, their weighted component sums as Python integers)."""
    import numpy as np

    used = np.flatnonzero(np.bincount(code, minlength=entries))
    rows = np.zeros(entries, np.int64)
    np.add.at(rows, code, counts)
    wide = int(np.abs(parts).max()) * int(counts.sum()) >= 1 << 62 if parts.size else False
    total = np.zeros((entries, parts.shape[1]), object if wide else np.int64)
    np.add.at(total, code, parts.astype(total.dtype) * counts.astype(total.dtype)[:, None])
    return used, rows[used], total[used]


# ------------------------------------------------------------------------------------------ tables

def integer_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str | None, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of every row whose vector is usable."""
    vec = F.col(vec_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    most = float(MOST_COMPONENT)

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), F.lit(float(scale)) * x)))

    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    return df.filter(vec.isNotNull() & ~F.exists(vec, bad)).select(
        F.col(id_col).alias("vec_id"), label.alias("label"), F.transform(vec, whole).alias("v"))


def part_counts(vectors: DataFrame, dim: int, parts: int = PARTS) -> DataFrame:
    """(part, v, rows): the distinct parts, sorted inside range partitions; repeated parts meet before the shuffle."""
    width = dim // parts
    cut = F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.slice("v", p * width + 1, width).alias("v"))
                              for p in range(parts)]))
    counted = vectors.filter(F.size("v") == dim).select(cut.alias("p")).groupBy("p.part", "p.v").agg(
        F.count("*").alias("rows"))
    return counted.repartitionByRange("part", "v").sortWithinPartitions("part", "v")


def first_codebooks(vectors: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES) -> list[list[list[int]]]:
    """By part: the parts of the ``entries`` smallest ids."""
    first = vectors.filter(F.size("v") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries)
    rows, width = [list(r.v) for r in first.select("v").collect()], dim // parts
    return [[r[p * width:(p + 1) * width] for r in rows] for p in range(parts)]


def one_round(counted: DataFrame, books: list[list[list[int]]]) -> list[list[list[int]]]:
    """The codebooks after one assignment of all parts: entries become floor(sum / count), unused ones stay."""
    width, entries = len(books[0][0]), len(books[0])
    held = counted.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        own = [np.array(b, np.int64) for b in held.value]
        for batch in batches:
            part, matrix = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            counts, out = batch.column(2).to_numpy(), ([], [], [], [])
            for p in np.unique(part).tolist():
                mine = part == p
                code, _ = nearest(matrix[mine], own[p])
                used, rows, total = _sums(matrix[mine], counts[mine], code, entries)
                for held_, x in zip(out, ([p] * len(used), used.tolist(), rows.tolist(),
                                          [[str(c) for c in t] for t in total])):
                    held_.extend(x)
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)],
                                             ["part", "entry", "rows", "total"])

    local = counted.mapInArrow(run, "part int, entry int, rows bigint, total array<string>")
    # the sums of one component at a time: decimals, since a component of many rows passes 2^63
    local = local.select("part", "entry", "rows", F.posexplode("total").alias("at", "c"))
    sums = local.groupBy("part", "entry", "at").agg(F.sum("rows").alias("rows"),
                                                    F.sum(F.col("c").cast("decimal(38,0)")).alias("total"))
    out = [[list(e) for e in book] for book in books]
    for r in sums.collect():                    # at most PARTS * ENTRIES * width numbers
        out[r.part][r.entry][r.at] = int(r.total) // r.rows
    held.unpersist()
    return out


def train(counted: DataFrame, books: list[list[list[int]]], rounds: int = ROUNDS) -> list[list[list[int]]]:
    for _ in range(rounds if books[0] else 0):
        books = one_round(counted, books)
    return books


def encode(vectors: DataFrame, books: list[list[list[int]]], dim: int) -> DataFrame:
    """(vec_id, label, code, error) of every row: two hex digits for each part, and the summed squared distance."""
    held = vectors.sparkSession.sparkContext.broadcast(books)
    parts, width = len(books), dim // len(books)
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema if f.name != "v"}

    def run(batches):
        import numpy as np
        import pyarrow as pa

        own = [np.array(b, np.int64) for b in held.value]
        for batch in batches:
            fits = (batch.column(2).value_lengths().to_numpy() == dim) if dim else np.zeros(len(batch), bool)
            matrix = _matrix(batch.column(2).filter(pa.array(fits)), dim) if fits.any() else np.empty((0, dim), np.int64)
            codes, total = [], np.zeros(len(matrix), object)
            for p in range(parts if len(matrix) else 0):
                distinct, back = np.unique(matrix[:, p * width:(p + 1) * width], axis=0, return_inverse=True)
                code, error = nearest(distinct, own[p])
                codes.append(code[back.reshape(-1)])
                total = total + error[back.reshape(-1)].astype(object)
            texts = iter(["".join(f"{c:02x}" for c in row) for row in zip(*(c.tolist() for c in codes))])
            sums = iter(total.tolist())
            said = [(next(texts), min(MOST_LONG, int(next(sums)))) if ok else (None, None) for ok in fits.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s[0] for s in said], pa.string()),
                                              pa.array([s[1] for s in said], pa.int64())],
                                             ["vec_id", "label", "code", "error"])

    schema = ", ".join(f"{n} {k}" for n, k in kinds.items())
    return vectors.select("vec_id", "label", "v").mapInArrow(run, f"{schema}, code string, error bigint")


def vector_codes(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
                 scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
    """(coded rows: vec_id, label, code, error; the codebooks: part, entry, component)."""
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits, so a codebook has 1 to 256 entries")
    vectors = cut_lineage(integer_vectors(df, id_col, vec_col, label_col, scale), "codes-vectors")
    usable = vectors.filter((F.size("v") > 0) & (F.size("v") % parts == 0))
    head = usable.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v").alias("dim")).first()
    dim = head.dim if head else 0
    books = first_codebooks(vectors, dim, parts, entries) if dim else [[] for _ in range(parts)]
    if dim:
        books = train(cut_lineage(part_counts(vectors, dim, parts), "codes-parts"), books, rounds)
    return cut_lineage(encode(vectors, books, dim), "codes-rows"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the errors summed over rows of the same label (nulls together); sums meet rows by an equi-join."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    most = F.lit(MOST_LONG)
    sums = coded.groupBy(F.col("label").alias("of")).agg(
        F.when(total > most, most).otherwise(total.cast("bigint")).alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def codebooks_digest(books: list[list[list[int]]]) -> str:
    return sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


# ------------------------------------------------------------------------------------------ registered query

def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select("vec_id", "code", "error", "label_error",
                                          F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    # integer components below 2^26 keep every product and sum exact in doubles
    steps = [f"""
e AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * cast(x AS DOUBLE))) AS v FROM embeddings
     WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
p AS MATERIALIZED (SELECT vec_id, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS v
     FROM e, range({PARTS}) AS r(part)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e QUALIFY entry < {ENTRIES}),
b0 AS MATERIALIZED (SELECT part, entry, v AS c FROM p JOIN f USING (vec_id))"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (SELECT vec_id, part, min(struct_pack(d := list_inner_product(v, v) - 2 * list_inner_product(v, c)
     + list_inner_product(c, c), entry := entry)) AS best FROM p JOIN b{k} USING (part) GROUP BY ALL)""")
        if k < ROUNDS:
            steps.append(f"""
m{k} AS (SELECT part, entry, list(c ORDER BY i) AS c FROM (
     SELECT part, best.entry AS entry, i, floor(sum(x) / count(*)) AS c FROM (
       SELECT part, best, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k} JOIN p USING (vec_id, part)) GROUP BY ALL)
     GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (part, entry))""")
    return "WITH " + ",".join(steps) + f""",
s AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: cast(cast(x AS BIGINT) AS VARCHAR)), ','), ','
                               ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS}),
o AS (SELECT vec_id, string_agg(format('{{:02x}}', best.entry), '' ORDER BY part) AS code,
             cast(sum(best.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM o JOIN e USING (vec_id), s"""


ORACLE = _oracle()
