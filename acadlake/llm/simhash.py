"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit where more than half of its shingle hashes have one.  Every bit position gets a nonzero
vector of ``radius + 1`` bits (the vectors take turns); mask v keeps the positions whose vector has an odd inner
product with v.  For at most ``radius`` differing positions some nonzero v is orthogonal to all of their vectors, so
the pair agrees under mask v: with 2^(radius+1) - 1 tables (15 for radius 3) every pair within the radius collides.

Buckets of distinct fingerprints are connected inside tasks: a search from member to member compares real distances
and returns one edge for each member, not pairs.  A bucket above ``BUCKET_LIMIT`` goes on to finer masks instead: its
free positions are cut into 2 * radius blocks, and each choice of ``radius`` blocks is kept as well; at most
``radius`` blocks can hold differences, so again no pair is lost.  Nothing is capped.

Defined results: a null or empty text has fingerprint zero, linked like any other; equal fingerprints are one node, so
copies and repeated rows cost one row each; rows of one id with several texts are separate members; an empty table
gives no rows; other columns are ignored; a component whose ids are all null has the id null.
"""

from __future__ import annotations

from itertools import combinations, repeat

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadlake.llm.common import small_batches, table
from acadlake.llm.components import components
from acadlake.llm.words import utf8, word_blocks
from acadlake.session import cut_lineage

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
BUCKET_LIMIT = 4096


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of a UTF-8 text."""
    import numpy as np
    from xxhash import xxh64_intdigest

    counts, total, tail = np.zeros(BITS, np.int64), 0, []
    for words in word_blocks((text or b"").lower()):
        words = tail + words
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
        tail = words[max(0, len(words) - shingle + 1):]
        for at in range(0, len(grams), 1 << 16):
            part = grams[at:at + (1 << 16)]
            h = np.fromiter(map(xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(part)
    if not total and tail:  # fewer words than a shingle
        counts[:] = [xxh64_intdigest(b" ".join(tail), SEED) >> i & 1 for i in range(BITS)]
        total = 1
    return sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist())


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = [fingerprint(t, shingle) for t in utf8(batch.column(1))]
            signed = [x - (1 << 64) if x >> 63 else x for x in fps]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed, pa.int64())], ["doc_id", "fp"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(run, f"doc_id {kind}, fp bigint")


def covering_masks(radius: int = RADIUS) -> list[int]:
    vectors = [1 + i % ((1 << radius + 1) - 1) for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (vectors[i] & v).bit_count() % 2) for v in range(1, 1 << radius + 1)]


def finer_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """Masks that keep ``mask`` and all but ``radius`` of 2 * radius blocks of the other positions."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    blocks = [free[k::2 * radius] for k in range(2 * radius)]
    return sorted({mask | sum(1 << i for b in keep for i in b) for keep in combinations(blocks, radius)})


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucketed(fps: DataFrame, masks: Column) -> DataFrame:
    df = fps.select("fp", F.explode(masks).alias("mask"))
    return df.select("fp", "mask", (F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))


def bucket_edges(keys, fps, radius: int):
    """Edges member -> finder inside runs of equal keys (numpy arrays, sorted by key)."""
    import numpy as np

    ends = np.flatnonzero(np.append(np.any(keys[1:] != keys[:-1], axis=1), True)) + 1
    out, start = [], 0
    for end in ends.tolist():
        left = np.unique(fps[start:end])
        start = end
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                seed = queue.pop()
                near = np.bitwise_count((left ^ seed).view(np.uint64)) <= radius
                if near.any():
                    found = left[near]
                    out.append(np.column_stack([found, np.full(len(found), seed)]))
                    queue.extend(found)
                    left = left[~near]
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def _edges_of(buckets: DataFrame, radius: int) -> DataFrame:
    """Edges of buckets that one task can hold; a batch boundary inside a bucket is carried over."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        keys, fps = np.empty((0, 2), np.int64), np.empty(0, np.int64)

        def made(k, f):
            e = bucket_edges(k, f, radius)
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["a", "b"])

        for batch in batches:
            col = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            keys = np.concatenate([keys, np.column_stack([col[0], col[1]])])
            fps = np.concatenate([fps, col[2]])
            if not len(keys):
                continue
            open_ = np.flatnonzero(np.any(keys != keys[-1], axis=1))
            cut = open_[-1] + 1 if len(open_) else 0
            if cut:
                yield made(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield made(keys, fps)

    return (buckets.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key")
            .mapInArrow(run, "a bigint, b bigint"))


def links(fps: DataFrame, radius: int = RADIUS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column fp) within ``radius`` of each other."""
    level = _bucketed(fps, F.array(*[F.lit(_signed(m)) for m in covering_masks(radius)]))
    found = None
    while True:
        sizes = cut_lineage(level.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1"), "sh-sizes")
        shared = level.join(sizes, ["mask", "key"])
        edges = cut_lineage(_edges_of(shared.filter(F.col("n") <= limit), radius).distinct(), "sh-edges")
        found = edges if found is None else found.unionByName(edges)
        hot = sizes.filter(F.col("n") > limit)
        masks = [r.mask for r in hot.select("mask").distinct().collect()]      # as many as there are masks, at most
        if not masks:
            return found
        finer = {m: finer_masks(m & (1 << 64) - 1, radius) for m in masks}
        table_ = fps.sparkSession.createDataFrame(
            [(m, [_signed(x) for x in fine if _signed(x) != m]) for m, fine in finer.items()],
            "mask bigint, finer array<bigint>")
        large = level.join(hot, ["mask", "key"]).join(table_, "mask")
        level = cut_lineage(_bucketed(large, F.col("finer")).distinct(), "sh-finer")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the smallest id reachable."""
    marked = cut_lineage(fingerprints(docs, id_col, text_col, shingle), "sh-fingerprints")
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "sh-nodes")
    group = components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    linked = nodes.join(group, "fp")
    best = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    linked = linked.join(best, "label").select("fp", "component_id")
    named = nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    named = cut_lineage(named, "sh-components")
    return marked.join(named, "fp", "left").select("doc_id", "fp", "component_id")


# ------------------------------------------------------------------------------------------ registered query

def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
