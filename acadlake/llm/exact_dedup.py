"""Exact deduplication by a cuckoo-filter index over bucketed digests.

Texts are equal when they are identical after each run of ASCII white space became one space; the SHA-256 of that form
is a text's digest.  The index deals digests into buckets by their first bytes.  A bucket is one row: a cuckoo filter
and the content it stands for (its live digests in full, with how many rows hold each and which row stays).

Rows reach the index as partial groups (digest, first row, number of rows) that each task made of its own batches, so
a digest on a third of all rows costs a bucket one entry for each batch.  A bucket's task takes them one after the other:

* the filter does not know the digest: it is new, and goes into filter and content;
* the filter knows it: the bucket's content decides.  If the digest is there, the group grows; if not, two digests
  share a place in the filter, and the new one is added as well;
* the filter is too full: it is rebuilt twice as large from the digests stored in the content (a digest that finds no
  place in a filter less than a quarter full, because too many share its fingerprint, waits in a stash beside it);
* a removed row makes its group smaller; with the last one, digest and fingerprint leave content and filter.

If buckets have outgrown ``BUCKET_KEYS``, the index is dealt anew into twice as many from the same content, so a task's
memory is bounded whatever the number of rows.  Which row stays after the first one of a group was removed is looked
up among the group's live rows by an equi-join, never gathered in the bucket.

Defined results: a null text is empty; the row with the smallest id stays, null ids last, and of equal ids the row that
was read first (so repeated rows leave one); an empty table gives an empty index; other columns are ignored; removing
rows that the index does not hold changes nothing.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acadlake.llm.common import table
from acadlake.session import cut_lineage

BUCKET_KEYS = 1 << 11           # live digests of a bucket on average, at most
SLOTS = 4                       # fingerprints in a place of the filter
KICKS = 200                     # fingerprints moved before a filter counts as too full
LEAST_PLACES = 4
SPARSE = 4                      # a filter with more than this many slots for a digest is not made larger

SPACES = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"         # what is not one space already


# ------------------------------------------------------------------------------------------ the filter

class CuckooFilter:
    """Fingerprints of 16 bits; one has two places, each found from the other and the fingerprint alone.

    ``add`` answers False when no place was found; the fingerprints held before are all still held then.
    """

    def __init__(self, places: int = LEAST_PLACES, slots: bytes | None = None):
        self.slots = array("H", slots) if slots else array("H", bytes(2 * SLOTS * places))
        self.mask = len(self.slots) // SLOTS - 1          # the number of places is a power of two

    @staticmethod
    def fingerprint(digest: bytes) -> int:
        return (int.from_bytes(digest[8:10], "big") or 1)

    def places(self, digest: bytes) -> tuple[int, int, int]:
        f = self.fingerprint(digest)
        first = int.from_bytes(digest[10:18], "big") & self.mask
        return f, first, self._other(first, f)

    def _other(self, place: int, f: int) -> int:
        return (place ^ (f * 0x5BD1E995 >> 7)) & self.mask

    def _find(self, place: int, f: int) -> int:
        for i in range(place * SLOTS, place * SLOTS + SLOTS):
            if self.slots[i] == f:
                return i
        return -1

    def __contains__(self, digest: bytes) -> bool:
        f, a, b = self.places(digest)
        return self._find(a, f) >= 0 or self._find(b, f) >= 0

    def add(self, digest: bytes) -> bool:
        f, a, b = self.places(digest)
        for place in (a, b):
            if (i := self._find(place, 0)) >= 0:
                self.slots[i] = f
                return True
        place, path = a, []
        for kick in range(KICKS):
            i = place * SLOTS + kick % SLOTS
            path.append(i)
            f, self.slots[i] = self.slots[i], f
            place = self._other(place, f)
            if (i := self._find(place, 0)) >= 0:
                self.slots[i] = f
                return True
        for i in reversed(path):                    # undo, so that nothing that was held is lost
            f, self.slots[i] = self.slots[i], f
        return False

    def remove(self, digest: bytes) -> None:
        f, a, b = self.places(digest)
        i = self._find(a, f)
        i = self._find(b, f) if i < 0 else i
        if i >= 0:
            self.slots[i] = 0


class Bucket:
    """One bucket of the index: the filter, its stash, and its content {digest: [rows, (id is null, id, row)]}."""

    def __init__(self, slots: bytes | None = None, content: dict | None = None, stash: set | None = None):
        self.content, self.stash = content or {}, stash or set()
        self.filter = CuckooFilter(slots=slots) if slots else CuckooFilter()
        self.hits = self.false_hits = self.resizes = 0

    def may_hold(self, digest: bytes) -> bool:
        return digest in self.filter or digest in self.stash

    def _add(self, digest: bytes) -> None:
        if self.filter.add(digest):
            return
        held = [*self.content, digest]
        while len(self.filter.slots) <= SPARSE * len(held):
            self.resizes += 1
            self.filter = CuckooFilter(2 * len(self.filter.slots) // SLOTS)
            self.stash = {d for d in held if not self.filter.add(d)}
            if not self.stash:
                return
        self.stash.add(digest)

    def insert(self, digest: bytes, rows: int, first: tuple) -> None:
        if self.may_hold(digest):
            self.hits += 1
            group = self.content.get(digest)
            if group is not None:
                group[0] += rows
                group[1] = _lesser(group[1], first)
                return
            self.false_hits += 1
        self._add(digest)
        self.content[digest] = [rows, first]

    def remove(self, digest: bytes, rows: int, first: tuple | None) -> None:
        """``first``: the row that stays now, None if that has not changed."""
        if not self.may_hold(digest) or digest not in self.content:
            return
        group = self.content[digest]
        group[0] -= rows
        if group[0] <= 0:
            del self.content[digest]
            if digest in self.stash:
                self.stash.remove(digest)
            else:
                self.filter.remove(digest)
        elif first is not None:
            group[1] = first


# ------------------------------------------------------------------------------------------ tables

@dataclass
class Index:
    """``state``: one row for each bucket; ``rows``: (row, doc_id, digest) of every live row."""

    state: DataFrame | None
    rows: DataFrame | None
    buckets: int = 1


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "dedup-rows") -> DataFrame:
    """(row, doc_id, digest), written: ``row`` tells rows of one id apart and follows the order of reading."""
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACES, " ")
    return cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                                   F.unhex(F.sha2(text, 256)).alias("digest")), label)


def _bucket(buckets: int):
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def _id_type(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def _state_schema(kind: str) -> str:
    return (f"bucket int, slots binary, stash binary, digests binary, counts array<bigint>, ids array<{kind}>, rows array<bigint>, "
            "hits bigint, false_hits bigint, resizes bigint")


def partial_groups(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, digest, n, doc_id, row): one row for each digest and Arrow batch, with its first row."""
    kind = _id_type(rows)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            groups: dict = {}
            bucket, digest, ids, places = (batch.column(i).to_pylist() for i in range(4))
            for b, d, i, r in zip(bucket, digest, ids, places):
                first, old = (i is None, i, r), groups.get(d)
                if old is None:
                    groups[d] = [b, 1, first]
                else:
                    old[1] += 1
                    old[2] = _lesser(old[2], first)
            columns = ([g[0] for g in groups.values()], list(groups), [g[1] for g in groups.values()],
                       [g[2][1] for g in groups.values()], [g[2][2] for g in groups.values()])
            kinds = pa.int32(), pa.binary(), pa.int64(), batch.schema.field(2).type, pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["bucket", "digest", "n", "doc_id", "row"])

    df = rows.select(_bucket(buckets).alias("bucket"), "digest", "doc_id", "row")
    return df.mapInArrow(run, f"bucket int, digest binary, n bigint, doc_id {kind}, row bigint")


def _lesser(a: tuple, b: tuple) -> tuple:
    """The row that stays of two (id is null, id, row)."""
    return a if (a[0], a[1] if not a[0] else 0, a[2]) <= (b[0], b[1] if not b[0] else 0, b[2]) else b


def _load(state) -> Bucket:
    if not len(state):
        return Bucket()
    r = state.slice(0, 1).to_pylist()[0]
    content = {d: [n, (i is None, i, p)] for d, n, i, p in zip(_cut(r["digests"]), r["counts"], r["ids"], r["rows"])}
    return Bucket(r["slots"], content, set(_cut(r["stash"])))


def _cut(digests: bytes) -> list[bytes]:
    return [digests[i:i + 32] for i in range(0, len(digests), 32)]


def _save(number: int, b: Bucket, schema):
    import pyarrow as pa

    groups = list(b.content.values())
    row = (number, b.filter.slots.tobytes(), b"".join(b.stash), b"".join(b.content), [g[0] for g in groups], [g[1][1] for g in groups],
           [g[1][2] for g in groups], b.hits, b.false_hits, b.resizes)
    return pa.table([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)


def _update(state: DataFrame | None, parts: DataFrame, kind: str, change) -> DataFrame:
    """The new state: ``change(bucket, parts)`` in one task for each bucket that has parts; others are kept."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    spark = parts.sparkSession
    schema = _state_schema(kind)
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    if state is None:
        state = spark.createDataFrame([], schema)

    def run(key, held, new):
        b = _load(held)
        if len(new):
            change(b, new)
        return _save(key[0].as_py(), b, arrow)

    out = state.groupBy("bucket").cogroup(parts.groupBy("bucket")).applyInArrow(run, schema)
    return cut_lineage(out, "dedup-state")


def _insert_parts(b: Bucket, parts) -> None:
    for d, n, i, r in zip(*(parts[c].to_pylist() for c in ("digest", "n", "doc_id", "row"))):
        b.insert(d, n, (i is None, i, r))


def groups(index: Index) -> DataFrame:
    """(digest, group_size, keep_id, keep_row) of every live digest."""
    kind = _id_type(index.rows)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_cut(r["digests"]), pa.binary()), pa.array(r["counts"], pa.int64()),
                     pa.array(r["ids"], batch.schema.field(2).type.value_type), pa.array(r["rows"], pa.int64())],
                    ["digest", "group_size", "keep_id", "keep_row"])

    return index.state.select("digests", "counts", "ids", "rows").mapInArrow(
        run, f"digest binary, group_size bigint, keep_id {kind}, keep_row bigint")


def _redeal(index: Index, keys: int) -> Index:
    """The index with enough buckets for ``keys`` digests; filters are built anew from the stored digests."""
    buckets = index.buckets
    while buckets * BUCKET_KEYS < keys:
        buckets *= 2
    if buckets == index.buckets or index.state is None:
        return Index(index.state, index.rows, buckets)
    kind = _id_type(index.rows)
    parts = groups(index).select(_bucket(buckets).alias("bucket"), "digest", F.col("group_size").alias("n"),
                                 F.col("keep_id").alias("doc_id"), F.col("keep_row").alias("row"))
    return Index(_update(None, parts, kind, _insert_parts), index.rows, buckets)


def insert(index: Index | None, rows: DataFrame) -> Index:
    """The index with the rows of ``digests`` added."""
    index = index or Index(None, None)
    if index.rows is not None:
        # later rows come after earlier ones
        last = index.rows.agg(F.max("row").alias("last")).first().last
        rows = rows.withColumn("row", F.col("row") + F.lit(0 if last is None else last + 1))
        rows = cut_lineage(index.rows.unionByName(rows), "dedup-rows"), rows
    else:
        rows = rows, rows
    # an upper bound of the digests: those held and one for each new row
    held = index.state.agg(F.sum(F.size("counts")).alias("n")).first().n or 0 if index.state is not None else 0
    index = _redeal(Index(index.state, index.rows, index.buckets), held + rows[1].count())
    parts = partial_groups(rows[1], index.buckets)
    return Index(_update(index.state, parts, _id_type(rows[0]), _insert_parts), rows[0], index.buckets)


def remove(index: Index, rows: DataFrame) -> Index:
    """The index without the live rows that have the id and digest of a row of ``digests``, all of them."""
    gone = rows.select(F.col("doc_id").alias("id"), F.col("digest").alias("d")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d"))
    out = cut_lineage(index.rows.join(gone, same, "left_semi"), "dedup-gone")
    live = cut_lineage(index.rows.join(gone, same, "left_anti"), "dedup-rows")
    touched = out.groupBy("digest").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    first = live.join(touched.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.min(order).alias("first"))
    parts = touched.join(first, "digest", "left").select(
        _bucket(index.buckets).alias("bucket"), "digest", "n", F.col("first.doc_id").alias("doc_id"),
        F.col("first.row").alias("row"))

    def change(b: Bucket, parts) -> None:
        for d, n, i, r in zip(*(parts[c].to_pylist() for c in ("digest", "n", "doc_id", "row"))):
            b.remove(d, n, None if r is None else (i is None, i, r))

    return Index(_update(index.state, parts, _id_type(index.rows), change), live, index.buckets)


def look_up(index: Index, rows: DataFrame) -> DataFrame:
    """(row, doc_id, digest, known): whether a live text equals the row's.

    Filters answer for most unknown digests; only digests that a filter knows are compared with the content.
    """
    kind = _id_type(rows)
    parts = partial_groups(rows, index.buckets).select("bucket", "digest")

    def run(key, held, new):
        import pyarrow as pa

        b = _load(held) if len(held) else None
        found = [d for d in set(new["digest"].to_pylist()) if b is not None and b.may_hold(d) and d in b.content]
        return pa.table({"known_digest": pa.array(found, pa.binary())})

    known = index.state.groupBy("bucket").cogroup(parts.groupBy("bucket")).applyInArrow(run, "known_digest binary")
    out = rows.join(known, rows["digest"] == known["known_digest"], "left")
    return out.select("row", "doc_id", "digest", F.col("known_digest").isNotNull().alias("known"))


def duplicates(index: Index) -> DataFrame:
    """(row, doc_id, digest, keep_id, group_size, kept) of every live row."""
    g = groups(index)
    return index.rows.join(g, "digest").select(
        "row", "doc_id", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"))


# ------------------------------------------------------------------------------------------ registered query

def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = insert(None, digests(table(spark, sf_dir, "documents")))
    return duplicates(index).select("doc_id", "keep_id", "group_size", "kept",
                                    F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
k AS (SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size,
             row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept FROM d)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM k
"""
