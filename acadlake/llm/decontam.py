"""Benchmark decontamination with a generalised suffix automaton.

The words of the test items form one automaton over all items; documents stream through it word by word, and the
length of the longest match that ends at a word says whether a window (13 words, or a whole shorter item) ends there.
Runs of words that the items use are the only places where a window can lie, so other words are skipped.

Items are dealt into blocks of at most ``BLOCK_WORDS`` words (a longer item in pieces that share all but one word of a
window, so that no window is lost).  Tasks build the blocks' automata and write them under the checkpoint folder.  Each
block is one pass over the documents, and the driver and every task hold one automaton at a time.  With several blocks
the documents are numbered and written once, a pass writes its hits only, and these are merged for each document.

Defined results: null and empty texts have no words and are not contaminated; an item without words has no window; an
empty benchmark hits nothing; repeated items count once by id (a null id is empty text); repeated documents are judged
one by one; documents keep all their columns, results come in one new struct column that replaces a column of its name.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acadlake.llm.folds import without
from acadlake.llm.common import LOWER, UPPER, id_text, small_batches, table
from acadlake.llm.words import utf8, word_blocks
from acadlake.session import cut_lineage

WINDOW = 13
COVERAGE = 20            # contaminated: n_hit > 0 and COVERAGE * n_hit >= n_words
BLOCK_WORDS = 100_000    # words of one automaton (a few hundred bytes each)

# separators: ASCII other than digits and letters; upper-case letters are lowered first
_SEPARATORS = bytes(c if chr(c).isalnum() and c < 128 or c > 127 else 32 for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

RESULT = "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:bigint,end:bigint,words:bigint>>>"


def normal_words(text: bytes) -> list[bytes]:
    return text.lower().translate(_SEPARATORS).split()


class Automaton:
    """Generalised suffix automaton of word sequences, with the windows that end in each state."""

    def __init__(self, window: int):
        self.window, self.words = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        self.items, self.whole, self.up = {}, {}, []

    def _add(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        link[q] = new
        return new

    def _of_length(self, state: int, n: int) -> int:
        while self.length[self.link[state]] >= n and self.link[state] >= 0:
            state = self.link[state]
        return state

    def build(self, items: list[tuple[str, list[bytes]]]) -> "Automaton":
        coded = [(name, [self.words.setdefault(w, len(self.words)) for w in words]) for name, words in items if words]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._add(last, c)
        for name, codes in coded:
            state, short = 0, len(codes) < self.window
            for i, c in enumerate(codes, 1):
                state = self.next[state][c]
                if not short and i >= self.window:
                    self.items.setdefault(self._of_length(state, self.window), set()).add(name)
            if short:
                self.whole.setdefault(self._of_length(state, len(codes)), {}).setdefault(len(codes), set()).add(name)
        self.shortest = min([self.window] + [len(c) for _, c in coded])
        # nearest state on the way to the root, itself included, where a short item ends
        self.up = [-1] * len(self.next)
        for s in sorted(range(len(self.next)), key=self.length.__getitem__):
            self.up[s] = s if s in self.whole else (self.up[self.link[s]] if self.link[s] >= 0 else -1)
        return self

    def dumped(self) -> bytes:
        """Plain containers only: tasks may hold this class by value."""
        return pickle.dumps(vars(self), pickle.HIGHEST_PROTOCOL)

    def match(self, codes: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word spans [start, end) under windows, and the items that have them."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state, n, spans, names = 0, 0, [], set()
        for i, c in enumerate(codes):
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                n += 1
            if n < self.shortest:
                continue
            widest = 0
            if n >= window:
                at = self.items.get(self._of_length(state, window))
                if at:
                    names |= at
                    widest = window
            s = self.up[state]
            while s >= 0:
                for k, own in self.whole[s].items():
                    if k <= n:
                        names |= own
                        widest = max(widest, k)
                s = self.up[link[s]] if link[s] >= 0 else -1
            if widest:
                start = i + 1 - widest
                while spans and spans[-1][1] > start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, names


def loaded(data: bytes) -> Automaton:
    out = Automaton(0)
    vars(out).update(pickle.loads(data))
    return out


def scan_text(text: bytes, automata: list[Automaton]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged hit spans in words, and items."""
    import numpy as np
    from itertools import repeat

    total, found, names = 0, [], set()
    normal = text.lower().translate(_SEPARATORS)
    for k, a in enumerate(automata):
        get, parts = a.words.get, []
        for words in word_blocks(normal):
            parts.append(np.fromiter(map(get, words, repeat(-1)), np.int32, len(words)))
        codes = np.concatenate(parts) if len(parts) != 1 else parts[0]
        total = len(codes)
        known = np.flatnonzero(np.diff(np.concatenate([[0], (codes >= 0).view(np.int8), [0]])))
        for lo, hi in zip(known[::2].tolist(), known[1::2].tolist()):
            if hi - lo >= a.shortest:
                spans, got = a.match(codes[lo:hi].tolist())
                found += [(lo + s, lo + e) for s, e in spans]
                names |= got
    if not automata:
        total = sum(map(len, word_blocks(normal)))
    return total, merged_spans(found), names


def merged_spans(found) -> list[tuple[int, int]]:
    """Spans that overlap become one."""
    merged: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if merged and s < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged


def character_spans(text: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Word spans as code-point spans (only asked for where something was hit)."""
    where = [m.span() for m in _WORD.finditer(text.lower())]
    return [{"start": len(text[:where[s][0]].decode()), "end": len(text[:where[e - 1][1]].decode()), "words": e - s}
            for s, e in spans]


@dataclass(frozen=True)
class Block:
    """A written automaton."""

    written: DataFrame
    block: int
    turn: int

    def data(self) -> bytes:
        return bytes(self.written.filter((F.col("block") == self.block) & (F.col("turn") == self.turn)).first().data)


def pieces(words: list[bytes], window: int, block_words: int) -> list[list[bytes]]:
    """An item in runs of at most ``block_words`` words (a window at least) that have all of its windows."""
    most = max(window, block_words)
    step = most - window + 1
    return [words[at:at + most] for at in range(0, max(1, len(words) - window + 1), step)] if len(words) > most else [words]


def automata(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
             block_words: int = BLOCK_WORDS) -> list[Block]:
    """The items' automata, built and written by tasks; a task holds one of them at a time."""

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                for part in pieces(normal_words(text or b""), window, block_words):
                    if part:
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b" ".join(part)], pa.binary()),
                                                          pa.array([len(part)], pa.int64())], ["name", "words", "n"])

    def build(batches):
        import pyarrow as pa

        def done():
            data = Automaton(window).build(held).dumped()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([turn], pa.int64()),
                                               pa.array([data], pa.binary())], ["block", "turn", "data"])

        now, turn, held, n = None, 0, [], 0
        for batch in batches:
            for block, name, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
                words = words.split()
                if held and (block != now or n + len(words) > block_words):
                    yield done()
                    turn, held, n = (turn + 1 if block == now else 0), [], 0
                now = block
                held.append((name, words))
                n += len(words)
        if held:
            yield done()

    small_batches(benchmark.sparkSession)
    rows = benchmark.select(id_text(F.col(id_col)).alias("name"), F.col(text_col).alias("text")).distinct()
    parts = cut_lineage(rows.mapInArrow(cut, "name string, words binary, n bigint"), "decontam-items")
    total = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    block = F.pmod(F.xxhash64("name", "words"), F.lit(max(1, -(-total // block_words))))
    dealt = parts.select(block.alias("block"), "name", "words").repartition("block")
    dealt = dealt.sortWithinPartitions("block", "name", "words")
    written = cut_lineage(dealt.mapInArrow(build, "block bigint, turn bigint, data binary"), "decontam-automata")
    return [Block(written, r.block, r.turn) for r in written.select("block", "turn").orderBy("block", "turn").collect()]


def _results(texts, found):
    """The result column of texts with (words, word spans, items)."""
    import pyarrow as pa

    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                      ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())])))])
    return pa.array([{"n_words": n, "n_hit": sum(e - s for s, e in spans), "items": sorted(names),
                      "spans": character_spans(text, spans) if spans else []}
                     for text, (n, spans, names) in zip(texts, found)], kind)


def _hits(numbered: DataFrame, block: Block) -> DataFrame:
    """(row, starts, ends, names) of the documents that one block hits, from one pass."""
    held = numbered.sparkSession.sparkContext.broadcast(block.data())

    def run(batches):
        import pyarrow as pa

        own = [loaded(held.value)]
        for batch in batches:
            got = [(row, *scan_text(t or b"", own)[1:]) for row, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)))]
            got = [g for g in got if g[1]]
            yield pa.RecordBatch.from_arrays([
                pa.array([r for r, _, _ in got], pa.int64()),
                pa.array([[a for a, _ in spans] for _, spans, _ in got], pa.list_(pa.int64())),
                pa.array([[b for _, b in spans] for _, spans, _ in got], pa.list_(pa.int64())),
                pa.array([sorted(names) for _, _, names in got], pa.list_(pa.string()))], ["row", "starts", "ends", "names"])

    out = cut_lineage(numbered.mapInArrow(run, "row bigint, starts array<bigint>, ends array<bigint>, names array<string>"),
                      "decontam-hits")
    held.destroy()
    return out


def annotate(docs: DataFrame, found: list[Block], text_col: str = "text", out: str = "decontamination") -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit, items, spans (code points and words)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop(out)
    schema = T.StructType(docs.schema.fields + [T.StructField(out, T._parse_datatype_string(RESULT))])
    columns, at, width = docs.columns, docs.columns.index(text_col), len(docs.columns)

    if len(found) < 2:
        held = [spark.sparkContext.broadcast(b.data()) for b in found]

        def run(batches):
            import pyarrow as pa

            own = [loaded(b.value) for b in held]
            for batch in batches:
                texts = [t or b"" for t in utf8(batch.column(at))]
                result = _results(texts, [scan_text(t, own) for t in texts])
                yield pa.RecordBatch.from_arrays([*batch.columns, result], [*batch.schema.names, out])

        return docs.mapInArrow(run, schema)

    # the documents' own columns in one struct, so that their names cannot meet those of the numbers and the hits
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    numbered = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), whole), "decontam-numbered")
    texts = numbered.select("row", F.col(f"doc.`{text_col}`").alias("text"))
    hits = None
    for block in found:
        own = _hits(texts, block)
        hits = own if hits is None else hits.unionByName(own)
    hits = hits.groupBy("row").agg(*[F.flatten(F.collect_list(c)).alias(c)
                                     for c in ("starts", "ends", "names")])
    met = numbered.join(hits, "row", "left").select(
        *[F.col(f"doc.`{c}`").alias(f"doc_{i}") for i, c in enumerate(docs.columns)], "starts", "ends", "names")

    def merge(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t or b"" for t in utf8(batch.column(at))]
            found = [(scan_text(t, [])[0], merged_spans(zip(a or [], b or [])), set(names or [])) for t, a, b, names in zip(
                texts, *(batch.column(width + i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], _results(texts, found)],
                                             [*columns, out])

    return met.mapInArrow(merge, schema)


def contaminated(out: str = "decontamination"):
    n = F.col(f"{out}.n_hit")
    return (n > 0) & (COVERAGE * n >= F.col(f"{out}.n_words"))


def without_spans(text, spans, least: int = WINDOW):
    """``text`` without the spans of at least ``least`` words."""
    return without(text, F.filter(spans, lambda s: s["words"] >= least))


# ------------------------------------------------------------------------------------------ registered query

def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = annotate(docs, automata(table(spark, sf_dir, "benchmark")))
    r = "decontamination"
    return out.select("doc_id", f"{r}.n_words", f"{r}.n_hit", F.size(f"{r}.items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort(f"{r}.items"), ","), 256).alias("items_sha256"),
                      contaminated(r).alias("contaminated"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT coalesce(cast(item_id AS VARCHAR), '') AS item,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS k, list_slice(w, i, i + least({WINDOW}, len(w)) - 1) AS g
        FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
pos AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k),
hit AS (SELECT r, i, pos.k, item FROM pos JOIN win ON pos.k = win.k AND list_slice(w, i, i + pos.k - 1) = g),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS j FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit > 0 AND {COVERAGE} * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)
"""
