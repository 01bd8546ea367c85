"""Language-model scores by online logistic context mixing.

A text is coded as a sequence of binary decisions: each token (word or end) is a path in a Huffman tree over the end,
an escape and the training words seen at least twice, ``TOP_WORDS`` of them at most.  An escape is followed by the
word's share of all escaped training words, or by the share kept for unknown words (estimated from the words seen
once).  Like the base score, the score takes all unknown words for one; the bits per byte add their spelling, so that
they are those of a whole code: each byte of an unknown word (a blank ends it) is a path in a second Huffman tree.

For a decision at tree node x three predictors know how often it went either way in the training texts:

* x itself;
* x with the last of the ``TOPICS`` most frequent words before it, hashed;
* x with the class of the word before it, hashed.

At a node of the byte tree they know x itself, x with the last frequent word and the byte before, and x with the two
bytes before; these tables are indexed directly, so they have no collisions.  They are counted on the escaped words.

Their counts fill fixed tables (``SLOTS`` entries for a hashed one), summed over all training documents by Spark; they are reduced
to a log-odds and a confidence per slot, which bounds what is broadcast.  A logistic mixer adds the three log-odds
with weights chosen by gates (the confidences of both hashed predictors), and refines the weights online along
the text: each block of decisions (the first has ``LEAST_BLOCK``, later ones up to ``BLOCK``) is scored with the
weights so far and then moves them along the gradient.  Every
document starts from the same weights, which are fitted on all training documents: in ``FIT_ROUNDS`` Newton rounds
tasks add up each gate's gradient and curvature as whole numbers, so a score does not depend on partitions or order.

One pass over the training texts counts every symbol in its contexts (token, topic, class; spelled byte, topic, two
bytes before) into a written table, which grows with the corpus and holds each distinct one once.  The predictors'
tables and all rounds of the fit are sums over that table, weighted by the counts.  Scoring goes through the texts of
a group together, each with its own weights; a text above ``GROUP`` bytes is scored alone, a block of words at a time.

The base score is exact: words beyond the ``TOP_WORDS`` meet the table of all training counts in an equi-join.

Defined results: a null text is an empty one (its only token is the end); with no training texts every count is 0;
equal rows are scored one by one; a null id hashes as empty text; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass
from itertools import islice, repeat

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acadlake.llm.common import crc_mod, small_batches, table
from acadlake.llm.words import BLOCK as WORDS, split_words, utf8, word_blocks
from acadlake.session import cut_lineage

TOP_WORDS = 1 << 17
TOPICS = 64
SLOTS = 1 << 20          # entries of a hashed table
CHUNK = 1 << 14          # counts of a table that travel in one row
FIT_ROUNDS = 2           # passes over the counted contexts for the starting weights
FIT_UNIT = 1 << 16       # a row's sums are added as whole numbers of 1 / FIT_UNIT
RIDGE = 1.0              # pull of the first weights, for gates that are seldom met
RATE = 0.02             # for log-odds in units; weights are for sixteenths
LEAST_BLOCK, BLOCK = 64, 1024    # decisions that are scored with the same weights: first, most
END, ESCAPE, FIRST = 0, 1, 2
GATES = 64
GROUP = 1 << 18          # bytes of texts that are scored together
LOOKED = 1 << 22         # bytes of texts whose words are looked up together
TOKENS = 1 << 12         # tokens whose decisions are found together
HELD_WORDS = 1_000_000   # counts of words (of some texts each) that a task holds before it adds them up
HELD = 1 << 23           # symbols that a task holds before it counts them
BUCKET_TOKENS = 1 << 21  # training tokens for each bucket of counted contexts
ROW_KEYS = 1 << 16       # counted contexts in one row
SPELLED = 1 << 60        # marks the contexts of a spelled byte
BYTES = 256
BLANK = 32               # ends a spelled word
SPELLING = (BYTES, (FIRST + TOPICS) * BYTES * BYTES, BYTES ** 3)    # entries of the byte predictors' tables


def huffman(weights: list[int]):
    """Code of each symbol as (inner node, bit) steps; returns flat nodes, flat bits, offsets, lengths, inner nodes."""
    import numpy as np

    n = len(weights)
    heap = [(max(1, w), i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, side, made = [0] * (2 * n - 1), [0] * (2 * n - 1), n
    while len(heap) > 1:
        (wa, a), (wb, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a] = parent[b] = made
        side[b] = 1
        heapq.heappush(heap, (wa + wb, made))
        made += 1
    nodes, bits, offsets, lengths, root = [], [], [], [], made - 1
    for i in range(n):
        path, at = [], i
        while at != root:
            path.append((parent[at] - n, side[at]))
            at = parent[at]
        offsets.append(len(nodes))
        lengths.append(len(path))
        nodes += [x for x, _ in reversed(path)]
        bits += [x for _, x in reversed(path)]
    return (np.array(nodes, np.int32), np.array(bits, np.int8), np.array(offsets, np.int32),
            np.array(lengths, np.int32), max(0, n - 1))


class Coder:
    """Turns words into decisions: tree node, two hashed contexts, bit."""

    def __init__(self, words: list[tuple[bytes, int]], ends: int, rare: int, byte_counts: list[int] | None = None):
        self.words, self.counts = words, [ends, rare] + [c for _, c in words]
        self.tree, self.byte_tree = huffman(self.counts), huffman(byte_counts or [1] * BYTES)
        self.nodes = self.tree[4]
        self._ready = False

    def __getstate__(self):
        return self.__dict__ | {"_ready": False, "index": None, "known": None, "classes": None, "paths": None}

    def ready(self) -> "Coder":
        import numpy as np

        if not self._ready:
            import pyarrow as pa

            self.index = {w: i for i, (w, _) in enumerate(self.words, FIRST)}
            self.known = pa.array([w for w, _ in self.words], pa.binary())
            self.paths = [(nodes << 1 | bits, offsets, lengths)
                          for nodes, bits, offsets, lengths, _ in (self.tree, self.byte_tree)]
            last = np.array([0, 0] + [w[-1] for w, _ in self.words], np.uint32)
            rank = np.arange(len(last), dtype=np.uint32)
            self.classes = np.where(rank < 256, rank, 256 + last).astype(np.uint32)
            self._ready = True
        return self

    def tokens(self, words: list[bytes], final: bool):
        """Ids of the words (and of the end), and the words that are escaped."""
        import numpy as np

        ids = np.fromiter(map(self.index.get, words, repeat(ESCAPE)), np.int32, len(words))
        escaped = [words[i] for i in np.flatnonzero(ids == ESCAPE).tolist()]
        return (np.append(ids, np.int32(END)) if final else ids), escaped

    def contexts(self, ids, topic: int, before: int):
        """Topic and class before each word, and those that the next block starts with."""
        import numpy as np

        topics = _topics(ids, topic)
        classes = self.classes[ids]
        return (np.concatenate([[topic], topics[:-1]]), np.concatenate([[before], classes[:-1]]),
                int(topics[-1]), int(classes[-1]))

    def steps(self, ids, topics, classes):
        """(node, slot 1, slot 2, bit) arrays of tokens after a topic and a class, and each token's decisions."""
        import numpy as np

        node, bit, n = _paths(self.paths[0], ids)
        mixed = node.view(np.uint32) * np.uint32(0x2C1B3C6D)
        return (node, _slot(mixed, topics, n, 0x9E3779B1), _slot(mixed, classes, n, 0x85EBCA77), bit), n

    def decisions(self, ids, topic: int, before: int):
        """(node, slot 1, slot 2, bit) arrays, and the topic and class that the next block starts with."""
        topics, classes, topic, before = self.contexts(ids, topic, before)
        return self.steps(ids, topics, classes)[0], topic, before

    def spelled(self, ids, escaped: list[bytes], topic: int):
        """Bytes of the escaped words, the topic and the two bytes before each, and its word."""
        import numpy as np

        return self.spelled_after(np.concatenate([[topic], _topics(ids, topic)[:-1]])[ids == ESCAPE], escaped)

    @staticmethod
    def spelled_after(topics, escaped: list[bytes]):
        """The same for escaped words (of any number of texts), each after one of the topics."""
        import numpy as np

        data = np.frombuffer(b" ".join(escaped) + b" ", np.uint8).astype(np.int32)
        word = np.repeat(np.arange(len(escaped)), np.fromiter(map(len, escaped), np.int64, len(escaped)) + 1)
        prev = np.concatenate([[BLANK], data[:-1]])
        prev2 = np.where(prev == BLANK, BLANK, np.concatenate([[BLANK, BLANK], data[:-2]])[:len(data)])
        return data, topics[word], prev, prev2, word

    def byte_steps(self, data, topics, prev, prev2):
        """(node, slot 1, slot 2, bit) arrays of spelled bytes, and each byte's decisions."""
        import numpy as np

        node, bit, n = _paths(self.paths[1], data)
        one = np.repeat((topics * BYTES + prev) * BYTES, n) + node
        two = np.repeat((prev2 * BYTES + prev) * BYTES, n) + node
        return (node, one.astype(np.int32), two.astype(np.int32), bit), n

    def spelling(self, ids, escaped: list[bytes], topic: int):
        """(node, slot 1, slot 2, bit) arrays over the bytes of the escaped words, and the word of each decision."""
        import numpy as np

        *symbols, word = self.spelled(ids, escaped, topic)
        steps, n = self.byte_steps(*symbols)
        return steps, np.repeat(word, n)

    def groups(self, texts: list[bytes]):
        """Texts in order, some at a time, and what ``laid`` gives for them (None for a text that is too long and alone)."""
        for many in _groups(texts, LOOKED):
            plain, ends, words = self._looked_up([t if len(t) <= GROUP else b"" for t in many])
            at = 0
            for group in _groups(many, GROUP):
                cut = ends[at:at + len(group) + 1]
                at += len(group)
                yield group, (None if len(group[0]) > GROUP else self.laid(plain[cut[0]:cut[-1]], cut - cut[0],
                                                                          words.slice(cut[0], cut[-1] - cut[0])))

    def _looked_up(self, texts: list[bytes]):
        """Ids of the words of texts one after another, the place of each text's first word (and the end), the words."""
        import numpy as np
        import pyarrow.compute as pc

        words, ends = split_words(texts)
        ids = pc.fill_null(pc.index_in(words, self.known), ESCAPE - FIRST).to_numpy() + np.int32(FIRST)
        return ids, ends, words

    def laid(self, plain, ends, words):
        """Ids of the tokens of whole texts one after another, the place of each text's first token (and the end),
        topic and class before each token, the escaped words, and the place of each text's first one (and the end)."""
        import numpy as np

        at = np.flatnonzero(plain == ESCAPE)
        escaped = words.take(at).to_pylist()
        ids = np.insert(plain, ends[1:], END)
        starts = ends + np.arange(len(ends))
        first = np.repeat(starts[:-1], np.diff(starts))
        seen = np.maximum.accumulate(np.where((ids >= FIRST) & (ids < FIRST + TOPICS), np.arange(len(ids)), -1))
        seen[1:] = seen[:-1]
        seen[0] = -1
        topics = np.where(seen >= first, ids[seen], 0)
        classes = np.zeros(len(ids), np.uint32)
        classes[1:] = self.classes[ids[:-1]]
        classes[starts[:-1]] = 0
        return ids, starts, topics, classes, escaped, np.searchsorted(at, ends)


def _topics(ids, topic: int):
    """The last frequent word up to each token."""
    import numpy as np

    where = np.where((ids >= FIRST) & (ids < FIRST + TOPICS), np.arange(len(ids)), -1)
    seen = np.maximum.accumulate(where)
    return np.where(seen >= 0, ids[seen], topic)


def _paths(paths, ids):
    """Concatenated code paths of the symbols: nodes, bits, and the number of steps of each symbol."""
    import numpy as np

    steps, offsets, lengths = paths
    n = lengths[ids]
    at = np.repeat(offsets[ids] - (np.cumsum(n, dtype=np.int32) - n), n)
    at += np.arange(len(at), dtype=np.int32)
    steps = steps[at]
    return steps >> 1, (steps & 1).astype(np.int8), n


def _slot(mixed, context, n, seed: int):
    """Hash of each (multiplied) node and the context of its symbol, which has ``n`` nodes."""
    import numpy as np

    h = np.repeat((context.astype(np.uint32) + np.uint32(1)) * np.uint32(seed), n)
    h += mixed
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x297A2D39)
    h >>= np.uint32(32 - (SLOTS.bit_length() - 1))
    return h.view(np.int32)


def text_decisions(coder: Coder, text: bytes):
    """Decisions of a whole text, a block of words at a time, with its words' ids and escaped words."""
    for steps, ids, escaped, _ in _text_blocks(coder, text):
        yield steps, ids, escaped


def _token_blocks(coder: Coder, text: bytes):
    """Ids of a block of words (the last one with the end) and its escaped words."""
    blocks = word_blocks(text.lower())
    words = next(blocks, [])
    while words is not None:
        after = next(blocks, None)
        ids, escaped = coder.tokens(words, after is None)
        if len(ids):
            yield ids, escaped
        words = after


def _text_blocks(coder: Coder, text: bytes):
    """The same with the topic before the block."""
    topic, before = 0, 0
    for ids, escaped in _token_blocks(coder, text):
        first = topic
        steps, topic, before = coder.decisions(ids, topic, before)
        yield steps, ids, escaped, first


# ---------------------------------------------------------------------------------------------- training counts

def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; tasks add up before the shuffle and hold a bounded number of words."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        held, size = [], 0

        def counted(words):
            found = pc.value_counts(words)
            return pa.table([found.field(0), found.field(1)], ["word", "n"])

        def flushed():
            total = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            held.clear()
            yield from total.rename_columns(["word", "n"]).to_batches(1 << 14)
            del total
            pa.default_memory_pool().release_unused()

        def parts(batch):
            texts = [t or b"" for t in utf8(batch.column(0))]
            yield split_words([t if len(t) <= WORDS else b"" for t in texts])[0]
            for text in texts:
                if len(text) > WORDS:
                    for words in word_blocks(text.lower()):
                        yield pa.array(words, pa.binary())

        for batch in _merged(batches, 0):
            for words in parts(batch):
                held.append(counted(words))
                size += len(held[-1])
                if size > HELD_WORDS:
                    yield from flushed()
                    size = 0
        if held:
            yield from flushed()

    return docs.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Escaped:
    """Counts of the words outside the tree."""

    least: int          # a word of the tree has this count or more
    tokens: int
    once: int           # words seen once, all of them outside

    @property
    def unknown(self) -> float:
        """Share of the escapes that is kept for unknown words."""
        return (self.once + 0.5) / (self.tokens + self.once + 1)


def build_coder(counts: DataFrame, ends: int, top: int = TOP_WORDS) -> tuple[Coder, Escaped]:
    """The number of words of each count decides what goes into the tree; ``top`` words at most come to the driver."""
    by_count = counts.groupBy("n").agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).orderBy(F.desc("n"))
    least, words, inside, total, once = 1 << 62, 0, 0, 0, 0
    for r in by_count.toLocalIterator():    # distinct counts: at most the root of twice the tokens
        total += r.tokens
        once = r.words if r.n == 1 else once
        words += r.words
        if words <= top and r.n > 1:
            least, inside = r.n, inside + r.tokens
    rows = counts.filter(F.col("n") >= least).select("word", "n").collect()
    chosen = sorted(((bytes(r.word), r.n) for r in rows), key=lambda x: (-x[1], x[0]))

    def histogram(batches):
        import numpy as np
        import pyarrow as pa

        seen = np.zeros(BYTES, np.int64)
        for batch in batches:
            for word, n in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                seen += n * np.bincount(np.frombuffer(word + b" ", np.uint8), minlength=BYTES)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], ["byte", "n"])

    spelled = counts.filter(F.col("n") < least).select("word", "n").mapInArrow(histogram, "byte bigint, n bigint")
    byte_counts = [1] * BYTES
    for r in spelled.groupBy("byte").agg(F.sum("n").alias("n")).collect():
        byte_counts[r.byte] += r.n
    return Coder(chosen, ends, total - inside, byte_counts), Escaped(least, total - inside, once)


def _pack(counts, base: int):
    """Chunks of a count table as bytes: places and values if few are set, else all values."""
    import numpy as np

    for at in range(0, len(counts), CHUNK):
        part = counts[at:at + CHUNK].astype(np.int64)
        used = np.flatnonzero(part)
        if len(used):
            dense = 2 * len(used) >= len(part)
            yield base + at // CHUNK, (b"d" + part.tobytes() if dense
                                       else b"s" + used.astype(np.int64).tobytes() + part[used].tobytes())


def _pack_few(places, counts, base: int):
    """The same for a large table of which few places, given in order, are set."""
    import numpy as np

    cuts = np.flatnonzero(np.diff(places // CHUNK)) + 1
    for at, n in zip(np.split(places, cuts), np.split(counts, cuts)):
        if len(at):
            yield base + int(at[0]) // CHUNK, b"s" + (at % CHUNK).astype(np.int64).tobytes() + n.astype(np.int64).tobytes()


def _unpack(data: bytes, into) -> None:
    import numpy as np

    values = np.frombuffer(data[1:], np.int64)
    if data[:1] == b"d":
        into[:len(values)] += values
    else:
        half = len(values) // 2
        into[values[:half]] += values[half:]


def _sum_chunks(parts: DataFrame, keys: list[str], out: str, finish) -> DataFrame:
    """Adds up packed chunks with equal keys, one row at a time."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def done(key, total):
            return pa.RecordBatch.from_arrays(
                [*[pa.array([k], pa.int64()) for k in key], pa.array([finish(total)], pa.binary())], [*keys, "data"])

        now, total = None, None
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(len(keys))]
            for *key, data in zip(*cols, utf8(batch.column(len(keys)))):
                if key != now:
                    if now is not None:
                        yield done(now, total)
                    now, total = key, np.zeros(CHUNK, np.int64)
                _unpack(data, total)
        if now is not None:
            yield done(now, total)

    return (parts.select(*keys, "data").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, ", ".join(f"{k} bigint" for k in keys) + ", data binary"))


def _dense(total) -> bytes:
    import numpy as np

    return b"d" + total.astype(np.int64).tobytes()


def _odds(total) -> bytes:
    """Log-odds (sixteenths) and confidence (0 to 7) of each pair of counts."""
    import numpy as np

    zero, one = total[0::2], total[1::2]
    odds = np.clip(np.rint(16 * np.log((one + 0.4) / (zero + 0.4))), -127, 127).astype(np.int8)
    sure = np.minimum(7, np.log2(zero + one + 1) / 1.5).astype(np.uint8)
    return zlib.compress(odds.tobytes() + sure.tobytes(), 1)        # the byte predictors set few places of a chunk


class Tables:
    """Log-odds (sixteenths, plus 128) and confidence (times 256) of the three predictors, in one code per slot."""

    def __init__(self, nodes: int, chunks: dict[int, bytes]):
        self.codes, base = self._filled((nodes, SLOTS, SLOTS), chunks, 0)
        self.spelling, _ = self._filled(SPELLING, chunks, base)

    @staticmethod
    def _filled(sizes, chunks: dict[int, bytes], base: int):
        import numpy as np

        out = []
        for size in sizes:
            pairs = -(-2 * size // CHUNK)
            codes = np.full(pairs * CHUNK // 2, 128, np.uint16)
            for i in range(pairs):
                if base + i in chunks:
                    data = np.frombuffer(zlib.decompress(chunks[base + i]), np.int8)
                    odds, sure = data[:CHUNK // 2].astype(np.int16) + 128, data[CHUNK // 2:].astype(np.uint16)
                    codes[i * CHUNK // 2:(i + 1) * CHUNK // 2] = odds.astype(np.uint16) | sure << np.uint16(8)
            out.append(codes)
            base += pairs
        return out, base


def _added(keys, counts):
    """Distinct keys in order and the sums of their counts."""
    import numpy as np

    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def _pack_keys(keys, counts) -> bytes:
    """Keys in order, as differences, and their counts."""
    import numpy as np

    return np.diff(keys, prepend=0).astype(np.int64).tobytes() + counts.astype(np.int64).tobytes()


def _unpack_keys(data: bytes):
    import numpy as np

    values = np.frombuffer(data, np.int64)
    return np.cumsum(values[:len(values) // 2]), values[len(values) // 2:]


def context_counts(docs: DataFrame, coder: Coder, tokens: int) -> DataFrame:
    """(data) Every token with the topic and class before it, and every byte of an escaped word with the topic and the
    two bytes before it, counted over all texts: each distinct one in one row, ``ROW_KEYS`` at most in a row.

    Tasks count what they hold before the shuffle, so a hot context costs one entry a flush; buckets follow ``tokens``.
    """
    held, buckets = docs.sparkSession.sparkContext.broadcast(coder), max(1, tokens // BUCKET_TOKENS)

    def count(batches):
        import numpy as np
        import pyarrow as pa

        own, wait, waiting = held.value.ready(), [], 0

        def flushed():
            keys = np.concatenate(wait)
            wait.clear()
            keys.sort()
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(first, append=len(keys))
            keys = keys[first]
            bucket = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            rows = [(int(bucket[part[0]]), _pack_keys(keys[part], counts[part])) for part in np.split(order, cuts)]
            for at in range(0, len(rows), 64):
                of, data = zip(*rows[at:at + 64])
                yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(data, pa.binary())], ["bucket", "data"])
            pa.default_memory_pool().release_unused()

        def add(ids, topics, classes, escaped):
            keys = ids.astype(np.int64) << 17 | topics.astype(np.int64) << 10 | classes.astype(np.int64)
            wait.append(keys)
            if escaped:
                data, topics, prev, prev2, _ = own.spelled_after(topics[ids == ESCAPE], escaped)
                wait.append(SPELLED | data.astype(np.int64) << 23 | topics.astype(np.int64) << 16 | prev << 8 | prev2)
                return len(keys) + len(data)
            return len(keys)

        for batch in _merged(batches, 0):
            for texts, laid in own.groups([t or b"" for t in utf8(batch.column(0))]):
                if laid is None:
                    topic, before = 0, 0
                    for ids, escaped in _token_blocks(own, texts[0]):
                        topics, classes, topic, before = own.contexts(ids, topic, before)
                        waiting += add(ids, topics, classes, escaped)
                        if waiting > HELD:
                            yield from flushed()
                            waiting = 0
                else:
                    ids, _, topics, classes, escaped, _ = laid
                    waiting += add(ids, topics, classes, escaped)
                if waiting > HELD:
                    yield from flushed()
                    waiting = 0
        if waiting:
            yield from flushed()

    def merge(batches):
        import numpy as np
        import pyarrow as pa

        now, keys, counts, more, size = None, np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def done():
            for at in range(0, len(keys), ROW_KEYS):
                data = _pack_keys(keys[at:at + ROW_KEYS], counts[at:at + ROW_KEYS])
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        def joined():
            parts = [(keys, counts), *more]
            return _added(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))

        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if bucket != now:
                    keys, counts = joined()
                    yield from done()
                    now, keys, counts, more, size = bucket, keys[:0], counts[:0], [], 0
                more.append(_unpack_keys(data))
                size += len(more[-1][0])
                if size > HELD // 4:        # sums need several arrays of that length at once
                    keys, counts = joined()
                    more, size = [], 0
        keys, counts = joined()
        yield from done()

    parts = docs.select("text").mapInArrow(count, "bucket bigint, data binary")
    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "data binary")


def _merged(batches, column: int):
    """Batches put together until their texts have about ``LOOKED`` bytes."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        own = batch.column(column).nbytes
        if held and size + own > LOOKED:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield pa.concat_batches(held)


def _groups(texts: list[bytes], most: int):
    """Texts in order, about ``most`` bytes at a time; a longer one stands alone."""
    now, size = [], 0
    for text in texts:
        if now and size + len(text) > most:
            yield now
            now, size = [], 0
        now.append(text)
        size += len(text)
    if now:
        yield now


def _counted_steps(coder: Coder, data: bytes):
    """Decisions of the counted tokens and of the counted bytes, each with the counts of its decisions."""
    import numpy as np

    keys, counts = _unpack_keys(data)
    cut = int(np.searchsorted(keys, SPELLED))
    word, byte = keys[:cut], keys[cut:]
    steps, n = coder.steps(word >> 17, word >> 10 & 127, word & 1023)
    spelled, m = coder.byte_steps(byte >> 23 & 255, byte >> 16 & 127, byte >> 8 & 255, byte & 255)
    return (steps, np.repeat(counts[:cut], n)), (spelled, np.repeat(counts[cut:], m))


def train_tables(counted: DataFrame, coder: Coder) -> Tables:
    """Counts of every decision of every training text, from the counted contexts, added up in two levels, so that no
    task gets one row per task of a large input; only the reduced tables (a few MB, fixed) reach the driver."""
    held = counted.sparkSession.sparkContext.broadcast(coder)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        own = held.value.ready()
        sizes = [own.nodes, SLOTS, SLOTS]
        sums = [np.zeros(2 * s) for s in sizes]
        few = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * 3      # places and counts of the byte predictors
        for batch in batches:
            for data in utf8(batch.column(0)):
                ((*slots, bit), times), ((*byte_slots, byte_bit), byte_times) = _counted_steps(own, data)
                for k, x in enumerate(slots):       # whole numbers, exact in a double up to 2^53
                    np.add.at(sums[k], 2 * x.astype(np.intp) + bit, times.astype(np.float64))
                for k, x in enumerate(byte_slots):
                    places, counts = few[k]
                    few[k] = _added(np.concatenate([places, 2 * x + byte_bit]), np.concatenate([counts, byte_times]))
        salt, base = TaskContext.get().partitionId() // 64, 0
        packed = []
        for k in range(3):
            packed.append(_pack(sums[k], base))
            base += -(-2 * sizes[k] // CHUNK)
        for k in range(3):
            packed.append(_pack_few(*few[k], base))
            base += -(-2 * SPELLING[k] // CHUNK)
        for rows in packed:
            for chunk, data in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([salt], pa.int64()), pa.array([data], pa.binary())],
                    ["chunk", "salt", "data"])

    parts = counted.select("data").mapInArrow(run, "chunk bigint, salt bigint, data binary")
    near = _sum_chunks(parts, ["chunk", "salt"], "data", _dense)
    rows = _sum_chunks(near, ["chunk"], "data", _odds).collect()
    return Tables(coder.nodes, {r.chunk: bytes(r.data) for r in rows})


# ---------------------------------------------------------------------------------------------------- the mixer

def starting_weights():
    """One row of weights per predictor; log-odds are in sixteenths."""
    import numpy as np

    return np.repeat(np.array([[0.3], [0.35], [0.35]], np.float32) / 16, GATES, axis=1)


def mix_block(tables: Tables, weights, steps, rate: float = RATE / 256, block: int = LEAST_BLOCK, of=None, costs=None) -> float:
    """log10 probability of the decisions; ``weights`` are refined on the way, ``costs[of]`` gets each one's share."""
    import numpy as np

    *slots, bit = steps
    tables = tables.codes if costs is None else tables.spelling
    total, at, n = 0.0, 0, len(bit)
    while at < n:
        end = min(n, at + block)
        block = min(BLOCK, 2 * block)
        codes = [np.take(t, s[at:end], mode="clip") for t, s in zip(tables, slots)]
        x = [(c & np.uint16(255)).astype(np.float32) - np.float32(128) for c in codes]
        gate = (codes[1] >> np.uint16(8) << np.uint16(3) | codes[2] >> np.uint16(8)).astype(np.intp)
        z = np.take(weights[0], gate, mode="clip") * x[0]
        z += np.take(weights[1], gate, mode="clip") * x[1]
        z += np.take(weights[2], gate, mode="clip") * x[2]
        np.clip(z, -12, 12, out=z)
        sign = bit[at:end] * np.float32(2) - np.float32(1)
        z *= sign
        odds = np.exp(-z)                       # against the decision
        loss = np.log(1 + odds)
        total -= float(loss.sum(dtype=np.float64))
        if costs is not None:
            costs += np.bincount(of[at:end], loss, len(costs)) / 2.302585092994046
        error = sign * (odds / (1 + odds))      # decision minus its predicted probability
        error = error.astype(np.float64)
        used = np.sqrt(np.maximum(np.bincount(gate, minlength=GATES), 1))
        for k in range(3):
            weights[k] += (rate * np.bincount(gate, error * x[k], GATES) / used).astype(np.float32)
        at = end
    return total / 2.302585092994046


def packed_odds(tables, steps):
    """Three log-odds for each decision, negative ones against it, and its gate: a byte each."""
    import numpy as np

    *slots, bit = steps
    first, second, third = (np.take(t, s, mode="clip").astype(np.uint32) for t, s in zip(tables, slots))
    out = first & np.uint32(255)
    out |= (second & np.uint32(255)) << np.uint32(8)
    out |= (third & np.uint32(255)) << np.uint32(16)
    against = (bit ^ 1).astype(np.uint32)       # turns x + 128, from 1 to 255, into 128 - x
    out ^= against * np.uint32(0xFFFFFF)
    out += against * np.uint32(0x010101)
    out ^= np.uint32(0x808080)
    out |= second >> np.uint32(8) << np.uint32(27)
    out |= third >> np.uint32(8) << np.uint32(24)
    return out


def mix_many(odds, weights, starts, rate: float = RATE / 256, block: int = LEAST_BLOCK, of=None, costs=None):
    """``mix_block`` of many texts at once, each from its own copy of ``weights``: log10 probability of the decisions
    (packed odds) between two ``starts``.  Block by block, all texts that reach it go through the same array operations."""
    import numpy as np

    texts, sizes = len(starts) - 1, np.diff(starts)
    own = [np.tile(w, texts) for w in weights]
    total, at, active = np.zeros(texts), 0, np.arange(texts)
    while True:
        more = sizes[active] > at
        if not more.all():
            active, own = active[more], [w.reshape(-1, GATES)[more].ravel() for w in own]
        if not len(active):
            break
        first = starts[active] + at
        n = np.minimum(sizes[active] - at, block)
        parts = [slice(a, b) for a, b in zip(first.tolist(), (first + n).tolist())]
        now = np.concatenate([odds[part] for part in parts]).view(np.int8)
        gate = np.repeat(np.arange(0, GATES * len(active), GATES), n)
        gate += now[3::4]
        x = [now[k::4].astype(np.float32) for k in range(3)]
        z = np.take(own[0], gate, mode="clip")
        z *= x[0]
        for k in (1, 2):
            y = np.take(own[k], gate, mode="clip")
            y *= x[k]
            z += y
        np.clip(z, -12, 12, out=z)
        z = np.exp(np.negative(z, out=z), out=z)        # odds against the decision
        whole = 1 + z
        z /= whole
        loss = np.log(whole, out=whole)
        total[active] -= np.add.reduceat(loss.astype(np.float64), np.cumsum(n) - n)
        if costs is not None:
            costs += np.bincount(np.concatenate([of[part] for part in parts]), loss, len(costs)) / 2.302585092994046
        error = z.astype(np.float64)
        used = np.sqrt(np.maximum(np.bincount(gate, minlength=len(own[0])), 1))
        for k in range(3):
            move = x[k].astype(np.float64)
            move *= error
            own[k] += (rate * np.bincount(gate, move, len(own[0])) / used).astype(np.float32)
        at, block = at + block, min(BLOCK, 2 * block)
    return total / 2.302585092994046


def fit_sums(tables, weights, steps, into, times=None) -> None:
    """Adds the gradient (three rows) and the curvature (six rows) of each gate at fixed weights to ``into``; a
    decision counts ``times`` times."""
    import numpy as np

    *slots, bit = steps
    for at in range(0, len(bit), 1 << 16):
        part = slice(at, at + (1 << 16))
        codes = [np.take(t, s[part], mode="clip") for t, s in zip(tables, slots)]
        x = [((c & np.uint16(255)).astype(np.float64) - 128) / 16 for c in codes]
        gate = (codes[1] >> np.uint16(8) << np.uint16(3) | codes[2] >> np.uint16(8)).astype(np.intp)
        z = sum(np.take(w, gate).astype(np.float64) * 16 * v for w, v in zip(weights, x))
        p = 1 / (1 + np.exp(-np.clip(z, -12, 12)))
        error, curve = bit[part] - p, p * (1 - p)
        if times is not None:
            error, curve = error * times[part], curve * times[part]
        sums = [error * v for v in x] + [curve * x[i] * x[j] for i in range(3) for j in range(i, 3)]
        for row, v in zip(into, sums):
            row += np.bincount(gate, v, GATES)


def newton_step(weights, sums):
    """The weights after a Newton step at every gate; none moves by more than a half."""
    import numpy as np

    now, first = weights.T.astype(np.float64) * 16, starting_weights().T.astype(np.float64) * 16
    curve = np.empty((GATES, 3, 3))
    for row, (i, j) in zip(sums[3:], [(i, j) for i in range(3) for j in range(i, 3)]):
        curve[:, i, j] = curve[:, j, i] = row
    move = np.linalg.solve(curve + RIDGE * np.eye(3), (sums[:3].T - RIDGE * (now - first))[:, :, None])[:, :, 0]
    return ((now + np.clip(move, -0.5, 0.5)).T / 16).astype(np.float32)


def fit_weights(docs: DataFrame, model: Model, rounds: int = FIT_ROUNDS) -> Model:
    """Starting weights from all texts."""
    return fit_counted(cut_lineage(context_counts(docs, model.coder, model.train_tokens), "lm-contexts"), model, rounds)


def fit_counted(counted: DataFrame, model: Model, rounds: int = FIT_ROUNDS) -> Model:
    """The same from their counted contexts; 2 x 9 x ``GATES`` sums a round reach the driver."""
    import numpy as np

    held = counted.sparkSession.sparkContext.broadcast(model)
    for _ in range(rounds):
        weights = model.weights, model.spelling_weights

        def run(batches, weights=weights):
            import numpy as np
            import pyarrow as pa

            own, total = held.value, np.zeros((2, 9, GATES), np.int64)
            coder = own.coder.ready()
            for batch in batches:
                for data in utf8(batch.column(0)):
                    sums = np.zeros((2, 9, GATES))
                    words, spelled = _counted_steps(coder, data)
                    fit_sums(own.tables.codes, weights[0], words[0], sums[0], words[1])
                    fit_sums(own.tables.spelling, weights[1], spelled[0], sums[1], spelled[1])
                    total += np.rint(sums * FIT_UNIT).astype(np.int64)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at], pa.int64())], ["at", "n"])

        sums = np.zeros(2 * 9 * GATES)
        found = counted.select("data").mapInArrow(run, "at bigint, n bigint")
        for r in found.groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect():
            sums[r.at] = float(r.n) / FIT_UNIT
        sums = sums.reshape(2, 9, GATES)
        model.weights, model.spelling_weights = (newton_step(w, s) for w, s in zip(weights, sums))
    held.destroy()
    return model


class Model:
    """Everything that scoring needs; its size is fixed by TOP_WORDS and SLOTS."""

    def __init__(self, coder: Coder, tables: Tables, train_tokens: int, distinct: int):
        import numpy as np

        self.coder, self.tables, self.train_tokens, self.distinct = coder, tables, train_tokens, distinct
        self.weights, self.spelling_weights = starting_weights(), starting_weights()
        self.floor = float(np.log10(1 / (train_tokens + distinct + 1)))
        self.base = np.log10((np.array(coder.counts, np.float64) + 1) / (train_tokens + distinct + 1))
        self.known_end = coder.counts[END] > 0

    def _spell(self, weights, ids, escaped: list[bytes], topic: int) -> list[float]:
        """Bits of each escaped word's bytes and end; ``weights`` are refined on the way."""
        import numpy as np

        costs = np.zeros(len(escaped))
        if escaped:
            steps, of = self.coder.spelling(ids, escaped, topic)
            mix_block(self.tables, weights, steps, of=of, costs=costs)
        return (costs / 0.30102999566398120).tolist()

    def score(self, text: bytes, bits: list[float] | None = None):
        """(log10 probability, tokens, known tokens so far, base score so far, words left to look up); ``bits`` gets
        the spelling of each of these words"""
        import numpy as np

        coder, weights, spelling = self.coder.ready(), self.weights.copy(), self.spelling_weights.copy()
        score, n, known, base, left = 0.0, 0, 0, 0.0, []
        for steps, ids, escaped, topic in _text_blocks(coder, text):
            score += mix_block(self.tables, weights, steps)
            sure = ids[ids != ESCAPE]
            n += len(ids)
            known += len(sure) - int((sure == END).sum()) * (not self.known_end)
            base += float(self.base[sure].sum())
            left += escaped
            if bits is not None:
                bits += self._spell(spelling, ids, escaped, topic)
        return score, n, known, base, left


    def score_many(self, texts: list[bytes], spell: list[bool]):
        """The same for each text, with the spelling of the words left (None if it is not asked for)."""
        import numpy as np

        coder, at = self.coder.ready(), 0
        for group, laid in coder.groups(texts):
            asked = spell[at:at + len(group)]
            at += len(group)
            if laid is None:
                bits = [] if asked[0] else None
                yield *self.score(group[0], bits), bits
                continue
            ids, starts, topics, classes, escaped, cuts = laid
            odds = []
            for a in range(0, len(ids), TOKENS):    # arrays stay small, so they are found in the cache
                part = slice(a, a + TOKENS)
                odds.append(packed_odds(self.tables.codes, coder.steps(ids[part], topics[part], classes[part])[0]))
            places = np.concatenate([[0], np.cumsum(coder.tree[3][ids], dtype=np.int64)])
            scores = mix_many(np.concatenate(odds), self.weights, places[starts])
            sure = ids != ESCAPE
            of = np.repeat(np.arange(len(group)), np.diff(starts))[sure]
            base = np.bincount(of, self.base[ids[sure]], len(group))
            known = np.bincount(of, minlength=len(group)) - (not self.known_end)
            bits = self._spell_many(topics[~sure], escaped, cuts, asked)
            cuts = cuts.tolist()
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                yield (float(scores[i]), int(starts[i + 1] - starts[i]), int(known[i]), float(base[i]), escaped[a:b], bits[i])

    def _spell_many(self, topics, escaped: list[bytes], cuts, asked: list[bool]) -> list[list[float] | None]:
        """``_spell`` for those of many texts that are asked for (None for the others); a text's words are between two
        ``cuts``."""
        import numpy as np

        sizes = np.diff(cuts) * np.array(asked)
        of_asked = np.repeat(np.array(asked), np.diff(cuts))
        costs = np.zeros(int(sizes.sum()))
        if len(costs):
            *symbols, word = self.coder.spelled_after(topics[of_asked], [escaped[i] for i in np.flatnonzero(of_asked).tolist()])
            steps, n = self.coder.byte_steps(*symbols)
            of = np.repeat(word, n)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            mix_many(packed_odds(self.tables.spelling, steps), self.spelling_weights, np.searchsorted(of, ends), of=of, costs=costs)
        bits = iter((costs / 0.30102999566398120).tolist())
        return [list(islice(bits, k)) if a else None for k, a in zip(sizes.tolist(), asked)]


def score_rows(docs: DataFrame, model: Model, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: row number, id, score and the words that still need their counts, with the bits of their
    spelling; a training document has no unknown word, so its words are not spelled."""
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                     F.coalesce(learn, F.lit(False)).alias("learn"))

    def run(batches):
        from collections import Counter

        import pyarrow as pa
        from pyspark import TaskContext

        own, row = held.value, TaskContext.get().partitionId() << 33
        for batch in _merged(batches, 1):
            texts = [t or b"" for t in utf8(batch.column(1))]
            spell = [not of_training for of_training in batch.column(2).to_pylist()]
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))     # a group's texts end at about one block
            found = own.score_many([texts[i] for i in order], [spell[i] for i in order])
            got = [g for _, g in sorted(zip(order, found), key=lambda pair: pair[0])]
            words = [Counter(g[4]) for g in got]
            spelling = [dict.fromkeys(w, 0.0) for w in words]
            for total, g in zip(spelling, got):
                for word, own_bits in zip(g[4], g[5] or []):
                    total[word] += own_bits
            yield pa.RecordBatch.from_arrays([
                pa.array(range(row, row + len(got)), pa.int64()), batch.column(0),
                pa.array([len(t) for t in texts], pa.int64()), pa.array([g[0] for g in got], pa.float64()),
                pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()),
                pa.array([g[3] for g in got], pa.float64()),
                pa.array([list(w) for w in words], pa.list_(pa.binary())),
                pa.array([list(w.values()) for w in words], pa.list_(pa.int64())),
                pa.array([list(w.values()) for w in spelling], pa.list_(pa.float64()))],
                ["row", "doc_id", "bytes", "score", "n_tokens", "n_known", "base", "words", "times", "spelling"])
            row += len(got)

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(run, f"row bigint, doc_id {kind}, bytes bigint, score double, n_tokens bigint, "
                              "n_known bigint, base double, words array<binary>, times array<bigint>, spelling array<double>")


def lm_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
              top: int = TOP_WORDS) -> DataFrame:
    """(doc_id, bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    training = docs.filter(learn).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts = cut_lineage(word_counts(training), "lm-counts")
    ends = training.count()
    coder, escaped = build_coder(counts, ends, top)
    all_ = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    counted = cut_lineage(context_counts(training, coder, all_.n + ends), "lm-contexts")
    model = Model(coder, train_tables(counted, coder), all_.n + ends, all_.v + (ends > 0))
    model = fit_counted(counted, model)

    scored = cut_lineage(score_rows(docs, model, learn, id_col, text_col), "lm-scored")
    whole = float(model.train_tokens + model.distinct + 1)
    parts = scored.select("row", F.arrays_zip("words", "times", "spelling").alias("w")).select("row", F.explode("w").alias("w"))
    parts = parts.select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"),
                         F.col("w.spelling").alias("spelling"))
    met = parts.join(counts.filter(F.col("n") < escaped.least), "word", "left")
    known, times = F.col("n").isNotNull(), F.col("times")
    share = F.when(known, F.lit((1 - escaped.unknown) / max(1, escaped.tokens)) * F.col("n")).otherwise(
        F.lit(escaped.unknown))
    met = met.select("row", (times * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(whole))).alias("base"),
                     (times * F.log10(share)).alias("share"), F.when(known, times).otherwise(0).alias("known"),
                     F.when(known, 0.0).otherwise(F.col("spelling")).alias("spelling"))
    met = met.groupBy("row").agg(*[F.sum(c).alias(f"more_{c}") for c in ("base", "share", "known", "spelling")])
    more = lambda c: F.coalesce(f"more_{c}", F.lit(0))
    out = scored.drop("words", "times", "spelling").join(met, "row", "left")
    out = out.withColumn("score", F.col("score") + more("share"))
    bits = more("spelling") - F.col("score") / F.lit(0.30102999566398120)
    return out.select("doc_id", "bytes", "n_tokens", (F.col("n_known") + more("known")).alias("n_known"),
                      F.lit(model.train_tokens).cast("long").alias("train_tokens"),
                      (F.col("base") + more("base")).alias("base_score"), "score",
                      F.try_divide(bits, F.col("bytes")).alias("bits_per_byte"))


# ------------------------------------------------------------------------------------------ registered query

def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lm_scores(docs, crc_mod(F.col("doc_id"), 7) != 2)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score", "bits_per_byte")
