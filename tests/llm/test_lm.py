import math
import random
import zlib
from collections import Counter

import edge
from acadlake.llm import lm


def plain_base(rows):
    """(n_tokens, n_known, N, base score) of each row, by plain counting."""
    c = Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            c.update((t or "").encode().lower().split())
            c[None] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        tokens = (t or "").encode().lower().split() + [None]
        out.append((i, len(tokens), sum(c[w] > 0 for w in tokens), n,
                    sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


def check(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(plain_base(rows), key=key)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and math.isclose(g[4], w[4], rel_tol=1e-9)


def test_query_base_is_exact_and_the_model_beats_it(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = lm.op6_lm_scoring(spark, small).collect()
    check(got, rows)
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)
    again = {(r.doc_id, r.score) for r in lm.op6_lm_scoring(spark, small).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


def test_words_beyond_the_tree_are_looked_up(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    got = lm.lm_scores(docs, lm.crc_mod(lm.F.col("doc_id"), 7) != 2, top=50).collect()
    check(got, [(r.doc_id, r.text) for r in docs.collect()])


def test_codes_are_prefix_free_and_complete():
    rng = random.Random(1)
    for n in (2, 3, 17, 300):
        nodes, bits, offsets, lengths, inner = lm.huffman([rng.randint(0, 1000) for _ in range(n)])
        paths = {tuple(zip(nodes[o:o + k].tolist(), bits[o:o + k].tolist())) for o, k in zip(offsets, lengths)}
        assert len(paths) == n and inner == n - 1 and max(nodes) == n - 2
        assert math.isclose(sum(2.0 ** -k for k in lengths.tolist()), 1.0)


def test_tree_probabilities_sum_to_one():
    import itertools

    import numpy as np
    coder = lm.Coder([(b"a", 5), (b"b", 3)], 4, 2).ready()
    model = lm.Model(coder, lm.Tables(coder.nodes, {}), 12, 3)
    for weights in (lm.starting_weights(), np.random.default_rng(1).normal(size=(3, lm.GATES)).astype(np.float32) / 16):
        for k in range(3):
            codes = model.tables.codes[k]
            codes[:] = np.random.default_rng(k).integers(88, 168, len(codes)) | np.random.default_rng(k).integers(0, 8, len(codes)) << 8
        model.weights = weights
        ends = model_mass(model, [()])
        total = ends
        for n in (1, 2, 3):
            total += model_mass(model, itertools.product("abc", repeat=n))
        rest = sum(10 ** prefix_score(model, p) for p in itertools.product("abc", repeat=4))
        assert math.isclose(total + rest, 1, rel_tol=1e-3)


def model_mass(model, texts):
    return sum(10 ** model.score(" ".join(t).encode())[0] for t in texts)


def prefix_score(model, words):
    """Score of the words without an end."""
    ids, _ = model.coder.tokens([w.encode() for w in words], False)
    steps, _, _ = model.coder.decisions(ids, 0, 0)
    return lm.mix_block(model.tables, model.weights.copy(), steps)


def test_decisions_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(random.Random(5).choices(["a", "b", "cc", "rare", "x"], k=300)).encode()
    coder = lm.Coder([(b"a", 50), (b"b", 30), (b"cc", 3)], 4, 2).ready()

    def steps():
        return [x for s, _, _ in lm.text_decisions(coder, text) for x in zip(*(a.tolist() for a in s))]

    whole = steps()
    monkeypatch.setattr(lm, "word_blocks", lambda t: __import__("acadlake.llm.words").llm.words.word_blocks(t, 64))
    assert steps() == whole


def test_shares_of_escaped_words_sum_to_one():
    e = lm.Escaped(3, 40, 20)
    assert 0 < e.unknown < 1 and lm.Escaped(2, 0, 0).unknown > 0


def test_packed_counts_add_up():
    import numpy as np
    a = np.zeros(2 * lm.CHUNK + 10, np.int64)
    a[[3, lm.CHUNK + 1, -1]] = 5
    a[:lm.CHUNK // 2] += 1
    back = np.zeros(3 * lm.CHUNK, np.int64)
    for k, data in lm._pack(a, 0):
        lm._unpack(data, back[k * lm.CHUNK:(k + 1) * lm.CHUNK])
    assert (back[:len(a)] == a).all()


def test_edge_rows(spark, folder):
    docs = edge.with_clashes(edge.documents(spark))
    for learn in (lm.F.lit(True), lm.F.lit(False)):
        got = lm.lm_scores(docs, learn).collect()
        assert len(got) == len(edge.DOCUMENTS) and all(math.isfinite(r.score) for r in got)
        assert {r.n_tokens for r in got if r.doc_id in (2, 3, 5)} == {1}
        if not learn._jc.toString() == "true":
            assert all(r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert lm.op6_lm_scoring(spark, folder()).count() == 0


def test_unknown_words_are_spelled_by_the_byte_predictors(spark):
    rng = random.Random(3)
    rare = ["".join(rng.choices(["na", "no", "ni", "ta", "to"], k=6)) for _ in range(400)]
    docs = [(i, f"the cat {w} the dog") for i, w in enumerate(rare)]
    docs += [(1000, "the cat nananonitato the dog"), (1001, "the cat xqzwjkvxqzwj the dog")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in lm.lm_scores(df, lm.F.col("doc_id") < 1000).collect()}
    like, unlike = got[1000], got[1001]
    assert like.n_known == unlike.n_known == like.n_tokens - 1 and like.bytes == unlike.bytes
    assert like.bits_per_byte + 1 < unlike.bits_per_byte        # flat bytes made both equal
    assert like.bits_per_byte * like.bytes < 8 * 13 / 2         # 12 bytes and an end


def test_spelling_is_a_code():
    import numpy as np
    coder = lm.Coder([(b"a", 5)], 4, 2).ready()
    model = lm.Model(coder, lm.Tables(coder.nodes, {}), 12, 3)
    ids = coder.tokens([b"x"], True)[0]
    mass = 0.0
    for byte in range(256):
        steps, of = coder.spelling(ids, [bytes([byte])], 0)
        n = int(coder.byte_tree[3][byte])       # decisions of the first byte; the rest are the blank
        costs = np.zeros(1)
        lm.mix_block(model.tables, lm.starting_weights(), tuple(a[:n] for a in steps), of=of[:n], costs=costs)
        mass += 10 ** -costs[0]
    assert math.isclose(mass, 1, rel_tol=1e-5)


def plain_mix(model, steps, block, most):
    """Score and weights (for log-odds in units) of a mixer that goes decision by decision."""
    *slots, bit = (a.tolist() for a in steps)
    weights = [[0.3, 0.35, 0.35] for _ in range(lm.GATES)]
    total, at = 0.0, 0
    while at < len(bit):
        moves, used = {}, Counter()
        end, block = min(len(bit), at + block), min(most, 2 * block)
        for i in range(at, end):
            codes = [int(t[s[i]]) for t, s in zip(model.tables.codes, slots)]
            x = [((c & 255) - 128) / 16 for c in codes]
            gate = (codes[1] >> 8) * 8 + (codes[2] >> 8)
            p = 1 / (1 + math.exp(-max(-12, min(12, sum(a * b for a, b in zip(weights[gate], x))))))
            total += math.log10(p if bit[i] else 1 - p)
            used[gate] += 1
            move = moves.setdefault(gate, [0.0] * 3)
            for k in range(3):
                move[k] += 0.02 * (bit[i] - p) * x[k]
        for gate, move in moves.items():
            for k in range(3):
                weights[gate][k] += move[k] / math.sqrt(used[gate])
        at = end
    return total, weights


def test_mixing_equals_a_plain_mixer_and_refines_short_texts():
    import numpy as np
    coder = lm.Coder([(b"a", 50), (b"b", 30), (b"cc", 3), (b"d", 2)], 4, 2).ready()
    model = lm.Model(coder, lm.Tables(coder.nodes, {}), 90, 6)
    for k, codes in enumerate(model.tables.codes):
        rng = np.random.default_rng(k)
        codes[:] = rng.integers(60, 196, len(codes)) | rng.integers(0, 8, len(codes)) << 8
    for n in (40, 1500):
        text = " ".join(random.Random(n).choices(["a", "b", "cc", "d", "x"], k=n)).encode()
        (steps, _, _), = lm.text_decisions(coder, text)
        weights = lm.starting_weights()
        score = lm.mix_block(model.tables, weights, steps)
        want, moved = plain_mix(model, steps, 64, 1024)
        assert math.isclose(score, want, rel_tol=1e-4)
        assert np.allclose(weights.T * 16, moved, atol=2e-4)
        fixed = lm.mix_block(model.tables, lm.starting_weights(), steps, rate=0)
        assert len(steps[3]) > 64 and abs(score - fixed) > 1e-4


def test_starting_weights_are_fitted_on_all_documents(spark):
    import numpy as np
    rng = random.Random(11)
    texts = [" ".join(rng.choices(["a", "b", "cc", "d", "x", "yy"], k=rng.randint(0, 30))).encode() for _ in range(400)]
    coder = lm.Coder([(b"a", 50), (b"b", 30), (b"cc", 3), (b"d", 2)], 4, 2).ready()

    def model():
        out = lm.Model(coder, lm.Tables(coder.nodes, {}), 90, 6)
        for k, codes in enumerate(out.tables.codes):
            own = np.random.default_rng(k)
            codes[:] = own.integers(100, 156, len(codes)) | own.integers(0, 2, len(codes)) << 8
        return out

    df = spark.createDataFrame([(t.decode(),) for t in texts], "text string")
    one, many = (lm.fit_weights(df.repartition(n), model()) for n in (1, 7))
    assert (one.weights == many.weights).all() and (one.spelling_weights == many.spelling_weights).all()
    plain = model()
    for _ in range(lm.FIT_ROUNDS):
        sums = np.zeros((9, lm.GATES))
        for text in texts:
            for steps, _, _ in lm.text_decisions(coder, text):
                lm.fit_sums(plain.tables.codes, plain.weights, steps, sums)
        plain.weights = lm.newton_step(plain.weights, sums)
    assert np.allclose(one.weights, plain.weights, atol=1e-4)

    def total(weights):
        return sum(lm.mix_block(plain.tables, weights.copy(), steps, rate=0) for t in texts
                   for steps, _, _ in lm.text_decisions(coder, t))

    assert total(one.weights) > total(lm.starting_weights())


def small_model(texts):
    import numpy as np
    c = Counter(w for t in texts for w in t.lower().split())
    words = sorted(((w, n) for w, n in c.items() if n > 1), key=lambda x: (-x[1], x[0]))
    coder = lm.Coder(words, len(texts), sum(n == 1 for n in c.values())).ready()
    model = lm.Model(coder, lm.Tables(coder.nodes, {}), sum(c.values()) + len(texts), len(c) + 1)
    for codes in (*model.tables.codes, *model.tables.spelling):
        rng = np.random.default_rng(len(codes))
        codes[:] = rng.integers(60, 196, len(codes)) | rng.integers(0, 8, len(codes)) << 8
    return model


def some_texts(n, seed=21):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(150)]
    return [b"", b" \n", *(" ".join(rng.choices(words, range(150, 0, -1), k=rng.choice([1, 5, 60, 700]))).encode() for _ in range(n)),
            b"Only once", b"W1 w1 W1 w1"]


def test_texts_of_a_group_score_as_if_alone(monkeypatch):
    texts = some_texts(60)
    model = small_model(texts[::2])
    alone = []
    for text in texts:
        bits = []
        alone.append((*model.score(text, bits), bits))
    for group in (1 << 18, 3000, 100):      # with the smallest most texts are long ones
        monkeypatch.setattr(lm, "GROUP", group)
        for got, want in zip(model.score_many(texts, [True] * len(texts)), alone, strict=True):
            assert math.isclose(got[0], want[0], rel_tol=1e-12) and math.isclose(got[3], want[3], rel_tol=1e-9)
            assert got[1:3] == want[1:3] and got[4:] == want[4:]


def plain_contexts(coder, texts):
    """Symbols in their contexts, counted token by token."""
    out = Counter()
    for text in texts:
        topic = before = 0
        for word in [*text.lower().split(), None]:
            i = lm.END if word is None else coder.index.get(word, lm.ESCAPE)
            out[i << 17 | topic << 10 | before] += 1
            if i == lm.ESCAPE:
                prev2 = prev = 32
                for byte in word + b" ":
                    out[1 << 60 | byte << 23 | topic << 16 | prev << 8 | prev2] += 1
                    prev2, prev = (32 if byte == 32 else prev), byte
            if lm.FIRST <= i < lm.FIRST + lm.TOPICS:
                topic = i
            before = int(coder.classes[i])
    return out


def test_contexts_and_tables_equal_plain_counts(spark, monkeypatch):
    import numpy as np
    texts = some_texts(80, 5)
    coder = small_model(texts[::2]).coder
    texts.append(b" ".join(random.Random(8).choices(texts[7].split() + [b"rare"], k=lm.GROUP // 2)))    # goes alone
    assert len(texts[-1]) > lm.GROUP
    df = spark.createDataFrame([(t.decode(),) for t in texts], "text string")
    want = plain_contexts(coder, texts)
    for parts, held, tokens in ((1, 1 << 22, 10), (5, 500, 50 << 21)):
        monkeypatch.setattr(lm, "HELD", held)
        counted = lm.context_counts(df.repartition(parts), coder, tokens)
        got = [lm._unpack_keys(bytes(r.data)) for r in counted.collect()]
        pairs = [(k, n) for keys, counts in got for k, n in zip(keys.tolist(), counts.tolist())]
        assert len(pairs) == len(want) and dict(pairs) == want
    tables = lm.train_tables(counted, coder)
    counts = [np.zeros((s, 2), np.int64) for s in (coder.nodes, lm.SLOTS, lm.SLOTS)]
    for text in texts:
        for (*slots, bit), _, _ in lm.text_decisions(coder, text):
            for c, s in zip(counts, slots):
                np.add.at(c, (s, bit), 1)
    for c, codes in zip(counts, tables.codes):
        odds = np.clip(np.rint(16 * np.log((c[:, 1] + 0.4) / (c[:, 0] + 0.4))), -127, 127).astype(int) + 128
        sure = np.minimum(7, np.log2(c.sum(1) + 1) / 1.5).astype(int)
        assert (codes[:len(c)] == odds + 256 * sure).all()


def test_words_of_many_texts_are_split_like_each_text():
    from acadlake.llm.words import split_words
    texts = [b"", b" \n", b"Ab\x0bcD\x0c e\r\n", b"\x00 \x1c\x1f x\xc2\xa0y \xc3\x84\xc3\xa4", b"\xff\xfe A", b"one"]
    for some in (texts, texts[:2], []):
        words, ends = split_words(some)
        assert [words.to_pylist()[a:b] for a, b in zip(ends, ends[1:])] == [t.lower().split() for t in some]


def test_word_counts_do_not_depend_on_what_a_task_holds(spark, monkeypatch):
    texts = [t.decode() for t in some_texts(80, 9)] + [None, "W3 " * 50 + "Long" * 30]
    want = Counter(w for t in texts for w in (t or "").encode().lower().split())
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for held, long, looked in ((1_000_000, 1 << 20, 1 << 22), (40, 100, 300)):      # with few most texts are long ones
        monkeypatch.setattr(lm, "HELD_WORDS", held)
        monkeypatch.setattr(lm, "WORDS", long)
        monkeypatch.setattr(lm, "LOOKED", looked)
        got = lm.word_counts(df.repartition(2)).collect()
        assert len(got) == len(want) and {bytes(r.word): r.n for r in got} == want


def test_packed_odds_are_those_for_the_decision():
    import numpy as np
    rng = np.random.default_rng(4)
    tables = [(rng.integers(1, 256, 500) | rng.integers(0, 8, 500) << 8).astype(np.uint16) for _ in range(3)]
    tables[0][:2] = 1, 255
    steps = *(np.concatenate([[0, 1, 0, 1], rng.integers(0, 500, 300)]) for _ in range(3)), np.arange(304) % 4 // 2
    odds = lm.packed_odds(tables, steps).view(np.int8).reshape(-1, 4)
    codes = [t[s].astype(int) for t, s in zip(tables, steps)]
    for k, c in enumerate(codes):
        assert (odds[:, k] == ((c & 255) - 128) * (2 * steps[3] - 1)).all()
    assert (odds[:, 3] == (codes[1] >> 8) * 8 + (codes[2] >> 8)).all()
