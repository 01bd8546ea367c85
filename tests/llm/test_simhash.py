import random

import pytest
import xxhash

import edge
from acadlake.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, radius=3):
    """Union of all pairs, one by one."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        if x is not None:
            least[r] = min(least.get(r, x), x)
    return [least.get(find(i)) for i in range(len(fps))]


def unsigned(x):
    return x & (1 << 64) - 1


def test_fingerprints_of_texts():
    texts = ["", None, "one", "One TWO", "a b c", "a b c d e f a b c", "É é ß", edge.LONG[:5000], "x\x0by\x0cz\tw"]
    for t in texts:
        assert simhash.fingerprint(t.encode() if t is not None else None) == plain_fingerprint(t), t


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choices(["ab", "cd", "efg", "h"], k=4000))
    monkeypatch.setattr(simhash, "word_blocks", lambda t: __import__("acadlake.llm.words").llm.words.word_blocks(t, 97))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_masks_cover_every_difference():
    rng = random.Random(2)
    masks = simhash.covering_masks()
    assert len(masks) == 15 and all(20 < m.bit_count() < 45 for m in masks)
    for _ in range(3000):
        diff = sum(1 << i for i in rng.sample(range(64), rng.randint(0, 3)))
        agree = [m for m in masks if not m & diff]
        assert agree
        assert all(any(not f & diff for f in simhash.finer_masks(m)) for m in agree[:2])


@pytest.mark.parametrize("limit", [4096, 8])
def test_links_connect_what_all_pairs_connect(spark, limit):
    rng = random.Random(limit)
    fps = []
    for _ in range(12):                                     # clusters, chains and lone values
        base = rng.getrandbits(64)
        fps.append(base)
        for _ in range(rng.choice([0, 3, 40])):
            base ^= sum(1 << i for i in rng.sample(range(64), rng.randint(1, 4)))
            fps.append(base)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    edges = [(unsigned(r.a), unsigned(r.b)) for r in simhash.links(df, limit=limit).collect()]
    at = {x: i for i, x in enumerate(fps)}
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    want = plain_components(list(range(len(fps))), fps)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(at[a]), find(at[b])))
        root[y] = x
    assert [find(i) for i in range(len(fps))] == want


def test_query_against_all_pairs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    ids, fps = [r.doc_id for r in docs], [plain_fingerprint(r.text) for r in docs]
    want = {(i, f"{f:016x}", c) for i, f, c in zip(ids, fps, plain_components(ids, fps))}
    got = {tuple(r) for r in simhash.op5_simhash_dedup(spark, small).collect()}
    assert got == want and len(docs) == len(got)


def test_edge_rows(spark):
    out = simhash.near_duplicates(edge.with_clashes(edge.documents(spark))).collect()
    assert len(out) == len(edge.DOCUMENTS)
    zero = {r.doc_id: r.component_id for r in out if r.fp == 0}
    assert zero == {2: 2, 3: 2, 5: 2}
    assert sum(r.doc_id == 1 and r.component_id == 1 for r in out) == 2
    assert [r.component_id for r in out if r.doc_id is None] == [None]
    assert simhash.near_duplicates(edge.documents(spark).limit(0)).count() == 0
