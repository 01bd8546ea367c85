import hashlib
import random
import re

import pytest

import edge
from acadlake.llm import decontam
from tools.oracle_check import compare, duck_con

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def plain(text, items, window):
    w, hit, names = words(text), set(), set()
    for name, item in items:
        v = words(item)
        k = min(window, len(v))
        for i in range(len(v) - k + 1 if k else 0):
            for j in range(len(w) - k + 1):
                if w[j:j + k] == v[i:i + k]:
                    hit |= set(range(j, j + k))
                    names.add(name)
    return len(w), len(hit), names


@pytest.mark.parametrize("window,block", [(4, 100), (4, 9), (13, 100), (1, 7)])
def test_matches_every_window(window, block):
    rng = random.Random(window * block)
    for _ in range(150):
        vocabulary = ["a", "B", "é", "d4", "zz"][:rng.randint(2, 5)]
        items = [(str(i), " ".join(rng.choices(vocabulary, k=rng.randint(0, 8)))) for i in range(rng.randint(0, 6))]
        text = "".join(x + rng.choice([" ", "-", "\n"]) for x in rng.choices(vocabulary + ["other"], k=rng.randint(0, 30)))
        blocks, held = [[]], 0
        for name, item in items:
            v = decontam.normal_words(item.encode())
            if held + len(v) > block and blocks[-1]:
                blocks.append([])
                held = 0
            if v:
                blocks[-1].append((name, v))
                held += len(v)
        machines = [decontam.Automaton(window).build(b) for b in blocks if b]
        n, spans, names = decontam.scan_text(text.encode(), machines)
        assert (n, sum(e - s for s, e in spans), names) == plain(text, items, window), (items, text)


def test_query_against_sql(spark, small):
    assert compare("op4", decontam.op4_decontamination(spark, small), decontam.ORACLE, duck_con(small))


def test_hot_item_and_short_items(spark, folder):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = [(i, f"Lead {passage.upper()}, tail " + "x " * (i % 3) * 250, "en", "a", 1) for i in range(60)]
    sf = folder(documents=docs, benchmark=[(1, passage), (2, "tail"), (3, None), (4, "--"), (1, passage), (None, "lead w0")])
    got = {r.doc_id: r for r in decontam.op4_decontamination(spark, sf).collect()}
    assert all(r.n_hit == 22 and r.n_items == 3 for r in got.values())
    assert got[0].items_sha256 == hashlib.sha256(b",1,2").hexdigest()
    assert got[0].contaminated and not got[2].contaminated       # 22 of 522 words are less than 1 in 20
    assert got[1].n_words == 272 and got[1].contaminated


def test_cut_leaves_the_rest(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    bench = spark.createDataFrame([(1, passage), (2, "tail")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"\U0001f600 lead. {passage}! tail"), (2, None), (3, "tail")], "doc_id long, text string")
    out = decontam.annotate(docs, decontam.automata(bench))
    cut = out.select("doc_id", decontam.without_spans(out.text, out["decontamination.spans"]).alias("t")).collect()
    assert {r.doc_id: r.t for r in cut} == {1: "\U0001f600 lead. ! tail", 2: None, 3: "tail"}


def test_edge_rows(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "no id here, only a text")], "item_id long, text string")
    out = decontam.annotate(edge.with_clashes(edge.documents(spark)), decontam.automata(bench)).collect()
    assert len(out) == len(edge.DOCUMENTS) and all(r.row == "x" for r in out)
    by = {r.doc_id: r.decontamination for r in out}
    assert by[4].n_hit == by[4].n_words == 240_000 and by[None].items == ["2"] and by[3].n_words == 0
    none = decontam.automata(bench.limit(0))
    assert none == [] and decontam.annotate(edge.documents(spark), none).filter("decontamination.n_words > 0").count() == 5
    assert decontam.annotate(edge.documents(spark).limit(0), none).count() == 0


def test_blocks_are_built_in_tasks_and_bounded(spark):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choices("abc", k=n))) for i, n in enumerate([3, 20, 5, 90, 13, 14, 2, 40])]
    texts = [" ".join(rng.choices("abcd", k=n)) for n in (0, 30, 200)] + [items[3][1], f"d {items[7][1]} d", items[3][1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(None if i == 4 else 7, t, "x", "y") for i, t in enumerate([*texts, None])],
                                 "doc_id long, text string, row string, names string")
    found = decontam.automata(bench, block_words=60)
    assert len(found) > 1 and all(isinstance(b, decontam.Block) for b in found)
    assert all(len(decontam.loaded(b.data()).next) <= 121 for b in found)     # 60 words: 2 states each at most
    for parts in (decontam.automata(bench), found):
        out = decontam.annotate(docs, parts)
        assert out.columns == [*docs.columns, "decontamination"]
        got = sorted((r.text or "", r.doc_id is None, r.decontamination.n_words, r.decontamination.n_hit,
                      tuple(r.decontamination.items), sum(s.words for s in r.decontamination.spans)) for r in out.collect())
        want = []
        for i, t in enumerate([*texts, None]):
            n, hit, names = plain(t, [(str(k), v) for k, v in items], 13)
            want.append((t or "", i == 4, n, hit, tuple(sorted(names)), hit))
        assert got == sorted(want)
