import hashlib
import random
import re

import pytest

import edge
from acadlake.llm import fim

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = ["", " ", "a", " a", "a ", "a b", "\t a\n\nb\x0b ", "é", "日本 語　x \U0001f600 y", "x" * 300, "ab " * 90,
         " " * 50, "<P>", "one <S> two", "a < P> b <M", "<" * 9 + " >S<", "w\x1cx y\x85z"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(doc_id, text):
    """The contract on whole strings."""
    text = text or ""
    units = UNITS.findall(text)
    n, key = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, form, len(pre), len(mid), sha(out), sha(text)


def as_frames(text, size):
    return [dict(zip(("units", "chars", "bytes", "data"), f)) for f in fim.pack(text.encode(), size)]


@pytest.mark.parametrize("size", [4, 5, 7, 64, 1 << 16])
def test_frames_count_units_and_round_trip(size):
    for text in TEXTS:
        frames = as_frames(text, size)
        units = UNITS.findall(text)
        assert sum(f["units"] for f in frames) == len(units), (text, size)
        assert sum(f["chars"] for f in frames) == len(text)
        assert b"".join(fim._open(f["data"]) for f in frames).decode() == text
        assert all(f["bytes"] <= size for f in frames)
        for k in range(len(units) + 1):
            opened = {}
            i, at, chars = fim.place(frames, k, opened)
            before = "".join(units[:k])
            assert chars == len(before) and sum(f["bytes"] for f in frames[:i]) + at == len(before.encode())
            assert len(opened) <= 1                       # a place opens one frame only


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_every_cut_is_reversible(form):
    marks = {name: fim.pack(m)[0][3] for name, m in fim.MARKS.items()}
    for text in (t for t in TEXTS if t and not any(m.decode() in t for m in fim.MARKS.values())):
        units = UNITS.findall(text)
        frames = as_frames(text, 9)
        rng = random.Random(len(text))
        for _ in range(12):
            a, b = sorted(rng.choices(range(len(units) + 1), k=2))
            out, n_pre, n_mid = fim.assemble(frames, a, b, form, marks)
            pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
            want = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
            assert b"".join(map(fim._open, out)).decode() == want
            assert (n_pre, n_mid) == (len(pre), len(mid))
            assert b"".join(fim.restored(out, form)).decode() == text


def test_frames_without_a_cut_are_passed_on():
    text = "word " * 5000
    frames = as_frames(text, 256)
    marks = {name: fim.pack(m)[0][3] for name, m in fim.MARKS.items()}
    out, _, _ = fim.assemble(frames, 1000, 3000, "psm", marks)
    stored = {f["data"] for f in frames}
    assert sum(x not in stored for x in out) <= 3 + 4       # the marks and two halves of each cut frame


def test_broken_output_is_refused():
    with pytest.raises(ValueError):
        list(fim.restored([fim.pack(b"<P>a<S>b")[0][3]], "psm"))


def test_query_against_whole_strings(spark, folder):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS * 6)]
    got = fim.op11_fill_in_middle(spark, folder(documents=rows)).collect()
    assert {tuple(r) for r in got} == {plain_row(i, t) for i, t, *_ in rows}
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_edge_rows(spark):
    docs = edge.with_clashes(edge.documents(spark))
    store = fim.store_frames(docs, size=1000)
    out = fim.digests(fim.fill_in_middle(store))
    want = sorted(map(str, (plain_row(d, t) for d, t, *_ in edge.DOCUMENTS)))
    assert sorted(str((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256))
                  for r in out.collect()) == want
    assert fim.digests(fim.fill_in_middle(fim.store_frames(docs.limit(0)))).count() == 0


def test_long_text_and_real_output(spark):
    text = "lorem ipsum " * 400_000 + "x" * 3_000_000          # 7.8 MB with one giant word
    docs = spark.createDataFrame([(7, text), (8, text)], "doc_id long, text string")
    outputs = fim.fill_in_middle(fim.store_frames(docs), fim_percent=100)
    rows = {r.doc_id: r for r in fim.digests(outputs).collect()}
    assert all(r.restored_sha256 == sha(text) and r.n == 800_001 and r.form != "plain" for r in rows.values())
    assert {r.doc_id: sha(r.text) for r in fim.output_texts(outputs).collect()} == {
        i: r.output_sha256 for i, r in rows.items()}
