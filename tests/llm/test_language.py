from collections import Counter

import edge
from acadlake.llm import language


def plain_grams(text):
    import re
    s = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    c = Counter()
    if s.strip():
        for n in (1, 2, 3):
            c.update(s[i:i + n] for i in range(len(s) - n + 1))
        del c[" "]
    return c


def code(gram):
    x = 0
    for ch in gram:
        x = x << 21 | (1 if ch == " " else ord(ch))
    return x


def test_grams_whole_and_in_pieces(monkeypatch):
    for text in ("Ab, c1dÉ \U00010400x", "", "12 !", "z", "the the the other " * 50):
        want = {code(g): n for g, n in plain_grams(text).items()}
        assert dict(zip(*(x.tolist() for x in language.grams(text)))) == want
        monkeypatch.setattr(language, "PIECE", 7)
        assert dict(zip(*(x.tolist() for x in language.grams(text)))) == want
        monkeypatch.undo()


def test_out_of_place_distance():
    p = language.Profiles({"x": [code("a"), code(" a"), code("a ")], "y": [code("b"), code(" b")]}, size=10)
    # " a ": grams a, " a", "a ", " a " once each, in order of their codes
    own = sorted([code("a"), code(" a"), code("a "), code(" a ")])
    ranks = {code("a"): 0, code(" a"): 1, code("a "): 2}
    cost = sum(abs(i - ranks[g]) if g in ranks else 10 for i, g in enumerate(own))
    assert p.predict("a") == ("x", 1 - cost / 40)
    assert p.predict("") == p.predict(None) == p.predict("1 2") == ("und", 0.0)


def test_numerals_are_no_letters():
    p = language.Profiles({"en": [code("a"), code(" a")]}, size=10)
    for text in ("²", "½ ①", "③④", "٣", "_", "¼"):
        assert p.predict(text) == ("und", 0.0), text
    assert p.predict("a²")[0] == "en" and len(language.grams("一二")[0])


def test_one_id_on_many_rows_is_one_text(spark):
    rows = [(1, f"word {i}", "en") for i in range(300)] + [(i, "autre mot", "en") for i in range(2, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = language.learn_profiles(docs, language.F.lit(True), rows=10)
    q = language.learn_profiles(docs.filter("doc_id > 1 OR text = 'word 0'"), language.F.lit(True), rows=10)
    assert [x.tolist() for x in p.codes] == [x.tolist() for x in q.codes]


def test_query_accuracy_on_held_out(spark, small):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = language.op2_language_id(spark, small).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and len(held) > 20 and all(0 <= r.score <= 1 for r in rows)
    assert sum(docs[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def test_held_out_rows_teach_nothing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held = language.crc_mod(language.F.col("doc_id"), 4) == 2
    a = language.learn_profiles(docs, ~held)
    b = language.learn_profiles(docs.withColumn("lang", language.F.when(held, "zz").otherwise(docs.lang)), ~held)
    assert a.names == b.names and all((x == y).all() for x, y in zip(a.codes, b.codes))


def test_edge_rows(spark):
    docs = edge.with_clashes(edge.documents(spark))
    p = language.learn_profiles(docs, language.F.lit(True))
    assert p.names == ["de", "en", "fr"] or p.names == ["en", "fr"]
    out = {r.doc_id: r.language for r in language.predict(docs, p).collect()}
    assert out[2].lang_pred == out[3].lang_pred == out[5].lang_pred == "und" and out[4].lang_pred == "fr"
    none = language.learn_profiles(docs.limit(0), language.F.lit(True))
    assert {r.language.lang_pred for r in language.predict(docs, none).collect()} == {"und"}
    assert language.predict(docs.limit(0), p).count() == 0
