import edge
from acadlake.llm import toxicity

LEX = toxicity.Lexicon({f" {toxicity.fold(w, toxicity.fold_table()).strip()} ": 3.0 for w in ("loser", "trash")}
                       | {f" {toxicity.fold('clow', toxicity.fold_table()).strip()}": 2.0}, coefficients=(-3.0, 2.0, 0.0, 0.0))


def total(text):
    return LEX.features(text, LEX.machine())[0]


def test_disguises_fold_to_the_word():
    for text in ("loser", "LOSER!", "l0ser", "1oser", "lo$er", "lоser", "ｌｏｓｅｒ", "ｌ０ｓｅｒ", "lo​ser", "|oser", "(loser)", "ιoser"):
        assert total(text) == 3.0, text
    for text in ("losers", "closer", "lose r", "", None, "10 5 3 7"):
        assert total(text) == 0.0, text


def test_prefixes_exceptions_and_length():
    assert total("clowns clown closet") == 4.0
    assert total("a trash can, Trash Bin and clown fish") == 0.0
    assert total("trash canon") == 3.0 and total("trash, trash can") == 3.0
    long_, short = LEX.features("loser " + "word " * 99, LEX.machine()), LEX.features("loser", LEX.machine())
    assert long_ == (3.0, 0.3, 0.03) and short == (3.0, 3.0, 3.0)


def test_query_on_held_out(spark, small):
    import os
    sf = os.path.dirname(small) + "/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = toxicity.op9_toxicity(spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_labels_of_held_out_rows_do_not_matter(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.may_learn(), labels.toxic).otherwise(1 - labels.toxic))
    a = toxicity.learn_lexicon(docs, labels, toxicity.may_learn())
    b = toxicity.learn_lexicon(docs, flipped, toxicity.may_learn())
    assert a == b


def test_the_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(3000)] + [(i, "x") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, toxic int")
    got = toxicity.fit_sample(docs, labels, toxicity.F.lit(True), rows=10).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in got} == {0: 10, 1: 10}


def test_edge_rows(spark, folder):
    docs = edge.with_clashes(edge.documents(spark))
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (4, 0, 0), (77, 0, 1), (None, 1, 1), (2, 1, None)],
                                   "doc_id long, quality int, toxic int")
    lex = toxicity.learn_lexicon(docs, labels, toxicity.F.lit(True))
    out = toxicity.with_features(docs, lex).collect()
    assert len(out) == len(edge.DOCUMENTS) and all(0 <= r.f.score <= 1 for r in out)
    none = toxicity.learn_lexicon(docs, labels.limit(0), toxicity.F.lit(True))
    assert {round(r.f.score, 6) for r in toxicity.with_features(docs, none).collect()} == {0.0}
    assert toxicity.op9_toxicity(spark, folder()).count() == 0
