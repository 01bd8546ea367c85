import os
import re

import corpus_pipeline
import edge
import pytest
from test_decontam import plain as plain_hits
from test_secrets import plain as plain_secrets
from test_simhash import plain_components, plain_fingerprint

from acadlake.llm import secrets, toxicity
from acadlake.session import cut_lineage


def staged(spark, sf, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, sf)


@pytest.fixture(scope="module")
def inputs(spark, small):
    """The input of every stage, and the last stage's result."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs
        docs = cut_lineage(stage(spark, docs, small), f"test-{name}")
    return out | {"end": docs}


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_columns(inputs, spark, small):
    columns = spark.read.parquet(f"{small}/documents.parquet").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "secret_scans", "mixing"]
    assert all(inputs[n].columns == columns for n, _ in corpus_pipeline.STAGES)
    got = sorted(map(tuple, corpus_pipeline.run(spark, small).collect()))
    assert got == sorted(map(tuple, inputs["end"].collect()))


def test_toxicity_stage(inputs, spark, small):
    docs = inputs["toxicity"]
    lexicon = toxicity.learn_lexicon(docs, spark.read.parquet(f"{small}/labels.parquet"), toxicity.may_learn())
    machine = lexicon.machine()
    keep = {r.doc_id for r in docs.collect() if lexicon.score(lexicon.features(r.text, machine)) < 0.5}
    assert rows(inputs["simhash_dedup"]).keys() == keep


def test_simhash_stage(inputs):
    docs = inputs["simhash_dedup"].collect()
    ids = [r.doc_id for r in docs]
    component = plain_components(ids, [plain_fingerprint(r.text) for r in docs])
    left = rows(inputs["decontamination"])
    assert left.keys() == set(component) and all(left[r.doc_id] == r for r in docs if r.doc_id in left)


def test_decontamination_stage(inputs, spark, small):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    after, dropped = rows(inputs["secret_scans"]), 0
    for r in inputs["decontamination"].collect():
        n, hit, _ = plain_hits(r.text, items, 13)
        if hit and 20 * hit >= n:
            dropped += 1
            assert r.doc_id not in after
        elif not hit:
            assert after[r.doc_id] == r
        else:
            assert plain_hits(after[r.doc_id].text, items, 13)[1] < hit and after[r.doc_id].n_chars < r.n_chars
    assert dropped


def test_secret_stage(inputs):
    after = rows(inputs["mixing"])
    for r in inputs["secret_scans"].collect():
        text, spans = r.text, plain_secrets(r.text)
        for start, _, _, end in sorted(spans, reverse=True):
            text = text[:start] + "\0" * (end - start) + text[end:]
        want = re.sub("\0+", "[SECRET]", text)
        assert after[r.doc_id].text == want and after[r.doc_id].n_chars == (len(want) if spans else r.n_chars)


def test_secret_stage_masks_findings(spark, small):
    out = rows(staged(spark, small, "secret_scans", edge.documents(spark)))
    assert out[6].text == "[SECRET] \U0001f600 [SECRET] [SECRET]" and out[6].n_chars == len(out[6].text)
    assert out[3].text is None and out[1].text.startswith("the cat")


def test_mixing_stage(inputs):
    docs, out = inputs["mixing"].collect(), inputs["end"].collect()
    assert len(docs) == len(out) and all(0 <= r.copies <= 3 and r.taken == r.copies * r.size for r in out)
    for s in {r.source for r in out}:
        own = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.15 * own[0].target + 20


def test_edge_rows_in_every_stage(spark, folder):
    docs = edge.with_clashes(edge.documents(spark))
    sf = folder(documents=docs, benchmark=[(1, "the cat sat on the mat and looked at the dog again"), (2, None)],
                labels=[(1, 1, 0), (4, 1, 0), (None, 1, 1)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType, name
        got = out.collect()
        assert all(r.key == "x" and r.blob == "x" for r in got), name
        want = {"toxicity": 8, "simhash_dedup": 5, "decontamination": 6, "secret_scans": 8}[name]
        assert len(got) == want, (name, got)
    assert corpus_pipeline.mixing_stage(spark, docs, sf).count() == 8
    empty = folder()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), empty).count() == 0
    assert corpus_pipeline.run(spark, empty).count() == 0
    assert secrets.RULES and os.path.isdir(sf)


def test_simhash_stage_keeps_one_of_each_group_when_ids_repeat(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    docs = spark.createDataFrame([(7, a, "en", "s", 1), (7, b, "en", "s", 1), (9, b, "en", "s", 1), (7, c, "en", "s", 1),
                                  (7, c, "en", "s", 1), (None, a, "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.simhash_stage(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(7, a), (7, b), (7, c)])


def test_secret_stage_leaves_the_kind_of_join_to_spark(spark, small):
    out = staged(spark, small, "secret_scans", edge.documents(spark))
    assert "strategy=merge" not in out._jdf.queryExecution().analyzed().toString()
