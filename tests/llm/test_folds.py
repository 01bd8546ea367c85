import random
import time

import pytest
from pyspark.sql import functions as F

from acadlake.llm import folds, secrets


def plain(text, spans, mark):
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


@pytest.mark.parametrize("mark", ["", "[X]"])
def test_spans_against_plain_python(spark, mark):
    rng, rows = random.Random(len(mark)), []
    for n in [0, 1, 2, 3, 7, 60, 400]:
        text = "".join(rng.choice("ab \u00e9\U0001f600") for _ in range(rng.randint(0, 900)))
        spans = sorted(sorted((rng.randint(0, len(text)), rng.randint(0, len(text)))) for _ in range(n))
        if n > 10:
            spans = sorted([s, min(len(text), s + rng.randint(0, 6))] for s, _ in spans)
        rows.append((n, text, [tuple(s) for s in spans]))
    df = spark.createDataFrame(rows, "n int, text string, spans array<struct<start:bigint,end:bigint>>")
    got = {r.n: r.t for r in df.select("n", folds.without(F.col("text"), F.col("spans"), mark).alias("t")).collect()}
    assert got == {n: plain(t, s, mark) for n, t, s in rows}


def test_a_hundred_thousand_findings_in_one_text(spark):
    text = "".join(f"\u00e9 token=abcdefgh{i:06d} " for i in range(100_000))
    blobs = secrets.with_blobs(spark.createDataFrame([(1, text)], "p long, t string"), "p", "t")
    began = time.time()
    ledger = secrets.update_ledger(blobs)
    out = blobs.join(ledger, "blob").select(F.size("findings").alias("n"), secrets.redact(F.col("text"), F.col("findings")).alias("t"),
                                            F.element_at("findings", -1).alias("last")).first()
    assert out.n == 100_000 and out.t == "\u00e9 [SECRET] " * 100_000
    assert text[out.last.start:out.last.end] == "token=abcdefgh099999"
    assert time.time() - began < 60
