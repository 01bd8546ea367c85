import hashlib
import re

import edge
from acadlake.llm import secrets
from tools.oracle_check import compare, duck_con


def plain(text):
    """Spans of the base kinds, by regular expressions with every match tried."""
    kinds = (("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
             ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32))
    return sorted((m.start(), k, name, m.end()) for k, (name, p, g, n) in enumerate(kinds)
                  for m in re.finditer(p, text) if len(m.group(g)) >= n)


TEXTS = [
    "password=secret:longlonglong", "Token = 'abcd' token: \"abcdefgh\"", "password: ab token=longvalue1",
    "apiKEY==x=yz12345 api_key=12345678", "\U0001f600é passwd:=12345678", "AKIAAKIAAKIAAKIA1 AKIA12345678901 AKIA123456789012",
    "0" * 31 + " " + "f" * 33 + "g" + "A" + "0" * 32, "secret" * 5 + "=aaaaaaaa", "token=" + "0a" * 20, "", "no secrets",
]


def test_base_kinds_against_plain_python(spark, folder):
    sf = folder(documents=[(i, t, "en", "a", 1) for i, t in enumerate(TEXTS)] + [(99, None, "en", "a", 1)])
    got = {r.doc_id: r for r in secrets.op7_secret_scans(spark, sf).collect()}
    for i, t in enumerate(TEXTS):
        want = plain(t)
        say = ",".join(f"{name}:{s}:{e}" for s, _, name, e in want)
        r = got[i]
        assert r.spans == say, t
        assert r.base_sha256 == hashlib.sha256(say.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w[2] == k for w in want) for k in ("assign", "access", "hex")]
    assert got[99].spans == ""


def test_query_against_sql(spark, small):
    assert compare("op7", secrets.op7_secret_scans(spark, small), secrets.ORACLE, duck_con(small))


def test_ledger_scans_unseen_blobs_and_new_rules_only(spark):
    first = secrets.with_blobs(spark.createDataFrame([("a", "password=12345678"), ("b", "password=12345678")],
                                                     "p string, t string"), "p", "t")
    ledger = secrets.update_ledger(first)
    assert ledger.count() == 1
    second = secrets.with_blobs(spark.createDataFrame([("a", "password=12345678"), ("c", "token=abcdefgh9")],
                                                      "p string, t string"), "p", "t")
    new = secrets.update_ledger(second, ledger)
    assert [r.findings[0].end for r in new.collect()] == [15]
    assert secrets.update_ledger(second, ledger.unionByName(new)).count() == 0
    assert secrets.update_ledger(second, ledger.unionByName(new), version="next").count() == 2
    found = secrets.findings_by_path(second, ledger.unionByName(new)).collect()
    assert sorted((r.path, len(r.findings)) for r in found) == [("a", 1), ("c", 1)]


def test_redaction_merges_overlaps(spark):
    df = spark.createDataFrame([("\U0001f600 token=" + "0a" * 20 + " end",), ("clean",), (None,)], "text string")
    led = secrets.with_blobs(df, "text", "text")
    out = led.join(secrets.update_ledger(led), "blob").select("path", secrets.redact(led.text, secrets.F.col("findings")).alias("t"))
    assert {r.path: r.t for r in out.collect()} == {
        "\U0001f600 token=" + "0a" * 20 + " end": "\U0001f600 [SECRET] end", "clean": "clean", None: ""}


def test_no_python_on_the_main_path(spark, small):
    plan = secrets.op7_secret_scans(spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_edge_rows(spark):
    versions = secrets.with_blobs(edge.with_clashes(edge.documents(spark)), "doc_id", "text")
    out = secrets.findings_by_path(versions, secrets.update_ledger(versions)).collect()
    assert len(out) == len(edge.DOCUMENTS)
    assert {r.path: len(r.findings) for r in out}[6] == 3
    empty = secrets.with_blobs(edge.documents(spark).limit(0), "doc_id", "text")
    assert secrets.findings_by_path(empty, secrets.update_ledger(empty)).count() == 0
