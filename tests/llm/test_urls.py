from acadlake.llm import urls
from tools.oracle_check import compare, duck_con

PAGES = [
    (1, "http://A.Example.ORG/es/x?q=1"), (2, "https://example.org/en/12"), (3, "https://notexample.org/en/1"),
    (4, "ftp://x.com/fr/"), (5, "http://com/de/1#a://b.org/"), (6, None), (7, "no scheme"), (8, "http://x.com"),
    (9, "http://É.Example.com/DE/"), (10, "http:///es/"), (11, "http://a.org?x/es/"), (12, "://org/"), (12, "://org/"),
    (None, "http://u:p@w.example.org:80/es/"), (13, "http://example.org/e\ns/"), (14, "http://example.org./es/"),
    (15, "http://" + "a." * 5000 + "com/de/" + "x" * 50_000),
]


def plain(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:end], rest[end:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in urls.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


def test_cases_against_plain_python(spark, folder):
    sf = folder(pages=[(i, u, "") for i, u in PAGES])
    got = sorted((tuple(r) for r in urls.op8_url_filters(spark, sf).collect()), key=str)
    assert got == sorted(((i, *plain(u)) for i, u in PAGES), key=str)


def test_query_against_sql(spark, small):
    assert compare("op8", urls.op8_url_filters(spark, small), urls.ORACLE, duck_con(small))


def test_no_rules_and_no_pages(spark, folder):
    df = spark.createDataFrame([("a.org", "/", "x")], "host string, path string, verdict string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    out = urls.judge(df.select("host", "path"), none).collect()
    assert [(r.rule, r.verdict) for r in out] == [(None, "allow")]
    assert urls.op8_url_filters(spark, folder()).count() == 0


def test_false_hash_prefixes_are_confirmed(spark, monkeypatch):
    monkeypatch.setattr(urls, "_digest", lambda h, p: urls.F.concat(
        urls.F.lit("00000000"), urls.F.sha2(urls.F.concat(h, urls.F.lit("\n"), p), 256)))
    rules = spark.createDataFrame(list(urls.RULES), "host string, path string, verdict string")
    df = spark.createDataFrame([plain(u)[:2] for _, u in PAGES], "host string, path string")
    got = sorted((tuple(r) for r in urls.judge(df, rules).collect()), key=str)
    assert got == sorted((plain(u) for _, u in PAGES), key=str)
