"""URL filters against plain Python and SQL, on pages that redirect to each other."""

import pytest

from meterloom.llm import queries, url_filters

SCHEMA = "page_id long, url string, html string, host int, node int, verdict string"


def canonical(target):
    return f'<html><head><link href="{target}" rel="canonical"></head>'


PAGES = [
    ("http://a.example.org/one", canonical("http://x.net/es/2")),  # blocked through its canonical page, which is no page here
    ("https://a.example.org/one?utm_source=feed#top", None),  # the same node
    ("http://a.example.org/two", "<META http-equiv=refresh content='0; URL=/one'>"),  # relative, two steps from the block
    ("http://a.example.org/three", canonical("http://shop.com/three")),  # an allowed member
    ("http://a.example.org/four", canonical("three")),
    ("http://a.example.org/five", canonical("//x.net/fr/5")),  # block and allow in one component: allow precedes
    ("http://a.example.org/five", canonical("http://www.example.com/en/5")),
    ("HTTP://A.Example.ORG:80/six", canonical("http://X.NET/es/6/")),
    ("http://a.example.org/seven", '<!-- <link rel="canonical" href="http://x.net/es/7"> --><script>"<link rel=canonical href=http://x.net/es/7>"</script>'),
    ("http://a.example.org/eight", canonical("mailto:x@x.net/es/")),
    ("http://a.example.org/nine", canonical("#top")),
    ("http://a.example.org?q=1&amp;utm_x=2", canonical("?q=1&amp;utm_medium=m")),
    ("http://a.example.org/ten/", "<link rel='shortcut canonical' href=http://y.x.net/es/10>"),
    ("http://a.example.org/ten/x", canonical("/ten/")),
    ("http://www.example.com/en/1", canonical("http://x.net/es/1")),  # a rule of its own
    ("http://blog.example.com/en/1", None), ("http://example.com/fr/1", None), ("http://notexample.com/en/1", None), ("http://com/x", None), ("http://x.com", None),
    ("http://x.net/es/", None), ("http://x.net/es", None), ("http://fr.net/fr/?a=/es/", None), ("ftp://x.NET/fr/9#/es/", None), ("http://X.NET:8080/es/1", None),
    (None, None), ("", ""), ("no scheme", "canonical"), ("://", None), ("http://", canonical("http://x.net/es/1")), ("x://y://z.com/", None),
    ("http://é.org/ü" + "x" * 50_000, "<p>refresh</p>" + "y" * 200_000), ("http://a.example.org/one", canonical("http://x.net/es/2")),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(None if i == 3 else i, u, h, 1, 2, "block") for i, (u, h) in enumerate(PAGES)], SCHEMA).repartition(3)


def verdicts(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


def split(url):
    """The contract's host and path."""
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    ends = [k for k, c in enumerate(after) if c in "/?#"] + [len(after)]
    stops = [k for k, c in enumerate(after) if c in "?#"] + [len(after)]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in after[: ends[0]])
    return low, after[ends[0] : stops[0]]


def ruled(host, path):
    fits = [(len(h + p), v, h + p) for v, h, p in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_rules_and_aliases(pages):
    blocked = {"/one", "/two", "/six", "/ten/", "/ten/x"}
    want = []
    for i, (url, _) in enumerate(PAGES):
        host, path = split(url)
        verdict, rule = ruled(host, path)
        aliased = "block" if host.startswith("a.example.org") and path in blocked else "allow"
        want.append((None if i == 3 else i, host, path, rule, verdict or aliased))
    assert verdicts(url_filters.url_verdicts(pages)) == sorted(want, key=repr)


def test_rules_of_a_table(spark, pages):
    rules = spark.createDataFrame(url_filters.RULES, "verdict string, host string, path string")
    assert verdicts(url_filters.url_verdicts(pages, rules)) == verdicts(url_filters.url_verdicts(pages))
    with pytest.raises(ValueError):
        url_filters.decided(pages, list(url_filters.RULES) * 200)


def test_sql(duck, pages):
    import duckdb

    own = duckdb.connect()
    frame = pages.select("page_id", "url", "html").toPandas()
    frame = frame.where(frame.notna(), None)
    own.register("pages", frame)
    found = own.execute(url_filters.SQL).fetchall()
    names = [d[0] for d in own.description]
    assert names == ["page_id", "host", "path", "rule", "verdict"]
    plain = [tuple(None if x != x else int(x) if k == 0 and x is not None else x for k, x in enumerate(r)) for r in found]
    assert sorted(plain, key=repr) == verdicts(url_filters.url_verdicts(pages))


def test_given_redirects_and_hubs(spark):
    """Three hundred pages lead to one blocked page, a chain of forty to another; all are blocked but those with a rule."""
    rows = [(i, f"http://h.org/{i}", canonical("http://t.net/es/"), 0, 0, "") for i in range(300)]
    rows += [(1000 + i, f"http://c.org/{i}", "", 0, 0, "") for i in range(40)]
    redirects = [(f"http://c.org/{i}", f"https://c.org/{i + 1}") for i in range(39)] + [("http://c.org/0", "http://z.net/fr/"), (None, "http://z.net/fr/")]
    pages = spark.createDataFrame(rows, SCHEMA)
    found = url_filters.url_verdicts(pages, redirects=spark.createDataFrame(redirects, "url string, target string"))
    assert {r["verdict"] for r in found.collect()} == {"block"}
    assert {r["verdict"] for r in url_filters.url_verdicts(pages).filter("page_id >= 1000").collect()} == {"allow"}


def test_empty(pages):
    assert url_filters.url_verdicts(pages.limit(0)).collect() == []


def test_query(spark, base, duck):
    found = verdicts(queries.QUERIES["op11_url_filters"](spark, base))
    assert found == sorted(duck.execute(queries.ORACLE_SQL["op11_url_filters"]).fetchall(), key=repr)
    assert len(found) == spark.read.parquet(f"{base}/pages.parquet").count()
