import random
import re

from pyspark.sql import functions as F

from tidemart.llm import queries, url_bloom


def canonical(u):
    if u is None or "://" not in u:
        return None
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    tail = rest[len(host):].split("#")[0]
    path, _, query = tail.partition("?")
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    kept = [p for p in re.split(r"[?&]", query) if p and not re.fullmatch(r"(utm_[^&=]*|ref)(=[^&]*)?", p)]
    return host + path.rstrip("/") + "".join("&" + p for p in kept)


URLS = ["http://A.Example.net/en/x?utm_source=a&id=3&ref=z#f", "https://a.example.net/en/x/?id=3", "x", None, "",
        "http://net/", "http://net", "http://foo.net?x", "ftp://q.example.net/en", "http://example.net/en/",
        "http://b.example.com/de/1", "http://xexample.com/de/1", "http://É.org/fr/ü", "http://a.org/fr?/fr/",
        "http://a.b://c/d", "http://h/?&&ref&utm_x=1&reference=2", "http://h/a b\nc?x=1", "http://:80/", "://", "a://h#/x"]


def test_canonical_form(spark):
    rng = random.Random(0)
    parts = ["http://", "h.net", "/", "?", "#", "&", "ref", "ref=1", "utm_a=2", "a=b", "EN", "//", "=", "utm_"]
    urls = URLS + ["http://" + "".join(rng.choice(parts) for _ in range(rng.randrange(10))) for _ in range(500)]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    for r in df.select("u", url_bloom.canonical_url(F.col("u")).alias("c")).collect():
        assert r["c"] == canonical(r["u"]), r["u"]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    none = spark.createDataFrame([], "url string")
    got = {r["page_id"]: r for r in url_bloom.url_verdicts(pages, none, queries.URL_RULES).collect()}
    assert len(got) == len(URLS)
    at = URLS.index
    want = {URLS[0]: ("a.example.net", "/en/x", "example.net/en/", "allow"), "http://net/": ("net", "/", "net/", "block"),
            "http://net": ("net", "", None, "allow"), "x": ("", "", None, "allow"), None: ("", "", None, "allow"),
            "ftp://q.example.net/en": ("q.example.net", "/en", "net/", "block"),
            "http://b.example.com/de/1": ("b.example.com", "/de/1", "example.com/de/", "block"),
            "http://xexample.com/de/1": ("xexample.com", "/de/1", None, "allow"),
            "http://É.org/fr/ü": ("É.org", "/fr/ü", "org/fr/", "allow"), "://": ("", "", None, "allow")}
    for u, w in want.items():
        r = got[at(u)]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == w


def test_list_has_no_false_positive_or_miss(spark):
    rng = random.Random(3)
    urls = [f"http://h{i % 50}.org/p{i}?id={i}" for i in range(4000)] + [None] * 3
    listed = [u + "&utm_q=1#x" for u in rng.sample(urls[:4000], 300)] + [None, "no url"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(9000 + i, urls[7], "h") for i in range(2000)],
                                  "page_id long, url string, host string")
    bad = {canonical(u) for u in listed} - {None}
    for bits in (1, 16):  # a crowded filter passes more, the exact join still decides
        got = url_bloom.url_verdicts(pages, spark.createDataFrame([(u,) for u in listed * 2], "url string"),
                                     [], bits_per_url=bits).collect()
        assert len(got) == 6003
        for r in got:
            u = urls[r["page_id"]] if r["page_id"] < 9000 else urls[7]
            assert (r["verdict"] == "block") == r["listed"] == (canonical(u) in bad)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_bloom.url_verdicts(pages, pages.select("url"), queries.URL_RULES).count() == 0
