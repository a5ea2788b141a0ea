import uuid

from pyspark.sql import functions as F

from lodestone.functions import urls

URLS = {
    "example.com": "https://example.com/",
    "HTTP://WWW.Example.com:80/A//b/index.html?utm_source=x&b=2&a=1#top": "https://example.com/A/b?a=1&b=2",
    "//example.com:8080/x/": "https://example.com:8080/x",
    "https://example.com/#/app/x": "https://example.com/#/app/x",
    " <https://example.com/a b> ": "https://example.com/ab",
    "https://example.com/caf%C3%A9": "https://example.com/caf%C3%A9",
    "https://example.com/x?q=a+b&ref=1": "https://example.com/x?q=a+b",
    "ftp://example.com": None,
    "localhost": None,
    "": None,
    None: None,
}


def column(spark, values, make):
    out = spark.createDataFrame(list(enumerate(values)), "k int, v string").select("k", make(F.col("v")).alias("o")).orderBy("k").collect()
    return [r["o"] for r in out]


def test_normalize(spark):
    assert column(spark, list(URLS), urls.normalize_url) == list(URLS.values())
    good = [u for u in URLS.values() if u]
    assert column(spark, good, urls.normalize_url) == good


def test_domains(spark):
    assert column(spark, ["a.b.co.uk", "docs.x.com", "x.github.io", "x.com", None], urls.registrable_domain) == ["b.co.uk", "x.com", "x.github.io", "x.com", None]


def test_product(spark):
    values = ["https://x.com/en/pricing", "https://x.com/App/login", "https://apps.apple.com/app/foo", "https://github.com/", "https://x.com/pricing/enterprise", None]
    got = column(spark, values, urls.product)
    assert [p and (p["key"], p["root"]) for p in got] == [("x.com", True), ("x.com/app", False), ("apps.apple.com/app/foo", False), ("github.com", True), ("x.com/pricing/enterprise", False), None]


def test_identity_and_id(spark):
    rows = [("A", "https://x.com", None), ("A", "https://github.com", "https://dir.com/t/a"), ("Acme Pro", None, None), (None, None, None)]
    got = spark.createDataFrame(rows, "n string, w string, l string").select(urls.identity(F.col("n"), F.col("w"), F.col("l")).alias("i")).select("i.*", urls.entity_id("Tool", F.col("i.key")).alias("id")).collect()
    assert [(r["key"], r["basis"], r["confidence"]) for r in got] == [("x.com", "website_domain", "high"), ("dir.com/t/a", "listing_product_url", "medium"), ("acme", "name", "low"), (None, None, None)]
    assert [r["id"] for r in got[:3]] == [str(uuid.uuid5(uuid.UUID(urls.NAMESPACE), f"tool:{k}")) for k in ("x.com", "dir.com/t/a", "acme")]


def test_links(spark):
    base = F.lit("https://x.com/a/b?q=1")
    values = ["/p", "c", "../d", "//y.org/z", "#top", "mailto:a@b.c", "https://z.com", "?r=2", None]
    assert column(spark, values, lambda c: urls.absolutize(c, base)) == ["https://x.com/p", "https://x.com/a/c", "https://x.com/d", "https://y.org/z", None, None, "https://z.com/", "https://x.com/a/b?r=2", None]
