from datetime import date

from pyspark.sql import functions as F

from lodestone.functions import address, brands, text, urls, values, words

TODAY = date(2026, 6, 1)


def column(spark, rows, make, kind="string"):
    out = spark.createDataFrame(list(enumerate(rows)), f"k int, v {kind}").select("k", make(F.col("v")).alias("o")).orderBy("k").collect()
    return [r["o"] for r in out]


def test_dates():
    want = {"2024": (date(2024, 1, 1), "year"), "2024-03": (date(2024, 3, 1), "month"), "2024-03-09": (date(2024, 3, 9), "day"), "March 2023": (date(2023, 3, 1), "month"), "9 March 2023": (date(2023, 3, 9), "day"), "1980": None, "2031-01-01": None, "soon": None, "0000": None, "": None}
    assert {t: (d["date"], d["precision"]) if (d := words.cleaned(t) and address and values.dated(t, TODAY)) else None for t in want} == want


def test_prices(spark):
    rows = ["$1,50 a seat", "from EUR 12.5", "It is free", "ask us", "", None, "€3 or $2"]
    got = [p and (p["amount"], p["currency"]) for p in column(spark, rows, values.price)]
    assert got == [(1.5, "USD"), (12.5, "EUR"), (0.0, None), None, None, None, (3.0, "EUR")]
    assert column(spark, rows, values.lowest_price) == [1.5, 12.5, None, None, None, None, 2.0]


def test_numbers(spark):
    rows = [None, date(2026, 6, 1), date(2026, 5, 1), date(2027, 1, 1)]
    assert column(spark, rows, lambda c: values.days_since(c, TODAY), "date") == [None, 0, 31, None]
    assert column(spark, [None, 1.0, 5.0, 50.0], lambda c: values.graded(c, [(10, 1.0), (5, 0.5)]), "double") == [0.0, 0.0, 0.5, 1.0]
    assert column(spark, [None, -1.0, 0.5, 9.0], lambda c: values.weighted([(80.0, c), (40.0, c)]), "double") == [0.0, 0.0, 60.0, 100.0]
    assert column(spark, [2.675, 1.005], values.quantize, "double") == [2.68, 1.01]


def test_arrays_and_maps(spark):
    df = spark.createDataFrame([(1, ["A", "b", None], ["a", "C"], {"x": "1"}, {"x": "2", "y": "3"}), (2, None, None, None, None)], "k int, a array<string>, b array<string>, m map<string,string>, n map<string,string>")
    got = df.orderBy("k").select(values.united(F.col("a"), F.col("b")).alias("u"), values.merged_map(F.col("m"), F.col("n")).alias("m"), values.completeness([("a", "array<string>"), ("m", "map<string,string>"), ("k", "int")]).alias("c")).collect()
    assert [(r["u"], r["m"], r["c"]) for r in got] == [(["A", "b", "C"], {"x": "1", "y": "3"}, 1.0), ([], {}, 0.333)]
    refs = spark.createDataFrame([([("S", "u"), ("s", "u"), ("S", None), (None, "u"), (" ", "u")],), (None,)], "r array<struct<name:string,url:string>>")
    assert [[tuple(x) for x in r[0]] for r in refs.select(values.distinct_refs(F.col("r"))).collect()] == [[("S", "u"), ("S", None)], []]
    assert column(spark, [["AI", " other ", "Maps", None], None], values.without_vague, "array<string>") == [["Maps"], []]
    known = [("art", "Art"), ("video", "Video"), ("ai", "AI")]
    assert column(spark, [["Clip art"], ["My Video maker"], ["ART", "video"], ["rain"], [None], None], lambda c: values.inferred(c, known), "array<string>") == [None, "Video", "Art", None, None, None]


def test_brands(spark):
    rows = [("Clever AI Detector", "Try the Clever AI Detector today"), ("Pi", "Pi is here"), ("Pi", "Pizza"), ("Acme Writer", "Other thing"), (None, "x"), ("x", None)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a string, b string").orderBy("k")
    assert [r[0] for r in df.select(brands.tells_name(F.col("a"), F.col("b"))).collect()] == [True, True, False, False, False, False]
    pairs = [("Acme Writer", "Acme"), ("Acme", "Zeta Acme Labs"), ("Foo Bar", "Bar None"), ("One", "Two"), (None, "x")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(pairs)], "k int, a string, b string").orderBy("k")
    keys = [text.canonical_name(F.col(c)) for c in "ab"] + [text.name_tokens(F.col(c)) for c in "ab"]
    assert [r[0] for r in df.select(brands.names_overlap(*keys)).collect()] == [True, True, True, False, False]
    sites = spark.createDataFrame([("acmewriter", "https://www.getacmewriter.co.uk/x"), ("pi", "https://pizza.com"), ("x", None)], "n string, u string")
    assert [r[0] for r in sites.select(brands.domain_tells_name(F.col("n"), F.col("u"))).collect()] == [True, False, False]


def test_addresses(spark):
    assert address.parsed("http://Bücher.example/Ä?b=1&a=2&utm_x=3")["url"] == "https://xn--bcher-kva.example/%C3%84?a=2&b=1"
    assert address.parsed("http://a.com/x?y=1", keep_query=False, keep_path=False, force_https=False)["url"] == "http://a.com/"
    assert address.absolute("../../../../../../../x/./y", "https://a.com/1/2/3/4/5/6/7/8") == "https://a.com/x/y"
    assert address.parsed("https://a.com:x/") is None and address.parsed("x" * 50_000) is None
    assert column(spark, ["a.com", "a b.com", ".com", "https://x.org/y z", "localhost", "", None, "u:p@h.io:80/x"], urls.is_probably_url) == [True, False, False, False, False, False, False, True]
    assert column(spark, ["https://a.com/x.PNG?y", "//cdn.a.com/x", "https://a.com/png", None], urls.looks_like_asset) == [True, True, False, True]


def test_words():
    assert words.cleaned("ﬁ ℡ é") == "fi TEL é" and words.slug("Ĳssel ½") == "ijssel-12"
    assert words.unmarked("a&eacute;<br>b &#9731;") == "aé\nb ☃" and words.distinct_texts(["A", "a", "b", "c"], 80, 2) == ["A", "b"]
