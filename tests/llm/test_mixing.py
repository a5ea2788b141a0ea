from lodestone.llm import mixing


def docs(spark, rows):
    return spark.createDataFrame([(*r, 5, "h") for r in rows], "doc_id bigint, source string, text string, tokens int, h string")


def test_shares(spark):
    rows = [(k, "Big Source", "one two three four five " * (1 + k % 7)) for k in range(600)] + [(1000 + k, "small", "one two three") for k in range(40)] + [(2000, None, "x"), (2001, "other", "y z"), (None, "small", "q"), (2002, "small", None), (2003, "small", "")]
    targets = spark.createDataFrame([("big_source", 0.6, 1), ("SMALL", 0.1, 3), ("absent", 0.3, 2)], "source string, target_share double, max_repeats int")
    mix, shares = mixing.plan(docs(spark, rows), targets)
    s = {r["source"]: r.asDict() for r in shares.collect()}
    total = mixing._encoding(mixing.TOKENIZER)
    n = sum(len(total.encode_ordinary(t)) for _, _, t in rows if t)
    assert abs(s["big_source"]["tokens_used"] - 0.6 * n) <= 50
    assert s["small"]["most_copies"] == 3 and s["small"]["falls_short"]
    assert s["absent"]["tokens_used"] == 0 and s["absent"]["falls_short"]
    m = mix.collect()
    assert all(1 <= r["copies"] <= 3 for r in m) and len({r["doc_id"] for r in m}) == len(m)
    assert sum(r["tokens"] * r["copies"] for r in m if r["source"] == "big_source") == s["big_source"]["tokens_used"]
    again, _ = mixing.plan(docs(spark, rows).repartition(7), targets)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in m}


def test_empty(spark):
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    mix, shares = mixing.plan(docs(spark, []), targets)
    assert mix.count() == 0 and shares.first()["share_reached"] is None
    assert mixing.plan(docs(spark, [(1, "a", "x y")]), targets.where("false"))[0].count() == 0
