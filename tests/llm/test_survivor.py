from datetime import datetime

from lodestone.llm import survivor

GROUP = "group_no bigint, prep_id bigint, observed_description string, categories array<string>, discovery_sources array<struct<name:string,url:string,kind:string,retrieved_at:timestamp>>, discovered_at timestamp, trust int, t string, value string"
CONFIG = "source_key string, name string, homepage string, listing_url string, trust double, k string"


def test_survivors(spark):
    src = lambda n, u=None: [(n, u, "directory", None)]
    t1, t2 = datetime(2026, 1, 1), datetime(2026, 2, 1)
    rows = [
        (1, 1, "A good text", ["misc"], src("Alpha"), t1), (1, 2, "A better one", ["Legal Work"], src(" BETA dir "), t1), (1, 3, "n/a", [None, ""], src("Gamma"), t2), (1, 4, "Cut off text…", None, src(None, "https://www.gamma.test/x"), t2),
        (2, 5, "Tie one", ["A b"], src("alpha"), None), (2, 6, "Tie two", ["C d"], src("Alpha"), t1), (2, 7, "Tie three", ["E f"], src("ALPHA"), t1),
        (3, 8, "No source", ["x"], [], t2), (3, 9, "Unknown source", None, src("Nobody"), None), (4, 10, None, None, None, None), (None, 11, "x y z", None, None, None),
    ]
    g = spark.createDataFrame([(*r, 1, "t", "v") for r in rows] + [(*rows[1], 1, "t", "v")], GROUP)
    c = spark.createDataFrame([("alpha", "Alpha", "https://alpha.test/", None, 0.4, "k"), ("beta", "Beta Dir", None, None, 0.8, "k"), ("gamma", "Gamma", "https://gamma.test", "https://gamma.test/t/", None, "k")], CONFIG)
    got = {(r["group_no"], r["field_name"]): r["prep_id"] for r in survivor.survivors(g, c).collect()}
    assert got == {(1, "observed_description"): 2, (1, "categories"): 2, (2, "observed_description"): 6, (2, "categories"): 6, (3, "observed_description"): 9}
    assert survivor.survivors(g.where("false"), c).count() == 0
    assert survivor.survivors(g, c.where("false")).count() == 5
