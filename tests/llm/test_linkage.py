import numpy as np

from lodestone.llm import linkage as L

ROW = "row_id bigint, name string, source_key string, listing_url string, website string, tagline string, pid string, block int"
CONF = "source_key string, name string, homepage string, listing_url string"


def test_label_model_finds_the_good_voter():
    rng = np.random.default_rng(1)
    y = rng.random(20_000) < 0.4
    acc = (0.95, 0.9, 0.6)
    v = np.column_stack([np.where(rng.random(len(y)) < a, np.where(y, 1, -1), np.where(y, -1, 1)) * (rng.random(len(y)) < 0.8) for a in acc])
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    m = L.LabelModel(patterns, counts.astype(float))
    p = {tuple(x): c for x, c in zip(patterns.tolist(), m.posterior(patterns))}
    assert p[(1, 1, -1)] > 0.9 and p[(-1, -1, 1)] < 0.1 and p[(1, 1, 1)] > 0.95


def test_deletions():
    for a, b, one in (("lantern", "lantrn", True), ("lantern", "lanetrn", True), ("lantern", "lanterns", True), ("lantern", "kettle", False)):
        assert bool(L.deletions(a) & L.deletions(b)) == one
    assert len(L.deletions("x" * 20_000)) == 2


def test_pairs(spark, monkeypatch):
    rows = [
        (1, "Hubnopab Summit", "a", "https://a.test/t/hubnopab-summit", "https://hubnopabsummit.test/", None), (2, "The Hubnopab Summit", "b", None, "http://www.hubnopabsummit.test?ref=x", None),
        (3, "Summit by Hubnopab", "c", "https://c.test/t/9", None, None), (4, "Hubnopab Jigsaw", "b", None, "https://hubnopabsummit.test/jigsaw", None), (5, "Hubnopab Sumit", "d", None, "https://hubnopabsummit.test/index.html", None),
        (6, "Photo Fixer", "a", None, "https://vakgucit.test/", None), (7, "photo fixer", "b", None, "https://jaspolac.test", None), (8, "PHOTO FIXER", "c", None, "//jaspolac.test/#top", None), (9, "Photo Fixer", "d", None, None, None), (10, "Photo Fixer", "a", None, "https://a.test/", None),
        (11, None, None, None, None, None), (12, "", "b", None, "n/a", ""), (13, "Zokpevel Quarry", "a", None, "https://a.test/", None), (14, "Zokpevel Quarry", "b", None, "https://zokpevelquarry.test", None), (14, "Zokpevel Quarry", "b", None, "https://zokpevelquarry.test", None), (15, "Zokpevel Quarry", "a", None, None, None),
    ]
    filler = []
    for k in range(40):
        maker = "".join("bcdfghjklm"[(k * m + m * m) % 10] + v for m, v in ((1, "o"), (3, "a"), (7, "e"), (9, "u"))) + "prstvwxz"[k % 8] + "kmnp"[k // 10]
        filler += [(100 + 3 * k, f"{maker} Lantern", "a", None, f"https://{maker}lantern.test", None), (101 + 3 * k, f"{maker.upper()} LANTERN", "b", None, f"https://www.{maker}lantern.test/", None), (102 + 3 * k, f"{maker} Kettle", "b", None, f"https://{maker}lantern.test/kettle", None)]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows + filler], ROW)
    conf = spark.createDataFrame([(x, x.upper(), f"https://{x}.test/", f"https://{x}.test/t/") for x in "abcd"], CONF)
    found = L.row_pairs(df, conf).collect()
    assert all(0.5 <= r["confidence"] <= 1 for r in found)
    got = {(r["left_row_id"], r["right_row_id"]) for r in found}
    monkeypatch.setattr(L, "PART", 2)
    assert {(r["left_row_id"], r["right_row_id"]) for r in L.row_pairs(df, conf).collect()} == got
    scored = L.scored(df, conf).collect()
    assert {r["confidence"] >= 0.5 for r in scored} == {True, False} and all(r["left_row_id"] < r["right_row_id"] for r in scored)
    assert {(a, b) for a, b in got if b < 100} == {(1, 2), (1, 3), (2, 3), (1, 5), (2, 5), (3, 5), (7, 8), (13, 14), (14, 15)}
    assert {(a, b) for a, b in got if a >= 100} == {(100 + 3 * k, 101 + 3 * k) for k in range(40)}
    assert L.row_pairs(df.where("false"), conf).count() == 0
