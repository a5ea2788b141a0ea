import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from lodestone.operators import pages, records, reports
from lodestone.sources import artefacts


def test_keys(spark):
    rows = [(" id ", "k", "s", "n", "l"), (None, " k ", "s", "n", "l"), ("", None, "s", "n", None), (None, None, None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "o int, a string, b string, c string, d string, e string").orderBy("o")
    keys = [r[0] for r in df.select(records.record_key(*[F.col(x) for x in "abcde"])).collect()]
    assert keys[:2] == ["id", "k"] and len(keys[2]) == 16 and len(set(keys)) == 4
    two = [r[0] for r in df.select(records.verification_key(F.col("a"), [F.col("b"), F.col("c")], [F.col("e")])).collect()]
    assert len(set(two)) == 4
    assert [r[0] for r in spark.createDataFrame([("a.com",), ("https://www.a.com/",), ("none",)], "u string").select(records.facts_key(F.col("u"))).collect()][2] is None


def test_latest_and_same(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "z"), (None, 9, "q")], "k string, o int, v string")
    assert {tuple(r) for r in records.keep_last(df, ["k"], ["o"]).collect()} == {("a", 3, None), ("b", 2, "z")}
    assert {tuple(r) for r in records.same_ids(df, "k", "o").collect()} == {("a", 1, 2), ("b", 2, 1)}
    assert records.keep_last(df.where("false"), ["k"], ["o"]).count() == 0


@pytest.mark.parametrize(("limit", "want"), [(0, []), (1, [1, 2, 3]), (2, [1, 2, 3, 4]), (9, [1, 2, 3, 4, 5]), (-1, [1, 2, 3, 4, 5])])
def test_limit(spark, limit, want):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "x"), (4, None), (5, None)], "o int, w string")
    assert sorted(r["o"] for r in records.limited_work(df, F.col("w").isNull(), "o", limit).collect()) == want


def test_filling(spark):
    df = spark.createDataFrame([(1, "", ["t"], "n"), (2, "own", None, "n"), (3, None, ["s"], "n")], "id int, s string, sure array<string>, new string")
    got = {r["id"]: (r["s"], r["s_filled"]) for r in records.gap_filled(df, "s", F.col("new"), "sure").collect()}
    assert got == {1: ("n", True), 2: ("own", False), 3: (None, False)}
    facts = spark.createDataFrame([(1, "f", None), (2, "", ["u"])], "id int, s string, sure array<string>")
    got = {r["id"]: (r["s"], r["sure"], r["applied"]) for r in records.applied(df, facts, "id", ["s", "sure"]).collect()}
    assert got == {1: ("f", ["t"], ["s"]), 2: ("own", ["u"], ["sure"]), 3: (None, ["s"], [])}
    rows = spark.createDataFrame([("a", " "), ("b", "w"), ("c", None)], "k string, website string")
    found = spark.createDataFrame([("a", "f", "x"), ("b", "g", "x")], "k string, found string, origin string")
    assert {tuple(r) for r in records.enriched(rows, found, "k").collect()} == {("a", "f", "x"), ("b", "w", "discovery_listing"), ("c", None, "none")}


def test_audit_and_outcomes(spark):
    p = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (None, 1)], "a int, b int")
    assert {tuple(r) for r in records.audit(p, "a", "b").collect()} == {(1, 2), (2, 1)}
    df = spark.createDataFrame([(True, True), (None, True), (False, None)], "r boolean, w boolean")
    assert [r["outcome"] for r in records.outcomes(df, F.col("r"), F.col("w")).collect()] == ["rejected", "review", "selected"]
    many = spark.range(5000).select((F.col("id") % 2).cast("string").alias("code"), F.col("id"))
    assert {tuple(r) for r in reports.examples(many, "code", "id", 3).collect()} == {("0", k, 2 * k) for k in range(3)} | {("1", k, 2 * k + 1) for k in range(3)}


def test_page_states(spark):
    rows = [(200, "x" * 500, "https://a.com", "https://www.a.com/y", None), (200, "x", "https://a.com", None, None), (404, "x", None, None, None), (200, None, None, None, None), (200, "x" * 500, "https://a.com", "https://b.com", None), (200, "This Domain is for sale" + "x" * 500, None, None, None), (200, "sunset " + "x" * 500, None, None, "A sunset"), (200, "sunset " + "x" * 500, None, None, "A day")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, s int, t string, u string, f string, h string").orderBy("k")
    assert [r[0] for r in df.select(pages.failure(*[F.col(x) for x in "stufh"])).collect()] == [None, "thin_content", "http_error", "fetch_failed", "redirected_off_site", "dead_or_parked", "dead_or_parked", None]
    kinds = spark.createDataFrame([("text/html; x", None), ("application/json", "<html>"), (None, "<!DOCTYPE html>"), ("", "plain"), (None, None)], "c string, b string")
    assert [r[0] for r in kinds.select(pages.is_html(F.col("c"), F.col("b"))).collect()] == [True, False, True, False, False]


def test_artefacts(spark, tmp_path):
    p = str(tmp_path / "a.json")
    assert artefacts.read_json(p, 7) == 7
    artefacts.write_json(p, {"d": date(2026, 1, 2), "s": {"b", "a"}, "p": tmp_path})
    assert artefacts.read_json(p) == {"d": "2026-01-02", "s": ["a", "b"], "p": str(tmp_path)} and [x.name for x in tmp_path.iterdir()] == ["a.json"]
    with pytest.raises(ValueError):
        artefacts.write_rows(spark.range(1), str(tmp_path / "final" / "x"))
    artefacts.write_rows(spark.range(3), str(tmp_path / "rows"))
    artefacts.write_rows(spark.range(3), str(tmp_path / "rows"), append=True)
    assert spark.read.json(str(tmp_path / "rows")).count() == 6
    state = artefacts.State(str(tmp_path / "state.json"), keep=3)
    for k in (1, 2, 3, 3, 4):
        state.add({"started_at": k, "n": k})
    assert [r["n"] for r in state.runs()] == [2, 3, 4]
    (tmp_path / "state.json").write_text("{broken")
    assert state.runs() == []


def test_stage_rows(spark, tmp_path):
    schema = "candidate_id string, name string, official_url string, outcome string, facts string"
    prepared, resolved = tmp_path / "prepared.jsonl", tmp_path / "resolved.jsonl"
    prepared.write_text("\n".join(json.dumps(x) for x in ({"candidate_id": "1", "name": "A"}, {"name": "B"}, {"candidate_id": "2", "name": " "}, [1])))
    assert [r["name"] for r in artefacts.load_prepared(spark, str(prepared), schema).collect()] == ["A"]
    assert sorted(r["name"] for r in artefacts.load_verified(spark, str(prepared), schema).collect()) == ["A", "B"]
    assert artefacts.verification_input(spark, str(resolved), str(prepared), schema).count() == 1
    resolved.write_text("")
    assert artefacts.verification_input(spark, str(resolved), str(prepared), schema).count() == 0
    facts = tmp_path / "facts.jsonl"
    facts.write_text("\n".join(json.dumps(x) for x in ({"official_url": "a.com", "outcome": "success", "facts": "1"}, {"official_url": "https://www.a.com/", "outcome": "empty", "facts": "2"}, {"official_url": "a.com", "outcome": "http_failure", "facts": "3"}, {"official_url": "b.com", "outcome": "success"})))
    assert [r["facts"] for r in artefacts.load_facts(spark, str(facts), schema).collect()] == ["2"]


def test_evidence(spark):
    from lodestone.operators import evidence

    html = '<title>Acme Writer | home</title><meta property="og:site_name" content="Other"><h1>Acme Writer</h1><img src="/logo.png" alt="Acme Writer"><a href="/plans?x=1">Buy</a><a href="https://docs.acmewriter.com/x">read</a><a href="/y">Sign-in</a><a href="https://b.com/demo">x</a><a href="#app">dashboard</a><input type="password">'
    rows = [(1, html, "https://acmewriter.com", "Acme Writer"), (2, html, None, "Acme Writer"), (3, None, "https://acmewriter.com", None)]
    df = spark.createDataFrame(rows, "page_id int, body string, url string, name string").select("page_id", pages.page_view(F.col("body")).alias("view"), "url", "name")
    got = {r["page_id"]: (r["offers"], r["named"]) for r in evidence.evidence(df).collect()}
    assert got[1] == (["pricing_link", "login_link", "credential_form"], ["name_in_title", "name_in_h1", "name_in_logo_alt", "name_in_body_text", "domain_matches_name"])
    assert got[2][0] == ["credential_form"] and got[3] == ([], [])
