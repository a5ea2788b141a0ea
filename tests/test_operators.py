from pyspark.sql import functions as F

from lodestone.operators import edges, joins, merge, pages, pairs, prepare, reports
from lodestone.operators import select as selection

RAW = "row_id bigint, name string, source_key string, source_name string, listing_url string, website string, tagline string, categories array<string>, discovered_at timestamp, key string, host int"


def raw(spark, rows):
    return spark.createDataFrame([(*r, None, "k", 1) for r in rows], RAW)


def test_prepare(spark):
    rows = [
        (1, " Acme | x ", "s", "S", "https://d.com/t/acme", "acme.com", "Short", ["A", "a", None]), (2, None, "s", "S", None, "acme.com", None, None), (3, "Beta", "s", "S", None, None, None, []),
        (4, "Gamma", "s", "S", "github.com", None, "A long enough description here", ["B"]),
    ]
    got = {r["row_id"]: r for r in prepare.prepare(raw(spark, rows)).collect()}
    assert [got[k]["reject_reason"] for k in (1, 2, 3, 4)] == [None, "no_name", "no_pointer", None]
    assert got[1]["identity_key"] == "acme.com" and got[1]["categories"] == ["A"] and got[1]["needs_review"]
    assert got[1]["issues"] == ["observed_description_too_short", "name_may_contain_a_tagline", "no_discovered_at_recorded"]
    assert got[4]["identity_basis"] == "name" and "weak_identity_name_only" in got[4]["issues"]
    assert prepare.prepare(raw(spark, [])).count() == 0
    r = {x["source_key"]: x for x in reports.by_source(prepare.prepare(raw(spark, rows))).collect()}
    assert r["all"]["rows"] == 4 and r["s"]["acceptance_rate"] == 0.5


def test_merge(spark):
    rows = [(2, "Acme B", "t", "T", None, "https://www.acme.com/", "tag", ["y", "x"]), (1, "Acme", "s", "S", "https://d.com/a", "acme.com", "", ["x", None]), (3, "Solo", "s", "S", None, None, None, None), (None, "Nobody", None, None, None, None, None, None)]
    got = {r["key"]: r for r in merge.merge_candidates(raw(spark, rows)).collect()}
    a = got["domain:acme.com"]
    assert (a["row_id"], a["name"], a["tagline"], a["categories"], a["sources"]) == (1, "Acme", "tag", ["x", "y"], 2)
    assert got["name:solo"]["categories"] == [] and len(got) == 2


def test_golden(spark):
    schema = "group_no bigint, prep_id bigint, name string, website string, observed_description string, categories array<string>, source_keys array<string>, discovery_sources array<struct<name:string>>, discovered_at timestamp, verification_status string, issues array<string>, needs_review boolean"
    rows = [(1, 5, "B", None, "text", ["x"], ["s"], [("a",)], None, "unverified", None, True), (1, 6, "A", "w.com", None, ["y", "x"], None, None, None, "Verified", ["i"], None), (2, 7, None, None, None, None, None, None, None, None, None, None)]
    got = {r["group_no"]: r for r in merge.golden_records(spark.createDataFrame(rows, schema)).collect()}
    assert (got[1]["prep_id"], got[1]["name"], got[1]["observed_description"], got[1]["categories"], got[1]["aliases"], got[1]["needs_review"]) == (6, "A", "text", ["y", "x"], ["A", "B"], True)
    assert got[2]["categories"] == [] and got[2]["name"] is None


def test_joins(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "o int, key string")
    done = spark.createDataFrame([("b",), (None,)], "key string")
    assert {tuple(r) for r in joins.pending(rows, done, "key", "o").collect()} == {(1, "a"), (4, None)}
    left = spark.createDataFrame([(1, "x", "p"), (2, "z", "q"), (3, None, None)], "id int, a string, b string")
    right = spark.createDataFrame([(10, "x", "q"), (9, "y", "q"), (8, None, None)], "rid int, ra string, rb string")
    got = {r["id"]: (r["matched"], r["matched_by"]) for r in joins.cascade(left, right, [("first", "a", "ra"), ("second", "b", "rb")], "rid", "rid").collect()}
    assert got == {1: (10, "first"), 2: (9, "second"), 3: (None, None)}
    twice = joins.cascade(left.union(left).union(left), right, [("first", "a", "ra"), ("second", "b", "rb")], "rid", "rid")
    assert twice.count() == 9 and twice.where("id = 3").count() == 3


def test_pairs(spark):
    t = spark.createDataFrame([(1, "Acme Writer", "Acme", "https://acme.com/writer"), (2, "Acme Writer", None, "http://www.acme.com/writer/"), (3, "Acme Writr", "Acme", "https://acme.com/other"), (4, "Other", None, None), (5, None, None, None)], "tool_no bigint, name string, company string, website string")
    r = pairs.records(t)
    got = {(x["left_id"], x["right_id"]): (x["decision"], x["tier"]) for x in pairs.judge(pairs.candidate_pairs(pairs.blocking_keys(r)), r).collect()}
    assert got == {(1, 2): ("merge", "tier_a_canonical_url"), (1, 3): ("review", "tier_e_review"), (2, 3): ("review", "tier_e_review")}
    many = spark.range(1, 61).select(F.col("id").alias("tool_no"), F.concat(F.lit("Shared "), F.col("id").cast("string")).alias("name"), F.lit(None).cast("string").alias("company"), F.lit(None).cast("string").alias("website"))
    keys = pairs.blocking_keys(pairs.records(many))
    assert pairs.block_sizes(keys).where("kind = 'token'").first()["large"]
    assert pairs.candidate_pairs(keys).count() == 60 * 59 // 2 and pairs.candidate_pairs(keys, skip_large=True).count() == 0
    e = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 99), (None, 5), (7, 7)], "a bigint, b bigint")
    groups = {r["id"]: r["group_id"] for r in pairs.groups(e, "a", "b").collect()}
    assert groups == {**{k: 1 for k in range(1, 41)}, 99: 99, 100: 99}


def test_pairs_of_large_blocks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "PART", 7)
    rows = [(k, f"{'Shared' if k % 3 else 'Common'} Tool{k % 11} {'Gadget' if k % 2 else 'Widget'}", [None, "Acme"][k % 2], [None, "https://acme.com/a", f"https://host{k % 4}.acme.com/x{k}", f"https://github.com/o{k % 5}/t"][k % 4]) for k in range(1, 91)]
    r = pairs.records(spark.createDataFrame(rows, "tool_no bigint, name string, company string, website string"))
    members = {}
    for x in pairs.blocking_keys(r).collect():
        members.setdefault((x["kind"], x["key"]), set()).add(x["tool_no"])
    want = {(a, b) for m in members.values() for a in m for b in m if a < b}
    assert max(map(len, members.values())) > pairs.BROAD
    got = [tuple(x) for x in pairs.judge_blocks(r).collect()]
    assert len(got) == len(want) and {x[:2] for x in got} == want
    pairs_ = pairs.candidate_pairs(pairs.blocking_keys(r))
    assert sorted(tuple(x) for x in pairs_.collect()) == sorted(want)
    # Pairs are neither gathered nor made distinct: nothing stands above their join.
    plan = pairs_._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[: plan.index("Join")]
    every = spark.createDataFrame(sorted(want), "left_id bigint, right_id bigint")
    assert sorted(got) == sorted(tuple(x) for x in pairs.judge(every, r).collect())


def test_groups_keep_sizes_small(spark):
    chain = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = pairs.groups(chain, "a", "b")
    assert got.count() == 400 and got.where("group_id <> 1").isEmpty()
    # The size that is estimated for a result must not multiply from round to round.
    assert got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2**63


def test_quota(spark):
    rows = [(k, "abc"[k % 3] if k % 7 else None, float(k % 5)) for k in range(60)]
    df = spark.createDataFrame(rows, "id int, g string, s double")
    for target, cap in ((10, 3), (1000, 2), (0, 5)):
        want, taken, per = {}, 0, {}
        for i, g, s in sorted(rows, key=lambda r: (-r[2], r[0])):
            if taken >= target:
                want[i] = "next_batch"
            elif per.get(g, 0) >= cap:
                want[i] = "over_quota"
            else:
                want[i], taken, per[g] = "selected", taken + 1, per.get(g, 0) + 1
        assert {r["id"]: r["outcome"] for r in selection.quota(df, "id", "g", "s", target, cap).collect()} == want


def test_edges(spark):
    t = spark.createDataFrame([(1, "Acme", "Acme Inc", "acme.com", "Write", ["a", "A", None]), (2, "Acme", "Acme Inc", "acme.com", "Write", None), (3, None, None, None, None, None)], "tool_no bigint, name string, company string, website string, primary_task string, tags array<string>")
    got = sorted((r["relationship"], r["target_name"], r["confidence"]) for r in edges.relationships(t).collect())
    assert got == [("develops", "Acme", 0.95), ("solves", "Write", 0.9), ("tagged", "a", 0.8)]


HTML = """<html><head><title>Acme &amp; Co</title><meta property="og:image" content="/i.png"><script type="application/ld+json">{"@graph":[{"@type":"Product","url":"https://acme.com"}]}</script>
<style>x{}</style></head><body><h1>Hello <b>there</b></h1><ul><li>one<li>two</ul><a href="https://other.org/p" title="T">t</a><a href="/in">in</a><a href="//cdn.org/x.png">i</a><input type=password><p>Body text"""


def test_pages(spark):
    df = spark.createDataFrame([(1, HTML), (2, None), (3, "<div"), (4, "")], "id int, body string")
    got = {r["id"]: r["v"] for r in df.select("id", pages.page_view(F.col("body")).alias("v")).collect()}
    v = got[1]
    assert v["title"] == "Acme & Co" and v["metas"]["og:image"] == "/i.png" and [(h["level"], h["text"]) for h in v["headings"]] == [(1, "Hello there")] and v["has_password"]
    assert [a["label"] for a in v["anchors"]] == ["T", "in", "i"] and "Body text" in v["text"] and "x{}" not in v["text"]
    made = df.where("id = 1").select(pages.page_view(F.col("body")).alias("v")).persist()
    row = made.select(pages.jsonld_nodes(F.col("v")).alias("n"), pages.outbound(F.col("v"), F.lit("https://acme.com/")).alias("o")).first()
    assert [F"{x}" for x in row["n"]] == ['{"@type":"Product","url":"https://acme.com"}'] and row["o"] == ["https://other.org/p"]
    listing = spark.createDataFrame([("s", k, f'<a href="/p{k if k < 4 else 1}">', 200, 3) for k in range(1, 7)] + [("t", 1, None, None, 0), ("t", 2, None, None, 0), ("t", 3, "x", 200, 1), ("u", 1, "<p>Hello", 403, 0)], "source_key string, page_no int, body string, status int, cards int")
    ends = {r["source_key"]: (r["page_no"], r["stop_reason"]) for r in pages.walk(listing).where("stop_reason is not null").collect()}
    more = spark.createDataFrame([("a", k, f"b{k}", 200, 5, f"u{k if k < 3 else 1}", "n") for k in range(1, 5)] + [("b", k, f"b{k}", 200, 5, f"u{k}", "n" if k < 2 else None) for k in range(1, 4)], "source_key string, page_no int, body string, status int, cards int, url string, next_url string")
    stops = lambda **x: {r["source_key"]: (r["page_no"], r["stop_reason"]) for r in pages.walk(more, **x).where("stop_reason is not null").collect()}
    assert stops() == {"a": (3, "seen_url"), "b": (2, "no_next")} and stops(limit=5) == {"a": (1, "limit"), "b": (1, "limit")}
    assert ends == {"s": (4, "repeated_content"), "t": (2, "consecutive_failures"), "u": (1, "bot_challenge")}


def test_whole_pages(spark):
    links = "".join(f'<a href="/p{k}">' for k in range(450))
    long = ["x" * 5000 + "a", "x" * 5000 + "b", links + '<a href="/y">', links + '<a href="/z">', "x" * 9000 + " Just a moment...", "x" * 9000]
    df = spark.createDataFrame(list(enumerate(long)), "id int, body string")
    got = [tuple(r) for r in df.orderBy("id").select(pages.fingerprint(F.col("body")), pages.looks_like_challenge(F.col("body"), F.lit(200))).collect()]
    assert len({r[0] for r in got}) == 6 and [r[1] for r in got] == [False] * 4 + [True, False]
    checks = [("Forbidden", 403, True), (None, 403, True), (None, 401, True), ("x" * 200_000, 429, False), ("x", 503, False), ("Access Denied", 200, True), (None, None, False), ("_cf_chl_opt", 200, True)]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(checks)], "id int, body string, status int, want boolean")
    assert [r[0] for r in df.orderBy("id").select(pages.looks_like_challenge(F.col("body"), F.col("status"))).collect()] == [c[2] for c in checks]
    links = spark.createDataFrame([('<a href="mailto:a@b.c">m</a><a href="javascript:x()">j</a><a href="/p?x=1#y">p</a><a href="/cdn-cgi/z">z</a>',)], "body string")
    assert links.select(pages.link_paths(F.col("body")).alias("l")).first()["l"] == ["/p"]
