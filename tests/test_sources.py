import json
import subprocess

import pytest
from pyspark.sql import functions as F

from lodestone.functions import urls
from lodestone.sources import jsonl, registry, robots
from lodestone.streaming import intake


def test_lines(spark, tmp_path):
    good = {"name": "A", "source_key": "s", "website": "a.com", "categories": ["x"], "discovered_at": "2026-01-02T03:04:05Z"}
    lines = [json.dumps(good), "", "[1, 2]", "{broken", '"text"', json.dumps({"name": " "}), json.dumps({"name": "B"}), json.dumps({"name": "C", "listing_url": "d.com/c", "discovered_at": "never"})]
    (tmp_path / "mysource.jsonl").write_text("\n".join(lines))
    got = {r["line_no"]: r for r in jsonl.classify(jsonl.read_lines(spark, str(tmp_path / "mysource.jsonl"))).collect()}
    assert [got[k]["skip_reason"] for k in sorted(got)] == [None, "not_a_mapping", "malformed", "not_a_mapping", "no_name", "no_pointer", None]
    last = got[max(got)]
    assert last["source_key"] == "mysource" and last["discovered_at"] is None
    assert jsonl.load_candidates(spark, str(tmp_path), ["s"]).count() == 1
    report = jsonl.load_report(jsonl.classify(jsonl.read_lines(spark, str(tmp_path)))).first()
    assert (report["rows"], report["kept"], report["repaired"], report["skipped"]["malformed"]) == (7, 2, 1, 1)
    assert jsonl.read_lines(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_signal(spark):
    values = ['{"u": 12}', '{"u": "4.3k"}', '{"u": "many"}', "{}", None, "[]"]
    got = spark.createDataFrame([(v,) for v in values], "v string").select(jsonl.signal(F.col("v"), "u").alias("s")).collect()
    assert [r["s"] for r in got] == [12, 4300, None, None, None, None]


def test_registry(spark, tmp_path):
    f = tmp_path / "s.yaml"
    f.write_text("defaults: {tier: 2, roles: [discovery]}\nsources:\n- {key: b, name: B, color: red}\n- {key: a, name: A, tier: 1, enabled: false}\n- text\n- {key: c, name: C, roles: [pricing]}\n")
    r = registry.load_yaml(spark, str(f))
    assert [x["source_key"] for x in registry.active(r, "discovery").collect()] == ["b"]
    assert r.where("source_key = 'b'").first()["extra"] == {"color": "red"}
    f.write_text("sources:\n- {key: a, name: A}\n- {key: a, name: B}\n")
    with pytest.raises(ValueError):
        registry.load_yaml(spark, str(f))


def test_robots(spark):
    body = "# hi\nUser-agent: *\nDisallow: /private\n\nAllow: /private/open\nDisallow:\nUser-agent: bot\nUser-agent: other\nDisallow: /*.pdf$\nAllow: /\n"
    table = robots.rules(spark.createDataFrame([("https://x.com", body), ("https://y.com", None)], "origin string, body string"))
    paths = ["/private/x", "/private/open/1", "/a.pdf", "/a.pdf?x", ""]
    a = spark.createDataFrame([(f"https://x.com{p}", "https://x.com") for p in paths] + [("https://y.com/z", "https://y.com")], "url string, origin string")
    ask = lambda agent: {r["url"]: r["allowed"] for r in robots.can_fetch(a, table, agent).collect()}
    assert list(ask("crawler/1.0")[f"https://x.com{p}"] for p in paths) == [False, True, True, True, True]
    assert list(ask("Bot/2")[f"https://x.com{p}"] for p in paths) == [True, True, False, True, True]
    assert ask("Bot")["https://y.com/z"]


def test_intake(spark, tmp_path):
    folder, table, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    key = urls.candidate_key(F.col("name"), F.col("website"), F.col("listing_url"))
    (folder / "a.jsonl").write_text("\n".join(json.dumps({"name": n, "website": w}) for n, w in (("A", "a.com"), ("A2", "www.a.com"), ("B", "b.com"))) + "\n{bad\n")
    intake.keep_new(spark, str(folder), table, state, key).awaitTermination()
    (folder / "b.jsonl").write_text("\n".join(json.dumps({"name": n, "website": w}) for n, w in (("A", "a.com"), ("C", "c.com"))))
    intake.keep_new(spark, str(folder), table, state, key).awaitTermination()
    assert sorted(r["key"] for r in spark.read.parquet(table).collect()) == ["domain:a.com", "domain:b.com", "domain:c.com"]


def test_core_stands_alone():
    code = "import importlib.util as u; real = u.find_spec; u.find_spec = lambda n, *a: None if n == 'lodestone.llm' else real(n, *a)\nimport __spark_entry__ as e; assert e.queries() and not any(k.startswith('p1_') for k in e.queries())"
    root = __file__.rsplit("/", 2)[0]
    subprocess.run(["python", "-c", code], cwd=root, check=True)
    found = subprocess.run(["grep", "-rl", "lodestone.llm", f"{root}/lodestone", "--include=*.py"], capture_output=True, text=True).stdout.split()
    assert all("/llm/" in f for f in found)
