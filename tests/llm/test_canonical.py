import random

from lodestone.llm import canonical
from lodestone.llm.canonical import Canon, Trie


def osa(a, b):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_equals_brute_force():
    rng = random.Random(1)
    for _ in range(600):
        words = ["".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(6)]
        trie, q = Trie(list(zip(words, range(6)))), "".join(rng.choices("abc", k=rng.randint(1, 7)))
        for k in range(4):
            assert trie.within(q, k) == {i: osa(w, q) for i, w in enumerate(words) if osa(w, q) <= k}


def test_paths():
    c = Canon([(1, "Writing and Editing", "Tools for copywriting; text drafting.", ("ghostwriting",)), (2, "Video Production", "Tools for clip maker; film editing.", ()), (3, "free", "Also said: no cost; gratis.", ("$0",)), (4, "one_time", None, ()), (5, "Three-Dimensional Modeling", None, ())])
    for v in ("WRITING & EDITING", "Editing + Writing", "Writ. and Edit.", "ai-powered Writing and Editing & more", "copywritng", "#Writing_and_Editing 🚀", "text ddrafting", "Ghost-writing"):
        assert c.find(v) == 1, v
    for v, want in (("clip maker", 2), ("$0", 3), ("freé", 3), ("one time", 4), ("ONE-TIME", 4), ("Thre. Mode.", 5), ("gardening", 0), ("???", 0), ("", 0), ("2024", 0), ("frog", 0), ("z" * 30_000, 0)):
        assert c.find(v) == want, v
    assert c.all_within("Vdeo Productoin") == {2: 2} and c.all_within("film editing") == {2: 0} and c.all_within("") == {}


def test_rows(spark):
    raw = spark.createDataFrame([(1, ["Legal Work", "legl work", None, " ", "x"], "c"), (2, None, "c"), (2, [], "c")], "row_id bigint, categories array<string>, value string")
    tools = spark.createDataFrame([(9, "legal", ("free ",), 1), (10, None, None, 1)], "tool_no bigint, primary_task string, pricing struct<model:string>, pos int")
    canon = spark.createDataFrame([(1, "categories", "Legal Work", "Tools for law."), (2, "pricing_model", "free", None), (3, "categories", None, None)], "canonical_id int, field_name string, label string, gloss string")
    got = {tuple(r) for r in canonical.canonical_values(raw, tools, canon).collect()}
    assert got == {("categories", 1, 1, 1), ("categories", 1, 4, 0), ("primary_task", 9, 0, 0), ("pricing_model", 9, 0, 2)}
    every = {tuple(r) for r in canonical.canonical_values(raw, tools, canon, every=True).collect()}
    assert every == {("categories", 1, 1, 1, 1), ("pricing_model", 9, 0, 2, 0)}
    more = spark.createDataFrame([("categories", "Legal Work", "x"), ("categories", "Legal Work", None)], "field_name string, label string, alias string")
    assert ("categories", 1, 4, 1) in {tuple(r) for r in canonical.canonical_values(raw, tools, canon, more).collect()}
    assert canonical.canonical_values(raw.where("false"), tools.where("false"), canon.where("false")).count() == 0
