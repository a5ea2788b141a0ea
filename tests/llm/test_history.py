import os
import random

from lodestone.llm import history

REC = "prep_id bigint, batch_no int, website string, listing_url string, identity_key string, identity_basis string, name string, page string, key int"
CONF = "source_key string, name string, homepage string, listing_url string"


def rec(spark, rows):
    return spark.createDataFrame([(*r, "x", "p", 1) for r in rows], REC)


def conf(spark):
    return spark.createDataFrame([("d", "Dir", "https://dir.test/", "https://dir.test/tool/")], CONF)


def test_spellings_and_chains(spark):
    rows = [
        (1, 0, "https://www.A.test/app/", None, None, None), (2, 0, None, "https://dir.test/tool/b", "name b", "name"), (3, 0, "https://a.test", None, None, None),
        (4, 1, "HTTP://a.test:80/app/index.html?utm_source=x#top", None, None, None), (5, 1, "https://c.test/", "//dir.test/tool/b?ref=1", None, None), (6, 1, "https://c.test", None, None, None),
        (7, 2, "https://dir.test/", None, "name b", "name"), (8, 2, "mailto:a@a.test", "n/a", "c.test", "website_domain"), (9, 2, "https://a.test/app?product=x", None, None, None), (10, 2, "https://a.test/app#/route", None, None, None),
        (11, 3, "https://a.test/app?product=x", None, None, None), (12, 3, None, None, None, None), (12, 3, None, None, None, None), (13, None, "https://z.test", None, None, None), (None, 3, "https://a.test", None, None, None),
    ]
    got = {tuple(r) for r in history.repeats(rec(spark, rows), conf(spark)).collect()}
    assert got == {(1, 4), (2, 5), (2, 6), (2, 8), (9, 11)}


def brute(rows):
    """(first, id) of the rows of later batches with a page of an earlier row, by union-find over all rows."""
    pages = {r[0]: {x.replace("https://", "") for x in (r[2], r[3]) if x} for r in rows}
    root = {k: k for k in pages}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    least = {}
    for k in sorted(pages):
        for p in pages[k]:
            a, b = find(least.setdefault(p, k)), find(k)
            root[max(a, b)] = min(a, b)
    return {(find(r[0]), r[0]) for r in rows if r[1] and any(least[p] < r[0] for p in pages[r[0]])}


def test_brute_force(spark):
    rng = random.Random(7)
    rows = [(k, min(2, k // 40), f"https://s{rng.randint(1, 60)}.test/p", rng.choice([None, f"https://dir.test/tool/{rng.randint(1, 60)}"]), None, None) for k in range(1, 110)]
    assert {tuple(r) for r in history.repeats(rec(spark, rows), conf(spark)).collect()} == brute(rows)


def test_a_stored_index_grows(spark, tmp_path):
    page = lambda x: x and f"https://{x}.test/p"
    rows = [(i, b, page(x), page(y), None, None) for i, b, x, y in [(1, 0, "a", None), (5, 0, "b", "c"), (10, 1, "a", "b"), (20, 2, "c", None), (30, 3, "z", None), (40, 3, "z", "c")]]
    path = str(tmp_path / "index")
    first = history.repeats(rec(spark, rows[:3]), conf(spark), path=path)
    assert {tuple(r) for r in first.collect()} == {(1, 10)}
    files = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{path}/keys") for f in fs}
    assert files
    store = history.History(spark, path)
    assert store.done() == [0, 1] and store.last_batch() == 1 and store.buckets == 16
    [(number, fresh, is_history)] = history._increments(rec(spark, rows), store, 0)
    assert (number, is_history) == (2, False) and sorted(r["prep_id"] for r in fresh.collect()) == [20, 30, 40]
    again = history.repeats(rec(spark, rows[3:]), conf(spark), path=path)
    assert {tuple(r) for r in again.collect()} == {(1, 20), (1, 40)}
    now = {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{path}/keys") for f in fs}
    assert all(now[f] == t for f, t in files.items()) and len(now) > len(files)
    assert history.repeats(rec(spark, rows), conf(spark), path=path).count() == 0


def test_near(spark):
    rng = random.Random(3)
    vocabulary = [f"word{k}" for k in range(200)]
    base = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(12)]

    def changed(text, n):
        w = text.split()
        for k in rng.sample(range(len(w)), n):
            w[k] = rng.choice(vocabulary)
        return " ".join(w)

    texts = [(k, k % 3, changed(base[k % 12], rng.choice([0, 0, 1, 1, 2, 9])).upper() + rng.choice(["", "!", "  "])) for k in range(1, 150)] + [(200, 1, None), (201, 2, " "), (202, 1, "short one"), (203, 2, "Short, one.")]
    df = spark.createDataFrame([(i, b, t, "n") for i, b, t in texts], "prep_id bigint, batch_no int, observed_description string, name string")
    plain = {i: " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split()) for i, _, t in texts}
    sets = {i: set(history.pieces(t, True)) for i, t in plain.items() if t}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = {(i, find(i)) for i, b, _ in texts if b and i in sets and (find(i) < i)}
    got = {(r["prep_id"], r["class_id"]) for r in history.near_repeats(df).collect()}
    assert want <= got and all(find(i) == c for i, c in got)
    assert history.near_repeats(df.where("false")).count() == 0


def test_bridges(spark):
    page = lambda x: x and f"https://{x}.test/p"
    rows = [(1, 0, "a", None), (5, 0, "b", "c"), (7, 0, "d", "e"), (20, 1, "a", "b"), (30, 2, "c", None), (40, 3, "b", "d"), (50, 4, "e", None)]
    got = {tuple(r) for r in history.repeats(rec(spark, [(i, b, page(x), page(y), None, None) for i, b, x, y in rows]), conf(spark)).collect()}
    assert got == {(1, 20), (1, 30), (1, 40), (1, 50)}


def test_empty(spark):
    assert history.repeats(rec(spark, []), conf(spark)).count() == 0
