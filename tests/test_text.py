import hashlib
import random
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from lodestone.functions import text



def column(spark, values, make, kind="string"):
    rows = [(k, v) for k, v in enumerate(values)]
    out = spark.createDataFrame(rows, f"k int, v {kind}").select("k", make(F.col("v")).alias("o")).orderBy("k").collect()
    return [r["o"] for r in out]


def test_clean_text(spark):
    values = [None, "", "  a \t b\r\n\r\n\r\n\r\nc ", "<p>x &amp; y</p><script>z</script>w", "N/A", " - ", "ｆｕｌｌ", "a ​b", "x" * 40_000]
    assert column(spark, values, text.clean_text) == [None, None, "a b\n\nc", "x & y\nw", None, None, "full", "a b", "x" * 40_000]


def test_truncate(spark):
    values = ["short", "one two three four", "abcdefghijklmnop", "one, two three", None]
    assert column(spark, values, lambda c: text.truncate(c, 12)) == ["short", "one two…", "abcdefghijk…", "one, two…", None]


def test_slug_and_names(spark):
    assert column(spark, ["Héllo, Wörld!", "™", "???", None, "Дом"], text.slugify) == ["hello-world", "tm", None, None, None]
    values = ["Open AI", "OpenAI", "OpenAI Inc.", "Jasper AI - Writing Assistant", "AI", "The Lab", "", None, "Zoë | x"]
    assert column(spark, values, text.canonical_name) == ["open", "openai", "openai", "jasper", "ai", "thelab", None, None, "zoe"]
    assert column(spark, ["Jasper AI Writer Writer", None], lambda c: F.array_sort(text.name_tokens(c))) == [["jasper", "writer"], []]


def test_ratios(spark):
    rows = [("jasper", "jaspr"), ("a", "a"), (None, "a"), ("abcd", "wxyz")]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", text.sequence_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r["r"] for r in got] == [0.0 if None in p else 1.0 if p[0] == p[1] else SequenceMatcher(None, *p).ratio() for p in rows]
    one = spark.range(1).select(text.token_ratio(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))).alias("x"), text.token_ratio(F.array().cast("array<string>"), F.array(F.lit("c"))).alias("y")).first()
    assert (round(one["x"], 6), one["y"]) == (0.333333, 0.0)


def test_codes_lists_and_hash(spark):
    assert column(spark, [" Yes", "unsupported", "maybe", None], text.tri_state) == [True, False, None, None]
    assert column(spark, [[" A ", "a", "n/a", None, "b  c", ""], None, []], text.clean_list, "array<string>") == [["A", "b c"], [], []]
    assert column(spark, ["x", None], lambda c: text.content_hash(c, F.lit("y"))) == [hashlib.sha256(f"{v}\x1fy\x1f".encode()).hexdigest()[:16] for v in ("x", None)]
    assert column(spark, ["One. Two! Three?", "x"], text.sentences) == [["One.", "Two!", "Three?"], ["x"]]
    assert column(spark, ["Strong-Tier A"], text.code_word) == ["strong_tier_a"]


def test_similarities():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["ab", "abc", "aé", "abcdefgh"][rng.randrange(4)]) for _ in range(rng.choice([0, 1, 3, 9, 20, 130, 210])))
    rows = [(word(), word()) for _ in range(3000)] + [(None, "a"), ("a", None), ("", ""), ("a", "")]
    n = len(rows)
    got = text.Similarity([a for a, _ in rows] + [b for _, b in rows])(np.arange(n), np.arange(n, 2 * n))
    assert got.tolist() == [0.0 if a is None or b is None else SequenceMatcher(None, a, b).ratio() for a, b in rows]
    assert text.Similarity([])(np.arange(0), np.arange(0)).tolist() == []


def test_similarity_of_many():
    import tracemalloc

    rng = random.Random(3)
    said = ["".join(rng.choice("ab c") for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["ab" * 63 + "a", "ba" * 63 + "b", "", "é a", None]
    x, y = (a.ravel() for a in np.indices((len(said), len(said))))
    got = text.Similarity(said)(x, y)
    assert got.tolist() == [0.0 if said[i] is None or said[j] is None else SequenceMatcher(None, said[i], said[j]).ratio() for i, j in zip(x, y)]
    # Runs are kept in two bytes: 4,096 pairs of 100 letters took 10.4 MB with four.
    many = text.Similarity(["ab" * 50, "ba" * 50])
    tracemalloc.start()
    many(np.zeros(4096, int), np.ones(4096, int))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 9_500_000
