from lodestone.llm import contamination as C

ITEM = "Use only the information given in the passage below. The older registries borrowed some keys, yet the toll keeper doubted what the brittle appendix meant near the quay. Among the curators only a tentative docket outlived silent footnotes under protest."
SHORT = "The older registries borrowed some keys, yet the toll keeper"


def test_alignment():
    s = "a quick brown fox jumps over the lazy dog".split()
    assert C.align(s, s)[0] == 9
    assert C.align(s, "x a quick brown fx jumps over indeed the lazy dog y".split())[0] == 8
    assert C.align(["tentative"], ["tentatve"])[0] == 1 and C.align(s, [])[0] == 0
    assert [len(x) for x in C.sentences(ITEM)] == [19, 12]


def test_leaks(spark):
    second = "among the CURATORS - only a tentat​ive dоcket outlived <b>silent</b> footnotes, under protest"
    rows = [
        (1, "Intro. " + ITEM), (2, "Some filler words here. " + second + " and more text"), (3, "Nothing of that."), (4, SHORT), (5, None), (6, ""),
        (7, "so the older registries indeed borrowed some other keys yet the toll keeper doubted what the brittle appendix rather meant near the quay today"),
        (8, "Use only the information given in the passage below."), (9, "the older assessors mirrored folded maps yet the mapmaker claimed what the crimson estuary meant near the quay"), (1, "Intro. " + ITEM),
        (10, "word " * 30_000 + second),
    ]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], "doc_id bigint, text string, term string, sentence int")
    items = spark.createDataFrame([(70, "s", ITEM), (71, "s", None), (None, "s", ITEM)], "item_id bigint, suite string, text string")
    assert {tuple(r) for r in C.leaks(docs, items).collect()} == {(1, 70), (2, 70), (7, 70), (10, 70)}
    assert C.leaks(docs.where("false"), items).count() == 0
    assert C.leaks(docs, items.where("false")).count() == 0


def test_long_sentence(spark):
    ws = [f"term{chr(97 + k % 26)}{k}" for k in range(130)]
    changed = [w if k % 6 else f"other{k}" for k, w in enumerate(ws)]
    docs = spark.createDataFrame([(1, "Start. " + " ".join(ws) + "."), (2, " ".join(changed)), (3, " ".join(ws[:60])), (4, " ".join(reversed(ws)))], "doc_id bigint, text string")
    items = spark.createDataFrame([(70, " ".join(ws) + ".")], "item_id bigint, text string")
    assert {tuple(r) for r in C.leaks(docs, items).collect()} == {(1, 70), (2, 70)}
