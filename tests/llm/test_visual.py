from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import visual
from lodestone.llm.visual import transducer


def test_forms():
    f = transducer()
    assert f("ｃａｆé") == f("café") == "café"
    assert f("a​b­ c d") == "ab c d"
    assert f("pаypаl") == "paypal" and f("Ηello") == "Hello"
    assert f("ofﬁce") == "office"
    assert f("é") != f("e")
    assert f("line \r\nnext\t") == "line\nnext"
    assert f("👩‍💻") != f("👩💻")
    assert f("") == ""
    assert f("ｶﾞ") == f("ガ") == "ガ" and f("각") == "각" and f("itꞌs") == "it's" and f("a\U000e0100b") == "ab"
    assert f("end \u200b\u00a0\nx\u00a0") == "end\nx"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aеé́̈о ｏ​ﬁﬀ \n\rЖx͏"), max_size=14))
def test_one_pass_is_enough(text):
    f = transducer()
    assert f(f(text)) == f(text)


def test_pairs_equal_brute_force(spark):
    texts = ["hello", "hеllo", "hello", "he​llo", "héllo", "héllo", "Hello", "", "​", None, "x" * 50_000, "ｘ" + "x" * 49_999]
    rows = [(k, t, "f", 1) for k, t in enumerate(texts)] + [(0, "hello", "f", 1), (None, "hello", "f", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, f string, t int")
    form = transducer()
    want = {(a, b) for (a, x), (b, y) in combinations(list(enumerate(texts)), 2) if x is not None and y is not None and x != y and form(x) == form(y)}
    assert {tuple(r) for r in visual.look_alike_pairs(df).collect()} == want
    assert visual.forms(df).where("doc_id = 1").first()["form"] == "hello"
    assert visual.look_alike_pairs(df.where("false")).count() == 0
