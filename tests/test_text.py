
from pairforge.functions import text as T

EDGE = " \t \u001f x　y  \n"


def one(spark, expr, value, schema="c string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_ws_set_is_pythons():
    assert len(T.WS_CODEPOINTS) == 29
    assert all(chr(c).isspace() for c in T.WS_CODEPOINTS)
    assert not any(chr(c).isspace() for c in range(0x3001, 0x110000))


def test_strip_matches_python(spark):
    assert one(spark, T.py_strip("c"), EDGE) == EDGE.strip() == "x　y"


def test_word_count(spark):
    assert one(spark, T.word_count("c"), "") == 0
    assert one(spark, T.word_count("c"), EDGE) == len(EDGE.split()) == 2
    assert one(spark, T.word_count("c"), None) is None


def test_truncate_counts_code_points(spark):
    s = "a\U0001F600é"
    assert one(spark, T.truncate("c", 2), s) == s[:2]
    assert one(spark, T.truncate("c", None), s) == s
    assert one(spark, T.truncate("c", 0), s) == s


def test_squeeze_and_blank(spark):
    assert one(spark, T.squeeze_ws("c"), EDGE + " a b ") == " ".join((EDGE + " a b ").split())
    assert one(spark, T.is_blank("c"), None) is True
    assert one(spark, T.is_blank("c"), " 　\n") is True
    assert one(spark, T.is_blank("c"), " a ") is False


def test_py_repr(spark):
    for s in ["user", "it's", 'say "x"', "a'b\"c", "back\\slash"]:
        assert one(spark, T.py_str_repr("c"), s) == repr(s)


def test_preview(spark):
    s = "x" * 250
    assert one(spark, T.preview("c"), s) == s[:200] + "..."
