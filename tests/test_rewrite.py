import pandas as pd

from pairforge.operators.rewrite import EMPTY_NOTICE, SENTENCE_LINES, SQUEEZE, batch_rewrite, compare_rewrites, guard_input, sentence_lines_factory, squeeze_factory


def docs(spark):
    return spark.createDataFrame(
        [(1, None), (2, " \n　"), (3, "Hello   world.  Second   one! Done"), (4, "x")], "doc_id long, text string"
    )


def test_guard(spark):
    out = {r["doc_id"]: r for r in guard_input(docs(spark)).collect()}
    for k in (1, 2):
        assert (out[k]["needs_rewrite"], out[k]["before"], out[k]["after"]) == (False, "", EMPTY_NOTICE)
    assert out[3]["before"] is None and out[3]["needs_rewrite"]


def test_compare_rewrites(spark):
    out = {r["doc_id"]: r for r in compare_rewrites(docs(spark), squeeze_factory, sentence_lines_factory).collect()}
    assert out[3]["before"] == "Hello world. Second one! Done"
    assert out[3]["after"] == "Hello world.\nSecond one!\nDone"
    assert out[2]["after"] == EMPTY_NOTICE
    assert len(out) == 4


def test_pluggable_rewriter(spark):
    # defined inside the test so that it is shipped to the workers by value
    def upper_factory():
        def run(s: pd.Series) -> pd.Series:
            return s.str.upper()

        return run

    out = {r["doc_id"]: r["rewrite"] for r in batch_rewrite(docs(spark), upper_factory).collect()}
    assert out == {3: "HELLO   WORLD.  SECOND   ONE! DONE", 4: "X"}


def test_rules_equal_their_factories(spark):
    import random

    r = random.Random(9)
    bits = ["a", "B.", "c! ", "\u3000", " ", "\n", "\x1f", "3.5", "?", "\\1 $1", "é"]
    df = spark.createDataFrame([(i, "".join(r.choice(bits) for _ in range(r.randrange(0, 30)))) for i in range(300)], "doc_id long, text string")
    pairs = [(SQUEEZE, SENTENCE_LINES), (squeeze_factory, sentence_lines_factory), (SQUEEZE, sentence_lines_factory), (squeeze_factory, SENTENCE_LINES)]
    got = [sorted(map(tuple, compare_rewrites(df, *p).collect())) for p in pairs]
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) == 300
    assert sorted(map(tuple, batch_rewrite(df, SQUEEZE).collect())) == sorted(map(tuple, batch_rewrite(df, squeeze_factory).collect()))
    assert "Python" not in compare_rewrites(df, *pairs[0])._jdf.queryExecution().executedPlan().toString()
