"""Randomised check of the Python-equivalent text functions against Python."""

import random


from pairforge.functions import text as T


def _strings(n=600, seed=11):
    rnd = random.Random(seed)
    ws = [chr(c) for c in T.WS_CODEPOINTS]
    other = list("abcXYZ09.,;'\"\\") + ["é", "ß", "​", "﻿", "\U0001F600", "\u0000", "­", "中"]
    out = ["", " ", "　", "a"]
    for _ in range(n):
        k = rnd.randint(0, 30)
        out.append("".join(rnd.choice(ws if rnd.random() < 0.35 else other) for _ in range(k)))
    return out


def test_strip_split_truncate_match_python(spark):
    data = _strings()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(data)], "i int, s string")
    got = df.select(
        "i",
        T.py_strip("s").alias("strip"),
        T.word_count("s").alias("words"),
        T.squeeze_ws("s").alias("squeeze"),
        T.truncate("s", 7).alias("cut"),
        T.char_length("s").alias("n"),
        T.non_ws_chars("s").alias("nws"),
        T.is_blank("s").alias("blank"),
    ).collect()
    for r in got:
        s = data[r["i"]]
        assert r["strip"] == s.strip(), repr(s)
        assert r["words"] == len(s.split()), repr(s)
        assert r["squeeze"] == " ".join(s.split()), repr(s)
        assert r["cut"] == s[:7], repr(s)
        assert r["n"] == len(s), repr(s)
        assert r["nws"] == sum(not ch.isspace() for ch in s), repr(s)
        assert r["blank"] == (s.strip() == ""), repr(s)
