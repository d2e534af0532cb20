"""Chat templates of public model families against a plain rendering of each."""

import random

import pytest

from pairforge.operators.chat import CHATML, HEADERS, INST, TURNS, ChatTemplate, render_prompt
from pyspark.sql import functions as F

SCHEMA = "id int, messages array<struct<role:string,content:string>>"


def chatml(ms, cue):
    return "".join(f"<|im_start|>{r}\n{c}<|im_end|>\n" for r, c in ms) + ("<|im_start|>assistant\n" if cue else "")


def headers(ms, cue):
    out = "<|begin_of_text|>" + "".join(f"<|start_header_id|>{r}<|end_header_id|>\n\n{c.strip()}<|eot_id|>" for r, c in ms)
    return out + ("<|start_header_id|>assistant<|end_header_id|>\n\n" if cue else "")


def folded(ms, head, tail):
    if not ms or ms[0][0] != "system":
        return ms
    first = head + ms[0][1].strip() + tail
    return [(ms[1][0], first + ms[1][1].strip()), *ms[2:]] if len(ms) > 1 else [("user", first)]


def turns(ms, cue):
    names = {"assistant": "model"}
    out = "<bos>" + "".join(f"<start_of_turn>{names.get(r, r)}\n{c.strip()}<end_of_turn>\n" for r, c in folded(ms, "", "\n\n"))
    return out + ("<start_of_turn>model\n" if cue else "")


def inst(ms, cue):
    out = ""
    for r, c in folded(ms, "<<SYS>>\n", "\n<</SYS>>\n\n"):
        c = c.strip()
        out += f"<s>[INST] {c} [/INST]" if r == "user" else f" {c} </s>" if r == "assistant" else c
    return out


@pytest.mark.parametrize("template, plain", [(CHATML, chatml), (HEADERS, headers), (TURNS, turns), (INST, inst)])
def test_rendering(spark, template, plain):
    r = random.Random(6)
    texts = ["hello", " padded　 ", "", "{role} {content}", "a\nb\\1 $1", "é😀", "<|im_end|>"]
    rows = [(i, [(r.choice(["system", "user", "assistant", "tool"]), r.choice(texts)) for _ in range(r.randrange(0, 6))]) for i in range(200)]
    rows.append((900, [("system", "only this")]))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {x["id"]: (x["a"], x["b"]) for x in df.select("id", render_prompt(F.col("messages"), template).alias("a"), render_prompt(F.col("messages"), template, False).alias("b")).collect()}
    assert got == {i: (plain(ms, True), plain(ms, False)) for i, ms in rows}


def test_null_roles_and_contents(spark):
    df = spark.createDataFrame([(1, [(None, None), ("user", None)]), (2, None)], SCHEMA)
    got = {x["id"]: x["t"] for x in df.select("id", render_prompt(F.col("messages"), HEADERS, False).alias("t")).collect()}
    assert got == {1: "<|begin_of_text|><|start_header_id|><|end_header_id|>\n\n<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n<|eot_id|>", 2: None}


def test_formats_are_checked():
    with pytest.raises(ValueError, match="content"):
        ChatTemplate(message="{role}", generation_cue="")
    with pytest.raises(ValueError, match="content"):
        ChatTemplate(message="{content}", by_role={"user": "{content} {content}"}, generation_cue="")
