"""Token limits against the tokenizer, row by row."""

import random

import pytest

from pyspark.sql import functions as F

from pairforge.operators.chat import CHATML, HEADERS, INST, TURNS, ChatTemplate, placed_messages, render_prompt
from pairforge.operators.token_limit import message_spans, token_limit, tokenizer_counter

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

FILE = public.path("word_bpe_49k.json")
PLAIN = ChatTemplate(message="{role}: {content}\n", generation_cue="")
SCHEMA = "id int, messages array<struct<role:string,content:string>>"


def made():
    r = random.Random(3)
    bits = ["word", "a", "é", "😀", "naïve", "42", ".", "  ", "\n", "Übung", "<|im_end|>", "日本", "é"]

    def text(n):
        return " ".join(r.choice(bits) for _ in range(n))

    rows = [[("system", text(3)), ("user", text(r.randrange(0, 60))), ("assistant", text(r.randrange(0, 60)))] for _ in range(60)]
    return [*enumerate([*rows, [("user", None), (None, "x")], [], None, [("user", "")], [("user", text(5000))]])]


def test_spans_of_other_templates(spark):
    """Every content stands where the spans say."""
    df = spark.createDataFrame([r for r in made() if r[1] is not None], SCHEMA)
    for t in (CHATML, HEADERS, TURNS, INST):
        cols = [render_prompt(F.col("messages"), t, False).alias("text"), message_spans(F.col("messages"), t).alias("spans"), placed_messages(F.col("messages"), t).alias("placed")]
        for r in df.select(*cols).collect():
            want = [(m["content"] or "").strip() if t.trim else m["content"] or "" for m in r["placed"]]
            assert [r["text"][s["start"] : s["end"]] for s in r["spans"]] == want


@pytest.mark.parametrize("template", [CHATML, PLAIN])
@pytest.mark.parametrize("limit", [1, 40, 10_000_000])
def test_cut_and_losses(spark, template, limit):
    tok = tokenizers.Tokenizer.from_file(FILE)
    rows = made()
    got = {r["id"]: r for r in token_limit(spark.createDataFrame(rows, SCHEMA).repartition(3), FILE, limit, template=template).collect()}
    assert len(got) == len(rows)
    for i, messages in rows:
        parts, text = [], ""
        for role, content in messages or []:
            head, tail = template.message.replace("{role}", role or "").split("{content}")
            parts.append((role, len(text) + len(head), len(text) + len(head) + len(content or "")))
            text += head + (content or "") + tail
        enc = tok.encode(text, add_special_tokens=False)
        cut = max(e for _, e in enc.offsets[:limit]) if len(enc.ids) > limit else None
        r = got[i]
        assert (r["n_tokens"], r["lost_tokens"], r["cut"]) == (len(enc.ids), max(0, len(enc.ids) - limit), cut)
        if messages is not None:
            assert r["kept"] == (text if cut is None else text[:cut])
            assert [tuple(x) for x in r["lost"]] == [(role, e - s, 0 if cut is None else max(0, e - max(s, cut))) for role, s, e in parts]


def test_counter_equals_the_tokenizer(spark):
    tok = tokenizers.Tokenizer.from_file(FILE)
    rows = [r for r in made() if r[1] is not None]
    count = tokenizer_counter(FILE, PLAIN)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["id"]: r["n"] for r in df.select("id", count(df["messages"]).alias("n")).collect()}
    assert got == {i: len(tok.encode("".join(f"{a or ''}: {b or ''}\n" for a, b in m)).ids) for i, m in rows}


def test_query_equals_the_tokenizer(spark):
    from pairforge.plans.queries import q_token_limit
    from pairforge.operators.chat import SYSTEM_PROMPT
    from tests.conftest import SF_SMALL

    tok = tokenizers.Tokenizer.from_file(FILE)
    got = {r["doc_id"]: r for r in q_token_limit(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and any(r["cut"] is not None for r in got.values())
    for d in docs:
        text = f"<|im_start|>system\n{SYSTEM_PROMPT}<|im_end|>\n<|im_start|>user\n{d['text']}<|im_end|>\n"
        enc = tok.encode(text, add_special_tokens=False)
        r, over = got[d["doc_id"]], len(enc.ids) > 1536
        cut = max(e for _, e in enc.offsets[:1536]) if over else None
        assert (r["n_tokens"], r["lost_tokens"], r["cut"]) == (len(enc.ids), max(0, len(enc.ids) - 1536), cut)
        end = len(text) - len("<|im_end|>\n")
        assert r["lost_user_chars"] == (max(0, end - max(cut, end - len(d["text"]))) if over else 0)
