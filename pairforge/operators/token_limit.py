"""Token counts with the model's own tokenizer, and where its limit cuts a record.

The tokenizer file is a parameter; each task loads it once and encodes Arrow
batches (iterator pandas UDFs). ``token_limit`` keeps the first ``limit`` tokens of
a rendered conversation, as a trainer with a fixed sequence length does, and says
what each message loses. Where the file says that the tokenizer cuts texts into words
by a rule known here, each word is encoded once and looked up after that (a bounded
number of words a task); other tokenizers, and texts beyond the rule, get whole texts.

Offsets are code points of the rendered text, as Spark's ``length`` and ``left``
count them. A null record counts as empty. Texts are encoded whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from pairforge.operators.chat import CHATML, ChatTemplate, placed_messages, render_prompt, template_parts

ENCODED_AT_ONCE = 32  # texts; their offsets take some 100 bytes a token


MOST_WORDS = 300_000  # words a task remembers: some 40 MB
TEXTS_AT_ONCE = 256
JOINED = 32  # new words encoded in one string

# The known rule: letters, single digits and runs of others of the NFC text in lower
# case, white space dropped. For texts of the characters in PLAIN, NFC changes nothing
# and lower case keeps places, so WORDS finds the same words.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-įı-ſ]*")
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ſ]+|[0-9]|[^\\sa-z0-9À-ÖØ-öø-ſ]+")


def _encodings(tok, texts: list[str], special: bool) -> Iterator:
    for i in range(0, len(texts), ENCODED_AT_ONCE):
        yield from tok.encode_batch(texts[i : i + ENCODED_AT_ONCE], add_special_tokens=special)


def _loaded(tokenizer_file: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


class _Numbers(dict):
    """Numbers new words as they are looked up."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        self.new.append(word)
        return i


class WordTokens:
    """(tokens, cut) of texts by the words they are cut into (``cut``: code points
    that the first ``limit`` tokens reach, None if there are no more)."""

    def __init__(self, tok, added: list[str]):
        self.tok, self.added = tok, added
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.tokens = _Numbers(), np.zeros(0, np.int64)

    @staticmethod
    def of(tok) -> WordTokens | None:
        """None for a tokenizer whose rule is not the known one."""
        rule = json.loads(tok.to_str())
        bytes_ = rule.get("pre_tokenizer") or {}
        steps = bytes_.get("pretokenizers") or [{}]
        known = (
            (rule.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
            and steps[0] == _SPLIT
            and [s.get("type") for s in steps[1:]] == ["ByteLevel"]
            and not steps[1].get("add_prefix_space")
            and not steps[1].get("use_regex")
            and not any(rule.get(k) for k in ("truncation", "padding", "post_processor"))
            and not rule["model"].get("dropout")
            and not any(a["normalized"] for a in rule["added_tokens"])
        )
        return WordTokens(tok, [a["content"] for a in rule["added_tokens"]]) if known else None

    def takes(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(a in text for a in self.added)

    def _learn(self) -> None:
        new = self.numbers.new
        got = self.tok.encode_batch([" ".join(new[i : i + JOINED]) for i in range(0, len(new), JOINED)], add_special_tokens=False)
        word = [w + k * JOINED for k, e in enumerate(got) for w in e.word_ids]
        self.tokens = np.concatenate([self.tokens, np.bincount(np.array(word, np.int64), minlength=len(new))])
        new.clear()

    def counted(self, texts: list[str], limit: int | None) -> Iterator[tuple[int, int | None]]:
        if len(self.numbers) > MOST_WORDS:
            self._forget()
        lower = [t.lower() for t in texts]
        found = [np.fromiter(map(self.numbers.__getitem__, w), np.int64, len(w)) for w in map(WORDS.findall, lower)]
        if self.numbers.new:
            self._learn()
        for text, words in zip(lower, found):
            upto = np.cumsum(self.tokens[words])
            n = int(upto[-1]) if len(upto) else 0
            if limit is None or n <= limit:
                yield n, None
                continue
            # the word of token number ``limit``, and as many of its tokens as are kept
            k = int(np.searchsorted(upto, limit))
            m = next(islice(WORDS.finditer(text), k, None))
            kept = limit - int(upto[k] - self.tokens[words[k]])
            yield n, m.start() + max(end for _, end in self.tok.encode(m.group(), add_special_tokens=False).offsets[:kept])


def _counted(tok, words: WordTokens | None, texts: pd.Series, special: bool, limit: int | None = None) -> Iterator[tuple[int, int | None]]:
    """(tokens, cut) of each text, null counting as empty."""
    rows = [t if t is not None else "" for t in texts]
    for i in range(0, len(rows), TEXTS_AT_ONCE):
        part = rows[i : i + TEXTS_AT_ONCE]
        plain = [words is not None and words.takes(t) for t in part]
        by_word = words.counted([t for t, p in zip(part, plain) if p], limit) if words is not None else iter(())
        whole = _encodings(tok, [t for t, p in zip(part, plain) if not p], special)
        for p in plain:
            if p:
                yield next(by_word)
            else:
                e = next(whole)
                yield len(e), max(end for _, end in e.offsets[:limit]) if limit is not None and len(e) > limit else None


def tokenizer_counter(tokenizer_file: str, template: ChatTemplate | None = None, special: bool = True) -> Callable[[Column], Column]:
    """Token counter of rendered conversations from a ``tokenizer.json`` file, loaded
    once per task. Requires the ``tokenizers`` package on the executors."""

    @pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = _loaded(tokenizer_file)
        words = WordTokens.of(tok)
        for texts in batches:
            yield pd.Series([n for n, _ in _counted(tok, words, texts, special)], index=texts.index, dtype="int64")

    return lambda messages: count(render_prompt(messages, template or CHATML, add_generation_prompt=False))


def token_cut(tokenizer_file: str, limit: int, special: bool = False) -> Callable[[Column], Column]:
    """Of a text: ``n_tokens``, and ``cut``: the code points that its first ``limit``
    tokens reach (null if it has no more)."""
    if limit < 1:
        raise ValueError("limit must be positive")

    @pandas_udf("n_tokens long, cut long")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tok = _loaded(tokenizer_file)
        words = WordTokens.of(tok)
        for texts in batches:
            yield pd.DataFrame(list(_counted(tok, words, texts, special, limit)), columns=["n_tokens", "cut"], index=texts.index).astype({"cut": "Int64"})

    return spans


def message_spans(messages: Column, template: ChatTemplate = CHATML) -> Column:
    """(role, start, end) of each message's content in the rendered text, as the
    template places the messages."""

    def step(x: Column, m: Column) -> Column:
        head, text, tail = template_parts(m, template)
        start = x["at"] + F.length(head)
        end = start + F.length(text)
        span = F.struct(m["role"].alias("role"), start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))
        return F.struct((end + F.length(tail)).cast("bigint").alias("at"), F.concat(x["spans"], F.array(span)).alias("spans"))

    none = F.array().cast("array<struct<role:string,start:bigint,end:bigint>>")
    zero = F.struct(F.lit(len(template.start)).cast("bigint").alias("at"), none.alias("spans"))
    return F.aggregate(placed_messages(messages, template), zero, step, lambda x: x["spans"])


def token_limit(records: DataFrame, tokenizer_file: str, limit: int, messages_col: str = "messages", template: ChatTemplate = CHATML, special: bool = False) -> DataFrame:
    """``records`` with ``n_tokens``, ``lost_tokens`` (beyond ``limit``), ``cut`` (code
    points of the rendered text that are kept; null if all are), ``kept`` (that
    text) and ``lost``: (role, chars, lost_chars) of each message."""
    names = records.columns
    text = render_prompt(F.col(messages_col), template, add_generation_prompt=False)
    rows = records.withColumn("__text", text).withColumn("__t", token_cut(tokenizer_file, limit, special)(F.col("__text")))
    cut = F.col("__t.cut")

    def lost(s: Column) -> Column:
        gone = F.when(cut.isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], cut)))
        return F.struct(s["role"].alias("role"), (s["end"] - s["start"]).alias("chars"), gone.cast("bigint").alias("lost_chars"))

    return rows.select(
        *names,
        F.col("__t.n_tokens").alias("n_tokens"),
        F.greatest(F.lit(0), F.col("__t.n_tokens") - limit).cast("bigint").alias("lost_tokens"),
        cut.alias("cut"),
        F.when(cut.isNull(), F.col("__text")).otherwise(F.left("__text", cut.cast("int"))).alias("kept"),
        F.transform(message_spans(F.col(messages_col), template), lost).alias("lost"),
    )
