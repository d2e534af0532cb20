"""Chat records: build, render and encode as JSON lines.

A chat record is ``messages: array<struct<role string, content string>>``.
All functions return Columns or DataFrames of built-in expressions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.text import py_strip

# Fixed value: the system instruction placed first in every training record
# and every inference prompt.
SYSTEM_PROMPT = (
    "You are a medical text simplifier. Rewrite the following medical text "
    "into plain language that a patient with no medical background can "
    "understand. Preserve all key findings and conclusions. Do not add "
    "information not present in the original text."
)

MESSAGE_TYPE = "array<struct<role:string,content:string>>"


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))


def chat_messages(abstract: Column, plain_summary: Column, system_prompt: str = SYSTEM_PROMPT) -> Column:
    """system, user (technical text), assistant (plain text)."""
    return F.array(
        _msg("system", F.lit(system_prompt)),
        _msg("user", abstract),
        _msg("assistant", plain_summary),
    )


def prompt_messages(text: Column, system_prompt: str = SYSTEM_PROMPT) -> Column:
    """system, user: the input of a rewrite."""
    return F.array(_msg("system", F.lit(system_prompt)), _msg("user", text))


def format_chat(pairs: DataFrame, system_prompt: str = SYSTEM_PROMPT, keep: tuple[str, ...] = ("pair_key",)) -> DataFrame:
    return pairs.select(
        *keep, chat_messages(F.col("abstract"), F.col("plain_summary"), system_prompt).alias("messages")
    )


@dataclass(frozen=True)
class ChatTemplate:
    """How a model wants a conversation written, as data.

    ``message``: the format of a message, with ``{role}`` and ``{content}``;
    ``by_role``: other formats for some roles; ``names``: what the template calls
    a role; ``start``: text before the first message; ``trim``: contents lose
    white space at both ends; ``system_into_user``: a leading system message has no
    place of its own, but goes before the content of the message after it, in this
    format; ``generation_cue``: asks for the next (assistant) message. The contents
    stand once in each format.
    """

    message: str
    generation_cue: str
    by_role: Mapping[str, str] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)
    start: str = ""
    trim: bool = False
    system_into_user: str | None = None

    def __post_init__(self):
        for f in (self.message, *self.by_role.values(), *([self.system_into_user] if self.system_into_user else [])):
            if f.count("{content}") != 1:
                raise ValueError(f"a message format holds {{content}} once: {f!r}")


# The formats of four public instruct model families.
CHATML = ChatTemplate(
    message="<|im_start|>{role}\n{content}<|im_end|>\n",
    generation_cue="<|im_start|>assistant\n",
)
HEADERS = ChatTemplate(
    start="<|begin_of_text|>",
    message="<|start_header_id|>{role}<|end_header_id|>\n\n{content}<|eot_id|>",
    generation_cue="<|start_header_id|>assistant<|end_header_id|>\n\n",
    trim=True,
)
TURNS = ChatTemplate(
    start="<bos>",
    message="<start_of_turn>{role}\n{content}<end_of_turn>\n",
    names={"assistant": "model"},
    generation_cue="<start_of_turn>model\n",
    trim=True,
    system_into_user="{content}\n\n",
)
INST = ChatTemplate(
    message="{content}",
    by_role={"user": "<s>[INST] {content} [/INST]", "assistant": " {content} </s>"},
    generation_cue="",
    trim=True,
    system_into_user="<<SYS>>\n{content}\n<</SYS>>\n\n",
)


def _text(m: Column, template: ChatTemplate) -> Column:
    text = F.coalesce(m["content"], F.lit(""))
    return py_strip(text) if template.trim else text


def template_parts(m: Column, template: ChatTemplate) -> tuple[Column, Column, Column]:
    """What stands before, in and after the content of a message; ``m`` has role
    and content."""
    name = F.coalesce(m["role"], F.lit(""))
    for role, other in template.names.items():
        name = F.when(m["role"] == role, F.lit(other)).otherwise(name)

    def side(k: int) -> Column:
        def fill(fmt: str) -> Column:
            pieces = re.split(r"(\{role\})", fmt.split("{content}")[k])
            return F.concat(F.lit(""), *[name if p == "{role}" else F.lit(p) for p in pieces if p])

        out = fill(template.message)
        for role, fmt in template.by_role.items():
            out = F.when(m["role"] == role, fill(fmt)).otherwise(out)
        return out

    return side(0), _text(m, template), side(1)


def placed_messages(messages: Column, template: ChatTemplate = CHATML) -> Column:
    """``messages`` as the template places them: with ``system_into_user`` a leading
    system message is joined to the one after it (alone, it is a user's message)."""
    if template.system_into_user is None:
        return messages
    head, tail = template.system_into_user.split("{content}")
    first = messages[0]
    rest = F.slice(messages, 2, F.greatest(F.size(messages) - 1, F.lit(0)))
    prefix = F.concat(F.lit(head), _text(first, template), F.lit(tail))
    joined = F.transform(rest, lambda m, i: F.struct(m["role"].alias("role"), F.when(i == 0, F.concat(prefix, _text(m, template))).otherwise(m["content"]).alias("content")))
    alone = F.array(F.struct(F.lit("user").alias("role"), prefix.alias("content")))
    merged = F.when(F.size(messages) == 1, alone).otherwise(joined)
    return F.when((F.size(messages) > 0) & (first["role"] == "system"), merged).otherwise(F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))))


def render_prompt(messages: Column, template: ChatTemplate = CHATML, add_generation_prompt: bool = True) -> Column:
    """messages -> one prompt string (JVM-side: transform + array_join)."""
    body = F.array_join(F.transform(placed_messages(messages, template), lambda m: F.concat(*template_parts(m, template))), "")
    parts = [F.lit(template.start)] if template.start else []
    parts += [body] + ([F.lit(template.generation_cue)] if add_generation_prompt and template.generation_cue else [])
    return F.concat(*parts) if len(parts) > 1 else body


def to_jsonl(df: DataFrame, messages_col: str = "messages", keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object per row, ``{"messages": [...]}``, in column ``value``;
    non-ASCII stays unescaped."""
    return df.select(*keep, F.to_json(F.struct(F.col(messages_col).alias("messages"))).alias("value"))
