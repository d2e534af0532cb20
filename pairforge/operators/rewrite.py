"""Batch rewriting and before/after comparison over a text table.

A rewriter is supplied as a *factory*: a picklable callable returning a
function ``pd.Series[str] -> pd.Series[str]``. The factory runs once per task
(inside ``mapInArrow``), so an expensive model is loaded once per task and
then fed slices of Arrow batches, of ``SLICE_BYTES`` of text or a single longer
one; only the texts become Python objects. ``compare_rewrites`` runs the base and the tuned
rewriter over the same batch in one pass, base first.

A rewriter that is a rule over text can be a ``ColumnRule`` instead: a function from
column to column, which needs no Python in tasks. The core ships two rules, and the
same two as factories, which stand in for a model in tests. There is no default:
the caller names the rewriters. The blank-input guard is a JVM-side column: blank
rows never reach a rewriter.

A model that samples is not reproducible: a task re-run after an executor loss,
or a second action on the same frame, gets different text. Write the comparison
once (a table in the shared folder) and evaluate that table, rather than
evaluating the lazy frame several times.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.text import is_blank, squeeze_ws

# Fixed value: the notice shown instead of a rewrite when the input is blank.
EMPTY_NOTICE = "Please paste some medical text above to see the rewrite."

RewriterFactory = Callable[[], Callable[[pd.Series], pd.Series]]

SLICE_BYTES = 1 << 20

_SENTENCE_END = r"([.!?]) "


@dataclass(frozen=True)
class ColumnRule:
    """A rewriter as a column expression."""

    expr: Callable[[Column], Column]


# one space between words, none at the ends; the same with a sentence per line
SQUEEZE = ColumnRule(squeeze_ws)
SENTENCE_LINES = ColumnRule(lambda c: F.regexp_replace(squeeze_ws(c), _SENTENCE_END, "$1\n"))

Rewriter = RewriterFactory | ColumnRule


def squeeze_factory() -> Callable[[pd.Series], pd.Series]:
    """A stand-in for a model: ``" ".join(text.split())`` of each text."""

    def run(s: pd.Series) -> pd.Series:
        return pd.Series([" ".join(x.split()) for x in s], index=s.index, dtype=object)

    return run


def sentence_lines_factory() -> Callable[[pd.Series], pd.Series]:
    """A stand-in for a tuned model: squeezed text with one sentence per line."""
    squeeze = squeeze_factory()
    end = re.compile(_SENTENCE_END)

    def run(s: pd.Series) -> pd.Series:
        return pd.Series([end.sub("\\1\n", x) for x in squeeze(s)], index=s.index, dtype=object)

    return run


def guard_input(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``needs_rewrite``; blank rows get ``before`` '' and ``after`` the
    notice, the others NULL (to be filled by the rewriters)."""
    blank = is_blank(text_col)
    return df.select(
        "*",
        (~blank).alias("needs_rewrite"),
        F.when(blank, F.lit("")).alias("before"),
        F.when(blank, F.lit(EMPTY_NOTICE)).alias("after"),
    )


def _slices(b: pa.RecordBatch, text_col: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``SLICE_BYTES`` of text, or of one row."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(b[text_col]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(upto):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + SLICE_BYTES, "right")))
        yield b.slice(i, j - i)
        i = j


def _apply(factories: dict[str, RewriterFactory], text_col: str, guard: str | None = None):
    """The batches with a column for each factory, or with its values in that column
    where ``guard`` (which goes) is true."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        funcs = {name: f() for name, f in factories.items()}  # once per task
        for b in batches:
            for part in _slices(b, text_col):
                todo = np.ones(len(part), bool) if guard is None else part[guard].to_numpy(zero_copy_only=False).astype(bool)
                src = pd.Series(part[text_col].to_pylist(), dtype=object)[todo]
                cols = {name: part.column(i) for i, name in enumerate(part.schema.names) if name != guard}
                for name, f in funcs.items():
                    values = pd.Series(cols[name].to_pylist() if name in cols else None, index=range(len(part)), dtype=object)
                    if len(src):
                        values[todo] = f(src)
                    cols[name] = pa.array(values, pa.string(), from_pandas=True)
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return fn


def batch_rewrite(
    df: DataFrame,
    rewriter: Rewriter,
    key_cols: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    out_col: str = "rewrite",
) -> DataFrame:
    """``key_cols, text, rewrite`` for every non-blank row."""
    g = guard_input(df.select(*key_cols, text_col), text_col).filter("needs_rewrite")
    base = g.select(*key_cols, text_col)
    if isinstance(rewriter, ColumnRule):
        return base.withColumn(out_col, rewriter.expr(F.col(text_col)))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields] + [f"`{out_col}` string"])
    return base.mapInArrow(_apply({out_col: rewriter}, text_col), schema)


def compare_rewrites(
    df: DataFrame,
    base: Rewriter,
    tuned: Rewriter,
    key_cols: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """``key_cols, text, before, after``: blank rows get the guard's values, the
    others both rewrites: rules as columns, all others from one Python pass over
    one scan."""
    g = guard_input(df.select(*key_cols, text_col), text_col).select(*key_cols, text_col, "before", "after", "needs_rewrite")
    named = {"before": base, "after": tuned}
    for name, r in named.items():
        if isinstance(r, ColumnRule):
            g = g.withColumn(name, F.when(F.col("needs_rewrite"), r.expr(F.col(text_col))).otherwise(F.col(name)))
    models = {name: r for name, r in named.items() if not isinstance(r, ColumnRule)}
    if not models:
        return g.drop("needs_rewrite")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in g.schema.fields if f.name != "needs_rewrite")
    return g.mapInArrow(_apply(models, text_col, "needs_rewrite"), schema)
