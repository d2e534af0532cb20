"""Rewrite evaluation as column expressions over a comparison table.

* length: words of each rewrite relative to the source;
* numbers: numbers in a rewrite that the source does not contain (a number the
  model invented or changed);
* readability: words per sentence and characters per word.

The formulas are ours; the reference names the concerns, not a formula.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.text import non_ws_chars, word_count

NUMBER = r"\d+(?:[.,]\d+)*"
SENTENCE_END = r"[.!?]+"


def numbers(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(NUMBER), 0)


def unsupported_numbers(rewrite: Column, source: Column) -> Column:
    """Distinct numbers of ``rewrite`` missing from ``source``."""
    return F.array_except(numbers(rewrite), numbers(source))


def sentences(c: Column) -> Column:
    """Sentence count, at least 1 for a text with words."""
    return F.greatest(F.regexp_count(c, F.lit(SENTENCE_END)), F.lit(1))


def eval_length(cmp: DataFrame, text_col: str = "text") -> DataFrame:
    """Mean word-count ratio of before and after against the source."""
    counted = cmp.select(
        word_count(text_col).alias("ws"), word_count("before").alias("wb"), word_count("after").alias("wa")
    )
    per = counted.filter(F.col("ws") > 0).select(
        (F.col("wb") / F.col("ws")).alias("rb"), (F.col("wa") / F.col("ws")).alias("ra")
    )
    return per.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("rb"), 6).alias("before_ratio"),
        F.round(F.avg("ra"), 6).alias("after_ratio"),
    )


def eval_numbers(cmp: DataFrame, key_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    return cmp.select(
        *key_cols,
        F.size(F.array_distinct(numbers(F.col(text_col)))).cast("bigint").alias("source_numbers"),
        F.size(unsupported_numbers(F.col("before"), F.col(text_col))).cast("bigint").alias("unsupported_before"),
        F.size(unsupported_numbers(F.col("after"), F.col(text_col))).cast("bigint").alias("unsupported_after"),
    )


def eval_readability(cmp: DataFrame, key_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    names = (("source", text_col), ("before", "before"), ("after", "after"))
    # counts first, ratios in a second projection (regex results are not recomputed)
    counted = cmp.select(
        *key_cols,
        *[x for name, c in names for x in (
            word_count(c).alias(f"{name}_w"), sentences(F.col(c)).alias(f"{name}_s"), non_ws_chars(F.col(c)).alias(f"{name}_c"))],
    )
    cols = []
    for name, _ in names:
        w, s_, ch = F.col(f"{name}_w"), F.col(f"{name}_s"), F.col(f"{name}_c")
        cols.append(F.when(w > 0, w / s_).alias(f"{name}_words_per_sentence"))
        cols.append(F.when(w > 0, ch / w).alias(f"{name}_chars_per_word"))
    return counted.select(*key_cols, *cols)
