"""Strict JSON-lines source with physical line numbers.

``read_lines`` reads text files and keeps an order key per line,
``(file_path, block_start, lid)``: the file, the byte offset of the split that
read the line, and ``monotonically_increasing_id`` (partition id in the high
bits, position inside the partition in the low bits). A split is read by one
task in file order, so ordering by that key is file order, on any split size.

Physical 1-based line numbers are only needed for bad lines:
``line_numbers`` counts lines per split (a table with one row per split, i.e.
file size / split size rows), turns them into per-file offsets with a window
over that small table, and joins them to the lines asked for.

Lines that hold a string of over ``STRING_LIMIT`` characters go through
``from_json``, which takes longer ones. The parser has limits: a VARIANT value of
128 MiB, nesting of 1,000, numbers of 1,000 digits and names of 50,000 characters.
A line of JSON beyond any of them has the status ``too_long``, is not valid, and is
told apart from lines that are not JSON.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.functions.text import py_strip
from pairforge.session import side_table

# characters of a string that try_parse_json takes
STRING_LIMIT = 20_000_000
LONG = {"maxStringLen": str(2**31 - 1), "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
LEAST_LONG = 1000  # a line that is beyond some limit has more characters
DEEPEST = 1000  # nesting that the parser takes
INVALID, TOO_LONG = "invalid JSON", "too long to parse"
LINE_ORDER = ["file_path", "block_start", "lid"]


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.text(paths)
    # partition columns of a partitioned directory (e.g. split=train) are kept
    return df.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("lid"),
        *df.columns,
    )


def line_numbers(all_lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (a subset of ``all_lines`` with the same order columns) with a
    ``line_no`` column: the 1-based physical line in its file. One pass counts the
    lines of each byte range; the lines themselves are not shuffled."""
    blocks = all_lines.groupBy("file_path", "block_start").agg(
        F.min("lid").alias("first_lid"), F.count(F.lit(1)).alias("n_lines")
    )
    w = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("offset", F.coalesce(F.sum("n_lines").over(w), F.lit(0)))
    return wanted.join(side_table(offsets, "line-offsets"), ["file_path", "block_start"], "inner").withColumn(
        "line_no", (F.col("offset") + F.col("lid") - F.col("first_lid") + 1).cast("bigint")
    ).drop("first_lid", "n_lines", "offset")


def _wrapped(value: Column) -> tuple[Column, Column]:
    return F.concat(F.lit("["), value, F.lit("]")), F.concat(F.lit('{"r":'), value, F.lit("}"))


def _is_long(value: Column) -> Column:
    return F.length(value) > STRING_LIMIT


def strict_json(value: Column) -> tuple[Column, Column]:
    """(valid, record) for one JSON text, with ``json.loads`` strictness.

    ``try_parse_json`` ignores text after the first value; wrapping the text in
    ``[..]`` and in ``{"r":..}`` and requiring both to parse rejects trailing
    text (what may close one wrapper is an error in the other). Duplicate keys
    keep the last value (``spark.sql.variant.allowDuplicateKeys``). NaN and
    Infinity, which Python accepts, are rejected.
    """
    wrapped_a, wrapped_b = (F.coalesce(F.try_parse_json(w), F.when(_is_long(value), F.from_json(w, "variant", LONG))) for w in _wrapped(value))
    valid = wrapped_a.isNotNull() & wrapped_b.isNotNull()
    record = F.when(valid, F.try_variant_get(wrapped_b, "$.r", "variant"))
    return valid, record


def _outline(value: Column) -> Column:
    """The text with every string as ``"x"`` and long numbers cut: JSON if and only
    if the text is, and within the limits but for nesting. (The patterns repeat
    single characters only, which costs no stack.)"""
    no_escapes = F.regexp_replace(value, r'\\(["\\/bfnrt]|u[0-9a-fA-F]{4})', "_")
    no_strings = F.regexp_replace(no_escapes, r'"[^"\\\x00-\x1f]*+"', '"x"')
    return F.regexp_replace(no_strings, r"((?<![0-9])[1-9]|[.eE+-][0-9])[0-9]{999,}", "$1")


def _nesting(brackets: Column) -> Column:
    """The deepest nesting of a text of brackets."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(x: Column, c: Column) -> Column:
        now = x["now"] + F.when(c.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(x["most"], now).alias("most"))

    return F.aggregate(F.split(brackets, ""), start, step, lambda x: x["most"])


def _is_deep_json(outline: Column) -> Column:
    """Whether an outline nested deeper than the parser takes is JSON: a letter for
    each scalar, then containers of scalars become scalars, level by level."""
    number = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
    letters = F.regexp_replace(F.regexp_replace(F.replace(outline, F.lit('"x"'), F.lit("s")), rf"(?<![\w.+-])(?:{number}|true|false|null)(?![\w.+-])", "v"), r"[ \t\n\r]", "")
    depth = _nesting(F.regexp_replace(letters, r"[^\[\]{}]", ""))
    inner = r"\[(?:[sv](?:,[sv])*)?\]|\{(?:s:[sv](?:,s:[sv])*)?\}"
    folded = F.aggregate(F.sequence(F.lit(1), depth), letters, lambda t, _: F.regexp_replace(t, inner, "v"))
    return F.when(depth > DEEPEST, folded.isin("s", "v")).otherwise(F.lit(False))


def too_long(value: Column, valid: Column) -> Column:
    """JSON that is beyond a limit of the parser: only its syntax is read."""
    outline = _outline(value)
    a, b = _wrapped(outline)
    object_b = F.from_json(b, "r string, bad string", {**LONG, "columnNameOfCorruptRecord": "bad"})
    is_json = F.from_json(a, "array<string>", LONG).isNotNull() & object_b["bad"].isNull()
    return F.when(~valid & (F.length(value) > LEAST_LONG), is_json | _is_deep_json(outline)).otherwise(F.lit(False))


def parse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Drop blank lines, add ``valid``, ``record`` (VARIANT, NULL if not valid) and
    ``too_long`` (JSON, but beyond the parser's limit; not valid)."""
    text = py_strip(value_col)
    valid, record = strict_json(text)
    rows = lines.filter(text != F.lit("")).withColumn("valid", valid).withColumn("record", record)
    return rows.withColumn("too_long", too_long(text, F.col("valid")))


class JsonLinesError(ValueError):
    pass


def load_jsonl(spark: SparkSession, paths: str | Sequence[str], mode: str = "failfast") -> DataFrame:
    """Parsed records of JSON-lines files.

    ``failfast``: raise on the first bad line (file order) naming the file and
    its 1-based physical line, like the reference loader, and whether it is not
    JSON or too long. ``collect``: return every non-blank line with ``valid`` and
    ``too_long``; bad lines get ``line_no`` through ``bad_lines``.
    """
    lines = read_lines(spark, paths)
    parsed = parse_lines(lines)
    if mode == "collect":
        return parsed
    bad = parsed.filter(~F.col("valid")).select(*LINE_ORDER, "too_long")
    first = bad.agg(F.min(F.struct(*LINE_ORDER)).alias("k")).first()["k"]
    if first is not None:
        one = bad.filter(
            (F.col("file_path") == first["file_path"])
            & (F.col("block_start") == first["block_start"])
            & (F.col("lid") == first["lid"])
        )
        row = line_numbers(lines, one).first()
        what = "JSON too long to parse" if row["too_long"] else "Invalid JSON"
        raise JsonLinesError(f"{what} on line {row['line_no']} of {row['file_path']}")
    return parsed.drop("valid", "too_long")


def bad_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file_path, line_no, value, status`` of every non-blank line without a
    record: not JSON (``INVALID``) or beyond the parser's limit (``TOO_LONG``)."""
    lines = read_lines(spark, paths)
    status = F.when(F.col("too_long"), F.lit(TOO_LONG)).otherwise(F.lit(INVALID))
    bad = parse_lines(lines).filter(~F.col("valid")).select(*LINE_ORDER, "value", status.alias("status"))
    return line_numbers(lines, bad).select("file_path", "line_no", "value", "status")
