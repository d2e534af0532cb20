"""Validation of written split files, as a Spark job.

Reads the JSON lines of every split back through the strict line reader
(a bad line fails the job with its file and physical line number), checks
every record and reports, per split: records, invalid records, status and the
word statistics of user and assistant messages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.text import py_strip
from pairforge.operators.validate import validate_records, validation_summary
from pairforge.sources.jsonl import LINE_ORDER, load_jsonl, read_lines
from pairforge.session import literal_frame, path_exists


REPORT = "file string, records bigint, invalid bigint, status string, user_words string, assistant_words string"


def absent(name: str) -> tuple:
    return (name, 0, 0, "missing", "no data", "no data")


def first_record(spark: SparkSession, out_dir: str, split: str = "train") -> DataFrame:
    """The first line of a split's files, in full (file name, then line)."""
    lines = read_lines(spark, out_dir).filter(F.col("split") == split)
    return lines.filter(py_strip("value") != "").agg(F.min_by("value", F.struct(*LINE_ORDER)).alias("value"))


def check_split_files(spark: SparkSession, out_dir: str, splits: Sequence[str] = ("train", "val")) -> DataFrame:
    """Summary per split directory below ``out_dir`` (``split=<name>``); expected
    splits that have no files are listed as missing, with 0 records."""
    if not any(path_exists(spark, f"{out_dir}/split={s}") for s in splits):
        return literal_frame(spark, [absent(s) for s in splits], REPORT)
    # one pass: the summary also counts lines that are not JSON or too long; only
    # when there are any is the first one located (with its line number) and raised
    parsed = load_jsonl(spark, out_dir, mode="collect").withColumnRenamed("split", "file")
    rows = validation_summary(validate_records(parsed), "file", with_bad_json=True).collect()
    if any(r["bad_json"] or r["too_long"] for r in rows):
        load_jsonl(spark, out_dir, mode="failfast")  # raises JsonLinesError naming file and line
    found = {r["file"]: tuple(r)[:-2] for r in rows}
    return literal_frame(spark, [*found.values(), *(absent(x) for x in splits if x not in found)], REPORT)
