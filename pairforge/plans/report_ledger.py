"""The report of written split files, kept up to date by reading changed files only.

Everything the report says is a function of sums: records and problems per file,
and how many messages of a role have how many words. The ledger holds these per
file, under the file's path, length and time of change. An update reads the files
that the ledger does not know as they are now; the report adds up the entries of
the files that are there, so files that went or changed drop out. Word counts are
kept exactly (a row per file, role and count), so the median is that of a full pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.operators.validate import STAT_ROLES, message_rows, stats_text, validate_records
from pairforge.plans.check import REPORT, absent
from pairforge.session import literal_frame, path_exists
from pairforge.sources.jsonl import load_jsonl, parse_lines, read_lines

_FILE = ["file_path", "length", "changed"]
_COUNTS = ["n", "records", "invalid", "bad_json", "too_long"]
LEDGER = "file_path string, length bigint, changed timestamp, role string, wc bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", batch string"


def listing(spark: SparkSession, out_dir: str) -> DataFrame:
    """(file_path, length, changed) of the files below a folder; none is read."""
    m = "_metadata"
    return spark.read.format("binaryFile").load(out_dir).select(
        F.col(f"{m}.file_path").alias("file_path"), F.col(f"{m}.file_size").alias("length"), F.col(f"{m}.file_modification_time").alias("changed")
    )


def file_facts(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file_path, role, wc, counts) of JSON-lines files: sums that can be added."""
    checked = validate_records(parse_lines(read_lines(spark, list(files))))
    m = message_rows(checked, "file_path", "record")
    first, ok, long = F.col("first"), F.col("ok"), F.col("long")
    return m.groupBy("file_path", F.when(F.col("role").isin(STAT_ROLES), F.col("role")).alias("role"), "wc").agg(
        F.count("wc").alias("n"),
        F.count_if(first & ok).alias("records"),
        F.count_if(first & ok & F.col("bad")).alias("invalid"),
        F.count_if(first & ~ok & ~long).alias("bad_json"),
        F.count_if(first & long).alias("too_long"),
    )


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; of a file that two updates have entered, one of them."""
    if not path_exists(spark, ledger):
        return literal_frame(spark, [], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(ledger)
    last = rows.groupBy(*_FILE).agg(F.max("batch").alias("batch"))
    return rows.join(last, [*_FILE, "batch"], "left_semi")


def update(spark: SparkSession, out_dir: str, ledger: str) -> list[str]:
    """Enter the files of ``out_dir`` that the ledger lacks; returns their paths."""
    now = listing(spark, out_dir)
    todo = now.join(entries(spark, ledger).select(*_FILE).distinct(), _FILE, "left_anti")
    rows = todo.collect()  # the changed files
    files = sorted(r["file_path"] for r in rows)
    if files:
        # a file without records has an entry too
        facts = literal_frame(spark, [tuple(r) for r in rows], "file_path string, length bigint, changed timestamp").join(file_facts(spark, files), "file_path", "left")
        counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in _COUNTS]
        facts.select(*_FILE, "role", "wc", *counts, F.lit(uuid.uuid4().hex).alias("batch")).write.mode("append").parquet(ledger)
    return files


def report(spark: SparkSession, out_dir: str, ledger: str, splits: Sequence[str] = ("train", "val")) -> DataFrame:
    """The report of ``check.check_split_files``, from the ledger's entries of the
    files that are there. Files with bad lines raise as they do there."""
    if not path_exists(spark, out_dir):
        return literal_frame(spark, [absent(s) for s in splits], REPORT)
    own = entries(spark, ledger).join(listing(spark, out_dir), _FILE, "left_semi")
    bad = own.filter("bad_json > 0 OR too_long > 0").select("file_path").distinct().limit(100)
    broken = sorted(r["file_path"] for r in bad.collect())
    if broken:
        load_jsonl(spark, broken, mode="failfast")
    own = own.withColumn("file", F.regexp_extract("file_path", r"/split=([^/]+)/", 1))
    totals = own.groupBy("file").agg(F.sum("records").alias("records"), F.sum("invalid").alias("invalid"))
    sums = own.filter("role IS NOT NULL AND n > 0").groupBy("file", "role", "wc").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("file", "role")  # a row per word count
    sums = sums.withColumns({"upto": F.sum("n").over(by.orderBy("wc")), "all": F.sum("n").over(by)})
    upper_median = F.min(F.when(F.col("upto") > F.floor(F.col("all") / 2), F.col("wc")))
    stats = sums.groupBy("file", "role").agg(
        F.sum("n").alias("n"), F.min("wc").alias("lo"), upper_median.alias("median"), F.max("wc").alias("hi"), F.floor(F.sum(F.col("wc") * F.col("n")) / F.sum("n")).alias("mean")
    )
    text = stats_text(F.col("n"), F.col("lo"), F.col("median"), F.col("hi"), F.col("mean"))
    sides = stats.groupBy("file").agg(*[F.coalesce(F.max(F.when(F.col("role") == r, text)), F.lit("no data")).alias(f"{r}_words") for r in STAT_ROLES])
    status = F.when(F.col("invalid") > 0, F.format_string("PROBLEMS found in %d records", F.col("invalid"))).otherwise(F.lit("all records valid"))
    words = [F.coalesce(f"{r}_words", F.lit("no data")).alias(f"{r}_words") for r in STAT_ROLES]
    found = totals.filter("records > 0").join(sides, "file", "left").select("file", "records", "invalid", status.alias("status"), *words)
    names = literal_frame(spark, [absent(s) for s in splits], REPORT).join(found.select("file"), "file", "left_anti")
    return found.unionByName(names)
