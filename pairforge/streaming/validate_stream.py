"""Validation of JSON-lines files as they arrive (Structured Streaming).

The parse and record checks are stateless column expressions, so the same
functions run on a streaming text source: every new file's lines are parsed
and checked in micro-batches. ``stream_file_summary`` keeps one running row per
file (records, invalid records), a streaming aggregation whose state is one
entry per file.

Caps, exact splits and the problem head need the whole input (a rank over all
rows) and are batch operations; physical line numbers likewise need the line
counts of every split of a file, so streaming problems name the file only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairforge.operators.validate import problem_text, validate_records
from pairforge.session import apply_required_conf
from pairforge.sources.jsonl import INVALID, TOO_LONG, parse_lines


def stream_problems(spark: SparkSession, in_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame ``file_path, value, valid, too_long, problems`` over the text
    files arriving in ``in_dir``; lines without a record get the problem ``invalid
    JSON`` or ``too long to parse``."""
    apply_required_conf(spark)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(in_dir).select(F.col("_metadata.file_path").alias("file_path"), "value")
    checked = validate_records(parse_lines(lines))
    problems = F.when(F.col("valid"), F.col("problems")).otherwise(
        F.array(F.when(F.col("too_long"), F.lit(TOO_LONG)).otherwise(F.lit(INVALID)))
    )
    return checked.select("file_path", "value", "valid", "too_long", problems.alias("problems"))


def stream_file_summary(problems: DataFrame) -> DataFrame:
    """Running ``file_path, records, invalid, too_long`` (use output mode update/complete)."""
    return problems.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if((F.size("problems") > 0) & ~F.col("too_long")).alias("invalid"),
        F.count_if("too_long").alias("too_long"),
    )


def start_problem_sink(problems: DataFrame, out_dir: str, checkpoint_dir: str) -> StreamingQuery:
    """Append every problem record to Parquet; the checkpoint makes the sink
    exactly-once across restarts."""
    return (
        problems.filter(F.size("problems") > 0)
        .select("file_path", "value", problem_text(F.col("problems")).alias("problems"))
        .writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .start()
    )


def validate_files_once(spark: SparkSession, in_dir: str, out_dir: str, checkpoint_dir: str) -> DataFrame:
    """Run the streaming checks over the files present now (``availableNow``
    trigger: every file once, then stop) into a Parquet sink, and summarize the
    sink per split directory: ``split, records, invalid, too_long``.

    Restarting with the same checkpoint skips files already processed, so new
    files that arrive later are checked incrementally.
    """
    lines = stream_problems(spark, in_dir)
    q = (
        lines.select(
            F.regexp_extract(F.col("file_path"), r"split=([^/]+)/", 1).alias("split"),
            "valid",
            "too_long",
            F.size("problems").alias("n_problems"),
        )
        .writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(out_dir).groupBy("split").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if((F.col("n_problems") > 0) & ~F.col("too_long")).alias("invalid"),
        F.count_if("too_long").alias("too_long"),
    )
