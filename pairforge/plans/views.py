"""Stand-in inputs built from the driver's tables (test adaptation).

The driver tables hold no technical/plain text pairs or chat files, so these
views derive them with joins and bounded groups:

* ``pairs_conv``: a user turn and the turn right after it when that is an
  assistant turn; columns ``conv_id, turn, query, answer``.
* ``pairs_doc``: each document with its successor (``doc_id + 1``); columns
  ``doc_id, Source, Target`` (mixed case on purpose, for the column pick). The texts
  are shuffled once: ``2 ** RUN_BITS`` ids meet in a group, with the next one's.
* ``chat_records``: for every turn, a record of that turn and the next two
  turns of the same conversation (fewer at the end); columns
  ``conv_id, start, messages``.

Conversations are joined on the full row key ``(conv_id, turn)``, so one that
holds a large share of the rows is still spread over many tasks; ``chat_records``
groups at most three rows per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.session import sf_table

RUN_BITS = 6


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(sf_table(sf_dir, name))


table = read_table


def pairs_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations")
    u = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("query"))
    a = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return u.join(a, ["conv_id", "turn"], "inner").select("conv_id", "turn", "query", "answer")


def pairs_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    run, run_before = F.shiftright("doc_id", RUN_BITS), F.shiftright(F.col("doc_id") - 1, RUN_BITS)
    # a run's first id is also wanted by the last one of the run before
    runs = F.when(run == run_before, F.array(run)).otherwise(F.array(run, run_before))
    rows = docs.select("doc_id", F.struct("text").alias("t"), F.explode(runs).alias("run"))
    # every row of the next id, as a join gives them
    next_id = Window.partitionBy("run").orderBy("doc_id").rangeBetween(1, 1)
    found = rows.withColumn("next", F.collect_list("t").over(next_id)).filter(F.shiftright("doc_id", RUN_BITS) == F.col("run"))
    return found.select("doc_id", F.col("t.text").alias("Source"), F.explode("next").alias("n")).select("doc_id", "Source", F.col("n.text").alias("Target"))


def chat_records(spark: SparkSession, sf_dir: str, width: int = 3) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations")
    spread = conv.select(
        "conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("pos")
    ).withColumn("start", F.col("turn") - F.col("pos")).filter(F.col("start") >= 0)
    grouped = spread.groupBy("conv_id", "start").agg(
        F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("m")
    )
    return grouped.select(
        "conv_id",
        "start",
        F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages"),
    )
