"""Exact, seeded subsample of written split files (the notebook's step).

Each split keeps the first ``n`` lines (all when fewer) of the seeded
permutation ``order by md5('<seed>|<line text>')``. Lines with equal digests
are equal texts, so of those at the threshold only their number matters: they
are counted and the wanted number of copies is written. The sample is a function
of the file contents alone, no line is numbered and no text outside the sample
is shuffled. It is written, in the order of the permutation, to a new directory;
the input is never overwritten, because Spark reads it lazily while writing.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.functions.text import py_strip
from pairforge.operators.sampling import HASH_COL, MD5_WIDTH, shuffle_key
from pairforge.operators.select import kth_digest

# Notebook sizes: 300 training and 50 validation records.
SUBSAMPLE_SIZES = {"train": 300, "val": 50}


def first_lines(lines: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """The first ``n`` rows of ``split, value`` by ``md5('<seed>|<value>')``, with
    the digest as ``shuffle_hash``."""
    h = shuffle_key(lines, seed, "value")
    if n <= 0:
        return h.limit(0)
    digests = h.select(HASH_COL).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        t = kth_digest(digests, HASH_COL, n, width=MD5_WIDTH)
    finally:
        digests.unpersist()
    if t is None:
        return h
    digest, wanted = t
    tied = h.filter(F.col(HASH_COL) == digest).groupBy(*h.columns).agg(F.count(F.lit(1)).alias("n"))
    # one row, but for texts with the same md5
    upto = F.sum("n").over(Window.partitionBy(HASH_COL).orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    copies = F.least(F.col("n"), F.lit(wanted) - upto + F.col("n"))
    tied = tied.withColumn("copies", copies).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return h.filter(F.col(HASH_COL) < digest).unionByName(tied.select(*h.columns))


def subsample_files(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    sizes: Mapping[str, int] = SUBSAMPLE_SIZES,
    seed: int = 42,
) -> DataFrame:
    """Write the subsample as ``out_dir/split=<name>`` text files; returns the
    lines kept per split."""
    lines = spark.read.text(in_dir).select("split", "value").filter(py_strip("value") != F.lit(""))
    parts = [first_lines(lines.filter(F.col("split") == F.lit(g)), n, seed) for g, n in sizes.items()]
    picked = reduce(DataFrame.unionByName, parts).orderBy("split", HASH_COL, "value")
    picked.select("split", "value").write.mode("overwrite").partitionBy("split").text(out_dir)
    kept = spark.read.text(out_dir).groupBy("split").agg(F.count(F.lit(1)).alias("records"))
    return kept
