"""Exact positions of rows in a global order, without a global window.

Rows are range partitioned and sorted into a written table; a row's place in its
part is counted while writing, and a running sum over the parts' counts (a row
per part) gives what stands before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.common import saved, small

_PLACES = 33  # monotonically_increasing_id: part number above, place in the part below


def written_order(df: DataFrame, name: str) -> DataFrame:
    """``df`` as it is partitioned and sorted, written with the columns ``part``
    and ``place`` (from 0) of each row."""
    out = saved(df.withColumn("__at", F.monotonically_increasing_id()), name)
    at = F.col("__at")
    return out.withColumns({"part": F.shiftright(at, _PLACES).cast("int"), "place": at.bitwiseAND(F.lit((1 << _PLACES) - 1))}).drop("__at")


def counted(df: DataFrame, name: str) -> DataFrame:
    """``df``, whose parts follow each other in some order and are sorted by it,
    and ``pos``: the row's place (from 0) in that order."""
    rows = written_order(df, name)
    sizes = saved(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), f"{name}-sizes")
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    start = saved(sizes.select("part", F.coalesce(before, F.lit(0)).alias("__start")), f"{name}-starts")
    return rows.join(small(start), "part").withColumn("pos", F.col("__start") + F.col("place")).drop("part", "place", "__start")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` and ``pos``, the row's place (from 0) in ``order``. Rows equal in
    ``order`` go into one part: let it end in a column that tells copies apart."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counted(df.repartitionByRange(n, *order).sortWithinPartitions(*order), name)
