"""Seeded shuffle, exact train/validation split and exact-size subsample.

The permutation is ``order by md5('<seed>|<key>'), key``: a function of the
seed and the row key only, so it does not change with partitioning, executor
loss or file layout, and any SQL engine with md5 reproduces it. Sizes are exact
(``randomSplit`` and ``sample`` are not); the k-th key comes from the hash
prefix histogram in ``select.kth_hex_key``.

``group_split`` keeps rows of equal content on one side: groups, not rows, are
permuted, and the validation split takes whole groups from the front.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.operators.select import kth_hex_key, le_key, weight_threshold

HASH_COL = "shuffle_hash"
MD5_WIDTH = 32  # hex characters of an md5 digest


def seeded_hash(key: Column, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def shuffle_key(df: DataFrame, seed: int = 42, key_col: str = "pair_key") -> DataFrame:
    return df.withColumn(HASH_COL, seeded_hash(F.col(key_col), seed))


def shuffle_seeded(df: DataFrame, seed: int = 42, key_col: str = "pair_key") -> DataFrame:
    """The seeded permutation as a sorted frame (distributed range sort)."""
    return shuffle_key(df, seed, key_col).orderBy(HASH_COL, key_col)


def with_position(df: DataFrame, order_cols: list[str], position: str = "position") -> DataFrame:
    """0-based place of each row in a total order, without a one-task window:
    the frame is range sorted and written, then each partition's rows are counted
    and numbered from the sum of the counts before it (a row per partition)."""
    from pairforge.session import scratch_path

    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ordered")
    df.orderBy(*order_cols).withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("__part", F.shiftright("__id", 33))
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    per = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("__first"))
    per = per.select("__part", "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    numbered = rows.join(F.broadcast(per), "__part")
    return numbered.withColumn(position, F.col("__before") + F.col("__id") - F.col("__first")).drop("__id", "__part", "__first", "__before")


def val_size(n: int, val_ratio: float) -> int:
    """``int(n * ratio)`` in double arithmetic, as Python computes it."""
    return int(n * float(val_ratio))


def train_val_split(df: DataFrame, val_ratio: float = 0.1, seed: int = 42, key_col: str = "pair_key") -> DataFrame:
    """Adds ``shuffle_hash`` and ``split``: the first ``int(n * val_ratio)`` rows
    of the seeded permutation are 'val', the rest 'train'."""
    h = shuffle_key(df, seed, key_col)
    keys = h.select(HASH_COL, key_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = keys.count()
        k = val_size(n, val_ratio)
        t = kth_hex_key(keys, HASH_COL, [key_col], k, total=n, width=MD5_WIDTH) if k > 0 else None
    finally:
        keys.unpersist()
    if k <= 0:
        is_val = F.lit(False)
    elif t is None:
        is_val = F.lit(True)
    else:
        is_val = le_key([HASH_COL, key_col], t, h)
    return h.withColumn("split", F.when(is_val, F.lit("val")).otherwise(F.lit("train")))


GROUP_COL = "group_key"


def content_key(cols: Sequence[str]) -> Column:
    """md5 of the columns' values: equal for rows whose columns are equal, null
    and empty told apart."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in cols]
    return F.md5(F.concat(*parts))


def group_split(
    df: DataFrame,
    val_ratio: float = 0.1,
    seed: int = 42,
    group_cols: Sequence[str] = ("abstract", "plain_summary"),
    key_col: str = "pair_key",
    weight: Column | None = None,
) -> DataFrame:
    """Adds ``shuffle_hash``, ``group_key`` and ``split``. Rows that agree in
    ``group_cols`` are a group and stay together, so no content of the validation
    split is trained on.

    Groups follow ``order by md5('<seed>|<group_key>')``. 'val' holds the groups
    from the front as long as their sizes add up to ``int(total * val_ratio)`` at
    most, so it is short of that by less than the size of the next group. Sizes
    are row counts, or sums of ``weight`` (whole numbers, such as words or
    tokens; null counts as 0). No shuffle by group: a group's rows carry the same
    digest, and sums by digest prefix find the last digest, however large a group
    is. Groups that do not fit (a group may hold a third of all rows) are left to
    the training split with all that follow.
    """
    h = shuffle_key(df, seed, key_col).withColumn(GROUP_COL, content_key(group_cols))
    h = h.withColumn("__order", seeded_hash(F.col(GROUP_COL), seed))
    size = F.lit(1) if weight is None else F.coalesce(weight.cast("bigint"), F.lit(0))
    keys = h.select("__order", size.cast("bigint").alias("__size")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = keys.agg(F.sum("__size").alias("n")).first()["n"] or 0
        k = val_size(total, val_ratio)
        last = weight_threshold(keys, "__order", F.col("__size"), k, width=MD5_WIDTH) if k > 0 else None
    finally:
        keys.unpersist()
    is_val = F.lit(False) if last is None else F.col("__order") <= F.lit(last)
    return h.withColumn("split", F.when(is_val, F.lit("val")).otherwise(F.lit("train"))).drop("__order")


def leaked_groups(split: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """One row: groups (rows that agree in ``group_cols``), groups that have rows
    on both sides, and the rows of the validation split that are in those."""
    per = split.groupBy(content_key(group_cols).alias("g")).agg(F.count_if(F.col("split") == "val").alias("val"), F.count_if(F.col("split") == "train").alias("train"))
    both = (F.col("val") > 0) & (F.col("train") > 0)
    return per.agg(
        F.count(F.lit(1)).alias("groups"), F.count_if(both).alias("leaked"), F.coalesce(F.sum(F.when(both, F.col("val"))), F.lit(0)).cast("bigint").alias("leaked_val_rows")
    )


def subsample_k(
    df: DataFrame,
    sizes: Mapping[str, int],
    seed: int = 42,
    key_col: str = "pair_key",
    group_col: str = "split",
    tie_col: str | None = None,
) -> DataFrame:
    """Exactly ``sizes[g]`` rows of each group ``g`` (all rows when fewer): the
    first ones of the seeded permutation. Groups not named are dropped.

    The permutation hashes ``key_col``; ``tie_col`` (default ``key_col``) orders
    rows with equal hashes and must be unique. Hashing content and breaking ties
    by position makes the kept multiset a function of the content alone."""
    tie = tie_col or key_col
    h = df if HASH_COL in df.columns else shuffle_key(df, seed, key_col)
    cond: Column | None = None
    for g, n in sizes.items():
        in_g = F.col(group_col) == F.lit(g)
        if n <= 0:
            continue
        part = h.filter(in_g).select(HASH_COL, tie).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            t = kth_hex_key(part, HASH_COL, [tie], n, width=MD5_WIDTH)
        finally:
            part.unpersist()
        c = in_g if t is None else in_g & le_key([HASH_COL, tie], t, h)
        cond = c if cond is None else cond | c
    if cond is None:
        return h.limit(0)
    return h.filter(cond)
