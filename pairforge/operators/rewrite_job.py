"""Rewriting a table as a job that survives being stopped.

A model that samples gives other text each time, so rows that are done must stay
as they are. Rows belong to shards by a hash of their key. A run rewrites some
shards at a time (a wave), writes them, and only then enters them in the ledger,
with the number of their rows and a checksum of their input. A restart leaves out
shards whose ledger entry equals their input now, and rewrites the others: those
of a wave that was stopped, and those whose rows have changed since. Readers take
the files that the ledger names, so a wave in progress is never seen.

``budgeted`` packs the rows of a rewriter's batch into calls of a bounded padded
size, as a model's memory asks for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.operators.rewrite import RewriterFactory, batch_rewrite
from pairforge.session import literal_frame, path_exists

SHARDS = 256
WAVE = 64  # shards written and entered together
LEDGER = "shard int, rows bigint, checksum bigint, version bigint, folder string"


# ---- batches of a bounded size ---------------------------------------------


def packed(sizes: Sequence[int], budget: int) -> list[np.ndarray]:
    """Places of the rows of each batch: similar sizes together, and the largest
    size times the rows at most ``budget``. A larger row is a batch of its own."""
    order = np.argsort(sizes, kind="stable")
    out, first = [], 0
    for i in range(1, len(order) + 1):
        if i == len(order) or sizes[order[i]] * (i + 1 - first) > budget:
            out.append(order[first:i])
            first = i
    return out


def word_sizes(texts: pd.Series) -> list[int]:
    return [len(t.split()) for t in texts]


def budgeted(factory: RewriterFactory, budget: int, sizes: Callable[[pd.Series], Sequence[int]] = word_sizes) -> RewriterFactory:
    """A factory whose rewriter gets batches of ``budget`` padded tokens at most
    (``sizes`` counts them) and gives its results in the rows' order."""

    def make() -> Callable[[pd.Series], pd.Series]:
        rewrite = factory()

        def run(texts: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            for batch in packed(sizes(texts), budget):
                out.iloc[batch] = list(rewrite(texts.iloc[batch]))
            return out

        return run

    return make


# ---- the job ---------------------------------------------------------------


def shard_of(key_cols: Sequence[str], shards: int = SHARDS) -> Column:
    return F.pmod(F.xxhash64(*key_cols), F.lit(shards)).cast("int")


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """The shards that are done: the latest entry of each."""
    if not path_exists(spark, f"{out}/ledger"):
        return literal_frame(spark, [], LEDGER)
    rows = spark.read.schema(LEDGER).json(f"{out}/ledger")
    latest = rows.groupBy("shard").agg(F.max_by(F.struct("rows", "checksum", "version", "folder"), "version").alias("r"))
    return latest.select("shard", "r.*")


def open_shards(df: DataFrame, out: str, key_cols: Sequence[str], text_col: str, shards: int = SHARDS) -> DataFrame:
    """(shard, rows, checksum) of the input's shards that the ledger lacks or has
    with other rows."""
    keyed = df.select(shard_of(key_cols, shards).alias("shard"), F.xxhash64(*key_cols, text_col).alias("h"))
    # a sum as well as an xor, so that repeated rows do not cancel out
    now = keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("h", F.lit(1))).alias("x"), F.sum(F.col("h") % 1_000_003).alias("s"))
    now = now.select("shard", "rows", F.xxhash64("x", "s").alias("checksum"))
    return now.join(ledger(df.sparkSession, out).select("shard", "rows", "checksum"), ["shard", "rows", "checksum"], "left_anti")


def rewrite_job(
    df: DataFrame,
    out: str,
    factory: RewriterFactory,
    key_cols: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    shards: int = SHARDS,
    wave: int = WAVE,
    most_waves: int | None = None,
) -> int:
    """Rewrite what is open of ``df`` into ``out``; returns the shards still open
    (0: done). Keys must be unique. Keep ``shards`` from run to run. ``most_waves``
    stops early; so does any failure, and the next call goes on."""
    spark = df.sparkSession
    todo = sorted(tuple(r) for r in open_shards(df, out, key_cols, text_col, shards).collect())  # ``shards`` rows at most
    version = (ledger(spark, out).agg(F.max("version")).first()[0] or 0) + 1
    shard = shard_of(key_cols, shards)
    done = 0
    for k, first in enumerate(range(0, len(todo), wave)):
        if most_waves is not None and k >= most_waves:
            break
        mine = todo[first : first + wave]
        part = df.select(*key_cols, text_col).filter(shard.isin([s for s, *_ in mine]))
        rows = batch_rewrite(part, factory, key_cols, text_col).drop(text_col)
        folder = f"{out}/rows/{version + k:012d}"
        # a stopped wave has left its folder without an entry: it is replaced
        rows.withColumn("shard", shard).write.mode("overwrite").parquet(folder)
        entries = [(s, n, c, version + k, f"rows/{version + k:012d}") for s, n, c in mine]
        literal_frame(spark, entries, LEDGER).coalesce(1).write.mode("append").json(f"{out}/ledger")
        done += len(mine)
    return len(todo) - done


def rewritten(spark: SparkSession, out: str, key_cols: tuple[str, ...] = ("doc_id",), out_col: str = "rewrite") -> DataFrame:
    """The rows of the shards that are done: ``key_cols`` and ``out_col``."""
    entries = ledger(spark, out)
    folders = [r["folder"] for r in entries.select("folder").distinct().collect()]  # a folder per wave
    if not folders:
        raise ValueError(f"nothing is done in {out}")
    rows = spark.read.parquet(*[f"{out}/{f}" for f in sorted(folders)])
    # the latest wave of a shard counts
    of = F.regexp_extract(F.col("_metadata.file_path"), r"(rows/[0-9]{12})/", 1)
    rows = rows.withColumn("__folder", of)
    keys = entries.select(F.col("shard").alias("__shard"), F.col("folder").alias("__of"))
    own = rows.join(F.broadcast(keys), (F.col("shard") == F.col("__shard")) & (F.col("__folder") == F.col("__of")))  # ``shards`` rows
    return own.select(*key_cols, out_col)
