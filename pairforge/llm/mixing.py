"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source gets the same expected number of copies: the source's
target divided by its size. The whole part is taken; the fractions are rounded
together. In descending order of size, so that partners are of similar size, two
documents exchange a mass of words: a random one of the two exchanges that make
one of them integral, with probabilities that keep all expectations; the other
goes on to the next. Words, not copies, are what an exchange conserves, so the
taken words of a source differ from its target by less than the size of its last
fractional document.

The exchanges run inside buckets of a source (a hash of the row deals them, so a
source of any share splits evenly); each bucket leaves one fractional document,
and those meet ``FAN`` buckets at a time, level by level, until one is left, which
is drawn with its probability. All choices are functions of the seed and the row,
so reruns agree.

Nulls: a null text has size 0, a null source is a source of its own, last in
order. Documents of size 0 are taken 0 times. Repeated rows (of one doc_id, text
and source) are counted, dealt ``BUCKET`` at a time, and rounded one by one. An
empty table gives no rows; if all sizes are 0, all targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.llm.common import pick, positional, saved, small, table
from pairforge.llm.quality import split_words

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
BUCKET = 4096  # documents of a bucket
FAN = 1024  # buckets whose leftovers meet in one
SEED = 20_240_501
_UNIT = "doc_id bigint, tie bigint, skey string, size bigint, base bigint, frac double, bucket bigint, chunk bigint, rows bigint, copies bigint"


def n_words(text: str = "text") -> Column:
    return F.size(split_words(F.coalesce(F.col(text), F.lit("")))).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: float = MAX_COPIES) -> DataFrame:
    """(skey, docs, source_size, target) per source from (skey, size).

    A source is capped at ``max_copies`` times its size; what it can't take is
    shared by the others' weights. In ascending order of cap / weight the capped
    sources are a prefix, which running sums find without iterating."""
    per = sizes.groupBy("skey").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("skey").isNull(), "skey")) - 1  # a row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("cap", F.lit(float(max_copies)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("skey").isNull(), "skey")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(0))
    per = per.withColumns(
        {
            "words": F.sum("source_size").over(all_rows),
            "w_left": F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)),
            "cap_before": F.coalesce(F.sum("cap").over(upto), F.lit(0.0)),
        }
    )
    rate = (F.col("words") - F.col("cap_before")) / F.col("w_left")
    per = per.withColumn("rate", rate).withColumn("capped", F.col("cap") <= F.col("rate") * F.col("w"))
    # the first source that is not capped sets the rate of all that follow
    per = per.withColumn("final", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), F.col("rate").alias("r")))).over(all_rows))
    return per.select("skey", "docs", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("final.r") * F.col("w")).alias("target"))


def pair_round(size: list[int], frac: list[float], draw: list[float]) -> tuple[list[int], int, float]:
    """Round fractions two at a time; returns 0 or 1 for each, and the index and
    fraction of the one left over (-1 if none). ``draw``: uniform numbers."""
    eps = 1e-9
    out = [0] * len(size)
    a, p = -1, 0.0
    for i, q in enumerate(frac):
        if q <= eps or q >= 1 - eps or size[i] == 0:
            out[i] = int(q > 0.5 and size[i] > 0)
            continue
        if a < 0:
            a, p = i, q
            continue
        s, t = size[a], size[i]
        lacks, gives, has, takes = s * (1 - p), t * q, s * p, t * (1 - q)
        up, down = min(lacks, gives), min(has, takes)
        if draw[i] * (up + down) < down:  # words move to a
            if lacks <= gives:
                out[a] = 1
                a, p = i, q - lacks / t
            else:
                p += gives / s
        elif has <= takes:
            a, p = i, q + has / t
        else:
            out[i] = 1
            p -= takes / s
        if p <= eps or p >= 1 - eps:
            out[a] = int(p > 0.5)
            a, p = -1, 0.0
    return out, a, p


def uniform(*cols: pd.Series) -> np.ndarray:
    """Uniform numbers that are functions of whole-number columns."""
    frame = pd.concat([c.astype("Int64").fillna(0).astype("int64").rename(str(i)) for i, c in enumerate(cols)], axis=1)
    return (pd.util.hash_pandas_object(frame, index=False).to_numpy() >> 11) / float(1 << 53)


def _round_bucket(seed: int, level: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # similar sizes side by side, large ones first, so that the one left over is small
        pdf = pdf.sort_values(["size", "tie", "doc_id", "chunk"], ascending=[False, True, True, True], kind="stable", na_position="first")
        pdf = pdf.loc[pdf.index.repeat(pdf["rows"])].reset_index(drop=True)
        key = ["doc_id", "tie", "chunk"]
        turn = pdf.groupby(key, dropna=False).cumcount()
        salt = pd.Series(seed, index=pdf.index)
        draw = uniform(*[pdf[c] for c in key], turn, salt, salt * 0 + level).tolist()
        up, left, p = pair_round(pdf["size"].tolist(), pdf["frac"].tolist(), draw)
        pdf["copies"] = (pdf["base"] + pd.Series(up, dtype="int64", index=pdf.index)).astype("Int64")
        if left >= 0:
            pdf.loc[left, "copies"] = pd.NA
            pdf.loc[left, "frac"] = p
        # equal rows of equal outcome are one row again
        same = ["doc_id", "tie", "skey", "size", "base", "frac", "bucket", "chunk", "copies"]
        pdf["rows"] = pdf.groupby(same, dropna=False)["rows"].transform("size")
        return pdf.drop_duplicates(same)[[f.split()[0] for f in _UNIT.split(", ")]]

    return run


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: float = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, tie (hash of its text), size, source_size,
    target (its source's), copies and taken (copies times size)."""
    rows = pick(docs, "doc_id", "text", "source").select(
        F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("tie"), F.col("source").cast("string").alias("skey"), n_words().alias("size")
    )
    sizes = saved(rows, "mix-sizes")
    targets = saved(source_targets(sizes, weights, max_copies), "mix-targets")
    most = targets.agg(F.max("docs").alias("n")).first()["n"] or 1
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = small(targets.withColumnRenamed("skey", "tkey"))
    # repeated rows, however many, are one row with their number until they are dealt
    units = sizes.groupBy("doc_id", "tie", "skey", "size").agg(F.count(F.lit(1)).alias("rows"))
    unit = units.join(t, units["skey"].eqNullSafe(t["tkey"]), "left").withColumn("share", share)
    unit = unit.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / BUCKET))))
    buckets = F.ceil(F.col("docs") / F.lit(BUCKET)).cast("bigint")
    unit = unit.select(
        "doc_id", "tie", "skey", "size",
        F.when(F.col("size") > 0, F.floor("share")).otherwise(F.lit(0)).cast("bigint").alias("base"),
        F.when(F.col("size") > 0, F.col("share") - F.floor("share")).otherwise(F.lit(0.0)).alias("frac"),
        F.pmod(F.xxhash64("doc_id", "tie", "chunk", F.lit(seed)), buckets).alias("bucket"), "chunk",
        F.least(F.lit(BUCKET), F.col("rows") - F.col("chunk") * BUCKET).cast("bigint").alias("rows"),
    )
    level, n_buckets, done, left = 0, -(-most // BUCKET), [], unit
    while True:
        out = saved(left.groupBy("skey", "bucket").applyInPandas(_round_bucket(seed, level), _UNIT), f"mix-level{level}")
        done.append(out.filter(F.col("copies").isNotNull()))
        left = out.filter(F.col("copies").isNull())
        if n_buckets == 1:
            break
        level, n_buckets = level + 1, -(-n_buckets // FAN)
        left = left.drop("copies").withColumn("bucket", F.floor(F.col("bucket") / FAN))
    # one document of a source is left: drawn with its probability
    drawn = F.pmod(F.xxhash64("doc_id", "tie", "skey", F.lit(seed + 1)), F.lit(1 << 30)) < F.col("frac") * float(1 << 30)
    done.append(left.withColumn("copies", F.col("base") + drawn.cast("bigint")))
    cols = ["doc_id", "tie", "skey", "size", "copies", "rows"]
    all_rows = done[0].select(cols)
    for d in done[1:]:
        all_rows = all_rows.unionByName(d.select(cols))
    all_rows = all_rows.withColumn("__row", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("rows", "__row")
    return all_rows.join(t, all_rows["skey"].eqNullSafe(t["tkey"]), "left").select(
        "doc_id", "tie", F.col("skey").alias("source"), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Rows of equal
    doc_id and text are one unit here; its copies are summed."""
    copies = mix(docs, **options).groupBy("doc_id", "tie").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    copies = saved(copies, "mix-copies").withColumnsRenamed({"doc_id": "__doc", "tie": "__tie"})
    plain, back = positional(docs)
    at = F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__tie"))
    got = plain.join(small(copies.filter(F.col("__copies") > 0)), at)
    repeated = copies.filter(F.col("__rows") > 1).limit(1).count() > 0
    if repeated:  # else no shuffle for it
        got = got.dropDuplicates(["__doc", "__tie"])
    return back(got.withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("__copies")))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
