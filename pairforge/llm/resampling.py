"""Importance resampling towards a target distribution.

Features are all runs of 1 to ``GRAM`` consecutive words, hashed into ``BUCKETS``
buckets by CRC-32. Both the documents and the target texts are counted whole; a
bucket's gain is the (smoothed) logarithm of how much likelier the target makes
it. Gains are an array of ``BUCKETS`` numbers, whatever the corpus, which goes to
the tasks; a document's weight is the floored mean over its features' entries. A
Gumbel number drawn from a hash of doc_id is added, so that the highest scores
are a sample without replacement, the same in each run.

Exact ranks come from parallel sorting by regular sampling. The scored rows (some
numbers each) are ``p`` locally sorted runs; each gives ``p`` keys at regular
places; the keys, sorted, give ``p`` - 1 regular splitters; each run's rows go to
their splitters' segments, where the runs' sorted pieces are merged; sums over the
segments' counts give each row its rank. No segment has more than two runs' rows.
``p`` is at most ``MAX_RUNS``, so the driver sees ``MAX_RUNS`` squared keys at most.

Rows without doc_id hash as an empty one and come after the others of their score.
Equal scores are ordered by doc_id, then by the number of features; rows that
agree in these too take either place. Null and empty texts have no features and
weight 0; only documents of ``LEAST`` words or more are drawn. An empty table
gives no rows; without target texts all gains still are defined. Other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from pairforge.llm.common import chunks, column, frugal, pick, saved, table, tune
from pairforge.llm.numbering import counted, written_order

GRAM = 2
BUCKETS = 10_000
SEED = 7
LEAST = 20  # words of a document that may be drawn
PERCENT = 25
SCALE = 1000
MAX_RUNS = 256
LONG = 40  # bytes of a word that the vectorised CRC-32 takes
_SCORED = "doc_id bigint, n_features bigint, n_words bigint, weight bigint, row bigint"


# ---- features ------------------------------------------------------------


def _word_bytes() -> np.ndarray:
    """Which bytes belong to words: digits, letters and all bytes from 0x80 on."""
    ok = np.zeros(256, bool)
    ok[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
    ok[128:] = True
    return ok


@cache
def _crc_step() -> np.ndarray:
    """The register after a byte, for each of its 256 lowest bytes (CRC-32 of zlib)."""
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = (r >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (r & np.uint32(1)))
    return r


def _next(r: np.ndarray) -> np.ndarray:
    """The register after a zero byte."""
    return _crc_step()[r & np.uint32(255)] ^ (r >> np.uint32(8))


@cache
def _crc_shift() -> np.ndarray:
    """[length, byte of the register, its value]: what ``length`` further bytes make
    of a CRC. Appending is linear, so a CRC's four bytes are looked up apart."""
    byte = np.arange(256, dtype=np.uint32)
    out = [np.stack([byte << np.uint32(8 * k) for k in range(4)])]
    for _ in range(LONG):
        out.append(_next(out[-1]))
    return np.stack(out)


def word_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each word."""
    length = end - start
    order = np.argsort(-length, kind="stable")
    ordered, at = length[order], start[order]
    r = np.full(len(start), 0xFFFFFFFF, np.uint32)
    step = _crc_step()
    for k in range(min(LONG, int(ordered[0])) if len(ordered) else 0):
        n = int(np.searchsorted(-ordered, -k, "left"))  # words longer than k
        r[:n] = step[(r[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (r[:n] >> np.uint32(8))
    out = np.empty_like(r)
    out[order] = ~r
    for i in np.flatnonzero(length > LONG):
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes())
    return out


def features(arr: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, words of each row, row of each feature, its bucket),
    chunk by chunk."""
    is_word, lower = _word_bytes(), np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    shift, space = _crc_shift(), np.uint32(zlib.crc32(b" "))
    for i, j, data, offs in chunks(arr):
        data, w = lower[data], is_word[data]
        begin, stop = w.copy(), w.copy()
        begin[1:] &= ~w[:-1]
        stop[:-1] &= ~w[1:]
        cut = offs[(offs > 0) & (offs < len(data))]
        begin[cut], stop[cut - 1] = w[cut], w[cut - 1]
        start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        n_words = np.diff(np.searchsorted(start, offs))
        text = np.repeat(np.arange(j - i), n_words)
        crc = word_crcs(data, start, end)
        two = np.flatnonzero(text[1:] == text[:-1])
        head = _next(crc[two]) ^ space  # of the first word and a space
        length = (end - start)[two + 1]
        short = np.minimum(length, LONG)
        pair = crc[two + 1].copy()
        for k in range(4):
            pair ^= shift[short, k, (head >> np.uint32(8 * k)) & np.uint32(255)]
        for x in np.flatnonzero(length > LONG):
            at = two[x] + 1
            pair[x] = zlib.crc32(data[start[at] : end[at]].tobytes(), int(head[x]))
        yield i, j, n_words, np.concatenate([text, text[two]]), (np.concatenate([crc, pair]) % np.uint32(BUCKETS)).astype(np.int64)


# ---- weights -------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for b in batches:
        for *_, bucket in features(b.column(0)):
            total += np.bincount(bucket, minlength=BUCKETS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket: ``BUCKETS`` numbers."""
    rows = pick(texts, "text").mapInArrow(frugal(_count), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) of each bucket, with one
    feature added to each."""
    t_all, s_all = float(target.sum()) + BUCKETS, float(corpus.sum()) + BUCKETS
    return np.array([math.floor(SCALE * math.log((t + 1) * s_all / ((s + 1) * t_all))) for t, s in zip(target.astype(float).tolist(), corpus.astype(float).tolist())], np.int64)


def _weigh(gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            words, weight = n.copy(), n.copy()
            for i, j, n_words, text, bucket in features(column(b, "text")):
                n[i:j] = np.bincount(text, minlength=j - i)
                total = np.bincount(text, gains[bucket], minlength=j - i).astype(np.int64)  # exact below 2^53
                weight[i:j] = total // np.maximum(n[i:j], 1)
                words[i:j] = n_words
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(n), pa.array(words), pa.array(weight), column(b, "row")], ["doc_id", "n_features", "n_words", "weight", "row"])

    return run


def scored(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Saved (doc_id, n_features, n_words, weight, row, score) of all rows."""
    tune(docs.sparkSession)
    gains = bucket_gains(bucket_counts(target), bucket_counts(docs))
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text", F.monotonically_increasing_id().alias("row"))
    out = rows.mapInArrow(frugal(_weigh(gains)), _SCORED)
    key = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(float(1 << 32)))))
    return saved(out.withColumn("score", F.col("weight") + gumbel), "resample-scored")


# ---- ranks ---------------------------------------------------------------


def _keys(t: pa.Table | pa.RecordBatch) -> list[tuple]:
    """Sort keys: score down, doc_id up (none last), features, row."""
    cols = (t.column(c).to_pylist() for c in ("score", "doc_id", "n_features", "row"))
    return [(-s, d is None, d or 0, n, r) for s, d, n, r in zip(*cols)]


def _segments(splitters: list[tuple]):
    """Rows and the number of splitters up to their key."""
    lead = np.array([s[0] for s in splitters], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = -column(b, "score").to_numpy()
            at, end = np.searchsorted(lead, key, "left"), np.searchsorted(lead, key, "right")
            tied = np.flatnonzero(at < end)
            if len(tied):
                for i, k in zip(tied.tolist(), _keys(b.take(pa.array(tied)))):
                    at[i] = bisect_right(splitters, k, at[i], end[i])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32))], names=[*b.schema.names, "segment"])

    return run


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (score, doc_id, n_features, row and others) and ``pos``, the place
    from 0, highest score first."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    p = max(1, min(MAX_RUNS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    runs = written_order(rows.coalesce(p).sortWithinPartitions(*order), "resample-runs")
    sizes = runs.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per run
    # the p keys of a run: the first row of each of p equal stretches
    turn = F.floor(F.col("place") * p / F.col("n"))
    regular = runs.join(F.broadcast(sizes), "part").filter((F.col("place") == 0) | (turn != F.floor((F.col("place") - 1) * p / F.col("n"))))
    keys = sorted(_keys(regular.select("score", "doc_id", "n_features", "row").toArrow()))
    splitters = [keys[i * len(keys) // p] for i in range(1, p)] if keys else []
    own = runs.drop("part", "place")
    dealt = own.mapInArrow(frugal(_segments(splitters)), StructType([*own.schema.fields, StructField("segment", IntegerType())]))
    return counted(dealt.repartitionById(p, F.col("segment")).sortWithinPartitions(*order).drop("segment"), "resample-ranks")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """Per row: doc_id, n_features, weight, score and rank (1 and up, in order of
    the score) among the ``percent`` drawn of the documents of ``least`` words."""
    rows = scored(docs, target)
    good = rows.filter(F.col("n_words") >= least)
    drawn = percent * good.count() // 100
    placed = ranked(good).withColumn("rank", F.when(F.col("pos") < drawn, F.col("pos") + 1))
    rest = rows.filter(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("bigint"))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return placed.select(out).unionByName(rest.select(out))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
