"""Toxicity scores: FTRL-proximal logistic regression over hashed features.

Features of a text are the distinct hashes of its words, of neighbouring words
and of words two apart (skip-grams), in lower case, punctuation left out. The
regression is trained by FTRL-proximal: each coordinate has its own learning
rate, and an L1 threshold keeps most weights at exactly 0, so a model is a short
list of (coordinate, weight).

Training uses at most ``TRAIN_ROWS`` labelled documents with a text (those of the smallest
hash; the bound is a parameter), dealt over ``SHARDS`` tasks, which get the texts'
coordinates (``DIMS`` at most for a text, however long); the shards' models are averaged. The list of weights has at most ``DIMS`` entries, whatever the
corpus, and travels to the scoring tasks. Every whole text is scored.

A doc_id is labelled toxic if any of its label rows says so; null labels and
labels of documents that do not exist are ignored. Null and empty texts get the
score of the intercept; a row without doc_id is scored and not held out. Repeated rows get equal scores; of the texts that share a
doc_id, training takes the smallest. Without training rows
all scores are 0.5's lower neighbour 0.0 (nothing is predicted toxic). An empty
table gives no rows. Other columns are passed through by ``scored``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pairforge.llm.common import Words, chunks, column, frugal, give_back, lut, mix64, pick, powers_pair, table, tune
from pairforge.operators.select import kth_key, le_key

BITS = 18
DIMS = 1 << BITS
TRAIN_ROWS = 24_000
SHARDS = 3
EPOCHS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 9.0, 0.01
POSITIVE = 3.0  # weight of a toxic example: they are the rarer
FOLDS, HELD = 5, 0
_SEPARATORS = bytes(c for c in range(128) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def features(arr: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row of each feature, coordinate), chunk by chunk;
    a coordinate may repeat."""
    tables, powers = lut(_SEPARATORS, lower=True), powers_pair()
    for i, j, data, offs in chunks(arr):
        w = Words(data, offs, tables, powers)
        text, h, n = w.text_of(), w.h, len(w.h)
        near, skip = np.flatnonzero(text[1:] == text[:-1]), np.flatnonzero(text[2:] == text[:-2]) if n > 2 else np.zeros(0, np.int64)
        two = mix64(h[near] * np.uint64(0x9E3779B97F4A7C15) + h[near + 1])
        gap = mix64(h[skip] * np.uint64(0xC2B2AE3D27D4EB4F) + h[skip + 2])
        at = (np.concatenate([h, two, gap]) >> np.uint64(64 - BITS)).astype(np.int64)
        yield i, j, np.concatenate([text, text[near], text[skip]]), at


class Ftrl:
    """FTRL-proximal over binary features; coordinate ``DIMS`` is the intercept
    (not thresholded)."""

    def __init__(self, dims: int = DIMS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(dims + 1), np.zeros(dims + 1)
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.l1 = l1
        self.bias = dims

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == self.bias, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, y: int, importance: float = 1.0) -> None:
        w = self.weights(at)
        g = importance * (1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y)
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def coordinates(texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's distinct coordinates in ascending order, 32 bits each."""
    for i, j, text, at in features(texts):
        key = np.unique(text * DIMS + at)
        split = np.searchsorted(key, np.arange(1, j - i) * DIMS)
        yield from ((x % DIMS).astype("<i4") for x in np.split(key, split))


def train(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, weights) that are not 0, the intercept last; ``rows``: the
    ``coordinates`` of the examples."""
    rows = [np.append(x, np.int32(DIMS)) for x in rows]
    model = Ftrl()
    weight = (1.0, POSITIVE)
    for _ in range(epochs):
        for at, y in zip(rows, labels.tolist()):
            model.learn(at, y, weight[y])
    every = np.arange(DIMS + 1)
    w = model.weights(every)
    keep = np.flatnonzero(w)
    return keep, w[keep]


def _train_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["rank", "doc_id"], kind="stable")
    at, w = train([np.frombuffer(x, "<i4") for x in pdf["at"]], pdf["y"].to_numpy())
    del pdf
    give_back()
    return pd.DataFrame({"at": at, "w": w})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = pa.array([x.tobytes() for x in coordinates(column(b, "text"))], pa.binary())
        yield pa.RecordBatch.from_arrays([*[column(b, c) for c in ("doc_id", "rank", "shard", "y")], at], ["doc_id", "rank", "shard", "y", "at"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray]:
    """The averaged model: coordinates and weights, at most ``DIMS`` + 1."""
    tune(docs.sparkSession)
    y = pick(labels, "doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    text = pick(docs, "doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    # labels without a text don't count for the bound; keys only
    y = y.filter(fold(F.col("doc_id")) != HELD).join(text.select("doc_id").distinct(), "doc_id", "left_semi")
    y = y.withColumn("rank", F.xxhash64("doc_id")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        last = kth_key(y, ["rank", "doc_id"], rows)
        chosen = y if last is None else y.filter(le_key(["rank", "doc_id"], last, y))
        chosen = chosen.withColumn("shard", F.pmod(F.shiftright("rank", 8), F.lit(shards)))
        pairs = text.join(F.broadcast(chosen), "doc_id")  # ``rows`` rows of 40 bytes
        # one text per doc_id, or a repeated one would pass the bound
        pairs = pairs.groupBy("doc_id", "rank", "shard", "y").agg(F.min("text").alias("text"))
        rows_of = f"doc_id {pairs.schema['doc_id'].dataType.simpleString()}, rank bigint, shard bigint, y int, at binary"
        hashed = pairs.select("doc_id", "rank", F.col("shard").cast("bigint"), "y", "text").mapInArrow(frugal(_hashed), rows_of)
        models = hashed.groupBy("shard").applyInPandas(_train_shard, "at bigint, w double")
        got = models.groupBy("at").agg((F.sum("w") / F.lit(shards)).alias("w")).orderBy("at").toPandas()
    finally:
        y.unpersist()
    return got["at"].to_numpy(np.int64), got["w"].to_numpy(np.float64)


def score_texts(arr: pa.Array, weights: np.ndarray) -> np.ndarray:
    out = np.full(len(arr), weights[DIMS])
    for i, j, text, at in features(arr):
        used = np.flatnonzero(weights[at])
        key = np.unique(text[used] * DIMS + at[used])
        out[i:j] += np.bincount(key // DIMS, weights[key % DIMS], minlength=j - i)
    return 1.0 / (1.0 + np.exp(-np.clip(out, -35, 35)))


def _score(at: np.ndarray, w: np.ndarray, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(DIMS + 1)
        weights[at] = w
        if not len(at):
            weights[DIMS] = -35.0
        for b in batches:
            s = score_texts(b.column(fields.index("__text")), weights)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s)], names=[*fields[:-1], "__score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, column_name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of its text as ``column_name``."""
    at, w = fit(docs, labels)
    cols = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(cols))])
    plain = plain.withColumn("__text", F.coalesce(F.col(f"_c{cols.index('text')}"), F.lit("")))
    schema = StructType([*plain.schema.fields[:-1], StructField("__score", DoubleType())])
    return plain.mapInArrow(frugal(_score(at, w, plain.columns)), schema).toDF(*cols, column_name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    out = scored(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
