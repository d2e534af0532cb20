"""Shared helpers: column picking, scratch tables, size-checked broadcasts, and
vectorised word hashing over Arrow string buffers."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.session import scratch_path

WS = " \t\n\x0b\x0c\r"  # the white space of the word contracts: \x20 and \x09-\x0D
ARROW_ROWS = 512  # rows of an Arrow batch: some MB of text in a Python worker
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 24 << 20
CHUNK_BYTES = 1 << 20


def tune(spark: SparkSession) -> None:
    """Small Arrow batches, so that a Python worker holds a few MB of text."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) != ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, matched by exact case, whatever other columns the
    frame has (also ones that differ by case alone)."""
    cols = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(cols))])
    return plain.select(*[F.col(f"_c{cols.index(n)}").alias(n) for n in names])


def positional(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns renamed by place, its key as ``__id`` (doc_id) and
    ``__hash`` (of the text), and the way back to its own columns; for functions
    that return whole rows, whatever the columns are called."""
    cols = docs.columns
    own = [f"_c{i}" for i in range(len(cols))]
    plain = docs.toDF(*own)
    plain = plain.withColumns({"__id": F.col(own[cols.index("doc_id")]).cast("bigint"), "__hash": F.xxhash64(own[cols.index("text")])})
    return plain, lambda df: df.select(*own).toDF(*cols)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written as a Parquet table below ``spark.checkpoint.dir`` and read
    back: cuts the lineage, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_bytes(df: DataFrame) -> int:
    """Bytes Spark's optimizer states for a saved table (its file sizes)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a *saved* table for broadcasting when its files and rows are within
    the bounds; beyond them it is returned as it is and the join shuffles."""
    if table_bytes(df) <= max_bytes and df.count() <= max_rows:
        return F.broadcast(df)
    return df


def kept_objects() -> dict:
    """What a Python worker keeps between the tasks of one kind. (Functions shipped
    by value get new globals with each task, so ``sys`` holds it.)"""
    return sys.__dict__.setdefault("_pairforge_kept", {})


def frugal(task: Callable, keeps: bool = False) -> Callable:
    """A batch function that gives its freed memory back when its task is done:
    Python workers live on, and several share an executor's memory. Only tasks
    that ``keeps`` leave what earlier ones have kept; all others drop it first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            kept_objects().clear()
        yield from task(batches)
        give_back()

    return run


def give_back() -> None:
    """Return freed memory of this Python worker to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# ---- vectorised words ----------------------------------------------------

_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_Q = 0xD6E8FEB86659FD93 | 1
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, b, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


def lut(separators: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, value of the byte) for each byte; ``lower`` folds A-Z."""
    word = np.ones(256, bool)
    word[list(separators)] = False
    ids = np.arange(256, dtype=np.uint64)
    if lower:
        ids[65:91] = ids[97:123]
    return word, mix64(ids * _U(0x9E3779B97F4A7C15) + _U(0x1234567))


class Words:
    """Words of a run of texts, hashed without a Python object per word.

    ``h``: 64-bit hash of each word; ``first``: index of each text's first word
    (and the total at the end); ``start``/``end``: byte bounds in ``data``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, tables, powers: tuple[Powers, Powers]):
        self.data, self.offsets, self.powers = data, offsets, powers
        is_word, value = tables
        n = len(data)
        w = is_word[data]
        begin, stop = w.copy(), w.copy()
        if n:
            begin[1:] &= ~w[:-1]
            stop[:-1] &= ~w[1:]
            cut = offsets[(offsets > 0) & (offsets < n)]
            begin[cut] = w[cut]
            stop[cut - 1] = w[cut - 1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, offsets)
        up, down = powers[0].get(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(value[data] * up[:n], out=total[1:])
        self.h = mix64((total[self.end] - total[self.start]) * down[self.start])

    def text_of(self) -> np.ndarray:
        """Index of the text that holds each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on (the last k-1 entries are left
        out; entries that reach into the next text are not masked here)."""
        return window_hash(self.h, k, self.powers[1])

    def room(self) -> np.ndarray:
        """Words from each word to its text's end, itself included."""
        n = np.diff(self.first)
        return np.repeat(self.first[1:], n) - np.arange(len(self.h))


def window_hash(h: np.ndarray, k: int, powers: Powers) -> np.ndarray:
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = powers.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up[:n], out=total[1:])
    return mix64((total[k:] - total[:-k]) * down[: n - k + 1])


def sliding_argmin(a: np.ndarray, w: int) -> np.ndarray:
    """Place of the (leftmost) minimum of each w consecutive entries, by doubling."""
    if len(a) < w:
        return np.zeros(0, np.int64)

    def better(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.where(a[x] <= a[y], x, y)

    have, width = np.arange(len(a)), 1
    while width * 2 <= w:
        have = better(have[:-width], have[width:])
        width *= 2
    rest = w - width
    return better(have[: len(a) - w + 1], have[rest : rest + len(a) - w + 1]) if rest else have


def powers_pair() -> tuple[Powers, Powers]:
    return Powers(_P), Powers(_Q)


def string_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of an Arrow string or binary array; nulls are empty."""
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offs[0] : offs[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``limit``
    bytes; a single longer text is a run of its own."""
    data, offs = string_bytes(arr)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
