"""Substring deduplication by relative Lempel-Ziv parsing.

Documents are parsed into factors: copies of word sequences that also stand
elsewhere, named by the place of the reference. The index of all sequences of
``WINDOW`` words is dealt over reference blocks by an anchor, the smallest hash
of the ``GRAM``-word sequences inside the window. Equal windows have equal
anchors, so a window needs to be looked up in one block only; consecutive
windows mostly share their anchor and travel as one run. A block names for each
window that starts more than once its first occurrence (for that one, the
second). Consecutive windows with references on one diagonal are one factor; as
every window is looked up, a factor that ends inside a longer shared span is
followed by one that starts at its boundary, and no span of ``WINDOW`` words or
more is missed. Every word of such a span is removed; windows are judged on the
input.

Hot anchors (a passage in a large share of all documents) are found in a sample
and dealt over many tasks; their windows' representatives then meet once more.
The sample decides only where rows go, not what is found.

Null texts have no words; texts under ``WINDOW`` words lose none. Repeated rows
are occurrences of their own, so each is a copy of the other. An empty table
gives no rows. Other columns are ignored. Windows are compared by 64 bits, folded
from the anchor's hash and 32 bits of the window's; no words are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.llm.common import WS, Words, chunks, column, frugal, lut, mix64, pick, powers_pair, saved, sliding_argmin, small, table, tune

WINDOW = 35
GRAM = 12
HOT_RUNS = 200_000  # runs of an anchor (some 80 bytes each) that one task may get
SAMPLE = 16  # one document in so many is sampled to find hot anchors
SALTS = 64
TASK_WINDOWS = 4_000_000  # windows of one reference block
BLOCKS_PER_TASK = 4
NULL_DOC = -(1 << 63)
_RUNS = "part int, anchor binary, doc binary, tie binary, pos binary, n binary, hashes binary, done binary"
_FOUND = "kind int, doc bigint, tie int, start int, n int, ref_doc bigint, ref_tie int, ref_start int, anchor bigint, hash bigint"
_TYPES = {"anchor": "<u8", "doc": "<i8", "tie": "<i4", "pos": "<u4", "n": "<u4", "hashes": "<u4", "done": "u1"}


def window_runs(arr: pa.Array, tables, powers):
    """(row, first window's word position, windows, anchor, hashes) of each run
    of windows with one anchor, chunk by chunk. A run is of one place of the anchor,
    so equal windows are never in the same run."""
    for i, _, data, offs in chunks(arr):
        w = Words(data, offs, tables, powers)
        if len(w.h) < WINDOW:
            continue
        grams = w.windows(GRAM)
        least = sliding_argmin(grams, WINDOW - GRAM + 1)
        full = w.windows(WINDOW)
        ok = np.flatnonzero(w.room()[: len(full)] >= WINDOW)
        if not len(ok):
            continue
        text, at_gram = w.text_of()[ok], least[ok]
        cut = np.ones(len(ok), bool)
        cut[1:] = (text[1:] != text[:-1]) | (at_gram[1:] != at_gram[:-1])
        at = np.flatnonzero(cut)
        n = np.diff(np.append(at, len(ok)))
        yield text[at] + i, ok[at] - w.first[text[at]], n, grams[at_gram[at]], (full[ok] >> np.uint64(32)).astype("<u4")


def _packed(part: np.ndarray, n: np.ndarray, hashes: np.ndarray, cols: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per block, each column the bytes of its runs."""
    order = np.argsort(part, kind="stable")
    starts = np.cumsum(n) - n
    n_o = n[order]
    ends = np.cumsum(n_o)
    idx = np.arange(ends[-1]) + np.repeat(starts[order] - (ends - n_o), n_o)
    hashes = np.ascontiguousarray(hashes[idx], "<u4")
    p = part[order]
    at = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
    stop = np.append(at[1:], len(p))
    hash_at, hash_stop = np.append(0, ends)[at], ends[stop - 1]
    arrays = [pa.array(p[at].astype(np.int32))]
    for name in ("anchor", "doc", "tie", "pos", "n", "done"):
        c = np.ascontiguousarray(cols[name][order], _TYPES[name])
        arrays.append(pa.array([c[a:b].tobytes() for a, b in zip(at, stop)], pa.binary()))
    arrays.insert(6, pa.array([hashes[a:b].tobytes() for a, b in zip(hash_at, hash_stop)], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["part", "anchor", "doc", "tie", "pos", "n", "hashes", "done"])


def _map_runs(blocks: int, hot: np.ndarray):
    tables = lut(WS.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = powers_pair()
        for b in batches:
            doc = column(b, "doc").to_numpy()
            tie = column(b, "tie").to_numpy()
            for text, pos, n, anchor, hashes in window_runs(column(b, "text"), tables, powers):
                d, t = doc[text], tie[text]
                spread = np.zeros(len(text), np.uint64)
                if len(hot):
                    salt = mix64(d.astype(np.uint64) + t.astype(np.uint64)) % np.uint64(SALTS) + np.uint64(1)
                    spread = np.where(hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor, salt, spread)
                part = (mix64(anchor + spread * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(blocks)).astype(np.int64)
                yield _packed(part, n, hashes, {"anchor": anchor, "doc": d, "tie": t, "pos": pos, "n": n, "done": np.zeros(len(n))})

    return run


def _map_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables, powers = lut(WS.encode()), powers_pair()
    for b in batches:
        for _, _, n, anchor, _ in window_runs(column(b, "text"), tables, powers):
            yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int64)), pa.array(n.astype(np.int64))], ["anchor", "n"])


def _find(hot: np.ndarray, last: bool):
    """The block's side: all runs of a partition, looked up against each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list[bytes]] = {k: [] for k in _TYPES}
        for b in batches:
            for k in got:
                got[k] += column(b, k).to_pylist()
        c = {k: np.frombuffer(b"".join(v), _TYPES[k]) for k, v in got.items()}
        got.clear()
        anchor, n, hashes = c["anchor"], c["n"].astype(np.int64), c["hashes"]
        if not len(anchor):
            return
        # a run whose anchor stands alone here holds no repeat
        _, inverse, count = np.unique(anchor, return_inverse=True, return_counts=True)
        keep = count[inverse] > 1
        if len(hot):
            is_hot = hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor
            keep |= is_hot
        runs = np.flatnonzero(keep)
        if not len(runs):
            return
        starts = np.cumsum(n) - n
        n_r = n[runs]
        total = np.cumsum(n_r)
        within = np.arange(total[-1]) - np.repeat(total - n_r, n_r)
        run_of = np.repeat(runs, n_r)
        h = hashes[starts[run_of] + within]
        pos = c["pos"][run_of].astype(np.int64) + within
        key = mix64(anchor[run_of] + h.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.lexsort((pos, c["tie"][run_of], c["doc"][run_of], key))
        k = key[order]
        new = np.append(True, k[1:] != k[:-1])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(k)))
        is_first = np.arange(len(k)) == first[group]
        ref = np.where(is_first, np.minimum(first[group] + 1, len(k) - 1), first[group])
        dup = size[group] > 1
        if last:  # those already found among their own kind are done
            dup &= c["done"][run_of[order]] == 0
        d = np.flatnonzero(dup)
        w, r = order[d], order[ref[d]]
        back = np.lexsort((pos[w], run_of[w]))
        w, r = w[back], r[back]
        rw, rr = run_of[w], run_of[r]
        if len(w):
            diagonal = pos[r] - pos[w]
            cut = np.append(True, (rw[1:] != rw[:-1]) | (pos[w][1:] != pos[w][:-1] + 1) | (c["doc"][rr][1:] != c["doc"][rr][:-1]) | (c["tie"][rr][1:] != c["tie"][rr][:-1]) | (diagonal[1:] != diagonal[:-1]))
            at = np.flatnonzero(cut)
            long = np.diff(np.append(at, len(w)))
            yield _found(0, c["doc"][rw[at]], c["tie"][rw[at]], pos[w[at]], long, c["doc"][rr[at]], c["tie"][rr[at]], pos[r[at]], np.zeros(len(at)), np.zeros(len(at)))
        if len(hot) and not last:
            rep = order[first]
            mine = is_hot[run_of[rep]]
            rep, many = rep[mine], size[mine] > 1
            o = run_of[rep]
            yield _found(1, c["doc"][o], c["tie"][o], pos[rep], many, c["doc"][o] * 0, c["tie"][o] * 0, pos[rep] * 0, anchor[o].astype(np.int64), h[rep])

    return run


def _found(kind: int, *cols: np.ndarray) -> pa.RecordBatch:
    types = [np.int64, np.int32, np.int32, np.int32, np.int64, np.int32, np.int32, np.int64, np.int64]
    arrays = [pa.array(np.full(len(cols[0]), kind, np.int32))] + [pa.array(np.asarray(x).astype(t)) for x, t in zip(cols, types)]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "doc", "tie", "start", "n", "ref_doc", "ref_tie", "ref_start", "anchor", "hash"])


def _repack(blocks: int):
    """Representatives of hot windows, dealt by anchor and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = {k: column(b, k).to_numpy() for k in ("doc", "tie", "start", "n", "anchor", "hash")}
                anchor, hashes, one = v["anchor"].astype(np.uint64), v["hash"].astype("<u4"), np.ones(b.num_rows, np.int64)
                part = (mix64(anchor + hashes.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)
                yield _packed(part, one, hashes, {"anchor": anchor, "doc": v["doc"], "tie": v["tie"], "pos": v["start"], "n": one, "done": v["n"]})

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    rows = pick(docs, "doc_id", "text")
    return rows.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_DOC)).alias("doc"),
        F.shiftright(F.xxhash64("text"), 32).cast("int").alias("tie"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
    )


def raw_factors(docs: DataFrame, hot_runs: int = HOT_RUNS, sample: int = SAMPLE) -> DataFrame:
    """Saved table of repeated windows: runs of ``n`` windows from word ``start``
    of (doc, tie) that equal those from ``ref_start`` of (ref_doc, ref_tie)."""
    spark = docs.sparkSession
    tune(spark)
    rows = _keyed(docs).filter("text IS NOT NULL").select("doc", "tie", "text")
    part = rows.filter(F.pmod(F.xxhash64("doc", "tie"), F.lit(sample)) == 0)
    counts = saved(part.mapInArrow(_map_anchors, "anchor bigint, n bigint").groupBy("anchor").agg(F.count(F.lit(1)).alias("runs"), F.sum("n").alias("windows")), "anchors-sampled")
    windows = (counts.agg(F.sum("windows").alias("w")).first()["w"] or 0) * sample
    # an anchor here has hot_runs runs at least, so there are few
    hot = np.sort(np.array([r["anchor"] for r in counts.filter(F.col("runs") >= max(2, hot_runs // sample)).select("anchor").collect()], np.int64).astype(np.uint64))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-windows // TASK_WINDOWS))
    blocks = tasks * BLOCKS_PER_TASK
    runs = rows.mapInArrow(frugal(_map_runs(blocks, hot)), _RUNS).repartition(tasks, "part")
    found = saved(runs.mapInArrow(frugal(_find(hot, False)), _FOUND), "rlz-found")
    out = found.filter("kind = 0")
    if len(hot):
        again = found.filter("kind = 1").mapInArrow(_repack(blocks), _RUNS).repartition(tasks, "part")
        out = out.unionByName(saved(again.mapInArrow(_find(hot[:0], True), _FOUND), "rlz-found-hot"))
    return out.drop("kind", "anchor", "hash")


def factors(docs: DataFrame, **options) -> DataFrame:
    """The parse: (doc_id, start, n_words, ref_doc_id, ref_start), words from 0."""
    f = raw_factors(docs, **options).withColumn("diagonal", F.col("ref_start") - F.col("start"))
    w = Window.partitionBy("doc", "tie", "ref_doc", "ref_tie", "diagonal").orderBy("start")
    f = f.withColumn("cut", F.coalesce((F.col("start") > F.lag(F.col("start") + F.col("n")).over(w)).cast("int"), F.lit(1)))
    f = f.withColumn("part", F.sum("cut").over(w))
    out = f.groupBy("doc", "tie", "ref_doc", "ref_tie", "diagonal", "part").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("stop"))
    name = lambda c: F.when(F.col(c) != NULL_DOC, F.col(c))
    return out.select(name("doc").alias("doc_id"), "start", (F.col("stop") - F.col("start") + WINDOW - 1).alias("n_words"), name("ref_doc").alias("ref_doc_id"), (F.col("start") + F.col("diagonal")).alias("ref_start"))


def duplicate_spans(found: DataFrame) -> DataFrame:
    """(doc, tie, spans): the words to remove as disjoint [start, stop) spans."""
    one = F.struct(F.col("start").alias("s"), (F.col("start") + F.col("n") + WINDOW - 1).alias("e"))
    per = found.groupBy("doc", "tie").agg(F.sort_array(F.collect_list(one)).alias("all"))
    joined = """aggregate(all, cast(array() AS array<struct<s:int,e:int>>), (acc, x) ->
        CASE WHEN size(acc) > 0 AND x.s <= element_at(acc, -1).e
             THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('s', element_at(acc, -1).s, 'e', greatest(x.e, element_at(acc, -1).e))))
             ELSE concat(acc, array(x)) END)"""
    return per.select("doc", "tie", F.expr(joined).alias("spans"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(column(b, "text").to_pylist(), column(b, "spans").to_pylist()):
            words = (text or "").encode().split()
            n = len(words)
            for span in reversed(spans or ()):
                del words[span["s"] : span["e"]]
            n_words.append(n)
            n_removed.append(n - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [column(b, "doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_text"],
        )


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row."""
    spans = saved(duplicate_spans(raw_factors(docs, **options)), "rlz-spans")
    rows = _keyed(docs).join(small(spans), ["doc", "tie"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(frugal(_remove), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    )
