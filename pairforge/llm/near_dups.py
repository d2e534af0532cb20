"""Near-duplicate classes by DartMinHash signatures and banded joins.

A text is a weighted set of five-word shingles. DartMinHash throws darts at the
plane of (weight, rank) of every element: a hash of the element and of a cell of
the plane gives the number of darts in the cell (Poisson), their ranks, weights
and coordinates. Darts under the element's weight count; each of the signature's
coordinates keeps the dart of the lowest rank. Two texts agree in a coordinate
with the probability of their weighted Jaccard similarity. Cells are opened in
the order of rank and only until all coordinates are filled, so a text costs
about as many darts as there are coordinates, whatever its length.

Texts of equal words are one node. Nodes that share a band are candidates. Not
all pairs of a band are made: each bucket names a pivot, the pairs (member,
pivot) are checked exactly, and linked nodes become one component. Buckets whose
members are still in several components get further pivots. In the end all pairs
across components are compared by signatures of ``FINE`` coordinates, block by
block and each pair in its first common band only; those that may reach the
threshold are checked exactly. So no link is lost between texts that share a
band, but for an estimate that is ``DEVIATIONS`` standard deviations off.

Weights are 1 (plain Jaccard, the similarity meant by ``MIN_SIMILARITY``) or the
shingles' counts. Texts of fewer than five words are near copies of equal words
only; texts without words (null, empty) are one class. Repeated rows are in one
class. A class is named by its smallest doc_id; rows without doc_id are members
but never give the name. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.common import WS, Words, chunks, column, frugal, lut, mix64, pick, positional, powers_pair, saved, small, table, tune

SHINGLE = 5
MIN_SIMILARITY = 0.8
BANDS, ROWS = 24, 5  # a pair of similarity 0.8 shares no band once in 14,000 times
COORDINATES = BANDS * ROWS
BASE = 0.125  # the first cell of ranks; the next ones double up to 1
PIVOTS = (1, 2)
SIGN_BYTES = 1 << 19  # text signed at once
FINE = 1024  # coordinates of the longer signatures that thin out the last pairs
DEVIATIONS = 4.5  # a pair is dropped when its estimate is so far below the threshold
BLOCK = 1024  # members of a bucket that one step compares with each other
MAX_ROUNDS = 50
_GOLD, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _poisson_cdf(mean: float) -> np.ndarray:
    p, total, out = math.exp(-mean), 0.0, []
    for k in range(1, 24):
        total += p
        out.append(total)
        p *= mean / k
    return np.array(out)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def dart_signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray | None, n: int, k: int = COORDINATES) -> np.ndarray:
    """(n, k) signatures of n weighted sets. ``owner`` (0 to n-1), ``element``
    (64-bit hash) and ``weight`` (None: 1) list the sets' elements; sets without
    elements get zeros."""
    if weight is None:
        cell_of, limit = np.arange(len(element)), None
        base = element
    else:  # a weight of 2.5 covers the weight cells 0, 1 and half of 2
        cells = np.ceil(weight).astype(np.int64)
        cell_of = np.repeat(np.arange(len(element)), cells)
        number = np.arange(len(cell_of)) - np.repeat(np.cumsum(cells) - cells, cells)
        base, limit = element[cell_of] + mix64(number.astype(np.uint64)) * (number > 0), weight[cell_of] - number
    own = owner[cell_of]
    sig = np.zeros(n * k, np.uint64)
    empty = np.ones(n * k, bool)
    lo, width, level = 0.0, BASE, 0
    live = np.arange(len(own))
    while len(live):
        parts = max(1, round(width))  # ranks from 1 on are opened in cells of length 1
        length = width / parts
        cell = mix64(base[live] + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64)))
        at = live
        if parts > 1:
            cell = mix64(np.repeat(cell, parts) + np.tile(np.arange(parts, dtype=np.uint64), len(live)) * _ODD)
            at = np.repeat(live, parts)
        count = np.searchsorted(_poisson_cdf(length), _unit(cell), "right")
        hit = np.flatnonzero(count)
        times = count[hit]
        dart_of = np.repeat(hit, times)
        turn = np.arange(len(dart_of)) - np.repeat(np.cumsum(times) - times, times)
        dart = mix64(cell[dart_of] ^ (_ODD * (turn.astype(np.uint64) + np.uint64(1))))
        who = at[dart_of]
        start = lo + (dart_of % parts) * length if parts > 1 else lo
        rank = start + _unit(dart) * length
        second = mix64(dart + _GOLD)
        slot = own[who] * k + ((second >> np.uint64(40)) % np.uint64(k)).astype(np.int64)
        ok = empty[slot]
        if limit is not None:
            ok &= _unit(mix64(second + _ODD)) < limit[who]
        slot, rank, dart = slot[ok], rank[ok], dart[ok]
        order = np.lexsort((rank, slot))
        slot = slot[order]
        first = np.append(True, slot[1:] != slot[:-1]) if len(slot) else np.zeros(0, bool)
        sig[slot[first]] = dart[order][first]
        empty[slot[first]] = False
        open_ = empty.reshape(n, k).any(axis=1)
        live = live[open_[own[live]]]
        lo, width, level = lo + width, (width if level == 0 else 2 * width), level + 1
    return sig.reshape(n, k)


def shingle_sets(arr: pa.Array, tables, powers, counts: bool = False):
    """(first row, end row, row of each distinct shingle, shingle, count, words
    per row), chunk by chunk."""
    for i, j, data, offs in chunks(arr, SIGN_BYTES):
        w = Words(data, offs, tables, powers)
        h = w.windows(SHINGLE)
        ok = np.flatnonzero(w.room()[: len(h)] >= SHINGLE)
        text, h = w.text_of()[ok], h[ok]
        order = np.lexsort((h, text))
        text, h = text[order], h[order]
        first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(h))).astype(np.float64) if counts else None
        yield i, j, text[first], h[first], n, np.diff(w.first)


def _sign(counts: bool):
    tables = lut(WS.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = powers_pair()
        for b in batches:
            texts = column(b, "text")
            seq = [xxhash.xxh3_128_digest(b" ".join(x.encode().split())) for x in texts.to_pylist()]
            bands: list[list[int] | None] = []
            for i, j, text, h, n, words in shingle_sets(texts, tables, powers, counts):
                sig = dart_signatures(text, h, n, j - i)
                rows = sig.reshape(j - i, BANDS, ROWS)
                band = np.full((j - i, BANDS), 1, np.uint64) * np.arange(1, BANDS + 1, dtype=np.uint64)
                for r in range(ROWS):
                    band = mix64(band * _GOLD + rows[:, :, r])
                bands += [band[r].astype(np.int64).tolist() if words[r] >= SHINGLE else None for r in range(j - i)]
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc"), column(b, "tie"), pa.array(seq, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc", "tie", "seq", "bands"],
            )

    return run


def _set_of(counts: bool):
    tables = lut(WS.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = powers_pair()
        for b in batches:
            sets: list[bytes] = []
            sizes: list[bytes] = []
            for i, j, text, h, n, _ in shingle_sets(column(b, "text"), tables, powers, counts):
                short = (h >> np.uint64(32)).astype("<u4")
                split = np.searchsorted(text, np.arange(1, j - i))
                sets += [x.tobytes() for x in np.split(short, split)]
                sizes += [x.astype("<u4").tobytes() for x in np.split(n, split)] if counts else [b""] * (j - i)
            yield pa.RecordBatch.from_arrays([column(b, "seq"), pa.array(sets, pa.binary()), pa.array(sizes, pa.binary())], ["seq", "shingles", "counts"])

    return run


def similarity(a: bytes, b: bytes, na: bytes = b"", nb: bytes = b"") -> float:
    """(Weighted) Jaccard similarity of two sorted shingle lists."""
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    if not na:
        shared = len(np.intersect1d(x, y))  # sets of 32-bit hashes
        total = len(np.unique(x)) + len(np.unique(y)) - shared
        return shared / total if total else 1.0
    wx, wy = np.frombuffer(na, "<u4").astype(float), np.frombuffer(nb, "<u4").astype(float)
    _, ix, iy = np.intersect1d(x, y, return_indices=True)
    shared = np.minimum(wx[ix], wy[iy]).sum()
    return float(shared / (wx.sum() + wy.sum() - shared))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = (column(b, c).to_pylist() for c in ("a_set", "b_set", "a_n", "b_n"))
        sim = [similarity(*x) for x in zip(*cols)]
        yield pa.RecordBatch.from_arrays([column(b, "a"), column(b, "b"), pa.array(sim, pa.float64())], ["a", "b", "sim"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes with edges (a, b): the label is the smallest
    node of the component. Large-star and small-star steps until all edges lead
    from a node straight to its one label; every step is a grouping and a join,
    written to the shared folder."""
    e = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "near-edges")
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(star.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "near-edges")
        labels = e.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        ends = e.select(F.col("v").alias("u")).distinct()
        if not labels.filter("n > 1").limit(1).count() and not labels.join(ends, "u", "left_semi").limit(1).count():
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(ends.select(F.col("u").alias("node"), F.col("u").alias("label")))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


class _Links:
    """Candidate pairs, their exact check, and the components so far."""

    def __init__(self, docs: DataFrame, signed: DataFrame, counts: bool, min_similarity: float):
        self.docs, self.counts, self.min = docs, counts, min_similarity
        self.nodes = saved(signed.dropDuplicates(["seq"]), "near-nodes")
        bands = self.nodes.filter("bands IS NOT NULL").select("seq", F.explode("bands").alias("band"))
        many = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band")
        self.bands = saved(bands.join(many, "band"), "near-bands")
        self.edges: DataFrame | None = None
        self.tested: DataFrame | None = None
        self.label: DataFrame | None = None

    def members(self) -> DataFrame:
        """(band, seq, label) of buckets whose members are in several components."""
        if self.label is None:
            return self.bands.withColumn("label", F.col("seq"))
        m = self.bands.join(self.label, F.col("seq") == F.col("node"), "left").select("band", "seq", F.coalesce("label", "seq").alias("label"))
        split = m.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("band")
        return saved(m.join(split, "band"), "near-open")

    def pairs(self, members: DataFrame, pivots: int, turn: int) -> DataFrame:
        """(a, b) with a < b: members and the pivots of their bucket."""

        def order(i: int) -> Column:
            return F.min(F.struct(F.xxhash64("seq", F.lit(1000 * turn + i)).alias("o"), "seq", "label"))

        top = members.groupBy("band").agg(F.array(*[order(i) for i in range(pivots)]).alias("p"))
        top = top.select("band", F.explode(F.array_distinct("p")).alias("p")).select("band", F.col("p.seq").alias("pivot"), F.col("p.label").alias("plabel"))
        got = members.join(top, "band").filter("seq <> pivot AND label <> plabel")
        return got.select(F.least("seq", "pivot").alias("a"), F.greatest("seq", "pivot").alias("b"))

    def texts(self, seqs: DataFrame) -> DataFrame:
        """(seq, text) of the given nodes, one row or more each."""
        keys = saved(self.nodes.select("seq", "doc", "tie").join(seqs, "seq", "left_semi"), "near-wanted")
        keys = keys.withColumnsRenamed({"doc": "__doc", "tie": "__tie"})
        at = F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("tie") == F.col("__tie"))
        return self.docs.join(small(keys), at).select("seq", "text")

    def cross(self, members: DataFrame) -> DataFrame:
        """(a, b): pairs of a bucket across components that may be similar."""
        fine = self.texts(members.select("seq").distinct()).mapInArrow(frugal(_fine(self.counts)), "seq binary, fine binary")
        fine = saved(fine.dropDuplicates(["seq"]), "near-fine").join(self.nodes.select("seq", "bands"), "seq")
        blocks = members.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
        m = members.join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("seq"), F.col("blocks")).cast("int"))
        m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        m = m.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "label", "seq")
        m = m.join(fine, "seq").select("band", "i", "j", "block", "label", "seq", "fine", "bands")
        n = int(m.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        m = m.repartition(n, "band", "i", "j").sortWithinPartitions("band", "i", "j")
        return m.mapInArrow(frugal(_across(self.min)), "a binary, b binary")

    def check(self, pairs: DataFrame) -> int:
        """Check the pairs not seen before; returns how many."""
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = saved(pairs, "near-pairs")
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        n = pairs.count()
        if not n:
            return 0
        wanted = pairs.select(F.col("a").alias("seq")).unionByName(pairs.select(F.col("b").alias("seq"))).distinct()
        sets = self.texts(wanted).mapInArrow(frugal(_set_of(self.counts)), "seq binary, shingles binary, counts binary")
        sets = saved(sets.dropDuplicates(["seq"]), "near-sets")
        a = sets.withColumnsRenamed({"seq": "a", "shingles": "a_set", "counts": "a_n"})
        b = sets.withColumnsRenamed({"seq": "b", "shingles": "b_set", "counts": "b_n"})
        full = pairs.join(a, "a").join(b, "b").select("a", "b", "a_set", "b_set", "a_n", "b_n")
        found = saved(full.mapInArrow(frugal(_verify), "a binary, b binary, sim double").filter(F.col("sim") >= self.min), "near-links")
        self.edges = found if self.edges is None else self.edges.unionByName(found)
        links = found.select("a", "b")
        if self.label is not None:  # go on from the components so far
            links = links.unionByName(self.label.select(F.col("node").alias("a"), F.col("label").alias("b")))
        self.label = saved(components(links), "near-labels")
        return n

    def run(self) -> None:
        for turn, pivots in enumerate(PIVOTS):
            open_ = self.members()
            if not open_.limit(1).count():
                return
            self.check(self.pairs(open_, pivots, turn))  # perhaps no new pair, though buckets are open
        self.check(self.cross(self.members()))


def _fine(counts: bool):
    tables = lut(WS.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = powers_pair()
        for b in batches:
            out: list[bytes] = []
            for i, j, text, h, n, _ in shingle_sets(column(b, "text"), tables, powers, counts):
                sig = dart_signatures(text, h, n, j - i, FINE)
                out += [x.tobytes() for x in (sig & np.uint64(0xFF)).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([column(b, "seq"), pa.array(out, pa.binary())], ["seq", "fine"])

    return run


def _across(min_similarity: float):
    """Streams sorted rows and compares the members of each (band, i, j) group."""
    equal = min_similarity + (1 - min_similarity) / 256  # expected share of equal bytes
    least = FINE * (equal - DEVIATIONS * math.sqrt(equal * (1 - equal) / FINE))

    def compare(group: list[tuple]) -> list[tuple[bytes, bytes]]:
        if len(group) < 2 or len({g[4] for g in group}) < 2:
            return []
        band, i, j = group[0][:3]
        _, label = np.unique([g[4] for g in group], return_inverse=True)
        block = np.array([g[3] for g in group])
        fine = np.frombuffer(b"".join(g[6] for g in group), np.uint8).reshape(len(group), FINE)
        bands = np.array([g[7] for g in group])
        out = []
        for r in range(len(group) - 1):
            rest = np.flatnonzero((label[r + 1 :] != label[r]) & ((block[r + 1 :] != block[r]) | (i == j))) + r + 1
            rest = rest[(fine[rest] == fine[r]).sum(axis=1) >= least]
            if len(rest):
                common = bands[rest] == bands[r]
                rest = rest[bands[rest, common.argmax(axis=1)] == band]
                out += [(min(group[r][5], group[q][5]), max(group[r][5], group[q][5])) for q in rest]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for b in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if group and group[0][:3] != row[:3]:
                    found += compare(group)
                    group = []
                group.append(row)
            yield _pair_batch(found)
        yield _pair_batch(compare(group))

    return run


def _pair_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])


def near_links(docs: DataFrame, counts: bool = False, min_similarity: float = MIN_SIMILARITY) -> tuple[DataFrame, _Links]:
    """Saved (doc, tie, seq) of all rows, and the checked links of their nodes."""
    spark = docs.sparkSession
    tune(spark)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    signed = saved(rows.mapInArrow(frugal(_sign(counts)), "doc bigint, tie bigint, seq binary, bands array<bigint>"), "near-signed")
    links = _Links(rows, signed, counts, min_similarity)
    links.run()
    return signed.select("doc", "tie", "seq"), links


def classes(docs: DataFrame, counts: bool = False, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """Per row: doc_id, tie (hash of its text), class_id, class_size."""
    rows, links = near_links(docs, counts, min_similarity)
    if links.label is not None:
        rows = rows.join(small(links.label), F.col("seq") == F.col("node"), "left").select("doc", "tie", F.coalesce("label", "seq").alias("label"))
    else:
        rows = rows.select("doc", "tie", F.col("seq").alias("label"))
    rows = saved(rows, "near-rows")
    named = rows.groupBy("label").agg(F.min("doc").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    # most classes are one row: only larger ones need a join
    named = saved(named.filter("class_size > 1"), "near-classes")
    out = rows.join(small(named), "label", "left")
    return out.select(F.col("doc").alias("doc_id"), "tie", F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"))


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that name their class; of repeated rows of one
    doc_id one stays. A class without any doc_id keeps its rows."""
    c = classes(docs, **options)
    drop = c.filter("doc_id <> class_id OR doc_id IS NULL AND class_id IS NOT NULL").select(F.col("doc_id").alias("__doc"), F.col("tie").alias("__tie")).distinct()
    plain, back = positional(docs)
    at = F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__tie"))
    kept = plain.join(small(saved(drop, "near-drop")), at, "left_anti")
    ids = pick(docs, "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND doc_id IS NOT NULL")
    twice = saved(ids.select(F.col("doc_id").alias("__doc")), "near-twice")
    if twice.limit(1).count():  # texts are shuffled for repeated ids only
        again = kept.join(small(twice), F.col("__id") == F.col("__doc"), "left_semi").dropDuplicates(["__id"])
        kept = kept.join(small(twice), F.col("__id") == F.col("__doc"), "left_anti").unionByName(again)
    return back(kept)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).drop("tie")
