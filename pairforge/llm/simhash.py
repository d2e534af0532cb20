"""SimHash classes by vantage-point trees over Hamming distance.

A text's fingerprint has a bit set where over half of the hashes of its shingles
have it set. Fingerprints that differ in ``RADIUS`` bits or fewer are linked;
components of links are the classes.

Two fingerprints within 3 bits agree up to one bit in one of their halves, so
there is a tree for each half, searched with radius 1 instead of 3: on 32 bits a
radius of 1 prunes far more. A node of a tree has a vantage point and a distance
``mu``; fingerprints at ``mu`` or nearer are inside, others outside. By the
triangle inequality the distances of two linked ones to the vantage point differ
by the radius at most, so it is enough to hand the insiders nearest to the border
(from ``mu - radius + 1`` on) to the outside as well: each linked pair then is
whole in some leaf. A branch that no border crosses is never compared.

The tree grows in rounds. A cell of more than ``CELL_ROWS`` fingerprints gets a
subtree of up to ``FANOUT`` leaves, built from a sample of about ``SAMPLE`` of its
fingerprints, and all its fingerprints are dealt to these; the sample decides
only where rows go. The cells are the shards: each goes on splitting in memory
(where a half no longer splits, by the whole fingerprint and radius 3) until
``LEAF`` fingerprints are left, which are all compared, exactly, on 64 bits. A
shard returns a spanning forest of its links, not all pairs, so a dense group of
copies costs a row per member. A ball too dense for any split is searched from
one member to the next, members leaving the search as they are reached. Its
memory is some 100 bytes a distinct fingerprint.

Words are runs other than ``[\\x20\\x09-\\x0D]``, A-Z lower-cased; a text of fewer
than ``SHINGLE`` words has one shingle, null and wordless texts have fingerprint
zero and are linked like others. Equal fingerprints are one node, whatever their
number. A component is named by its smallest doc_id; rows without doc_id are
members but never give the name, and are unnamed (null) among themselves.
Repeated rows are in one component. An empty table gives no rows. Other columns
are ignored. Texts are read in slabs of ``SLAB`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pairforge.llm.common import column, frugal, pick, saved, small, table, tune
from pairforge.llm.near_dups import components

SHINGLE = 3
SEED = 42
RADIUS = 3
HALVES = (np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000))
WHOLE = np.uint64(0xFFFFFFFFFFFFFFFF)
HALF_RADIUS = RADIUS // len(HALVES)
CELL_ROWS = 16_384  # fingerprints of a shard, unless they don't split
FANOUT = 64
SAMPLE = 4096  # fingerprints of a cell that its subtree is built from
LEAF = 512
CANDIDATES = 12  # vantage points tried at a node
SLAB = 1 << 20
MAX_ROUNDS = 8


# ---- fingerprints --------------------------------------------------------


def _slabs(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, some at a time; each list starts with the last
    ``SHINGLE`` - 1 words of the one before."""
    at, held = 0, []
    while at < len(data):
        end = at + SLAB
        while end < len(data) and not data[end : end + 1].isspace():
            end += 1
        held += data[at:end].split()
        if len(held) >= SHINGLE or end >= len(data):
            yield held
            held = held[-(SHINGLE - 1) :]
        at = end


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each ``SHINGLE`` consecutive words joined by a space; of the whole
    sequence if it is shorter."""
    k = min(SHINGLE, len(words))
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.append(0, end[:-1] + 1)[: len(words) - k + 1]
    return np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first.tolist(), end[k - 1 :].tolist())], np.uint64)


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text, unsigned."""
    ones, n = np.zeros(64, np.int64), 0
    for words in _slabs((text or "").encode().lower()):
        if not words or n and len(words) < SHINGLE:
            continue
        h = shingle_hashes(words)
        n += len(h)
        for i in range(0, len(h), 1 << 16):
            ones += np.unpackbits(h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = np.array([fingerprint(t) for t in column(b, "text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])


# ---- vantage-point trees -------------------------------------------------


def _split(points: np.ndarray, sample: np.ndarray, radius: int) -> tuple[int, int, float]:
    """(vantage point, mu, share of the pairs that the two sides still hold)."""
    n, best = len(sample), (0, 0, 1.0)
    for v in points[:: max(1, len(points) // CANDIDATES)][:CANDIDATES]:
        count = np.bincount(np.bitwise_count(sample ^ v), minlength=65)
        inside = np.cumsum(count)
        near = inside - np.append(np.zeros(radius, np.int64), inside[:-radius])  # the last ``radius`` distances inside
        outside = n - inside + near
        cost = (inside.astype(float) ** 2 + outside.astype(float) ** 2) / float(n) ** 2
        mu = int(cost.argmin())
        if cost[mu] < best[2]:
            best = (int(v), mu, float(cost[mu]))
    return best


def _sides(points: np.ndarray, vantage: int, mu: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the inside and of the outside, which gets the insiders at the border."""
    d = np.bitwise_count(points ^ np.uint64(vantage))
    return d <= mu, d > mu - radius


def plant(sample: np.ndarray, mask: np.uint64, radius: int, leaves: int = FANOUT) -> list[tuple[int, int, int, int]]:
    """A subtree as nodes (vantage, mu, inside, outside); a child is a node's
    number, or -1 - the number of a leaf. The largest leaf is split first."""
    nodes: list[list[int]] = []
    open_: list[tuple[np.ndarray, int, int]] = [(sample & mask, -1, 0)]  # points, parent, side
    final: list[tuple[int, int]] = []
    while open_:
        i = max(range(len(open_)), key=lambda k: len(open_[k][0]))
        points, parent, side = open_.pop(i)
        vantage, mu, cost = _split(points, points, radius) if len(points) > 16 and len(open_) + len(final) + 2 <= leaves else (0, 0, 1.0)
        if cost >= 0.9:
            final.append((parent, side))
            continue
        if parent >= 0:
            nodes[parent][2 + side] = len(nodes)
        inside, outside = _sides(points, vantage, mu, radius)
        open_ += [(points[inside], len(nodes), 0), (points[outside], len(nodes), 1)]
        nodes.append([vantage, mu, 0, 0])
    for k, (parent, side) in enumerate(final):
        if parent >= 0:
            nodes[parent][2 + side] = -1 - k
    return [tuple(n) for n in nodes]


def route(nodes: list[tuple[int, int, int, int]], points: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
    """(leaf, places of its points) of each leaf that gets any."""
    out, todo = [], [(0, np.arange(len(points)))]
    while todo:
        at, idx = todo.pop()
        if at < 0:
            out.append((-1 - at, idx))
            continue
        vantage, mu, a, b = nodes[at]
        inside, outside = _sides(points[idx], vantage, mu, radius)
        todo += [(child, idx[side]) for child, side in ((a, inside), (b, outside)) if side.any()]
    return out


# ---- exact links of a shard ----------------------------------------------


def _compared(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of a leaf, all pairs compared: label propagation on the
    matrix of distances."""
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= RADIUS
    if near.sum() == len(points):
        return []
    label = np.arange(len(points))
    while True:
        new = np.where(near, label[None, :], len(points)).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(points)))
    return [(points[far], points[label[far]])]


def _walked(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of a ball that no vantage point splits: from one point to
    all unreached ones near it, and on from those."""
    out, rest = [], points
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            p = frontier.pop()
            near = np.bitwise_count(rest ^ p) <= RADIUS
            if near.any():
                found, rest = rest[near], rest[~near]
                out.append((found, np.full(len(found), p)))
                frontier += found.tolist()
                frontier = [np.uint64(x) for x in frontier]
    return out


def shard_links(points: np.ndarray, mask: np.uint64, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that span the components of the distinct ``points``, as far as both
    ends agree within ``radius`` under ``mask``."""
    out, todo = [], [(points, mask, radius)]
    while todo:
        points, mask, radius = todo.pop()
        if len(points) <= LEAF:
            out += _compared(points)
            continue
        for mask, radius in ((mask, radius), (WHOLE, RADIUS)):
            shown = points & mask
            some = shown[:: max(1, len(shown) // SAMPLE)]
            vantage, mu, cost = _split(some, some, radius)
            inside, outside = _sides(shown, vantage, mu, radius)
            if cost < 0.9 and max(inside.sum(), outside.sum()) < len(points):
                todo += [(points[inside], mask, radius), (points[outside], mask, radius)]
                break
        else:
            out += _walked(points)
    return out


# ---- the distributed index -----------------------------------------------


def _planted(t: pa.Table) -> pa.Table:
    tree, cell = t.column("tree")[0], t.column("cell")[0]
    sample = np.sort(t.column("fp").to_numpy()).view(np.uint64)
    nodes = plant(sample, HALVES[tree.as_py()], HALF_RADIUS)
    rows = np.array([(v, mu, a, b) for v, mu, a, b in nodes], object).reshape(-1, 4)
    parts = [pa.array([[int(x) if k else int(np.uint64(x).astype(np.int64)) for x in rows[:, k]]], pa.list_(pa.int64())) for k in range(4)]
    return pa.table([pa.array([tree.as_py()], pa.int32()), pa.array([cell.as_py()], pa.int64()), *parts], ["tree", "cell", "vantage", "mu", "a", "b"])


_NODES = "tree int, cell bigint, vantage array<bigint>, mu array<bigint>, a array<bigint>, b array<bigint>"


def _dealt(subtrees: dict[tuple[int, int], list[tuple[int, int, int, int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tree, cell, fp = (column(b, c).to_numpy() for c in ("tree", "cell", "fp"))
            got: list[list[np.ndarray]] = [[], [], []]
            for t, c in set(zip(tree.tolist(), cell.tolist())):
                idx = np.flatnonzero((tree == t) & (cell == c))
                for leaf, at in route(subtrees[t, c], fp[idx].view(np.uint64) & HALVES[t], HALF_RADIUS):
                    got[0].append(np.full(len(at), t, np.int32))
                    got[1].append(np.full(len(at), c * FANOUT + leaf))
                    got[2].append(fp[idx[at]])
            if got[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in got], ["tree", "cell", "fp"])

    return run


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows sorted by shard and searches shard by shard."""
    held: list[np.ndarray] = []
    now: tuple[int, int, int] | None = None

    def search() -> Iterator[pa.RecordBatch]:
        if held:
            for a, b in shard_links(np.concatenate(held).view(np.uint64), HALVES[now[1]], HALF_RADIUS):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

    for batch in batches:
        cols = [column(batch, c).to_numpy() for c in ("turn", "tree", "cell", "fp")]
        change = np.ones(len(cols[0]), bool)
        change[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
        cuts = [*np.flatnonzero(change).tolist(), len(change)]
        for i, j in zip(cuts, cuts[1:]):
            key = tuple(int(c[i]) for c in cols[:3])
            if key != now:
                yield from search()
                held.clear()
                now = key
            held.append(cols[3][i:j])
    yield from search()


def _subtrees(rows: DataFrame) -> dict[tuple[int, int], list[tuple[int, int, int, int]]]:
    return {(r["tree"], r["cell"]): [(v & 0xFFFFFFFFFFFFFFFF, mu, a, b) for v, mu, a, b in zip(r["vantage"], r["mu"], r["a"], r["b"])] for r in rows.collect()}


DEALT = 2048  # cells whose subtrees travel to the tasks together: some 4 MB


def shards(fps: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(turn, tree, cell, fp): the cells of both trees over the distinct ``fps``
    (column fp), copies at the borders included."""
    trees = F.explode(F.array(*[F.lit(k) for k in range(len(HALVES))])).alias("tree")
    open_ = fps.select(trees, F.lit(0).cast("bigint").alias("cell"), "fp")
    done: DataFrame | None = None

    def add(turn: int, rows: DataFrame) -> DataFrame:
        rows = rows.select(F.lit(turn).alias("turn"), "tree", "cell", "fp")
        return rows if done is None else done.unionByName(rows)

    for turn in range(MAX_ROUNDS):
        sizes = saved(open_.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("n")), "simhash-sizes")
        large = sizes.filter(F.col("n") > cell_rows)
        if not large.limit(1).count():
            return add(turn, open_)
        chance = F.pmod(F.xxhash64("fp", F.lit(turn)), F.col("n")) < SAMPLE
        sample = open_.join(small(saved(large, "simhash-large")), ["tree", "cell"]).filter(chance).select("tree", "cell", "fp")
        planted = saved(sample.groupBy("tree", "cell").applyInArrow(_planted, _NODES), "simhash-subtrees")
        planted = planted.filter(F.size("a") > 0)  # the others don't split: they stay as they are
        key = planted.select("tree", "cell")
        n = key.count()
        done = add(turn, open_.join(small(saved(key, "simhash-split")), ["tree", "cell"], "left_anti"))
        if not n:
            return done
        parts = -(-n // DEALT)
        next_: DataFrame | None = None
        for k in range(parts):  # the subtrees of some cells at a time
            mine = planted.filter(F.pmod(F.xxhash64("tree", "cell"), F.lit(parts)) == k)
            own = open_.join(small(saved(mine.select("tree", "cell"), "simhash-some")), ["tree", "cell"], "left_semi")
            got = own.mapInArrow(frugal(_dealt(_subtrees(mine))), "tree int, cell bigint, fp bigint")
            next_ = got if next_ is None else next_.unionByName(got)
        open_ = saved(next_, "simhash-cells")
    return add(MAX_ROUNDS, open_)


def links(fps: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Saved (a, b): links that span the components of the distinct ``fps``."""
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = shards(fps, cell_rows).repartition(n, "turn", "tree", "cell").sortWithinPartitions("turn", "tree", "cell")
    return saved(dealt.mapInArrow(frugal(_links), "a bigint, b bigint").distinct(), "simhash-links")


def classes(docs: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per row: doc_id, fp (signed), component_id and the component's rows."""
    tune(docs.sparkSession)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text")
    signed = saved(rows.mapInArrow(frugal(_sign), "doc_id bigint, fp bigint"), "simhash-signed")
    nodes = saved(signed.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    label = saved(components(links(nodes.select("fp"), cell_rows)), "simhash-labels")
    named = nodes.join(small(label), F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("label", "fp").alias("label"), "first", "n")
    named = saved(named, "simhash-named")
    comps = named.groupBy("label").agg(F.min("first").alias("component_id"), F.sum("n").alias("size")).filter("size > 1")
    comps = saved(comps, "simhash-components")
    by_fp = saved(named.select("fp", "label").join(small(comps), "label").select("fp", "component_id", "size"), "simhash-by-fp")
    one = F.lit(1).cast("bigint")
    return signed.join(small(by_fp), "fp", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("size", one).alias("size"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
