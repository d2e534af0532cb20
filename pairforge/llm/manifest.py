"""Merkle manifest of a table with an octopus multiproof for its rows.

Leaves are digests of whole rows. Each lang's leaves, in ascending doc_id, are the
bottom of a tree in which every ``ARITY`` consecutive nodes become one; the trees'
tops, in the order of the langs, are the bottom of the top tree, whose last node
is the root. Levels are built by grouping at most ``ARITY`` digests; all nodes
make the node table, the manifest itself.

Proofs are made by blocks of ``BLOCK`` leaves that follow each other in the global
order, whatever langs they are of. A block knows its own leaves. It names the
smallest set of other nodes that its paths to the root need: level by level, the
children of a known node's parent that are not known themselves; a parent whose
children are then all there is derived, not fetched. These coordinates are looked
up once in the node table. From its leaves and what it fetched the block derives
all interior nodes its leaves share, and expands each leaf's proof from them.

H is the lowercase hex SHA-256 of the inputs' concatenation. A leaf is H of
doc_id, source, lang, n_chars and text, each ``-`` if null, else its UTF-8 byte
count, a colon and the value. A run of one node is hashed like any other while
its level has several nodes; a lang of one leaf has that leaf as its top, and the
only lang's top is the root.

Rows of one lang and doc_id are ordered by their leaf; rows equal in all columns
have equal leaves and a place each. Rows without doc_id come first in their lang
and are never tampered with; a null lang comes first. An empty table gives no
rows. Other columns are ignored. Texts are hashed whole, by the JVM; only digests
are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.common import frugal, pick, saved, small, table, tune
from pairforge.llm.numbering import numbered

ARITY = 8
BLOCK = 4096  # leaves of one block: some MB with all their interior nodes
TAMPERED = 3  # of doc_ids whose crc32 this divides, the text is changed
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = -1  # the tree of the langs' tops; other trees have their lang's number
_PROOF = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


# ---- leaves --------------------------------------------------------------


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[field(F.col(c)) for c in FIELDS[:-1]], field(text)), 256)


def leaves(rows: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, shown, row) of every row; ``shown`` is the leaf of the
    row as a reader would present it, tampered with or not."""
    rows = pick(rows, *FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    shown = F.when(hit, leaf(F.translate("text", UPPER, LOWER)))
    return rows.select("doc_id", "lang", leaf(F.col("text")).alias("leaf"), shown.alias("shown"), F.monotonically_increasing_id().alias("row")).withColumn(
        "shown", F.coalesce("shown", "leaf")
    )


# ---- trees ---------------------------------------------------------------


def heights(n: int) -> list[int]:
    """Numbers of nodes of a tree's levels over ``n`` leaves, the top (1) last."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def parents(nodes: DataFrame) -> DataFrame:
    """The next level of all trees in (tree, level, idx, size, digest) that have
    one; ``size`` is the number of the tree's nodes on that level."""
    run = F.array_sort(F.collect_list(F.struct("idx", "digest")))
    up = nodes.filter("size > 1").groupBy("tree", "level", "size", F.shiftright("idx", 3).alias("up")).agg(run.alias("run"))  # ARITY rows at most
    digest = F.sha2(F.array_join(F.transform("run", lambda x: x.digest), ""), 256)
    return up.select("tree", (F.col("level") + 1).alias("level"), F.col("up").alias("idx"), F.shiftright(F.col("size") + ARITY - 1, 3).alias("size"), digest.alias("digest"))


def grown(bottom: DataFrame, most: int) -> DataFrame:
    """All nodes (tree, level, idx, size, digest) of the trees over ``bottom``'s
    nodes of level 0, ``most`` at most in a tree; each level is a saved table."""
    out = level = bottom
    for _ in heights(most)[1:]:
        level = saved(parents(level), "merkle-level")
        out = out.unionByName(level)
    return out


class Manifest:
    """The placed leaves (doc_id, lang, leaf, shown, tree, idx, n, pos, langs) and
    the node table (tree, level, idx, size, digest) of a table. ``tree`` is the lang's
    place in the order of langs, ``n`` its leaves, ``pos`` the place among all."""

    def __init__(self, rows: DataFrame):
        order = [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("row")]
        digests = saved(leaves(rows), "merkle-digests")  # texts are hashed once, also if a sort looks at its rows first
        placed = saved(numbered(digests, order, "merkle-leaves"), "merkle-placed")
        langs = placed.groupBy("lang").agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("n"))
        langs = saved(numbered(saved(langs, "merkle-langs"), [F.col("start")], "merkle-lang-order").withColumnRenamed("pos", "tree"), "merkle-lang-places")
        count, most = langs.agg(F.count(F.lit(1)), F.max("n")).first()
        key = langs.select(F.col("lang").alias("__lang"), "start", "n", "tree")
        self.leaves = placed.join(small(key), F.col("lang").eqNullSafe(F.col("__lang"))).select(
            "doc_id", "lang", "leaf", "shown", "tree", (F.col("pos") - F.col("start")).alias("idx"), "n", "pos", F.lit(count).cast("bigint").alias("langs")
        )
        self.leaves = saved(self.leaves, "merkle-rows")
        level0 = F.lit(0).alias("level")
        trees = grown(self.leaves.select("tree", level0, "idx", F.col("n").alias("size"), F.col("leaf").alias("digest")), most or 0)
        tops = trees.filter("size = 1").select(F.lit(TOP).cast("bigint").alias("tree"), level0, F.col("tree").alias("idx"), F.lit(count).cast("bigint").alias("size"), "digest")
        self.nodes = trees.unionByName(grown(saved(tops, "merkle-tops"), count))


# ---- octopus -------------------------------------------------------------


def octopus(known: np.ndarray, n: int) -> list[np.ndarray]:
    """By level, the nodes that the paths from the ``known`` leaves of a tree over
    ``n`` leaves need and that cannot be derived from nodes below them."""
    out = []
    for size in heights(n)[:-1]:
        up = np.unique(known // ARITY)
        need = (up[:, None] * ARITY + np.arange(ARITY)).ravel()
        out.append(np.setdiff1d(need[need < size], known, assume_unique=True))
        known = up
    return out


def _runs(tree: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(tree, first, end) of a block's runs of leaves."""
    cut = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
    yield from zip(tree[cut].tolist(), cut.tolist(), np.append(cut[1:], len(tree)).tolist())


class _Blocks:
    """Streams rows sorted by block and hands over whole blocks."""

    def __init__(self, fields: list[str]):
        self.fields, self.held = fields, []

    def feed(self, b: pa.RecordBatch) -> Iterator[pa.Table]:
        t = pa.Table.from_batches([b])
        block = t.column("block").to_numpy()
        cuts = np.flatnonzero(block[1:] != block[:-1]) + 1
        at = 0
        for c in [*cuts.tolist(), len(block)]:
            part = t.slice(at, c - at)
            if self.held and self.held[-1].column("block")[0] != part.column("block")[0]:
                yield pa.concat_tables(self.held)
                self.held = []
            if len(part):
                self.held.append(part)
            at = c

    def rest(self) -> Iterator[pa.Table]:
        if self.held:
            yield pa.concat_tables(self.held)


def _by_block(work):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = None
        for b in batches:
            blocks = blocks or _Blocks(b.schema.names)
            for t in blocks.feed(b):
                yield work(t)
        if blocks:
            for t in blocks.rest():
                yield work(t)

    return run


def _wanted(t: pa.Table) -> pa.RecordBatch:
    """The coordinates a block has to fetch, the published root among them."""
    tree, idx, n = (t.column(c).to_numpy() for c in ("tree", "idx", "n"))
    langs = t.column("langs")[0].as_py()
    out: list[tuple[int, int, int]] = []
    for k, a, e in _runs(tree):
        out += [(k, level, i) for level, miss in enumerate(octopus(idx[a:e], int(n[a]))) for i in miss.tolist()]
    top = octopus(np.unique(tree), langs)
    out += [(TOP, level, i) for level, miss in enumerate(top) for i in miss.tolist()]
    out.append((TOP, len(top), 0))
    trees, levels, at = zip(*out)
    block = t.column("block")[0].as_py()
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(out), pa.int64()), pa.array(trees, pa.int64()), pa.array(levels, pa.int32()), pa.array(at, pa.int64())], ["block", "tree", "level", "idx"]
    )


def _hex(x: str) -> str:
    return sha256(x.encode()).hexdigest()


class _Tree:
    """The nodes a block knows of one tree: its leaves, what it fetched for it,
    and all it derives from these, as runs of ``ARITY`` digests."""

    def __init__(self, leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int):
        self.runs: list[dict[int, list[str]]] = []
        level = dict(leaves)
        for depth, size in enumerate(heights(n)[:-1]):
            runs = {}
            for up in {i // ARITY for i in level}:
                ids = range(up * ARITY, min(size, (up + 1) * ARITY))
                runs[up] = [level[i] if i in level else fetched[depth, i] for i in ids]
            self.runs.append(runs)
            level = {up: _hex("".join(r)) for up, r in runs.items()}
        (self.top,) = level.values()

    def siblings(self, idx: int) -> str:
        """The proof of a leaf: the other nodes of each run on its path."""
        out = []
        for runs in self.runs:
            up, slot = divmod(idx, ARITY)
            run = runs[up]
            out += run[:slot] + run[slot + 1 :]
            idx = up
        return "".join(out)


def fold(digest: str, proof: str, places: list[tuple[int, int]]) -> str:
    """The root that a leaf's digest and its proof give. ``places``: (slot, nodes
    of the run) of each level, which follow from the leaf's place in the trees."""
    at = 0
    for slot, size in places:
        left, right = at + 64 * slot, at + 64 * (size - 1)
        digest = _hex(proof[at:left] + digest + proof[left:right])
        at = right
    return digest


def places(idx: int, n: int) -> list[tuple[int, int]]:
    out = []
    for size in heights(n)[:-1]:
        up, slot = divmod(idx, ARITY)
        out.append((slot, min(size, (up + 1) * ARITY) - up * ARITY))
        idx = up
    return out


def _expanded(t: pa.Table) -> pa.RecordBatch:
    """A block's rows: its leaves (kind 1) and what it fetched (kind 0)."""
    kind = t.column("kind").to_numpy()
    got, own = t.filter(pa.array(kind == 0)), t.filter(pa.array(kind == 1))
    fetched: dict[int, dict[tuple[int, int], str]] = {}
    for k, level, i, d in zip(*(got.column(c).to_pylist() for c in ("tree", "level", "idx", "digest"))):
        fetched.setdefault(k, {})[level, i] = d
    tree, idx, n = (own.column(c).to_numpy() for c in ("tree", "idx", "n"))
    leaf, shown = own.column("digest").to_pylist(), own.column("shown").to_pylist()
    langs = own.column("langs")[0].as_py()
    mine = {k: _Tree(dict(zip(idx[a:e].tolist(), leaf[a:e])), fetched.get(k, {}), int(n[a])) for k, a, e in _runs(tree)}
    sizes = {k: int(n[a]) for k, a, _ in _runs(tree)}
    top = _Tree({k: x.top for k, x in mine.items()}, fetched.get(TOP, {}), langs)
    root = fetched[TOP][len(heights(langs)) - 1, 0]
    over = {k: (top.siblings(k), places(k, langs)) for k in mine}
    proofs, folded = [], []
    for k, i, d in zip(tree.tolist(), idx.tolist(), shown):
        proof = mine[k].siblings(i) + over[k][0]
        proofs.append(_hex(proof))
        folded.append(fold(d, proof, places(i, sizes[k]) + over[k][1]))
    ids = own.column("doc_id").combine_chunks()
    cols = [leaf, [mine[k].top for k in tree.tolist()], [root] * len(leaf), proofs, folded]
    return pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.string()) for c in cols], pa.array([x == root for x in folded], pa.bool_())], [f.split()[0] for f in _PROOF.split(", ")])


def proofs(manifest: Manifest, of: DataFrame | None = None) -> DataFrame:
    """Per leaf of ``of`` (rows of ``manifest.leaves``; all by default): doc_id,
    leaf, subroot, root, proof_sha256, folded_root (of the shown leaf) and whether
    that is the root."""
    own = (manifest.leaves if of is None else of).withColumn("block", F.floor(F.col("pos") / F.lit(BLOCK)).cast("bigint"))
    n = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.select("block", "pos", "tree", "idx", "n", "langs").repartition(n, "block").sortWithinPartitions("block", "pos")
    wanted = saved(dealt.mapInArrow(frugal(_by_block(_wanted)), "block bigint, tree bigint, level int, idx bigint"), "merkle-wanted")
    fetched = manifest.nodes.join(wanted, ["tree", "level", "idx"])
    none = F.lit(None)
    fetched = fetched.select("block", F.lit(0).alias("kind"), none.cast("bigint").alias("pos"), "tree", "level", "idx", "digest", none.cast("string").alias("shown"), none.cast("bigint").alias("n"), none.cast("bigint").alias("langs"), none.cast("bigint").alias("doc_id"))
    rows = own.select("block", F.lit(1).alias("kind"), "pos", "tree", F.lit(0).alias("level"), "idx", F.col("leaf").alias("digest"), "shown", "n", "langs", F.col("doc_id").cast("bigint"))
    both = fetched.unionByName(rows).repartition(n, "block").sortWithinPartitions("block", "kind", "pos")
    return both.mapInArrow(frugal(_by_block(_expanded)), _PROOF)


def verified(rows: DataFrame) -> DataFrame:
    """The manifest of ``rows`` and the proofs of all of them."""
    tune(rows.sparkSession)
    return proofs(Manifest(rows))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(table(spark, sf_dir, "documents"))
