"""SimHash classes, importance resampling and the Merkle manifest against brute
force, with nulls, empty and long texts, ties, repeated rows, empty tables and
clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

import __spark_entry__  # noqa: F401  (ships the package to the workers)
from pairforge.llm import manifest, resampling, simhash
from tests.llm.test_small_cases import SCHEMA, docs, none, prose, rows  # noqa: F401  (fixtures)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# ---- SimHash ---------------------------------------------------------------


def fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    """Number of the component of each distinct fingerprint, all pairs compared."""
    fps = sorted(set(fps))
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_simhash_classes(spark, docs, none, rows):
    fps = [fingerprint(t) for _, t, *_ in rows]
    comp = components(fps)
    least = {}
    for (d, *_), f in zip(rows, fps):
        if d is not None:
            least[comp[f]] = min(d, least.get(comp[f], d))
    want = [(d, f, least.get(comp[f])) for (d, *_), f in zip(rows, fps)]
    got = [(r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.classes(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.classes(none).count() == 0
    unnamed = simhash.classes(spark.createDataFrame([x for x in rows if x[0] is None] * 2, SCHEMA)).collect()
    assert [r["component_id"] for r in unnamed] == [None, None] and all(r["size"] == 2 for r in unnamed)


def test_long_texts_are_read_in_slabs(monkeypatch):
    texts = [prose(1, 500), " \n" * 300, "x" * 700, f"{'y' * 500} a b {'z ' * 40}", "a\tb", prose(2, 40) + " " * 200 + "\n\nEnd"]
    want = [simhash.fingerprint(t) for t in texts]
    assert want == [fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "SLAB", 16)
    assert [simhash.fingerprint(t) for t in texts] == want


def near(r, f, bits):
    for b in r.sample(range(64), bits):
        f ^= 1 << b
    return f


@pytest.mark.parametrize("cell_rows", [200, 1500])
def test_every_close_pair_is_linked(spark, cell_rows):
    r = random.Random(4)
    fps = {r.getrandbits(64) for _ in range(2000)}
    fps |= {near(r, f, r.randint(0, 5)) for f in r.sample(sorted(fps), 600)}
    core = r.getrandbits(64)
    fps |= {near(r, core, r.randint(0, 4)) for _ in range(900)}  # a dense ball
    fps |= {core & 0xFFFFFFFF | r.getrandbits(32) << 32 for _ in range(700)}  # one half in common
    df = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp bigint")
    got = simhash.links(df, cell_rows).collect()
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in ((x["a"] & (1 << 64) - 1, x["b"] & (1 << 64) - 1) for x in got):
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {f: find(f) for f in fps} == components(fps)
    assert len(got) < 4 * len(fps)  # a forest for each shard, not all pairs


def test_routing_keeps_close_points_together():
    r = np.random.default_rng(1)
    for radius, mask in ((1, simhash.HALVES[1]), (3, simhash.WHOLE)):
        points = r.integers(0, 1 << 63, 3000, np.uint64) & mask
        nodes = simhash.plant(points[:1000], mask, radius, 16)
        flips = np.zeros(3000, np.uint64)
        for _ in range(radius):
            flips ^= np.uint64(1) << (r.integers(32, 64, 3000).astype(np.uint64))
        assert (np.bitwise_count(flips) <= radius).all()
        home, moved = ([set() for _ in range(3000)] for _ in range(2))
        for sets, x in ((home, points), (moved, points ^ flips)):
            for leaf, idx in simhash.route(nodes, x, radius):
                for i in idx:
                    sets[i].add(leaf)
        assert len(nodes) > 5 and all(a & b for a, b in zip(home, moved))


# ---- resampling ------------------------------------------------------------


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def buckets(text):
    w = item_words(text)
    return len(w), [zlib.crc32(x.encode()) % 10_000 for x in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


def resampled(docs, target, percent=25, least=20):
    s, t = collections.Counter(), collections.Counter()
    for x in target:
        t.update(buckets(x)[1])
    found = [(d, *buckets(x)) for d, x in docs]
    for *_, f in found:
        s.update(f)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    out = []
    for d, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha(f"7:{'' if d is None else d}")[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    good = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(good[: percent * len(good) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_resampling(spark, docs, none, rows):
    target = ["One w1 W2 w3", None, "", "w1 w2 w3 w4 w5 ü" * 30, "x" * 90 + " " + "y" * 70]
    bench = spark.createDataFrame([(i, t, "z") for i, t in enumerate(target)], "item_id int, text string, Text string")
    pairs = [(d, t) for d, t, *_ in rows]
    for percent, least in ((25, 20), (100, 0), (0, 20)):
        got = resampling.resample(docs, bench, percent, least).collect()
        assert sorted((tuple(r) for r in got), key=str) == resampled(pairs, target, percent, least)
    again = docs.union(docs).repartition(7)
    got = resampling.resample(again, bench, 60).collect()
    assert sorted((tuple(r) for r in got), key=str) == resampled(pairs * 2, target, 60)
    assert resampling.resample(none, bench).count() == 0
    got = resampling.resample(docs, bench.limit(0), 50).collect()
    assert sorted((tuple(r) for r in got), key=str) == resampled(pairs, [], 50)


def test_hashes_are_zlibs():
    import pyarrow as pa

    r = random.Random(2)
    texts = [None, "", "A", " ".join("".join(r.choice("abcé9ZÄ") for _ in range(r.choice([1, 3, 39, 40, 41, 90]))) for _ in range(300)), "a-b_c"]
    got = {k: [] for k in range(len(texts))}
    for i, _, _, text, bucket in resampling.features(pa.array(texts)):
        for t, b in zip(text.tolist(), bucket.tolist()):
            got[i + t].append(b)
    assert [sorted(got[k]) for k in got] == [sorted(buckets(t)[1]) for t in texts]


def test_regular_sampling_sorts_uneven_runs(spark):
    """A third of the rows share one score and doc_id; runs differ in length."""
    rows = spark.range(0, 9000, 1, 13).selectExpr(
        "if(id % 3 = 0, 5, hash(id) % 40) AS score", "if(id % 3 = 0, 77, if(id % 50 = 1, null, id % 900)) AS doc_id", "id % 2 AS n_features", "id AS row"
    ).selectExpr("cast(score as bigint) score", "cast(doc_id as bigint) doc_id", "n_features", "row").filter("row > 2000 OR row % 17 = 0")
    got = sorted(resampling.ranked(rows).collect(), key=lambda r: r["pos"])
    assert [r["pos"] for r in got] == list(range(rows.count()))
    key = [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0, r["n_features"], r["row"]) for r in got]
    assert key == sorted(key)


# ---- Merkle manifest -------------------------------------------------------


def merkle(rows):
    """Expected proofs of (doc_id, source, lang, n_chars, text) rows."""

    def leaf(*values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(level):
        out = [level]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
        return out

    def climb(tree, i, digest, siblings):
        for level in tree[:-1]:
            run, slot = level[i // 8 * 8 : i // 8 * 8 + 8], i % 8
            siblings += run[:slot] + run[slot + 1 :]
            digest, i = sha("".join([*run[:slot], digest, *run[slot + 1 :]])), i // 8
        return digest

    by = collections.defaultdict(list)
    for doc, source, lang, n, text in rows:
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 and text is not None
        shown = text.translate({i: i + 32 for i in range(65, 91)}) if hit else text
        by[lang].append((doc is not None, doc or 0, leaf(doc, source, lang, n, text), leaf(doc, source, lang, n, shown)))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = [levels([x[2] for x in sorted(by[k])]) for k in langs]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, lang in enumerate(langs):
        for i, (known, doc, digest, shown) in enumerate(sorted(by[lang])):
            siblings = []
            folded = climb(top, k, climb(trees[k], i, shown, siblings), siblings)
            out.append((doc if known else None, digest, trees[k][-1][0], top[-1][0], sha("".join(siblings)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


LEAVES = "doc_id bigint, source string, lang string, n_chars int, text string, Lang string, TEXT string, size int, idx int, tree int"


def leaf_rows(n, langs):
    r = random.Random(n)
    return [(r.choice([None, i, i, i, 3]), r.choice([None, "s", "ü"]), r.choice(langs), r.choice([None, i]), r.choice([None, "", "Some Text É", "lower", "A" * 5000])) for i in range(n)]


@pytest.mark.parametrize("n, langs, block", [(150, [None, "", "en", "é", "z"], 16), (1, ["en"], 16), (70, [f"l{i}" for i in range(40)], 8), (530, ["en"], 64), (9, [None], 4096)])
def test_merkle_proofs(spark, monkeypatch, n, langs, block):
    monkeypatch.setattr(manifest, "BLOCK", block)
    rows = leaf_rows(n, langs)
    rows += rows[: n // 3]  # repeated rows
    df = spark.createDataFrame([(*x, "other", "clash", 1, 2, 3) for x in rows], LEAVES).repartition(3)
    assert sorted((tuple(r) for r in manifest.verified(df).collect()), key=str) == merkle(rows)


def test_merkle_empty_table_and_some_rows(spark):
    none = spark.createDataFrame([], LEAVES)
    assert manifest.verified(none).count() == 0
    rows = [(i, "s", "en" if i % 3 else "de", i, f"Text {i}") for i in range(300)]
    tree = manifest.Manifest(spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars int, text string"))
    want = {r[0]: r for r in merkle(rows)}
    few = manifest.proofs(tree, tree.leaves.filter("doc_id IN (5, 6, 200, 299)")).collect()
    assert sorted(r["doc_id"] for r in few) == [5, 6, 200, 299] and all(tuple(r) == want[r["doc_id"]] for r in few)


def test_octopus_is_minimal():
    r = random.Random(8)
    for _ in range(200):
        n = r.randint(1, 700)
        known = sorted(r.sample(range(n), r.randint(1, min(n, 60))))
        sizes, have = manifest.heights(n), {(0, i) for i in known}
        got = {(level, i) for level, miss in enumerate(manifest.octopus(np.array(known), n)) for i in miss.tolist()}
        derived, need = set(have), set()
        for level, size in enumerate(sizes[:-1]):
            for up in {i // 8 for k, i in derived if k == level}:
                need |= {(level, i) for i in range(up * 8, min(size, up * 8 + 8))} - derived
                derived.add((level + 1, up))
        assert got == need and not got & derived
