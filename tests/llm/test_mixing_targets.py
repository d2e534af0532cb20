"""The mix against brute-force targets, repeated rows and the last draw."""

import collections
import random

from pairforge.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def targets(sizes, weights=(1, 2, 3), most=3):
    """Water-filling, one capped source after the other."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= most * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_targets_with_capped_sources(spark):
    r = random.Random(2)
    for n_sources in (1, 2, 5, 9):
        rows = []
        for i in range(400):
            s = r.choice([None, *[f"s{k}" for k in range(n_sources)]])
            rows.append((i, " ".join(["w"] * r.randrange(0, 3 if s == "s1" else 60)), s))
        sizes = collections.Counter()
        for _, t, s in rows:
            sizes[s] += len(t.split())
        got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
        want = targets(sizes)
        taken = collections.Counter()
        for x in got:
            assert x["source_size"] == sizes[x["source"]] and abs(x["target"] - want[x["source"]]) < 1e-6
            taken[x["source"]] += x["taken"]
        for s in sizes:
            assert abs(taken[s] - want[s]) < 60


def test_repeated_rows_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 64)
    monkeypatch.setattr(mixing, "FAN", 2)
    rows = spark.range(1500).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "repeat('a ', if(id % 3 = 0, 5, 1 + id % 9)) AS text", "if(id % 11 = 0, 'y', 'x') AS source")
    a, b = (sorted(tuple(r) for r in mixing.mix(df).collect()) for df in (rows, rows.repartition(9)))
    assert a == b and len(a) == 1500
    by = collections.defaultdict(list)
    for doc, _, source, size, _, target, copies, taken in a:
        assert taken == copies * size <= 3 * size
        by[source, target].append(taken)
    assert all(abs(sum(x) - target) < 10 for (_, target), x in by.items())
    assert len({x[6] for x in a if x[0] == 7}) > 1  # copies of one row are rounded one by one


def test_the_last_document_is_drawn(spark):
    """Single documents at a fraction of one half: about half of them are taken."""
    rows = [(i, "a " * 10, "x") for i in (1,)] + [(2, "b " * 10, "y")]
    # weights 1 and 3: targets 5 and 15 of 10 words each
    taken = []
    for seed in range(40):
        got = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(rows, SCHEMA), weights=(1, 3), seed=seed).collect()}
        assert got[1] in (0, 1) and got[2] in (1, 2)
        taken.append(got[1])
    assert 8 < sum(taken) < 32
