"""The split by groups of equal content against a plain loop."""

import collections
import hashlib
import random

import pytest

from pairforge.operators.sampling import content_key, group_split, leaked_groups, train_val_split
from pairforge.operators.select import weight_threshold
from pyspark.sql import functions as F


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def made(n, kinds, seed):
    r = random.Random(seed)
    # a third of all rows are one group
    texts = [None if r.random() < 0.05 else f"text {0 if r.random() < 0.33 else r.randrange(kinds)}" for _ in range(n)]
    return [(f"k{i}", t, r.choice(["a", "", None]), r.randrange(0, 50)) for i, t in enumerate(texts)]


def expected(rows, ratio, seed, cols, weight):
    def group(r):
        return md5("".join("-" if r[c] is None else f"{len(r[c])}:{r[c]}" for c in cols))

    size = collections.Counter()
    for r in rows:
        size[group(r)] += r[3] if weight else 1
    left, val = int(sum(size.values()) * ratio), set()
    for g in sorted(size, key=lambda g: md5(f"{seed}|{g}")):
        if size[g] > left:
            break
        left -= size[g]
        val.add(g)
    return {r[0]: "val" if group(r) in val else "train" for r in rows}


@pytest.mark.parametrize("weight", [False, True])
@pytest.mark.parametrize("ratio, seed, cols", [(0.1, 42, (1, 2)), (0.5, 1, (1,)), (0.9, 7, (1,)), (0.0, 3, (1,)), (1.0, 3, (1, 2))])
def test_group_split_is_the_plain_loops(spark, ratio, seed, cols, weight):
    rows = made(900, 250, seed)
    df = spark.createDataFrame(rows, "pair_key string, abstract string, plain_summary string, size int")
    names = [("abstract", "plain_summary")[c - 1] for c in cols]
    got = group_split(df, ratio, seed, names, weight=F.col("size") if weight else None)
    want = expected(rows, ratio, seed, cols, weight)
    assert {r["pair_key"]: r["split"] for r in got.collect()} == want
    assert {r["pair_key"]: r["split"] for r in group_split(df.repartition(7), ratio, seed, names, weight=F.col("size") if weight else None).collect()} == want
    assert leaked_groups(got, names).first()["leaked"] == 0


def test_leaks_of_the_row_split_are_counted(spark):
    rows = made(600, 40, 5)
    df = spark.createDataFrame(rows, "pair_key string, abstract string, plain_summary string, size int")
    split = train_val_split(df, 0.2, 5)
    sides = collections.defaultdict(list)
    for r in split.collect():
        sides[r["abstract"]].append(r["split"])
    leaked = [s for s in sides.values() if len(set(s)) == 2]
    got = leaked_groups(split, ("abstract",)).first()
    assert tuple(got) == (len(sides), len(leaked), sum(s.count("val") for s in leaked)) and len(leaked) > 5


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "pair_key string, abstract string, plain_summary string")
    assert group_split(none).count() == 0 and tuple(leaked_groups(group_split(none), ("abstract",)).first()) == (0, 0, 0)
    one = spark.createDataFrame([("a", "x", "y")], "pair_key string, abstract string, plain_summary string")
    assert [r["split"] for r in group_split(one, 0.5).collect()] == ["train"]
    assert [r["split"] for r in group_split(one, 1.0).collect()] == ["val"]


def test_content_key_tells_columns_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "c"), ("", "c"), ("-", "c"), ("1:a", ""), ("a", "1:"), ("ab", "c")]
    got = [r[0] for r in spark.createDataFrame(rows, "abstract string, plain_summary string").select(content_key(("abstract", "plain_summary"))).collect()]
    assert len(set(got)) == len(set(rows)) and got[0] == got[-1]


def test_threshold_inside_a_shared_prefix(spark):
    """Digests that share many characters need several passes."""
    digests = [f"abcdef0123{i:022x}" for i in range(1000)]
    rows = [(d, 1 + i % 3) for i, d in enumerate(digests) for _ in range(1 + i % 2)]
    df = spark.createDataFrame(rows, "h string, w int")
    total = 0
    for target in (0, 1, 100, 1499, 10**6):
        total, want = 0, None
        for d in digests:
            total += sum(w for h, w in rows if h == d)
            if total > target:
                break
            want = d
        assert weight_threshold(df, "h", F.col("w"), target, width=32, window_rows=50) == want
