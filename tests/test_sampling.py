from pyspark.sql import functions as F

from pairforge.operators.sampling import subsample_k, train_val_split, val_size


def keyed(spark, n, parts=4):
    return spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("pair_key")).repartition(parts)


def test_val_size_like_python():
    assert [val_size(n, 0.1) for n in (9, 10, 100)] == [0, 1, 10]
    assert val_size(100, 0.29) == 28 == int(100 * 0.29)


def test_split_exact_disjoint_and_partition_independent(spark):
    for n, ratio in ((9, 0.1), (10, 0.1), (100, 0.1), (100, 0.29), (2345, 0.1)):
        a = {r["pair_key"]: r["split"] for r in train_val_split(keyed(spark, n, 3), ratio).collect()}
        b = {r["pair_key"]: r["split"] for r in train_val_split(keyed(spark, n, 11), ratio).collect()}
        assert a == b
        assert len(a) == n
        assert sum(v == "val" for v in a.values()) == int(n * ratio)


def test_split_is_seeded_prefix_of_permutation(spark):
    import hashlib

    n = 500
    got = {r["pair_key"] for r in train_val_split(keyed(spark, n), 0.1).filter("split = 'val'").collect()}
    order = sorted((hashlib.md5(f"42|k{i}".encode()).hexdigest(), f"k{i}") for i in range(n))
    assert got == {k for _, k in order[:50]}


def test_subsample_exact(spark):
    split = train_val_split(keyed(spark, 1000), 0.1)
    out = subsample_k(split, {"train": 300, "val": 50}).groupBy("split").count().collect()
    assert dict((r[0], r[1]) for r in out) == {"train": 300, "val": 50}
    small = subsample_k(split, {"train": 5000, "val": 0}).groupBy("split").count().collect()
    assert dict((r[0], r[1]) for r in small) == {"train": 900}


def test_split_exact_for_random_sizes_and_ratios(spark):
    import random

    rnd = random.Random(3)
    cases = [(0, 0.1), (1, 0.5)] + [(rnd.randint(2, 700), rnd.choice([0.05, 0.1, 0.29, 0.33, 0.5, 0.99])) for _ in range(4)]
    for n, ratio in cases:
        got = train_val_split(keyed(spark, n, rnd.randint(1, 9)), ratio).groupBy("split").count().collect()
        counts = {r[0]: r[1] for r in got}
        assert counts.get("val", 0) == int(n * ratio), (n, ratio)
        assert counts.get("train", 0) == n - int(n * ratio), (n, ratio)
