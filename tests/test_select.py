import random

from pyspark.sql import functions as F

from pairforge.operators.select import kth_digest, kth_hex_key, kth_key


def test_kth_key_matches_sort_on_sampling_path(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 5), rnd.choice(["a", "b", "c"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "p int, f string, r long").repartition(7)
    ordered = sorted(rows)
    for k in (1, 2, 17, 1500, 2999):
        got = kth_key(df, ["p", "f", "r"], k, window_rows=50, sample_rows=200)
        assert got == ordered[k - 1], k
    assert kth_key(df, ["p", "f", "r"], 3000, window_rows=50) is None


def test_kth_hex_key_matches_sort(spark):
    df = spark.range(5000).select(F.md5(F.concat(F.lit("42|"), F.col("id").cast("string"))).alias("h"), F.col("id").cast("string").alias("k"))
    rows = sorted(tuple(r) for r in df.collect())
    for k in (1, 499, 2500, 4999):
        assert kth_hex_key(df, "h", ["k"], k, window_rows=20) == rows[k - 1]


def test_kth_hex_key_with_colliding_digests(spark):
    # 400 rows share one digest: the tie column decides
    df = spark.range(400).select(F.lit("ab" * 16).alias("h"), F.format_string("%05d", F.col("id")).alias("k"))
    assert kth_hex_key(df, "h", ["k"], 123, window_rows=30) == ("ab" * 16, "00122")


def test_kth_digest_counts_the_rows_of_the_threshold(spark):
    # digests of 1 to 40 rows each, and one of 400
    n = F.when(F.col("id") == 7, 400).otherwise(F.pmod("id", F.lit(40)) + 1)
    df = spark.range(120).withColumn("i", F.explode(F.sequence(F.lit(1), n))).select(F.md5(F.col("id").cast("string")).alias("h"))
    rows = sorted(r["h"] for r in df.collect())
    hot = rows.index(max(set(rows), key=rows.count))
    for k in (1, 55, hot, hot + 1, hot + 200, hot + 400, hot + 401, len(rows) - 1):
        assert kth_digest(df, "h", k, window_rows=30) == (rows[k - 1], k - rows.index(rows[k - 1])), k
    assert kth_digest(df, "h", len(rows)) is None


def test_kth_key_with_a_hot_prefix(spark):
    # one file (o_part 1) holds two thirds of all rows; selection stays exact
    rows = [(0, "a", i) for i in range(300)] + [(1, "b", i) for i in range(2000)] + [(2, "c", i) for i in range(700)]
    df = spark.createDataFrame(rows, "p int, f string, r long").repartition(9)
    ordered = sorted(rows)
    for k in (299, 300, 301, 1234, 2300, 2301, 2999):
        assert kth_key(df, ["p", "f", "r"], k, window_rows=40, sample_rows=150) == ordered[k - 1], k
