import json

from pyspark.sql import functions as F

from pairforge.operators.validate import typed_record, validate_records
from pairforge.plans import build as B
from pairforge.sources.splits import path_report, read_json_array, read_splits
from tests.conftest import SF_SMALL


def test_missing_input_report(spark, tmp_dir):
    p = f"{tmp_dir}/there.json"
    open(p, "w").write("[]")
    out = {r["path"]: r["status"] for r in path_report(spark, [p, f"{tmp_dir}/nope.json"]).collect()}
    assert out == {p: "ok", f"{tmp_dir}/nope.json": "missing"}
    assert read_json_array(spark, f"{tmp_dir}/nope.json") is None


def test_json_array_source(spark, tmp_dir):
    p = f"{tmp_dir}/pairs.json"
    with open(p, "w", encoding="utf-8") as f:
        json.dump([{"abstract": "é" * 3, "plain_summary": "b"}, {"abstract": "c", "plain_summary": "d"}], f, indent=2, ensure_ascii=False)
    rows = read_json_array(spark, p).collect()
    assert [r["abstract"] for r in rows] == ["ééé", "c"]


def test_build_writes_valid_splits(spark, tmp_dir):
    import glob

    from pairforge.session import checkpoint_root

    root = checkpoint_root(spark).replace("file:", "")
    before = set(glob.glob(root + "/pairforge/pairs-*"))
    out = f"{tmp_dir}/splits"
    counts = {r["split"]: (r["records"], r["status"]) for r in B.run_build(spark, B.default_sources(spark, SF_SMALL), out).collect()}
    # the intermediate union table is removed once the splits are written
    assert set(glob.glob(root + "/pairforge/pairs-*")) - before == set()
    back = read_splits(spark, out)
    got = {r["split"]: r["count"] for r in back.groupBy("split").count().collect()}
    assert got == {k: v[0] for k, v in counts.items() if v[0]}
    n = sum(v[0] for v in counts.values())
    assert counts["val"][0] == int(n * 0.1)
    bad = validate_records(back.select(typed_record(F.col("messages")).alias("record"))).filter(F.size("problems") > 0)
    assert bad.count() == 0


def test_entry_smoke(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "val"}
    assert set(E.oracle_sql()) <= set(E.queries())


def test_pair_files_feed_the_build(spark, tmp_dir):
    from pairforge.operators.pairs import json_array_source, union_sources

    a = f"{tmp_dir}/first_pairs.json"
    pairs = [{"abstract": f"technical text number {i} " + "t" * 40, "plain_summary": f"plain {i} " + "p" * 50} for i in range(12)]
    with open(a, "w", encoding="utf-8") as f:
        json.dump(pairs, f, indent=2, ensure_ascii=False)
    srcs = [json_array_source(spark, "first", a), json_array_source(spark, "second", f"{tmp_dir}/missing.json")]
    assert srcs[1] is None  # missing file skipped
    u = union_sources([s for s in srcs if s is not None])
    got = [r["abstract"] for r in u.orderBy("o_row").collect()]
    assert got == [p["abstract"] for p in pairs]
    res = B.build_records([s for s in srcs if s is not None], checkpoint=True)
    counts = {r["split"]: r["records"] for r in B.split_counts(res.records).collect()}
    assert counts == {"train": 11, "val": 1}


def test_pair_keys_are_unique_on_partitioned_parquet(spark, tmp_dir):
    from pairforge.operators.pairs import parquet_source
    from pairforge.operators.sampling import train_val_split

    text = "q" * 60
    df = spark.createDataFrame([(f"{text} {i}", f"{text} {i}", i % 2) for i in range(40)], "abstract string, summary string, p int")
    df.coalesce(1).write.partitionBy("p").parquet(f"{tmp_dir}/t")
    for cap in (None, 40, 33):
        src = parquet_source(spark, "s", [f"{tmp_dir}/t"], cap=cap)
        pairs = B.union_sources([src])
        assert pairs.select("pair_key").distinct().count() == pairs.count() == (cap or 40)
        n = pairs.count()
        assert train_val_split(pairs, 0.125).filter("split = 'val'").count() == int(n * 0.125)


def test_selection_fetches_small_windows_only(spark, monkeypatch):
    from pairforge.operators import select

    sizes = []
    fetch = select._fetch_sorted
    monkeypatch.setattr(select, "_fetch_sorted", lambda df, cols, n: sizes.append(n) or fetch(df, cols, n))
    df = spark.range(20000).selectExpr("id", "md5(cast(id as string)) as h").cache()
    ids = sorted((r["h"], r["id"]) for r in df.collect())
    assert select.kth_key(df, ["id"], 7000) == (6999,)
    assert select.kth_hex_key(df, "h", ["id"], 1234, width=32) == ids[1233]
    assert sizes and max(sizes) <= select.WINDOW_ROWS


def test_build_drops_its_scratch_table(spark, tmp_dir):
    from pairforge.session import checkpoint_root, path_exists

    res = B.build_records(B.default_sources(spark, SF_SMALL))
    assert res.path.startswith(checkpoint_root(spark)) and path_exists(spark, res.path)
    before = res.path.rsplit("/", 1)[0]
    import os

    local = before.removeprefix("file:")
    n = len(os.listdir(local))
    B.run_build(spark, B.default_sources(spark, SF_SMALL), f"{tmp_dir}/s")
    assert len(os.listdir(local)) == n


def test_intermediate_data_needs_a_shared_folder_on_a_cluster():
    import pytest

    from pairforge.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Ctx(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
