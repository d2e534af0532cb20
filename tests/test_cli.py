import json
import os

from pairforge.__main__ import main

L51 = "q" * 51


def test_build_then_check(spark, tmp_dir, capsys):
    src = f"{tmp_dir}/src.parquet"
    rows = [(f"{L51} {i}", f"{L51} plain {i}") for i in range(40)] + [("short", L51)]
    spark.createDataFrame(rows, "Abstract string, Target string").coalesce(2).write.parquet(src)
    out = f"{tmp_dir}/splits"
    assert main(["build", "--source", f"one={src}:cap=30", "--out", out], spark=spark) == 0
    text = capsys.readouterr().out
    assert "train: 27 records" in text and "val: 3 records" in text
    # add a file with one damaged record (sorted first, so it is record 0)
    part = next(os.path.join(out, "split=train", f) for f in sorted(os.listdir(f"{out}/split=train")) if f.endswith(".json"))
    with open(part, encoding="utf-8") as f:
        rec = json.loads(f.readline())
    rec["messages"] = rec["messages"][1:]
    with open(os.path.join(out, "split=train", "a-extra.json"), "w", encoding="utf-8") as f:
        f.write(json.dumps(rec) + "\n")
    main(["check", out], spark=spark)
    text = capsys.readouterr().out
    assert "split train: 28 records, 1 with problems" in text and "split val: 3 records, 0 with problems" in text
    assert "at 0: unexpected role order: ['user', 'assistant']" in text
    assert "first training record:" in text
    main(["check", f"{tmp_dir}/nope"], spark=spark)
    text = capsys.readouterr().out
    assert "split train: 0 records" in text and "missing" in text


def test_source_spec_takes_uris_and_trailing_options():
    from pairforge.__main__ import split_spec

    assert split_spec("a=hdfs://n:8020/x,s3a://b/y:cap=5:truncate=7") == ("a=hdfs://n:8020/x,s3a://b/y", {"truncate": 7, "cap": 5})
    assert split_spec("a=file:///x/y.parquet:enabled=no") == ("a=file:///x/y.parquet", {"enabled": False})
    assert split_spec("a=s3a://b/c") == ("a=s3a://b/c", {})


def test_build_from_a_uri_and_report_of_an_empty_split(spark, tmp_dir, capsys):
    src = f"{tmp_dir}/src.parquet"
    spark.createDataFrame([(f"{L51} {i}", f"{L51} p {i}") for i in range(6)], "abstract string, target string").write.parquet(src)
    out = f"{tmp_dir}/splits"
    main(["build", "--source", f"one=file://{src}", "--source", f"two={src}:enabled=no", "--json-source", f"x={tmp_dir}/none.json", "--out", out], spark=spark)
    assert "skipped, not found" in capsys.readouterr().out
    main(["check", out], spark=spark)
    text = capsys.readouterr().out
    assert "split train: 6 records" in text and "split val: 0 records, 0 with problems (missing)" in text


def test_rewrite(spark, tmp_dir, capsys):
    src = f"{tmp_dir}/docs.parquet"
    spark.createDataFrame([(1, "A  b. C"), (2, "  ")], "doc_id long, text string").write.parquet(src)
    out = f"{tmp_dir}/rw"
    main(["rewrite", "--input", src, "--out", out], spark=spark)
    got = {r["doc_id"]: (r["before"], r["after"]) for r in spark.read.parquet(out).collect()}
    assert got[1] == ("A b. C", "A b.\nC")
    assert got[2][0] == ""


def test_subsample_files_exact_and_stable(spark, tmp_dir, capsys):
    import glob
    import hashlib

    from pairforge.plans.subsample import subsample_files

    src = f"{tmp_dir}/src.parquet"
    rows = [(f"{L51} {i}", f"{L51} plain {i}") for i in range(120)]
    spark.createDataFrame(rows, "abstract string, summary string").repartition(3).write.parquet(src)
    out = f"{tmp_dir}/splits"
    main(["build", "--source", f"one={src}", "--out", out], spark=spark)
    capsys.readouterr()
    kept = {r["split"]: r["records"] for r in subsample_files(spark, out, f"{tmp_dir}/sub", {"train": 25, "val": 5}).collect()}
    assert kept == {"train": 25, "val": 5}
    # the kept lines are the first of the seeded permutation, in its order
    def in_order(path, split):
        files = sorted(glob.glob(f"{path}/split={split}/part-*"))
        return [x for f in files for x in open(f, encoding="utf-8").read().splitlines()]

    for split, n in (("train", 25), ("val", 5)):
        lines = in_order(out, split)
        assert len(lines) == {"train": 108, "val": 12}[split]
        first = sorted(lines, key=lambda v: hashlib.md5(f"42|{v}".encode()).hexdigest())[:n]
        assert in_order(f"{tmp_dir}/sub", split) == first
    # and do not depend on the split size Spark reads with
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        subsample_files(spark, out, f"{tmp_dir}/sub-small", {"train": 25, "val": 5}).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for split in ("train", "val"):
        assert in_order(f"{tmp_dir}/sub-small", split) == in_order(f"{tmp_dir}/sub", split)
    main(["subsample", out, "--out", f"{tmp_dir}/sub2", "--size", "train=7"], spark=spark)
    assert "train: 7 records" in capsys.readouterr().out


def test_subsample_with_one_line_in_most_rows(spark):
    import hashlib
    from collections import Counter

    from pairforge.plans.subsample import first_lines

    texts = ["the same"] * 900 + [f"line {i}" for i in range(300)] + ["twice"] * 2
    lines = spark.createDataFrame([("train", t) for t in texts], "split string, value string").repartition(5)
    ordered = sorted(texts, key=lambda v: hashlib.md5(f"42|{v}".encode()).hexdigest())
    at = ordered.index("the same")
    for n in (0, 1, at, at + 1, at + 450, at + 900, at + 901, 1201, 1202, 5000):
        got = Counter(r["value"] for r in first_lines(lines, n).collect())
        assert got == Counter(ordered[:n]), n


def test_check_raises_on_a_line_that_is_not_json(spark, tmp_dir, capsys):
    import pytest

    from pairforge.sources.jsonl import JsonLinesError

    src = f"{tmp_dir}/src.parquet"
    spark.createDataFrame([(f"{L51} {i}", f"{L51} p {i}") for i in range(12)], "abstract string, target string").write.parquet(src)
    out = f"{tmp_dir}/splits"
    main(["build", "--source", f"one={src}", "--out", out], spark=spark)
    with open(os.path.join(out, "split=val", "a-extra.json"), "w", encoding="utf-8") as f:
        f.write('{"messages": []}\n\n{broken\n')
    with pytest.raises(JsonLinesError, match=r"line 3 of .*a-extra\.json"):
        main(["check", out], spark=spark)


def test_build_together_and_versioned(spark, tmp_dir, capsys):
    from pairforge.sources.splits import read_splits
    from pairforge.sources.versions import resolve

    src, out = f"{tmp_dir}/src.parquet", f"{tmp_dir}/out"
    rows = [(f"{L51} {i % 8}", f"{L51} plain {i}") for i in range(80)]
    spark.createDataFrame(rows, "abstract string, target string").write.parquet(src)
    for ratio in ("0.4", "0.3"):
        main(["build", "--source", f"one={src}", "--out", out, "--val-ratio", ratio, "--together", "input", "--versioned"], spark=spark)
    assert "val: 20 records" in capsys.readouterr().out  # 24 do not hold a third group of ten
    sides = {}
    for r in read_splits(spark, resolve(spark, out)).collect():
        sides.setdefault(r["messages"][1]["content"], set()).add(r["split"])
    assert len(sides) == 8 and all(len(s) == 1 for s in sides.values())
    first = read_splits(spark, resolve(spark, out, 1))
    assert first.filter("split = 'val'").count() == 30
