"""The incremental report equals the full one after files come, change and go."""

import json
import os
import random

import pytest

from pairforge.plans.check import check_split_files
from pairforge.plans.report_ledger import entries, report, update
from pairforge.sources.jsonl import JsonLinesError


def write(path, seed, n):
    r = random.Random(seed)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for _ in range(n):
            roles = r.choice([["system", "user", "assistant"]] * 4 + [["user", "system", "assistant"], ["user"], ["system", "tool", "assistant", "user"]])
            record = {"messages": [{"role": x, "content": " ".join(["w"] * r.choice([0, 1, 2, 5, 9, 40]))} for x in roles]}
            f.write(r.choice(["", "\n", " \t\n"]) + json.dumps(r.choice([record] * 9 + [{"body": 1}])) + "\n")


def same(spark, out, ledger):
    a, b = (sorted(map(tuple, x.collect())) for x in (report(spark, out, ledger), check_split_files(spark, out)))
    assert a == b
    return a


def test_equal_to_the_full_report(spark, tmp_dir):
    out, ledger = f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    for i in range(4):
        write(f"{out}/split=train/f{i}.json", i, 17 + i)
    assert len(update(spark, out, ledger)) == 4
    first = same(spark, out, ledger)
    assert [r[0] for r in first] == ["train", "val"] and first[1][3] == "missing"
    assert update(spark, out, ledger) == []
    write(f"{out}/split=val/f9.json", 9, 30)
    with open(f"{out}/split=train/empty.json", "w") as f:
        f.write("\n \n")  # Spark lists no files of length 0
    assert [os.path.basename(f) for f in update(spark, out, ledger)] == ["empty.json", "f9.json"]
    assert same(spark, out, ledger) != first and update(spark, out, ledger) == []
    write(f"{out}/split=train/f2.json", 77, 25)  # another length
    assert [os.path.basename(f) for f in update(spark, out, ledger)] == ["f2.json"]
    same(spark, out, ledger)
    os.remove(f"{out}/split=train/f0.json")
    assert update(spark, out, ledger) == []
    same(spark, out, ledger)


def test_an_update_that_was_done_twice_counts_once(spark, tmp_dir):
    out, ledger = f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    write(f"{out}/split=train/a.json", 3, 20)
    update(spark, out, ledger)
    rows = spark.read.parquet(ledger)
    rows.selectExpr("* EXCEPT (batch)", "'zz' AS batch").write.mode("append").parquet(ledger)
    assert entries(spark, ledger).count() == rows.select("file_path", "role", "wc").distinct().count()
    same(spark, out, ledger)


def test_bad_lines_are_raised_and_missing_folders_reported(spark, tmp_dir):
    out, ledger = f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    assert {r["status"] for r in report(spark, out, ledger).collect()} == {"missing"}
    write(f"{out}/split=train/a.json", 3, 5)
    with open(f"{out}/split=train/b.json", "w") as f:
        f.write("{}\n\n{bad\n")
    update(spark, out, ledger)
    with pytest.raises(JsonLinesError, match="line 3 of .*b.json"):
        report(spark, out, ledger).collect()
