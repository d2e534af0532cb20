"""Lines beyond a parser's limits are told apart from lines that are not JSON."""

import os

import pytest
from pyspark.sql import functions as F

from pairforge.operators.validate import problem_text, validate_records, validation_summary
from pairforge.sources.jsonl import INVALID, TOO_LONG, JsonLinesError, bad_lines, load_jsonl, parse_lines
from pairforge.streaming.validate_stream import validate_files_once


def record(n):
    return '{"messages":[{"role":"system","content":"s"},{"role":"user","content":"' + "x" * n + '"},{"role":"assistant","content":"a"}]}'


def write(folder, lines):
    os.makedirs(folder)
    with open(f"{folder}/a.json", "w") as f:
        for line in lines:
            f.write(line + "\n")


def test_a_long_string_is_a_valid_record(spark, tmp_dir):
    write(f"{tmp_dir}/split=train", [record(30_000_000), record(30_000_000) + "]", record(5)])
    rows = validate_records(parse_lines(spark.read.text(f"{tmp_dir}/split=train"))).select("valid", "too_long", F.size("problems").alias("n"))
    assert sorted(map(tuple, rows.collect())) == [(False, False, 1), (True, False, 0), (True, False, 0)]


def test_too_long_is_a_status_of_its_own(spark, tmp_dir):
    write(f"{tmp_dir}/in/split=train", [record(5), record(140_000_000), "{bad"])
    path = f"{tmp_dir}/in/split=train"
    assert {r["line_no"]: r["status"] for r in bad_lines(spark, path).select("line_no", "status").collect()} == {2: TOO_LONG, 3: INVALID}
    with pytest.raises(JsonLinesError, match=r"too long to parse on line 2 of"):
        load_jsonl(spark, path)
    v = validate_records(load_jsonl(spark, path, mode="collect")).withColumn("file", F.lit("f"))
    assert v.filter("too_long").select(problem_text(F.col("problems"))).first()[0] == TOO_LONG
    r = validation_summary(v, "file", with_bad_json=True).first()
    assert (r["records"], r["invalid"], r["bad_json"], r["too_long"]) == (1, 0, 1, 1)
    s = validate_files_once(spark, f"{tmp_dir}/in", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt").first()
    assert (s["records"], s["invalid"], s["too_long"]) == (3, 1, 1)
