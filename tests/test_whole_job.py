"""Steps that once put a whole table through one task, or left rows out."""

import glob
import gzip
import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pairforge.operators.pairs import json_array_source, prepare_pairs
from pairforge.plans import queries as Q
from pairforge.plans.views import pairs_doc
from pairforge.sources.splits import write_json_arrays


def test_file_sources_are_written_in_bounded_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    monkeypatch.setattr(Q, "ARRAY_ROWS", 40)
    got = Q.q_file_sources(spark, SF_SMALL).groupBy("source").count().collect()
    arrays = [json.load(gzip.open(f)) for f in glob.glob(f"{tmp_dir}/files/array/**/part-*", recursive=True)]
    n = pairs_doc(spark, SF_SMALL).count()
    assert max(map(len, arrays)) <= 40 and len(arrays) >= n / 40 and sum(map(len, arrays)) == n
    assert len(glob.glob(f"{tmp_dir}/files/a/part-*")) > 1 and len(glob.glob(f"{tmp_dir}/files/b/*/part-*")) > 4
    docs = pairs_doc(spark, SF_SMALL).filter((F.length(F.trim("Source")) > 50) & (F.length(F.trim("Target")) > 50))
    assert {r["source"]: r["count"] for r in got}["array"] == docs.count()


def test_array_folder_keeps_order_and_keys(spark, tmp_dir):
    # ids with gaps, and one id on more rows than a file takes
    ids = sorted([*range(-3, 25), *range(995, 1105), *[50] * 23])
    rows = [(i, f"{k:06d} " + "a" * 60, "b" * 60) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id bigint, abstract string, plain_summary string").repartition(5)
    write_json_arrays(df, "doc_id", f"{tmp_dir}/arrays", 10)
    assert max(len(json.load(gzip.open(f))) for f in glob.glob(f"{tmp_dir}/arrays/**/part-*", recursive=True)) == 10
    seen = []
    for size in ("128m", "1k"):
        old = spark.conf.get("spark.sql.files.openCostInBytes")
        spark.conf.set("spark.sql.files.openCostInBytes", size)
        try:
            pairs = prepare_pairs(json_array_source(spark, "array", f"{tmp_dir}/arrays")).orderBy("o_part", "o_file", "o_row").collect()
        finally:
            spark.conf.set("spark.sql.files.openCostInBytes", old)
        seen.append([(r["pair_key"], r["abstract"]) for r in pairs])
    assert seen[0] == seen[1] and len({k for k, _ in seen[0]}) == len(rows)
    of = {a: i for i, a, _ in rows}
    assert [of[a] for _, a in seen[0] if of[a] >= 0] == [i for i in ids if i >= 0]


def test_bad_lines_are_counted_through_sorted_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    got = sorted((r["line_no"], r["value"]) for r in Q.q_bad_lines(spark, SF_SMALL).collect())
    assert len(glob.glob(f"{tmp_dir}/hostile/part-*")) > 1
    lines = Q.hostile_props(spark, SF_SMALL).orderBy("line_no").collect()
    cut = [(k, r["value"]) for k, r in enumerate(lines, 1) if (r["line_no"] - 1) % 5 == 2 and r["value"].strip()]
    assert got == cut
