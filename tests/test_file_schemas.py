"""Folders of Parquet files whose schemas differ, against a plain loop over them."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pairforge.operators.pairs import parquet_source, prepare_pairs, union_sources
from pairforge.sources.parquet import ColumnPickError, resolve_columns, scan_texts, schema_groups

LONG = "a technical text that is certainly longer than fifty characters, number"


def write(path, **columns):
    pq.write_table(pa.table(columns), path)


@pytest.fixture()
def mixed(tmp_dir):
    write(f"{tmp_dir}/f0.parquet", id=[1, 2])
    write(f"{tmp_dir}/f1.parquet", Query=[f"{LONG} 1", None], Answer=[f"{LONG} A", f"{LONG} B"], id=[3, 4])
    write(f"{tmp_dir}/f2.parquet", Query=pa.array([12, 10**17], pa.int64()), Answer=[f"{LONG} C", f"{LONG} D"], id=["x", "y"])
    write(f"{tmp_dir}/f3.parquet", answer=[f"{LONG} E"], query=[f"{LONG} 3"], Source=[f"{LONG} S"], target=[f"{LONG} T"])
    write(f"{tmp_dir}/f4.parquet", Query=[f"{LONG} 4"], other=[1.5])
    write(f"{tmp_dir}/f5.parquet", Query=pa.array([True]), Answer=pa.array([2.5]), id=[9])
    return tmp_dir


def rows_of(pairs):
    return [(r["abstract"], r["plain_summary"]) for r in pairs.orderBy("o_part", "o_file", "o_row").collect()]


def test_columns_come_from_the_first_file_that_has_them(spark, mixed):
    assert resolve_columns(spark, [mixed]) == ("Query", "Answer")
    assert resolve_columns(spark, [f"{mixed}/f3.parquet", mixed]) == ("Source", "target")
    with pytest.raises(ColumnPickError, match="id"):
        resolve_columns(spark, [f"{mixed}/f0.parquet", f"{mixed}/f4.parquet"])


def test_types_are_reconciled_file_by_file(spark, mixed):
    got = rows_of(prepare_pairs(parquet_source(spark, "m", [mixed]), min_chars=0))
    want = [(f"{LONG} 1", f"{LONG} A"), ("12", f"{LONG} C"), (str(10**17), f"{LONG} D"), (f"{LONG} 3", f"{LONG} E"), ("true", "2.5")]
    assert got == want
    assert rows_of(union_sources([parquet_source(spark, "m", [mixed])])) == [want[0], want[3]]


@pytest.mark.parametrize("cap", [1, 2, 3, 4, 5, 9])
def test_cap_goes_through_the_same_files(spark, mixed, cap):
    whole = rows_of(prepare_pairs(parquet_source(spark, "m", [mixed]), min_chars=0))
    assert rows_of(union_sources([parquet_source(spark, "m", [mixed], cap=cap)], min_chars=0)) == whole[:cap]


def test_one_scan_for_each_combination_of_types(spark, mixed):
    files = [f"{mixed}/f{i}.parquet" for i in range(6)]
    groups = list(schema_groups(spark, files))
    assert [f for _, g in groups for f in g] == files and 1 < len(groups) <= 6
    plan = scan_texts(spark, [mixed], ("Query", "Answer"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len({tuple(s[c].dataType.simpleString() if c in s.fieldNames() else None for c in ("Query", "Answer")) for s, _ in groups})


def test_lists_are_no_texts(spark, mixed):
    write(f"{mixed}/f6.parquet", Query=[["a"]], Answer=["b"])
    with pytest.raises(TypeError, match="Query"):
        parquet_source(spark, "m", [mixed])


def test_order_and_place_of_rows(spark, mixed):
    rows = scan_texts(spark, [f"{mixed}/f2.parquet", mixed], ("Query", "Answer")).orderBy("path_ord", "file_path", "row_index").collect()
    assert [(r["path_ord"], r["rel_path"], r["row_index"]) for r in rows][:4] == [(0, "f2.parquet", 0), (0, "f2.parquet", 1), (1, "f0.parquet", 0), (1, "f0.parquet", 1)]
    assert len(rows) == 2 + 9
