"""JSON array files cut into many byte ranges against json.loads."""

import json
import os
import random

import pytest

from pairforge.sources.json_array import JsonArrayError, array_elements, array_index


def hostile(n, seed):
    r = random.Random(seed)
    bits = ['"', "\\", "}", "{", "[", "]", "},{", '\\"', "é", "\n", "😀", "a b", ",", "  ", '"}', "\\\\", " "]

    def text():
        return "".join(r.choice(bits) for _ in range(r.randrange(0, 30)))

    def value(depth):
        k = r.randrange(7 if depth else 5)
        if k == 5:
            return [value(depth - 1) for _ in range(r.randrange(0, 4))]
        if k == 6:
            return {text(): value(depth - 1) for _ in range(r.randrange(0, 4))}
        return [text(), r.random() * 1e6, r.randrange(-5, 5), None, True][k]

    return [{"abstract": text(), "plain_summary": text(), **{f"k{i}": value(3) for i in range(r.randrange(0, 3))}} for _ in range(n)]


@pytest.fixture()
def small_ranges(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield to
    for k, v in keep.items():
        spark.conf.set(k, v)


def read(spark, path, **options):
    rows = array_elements(spark, path, **options).collect()
    got = {}
    for r in rows:
        got.setdefault(os.path.basename(r["file_path"]), {})[r["element"]] = json.loads(r["value"])
    assert sum(map(len, got.values())) == len(rows)
    return {f: [x[i] for i in range(len(x))] for f, x in got.items()}


@pytest.mark.parametrize("layout", [{"indent": 2}, {"separators": (",", ":")}, {"indent": 1, "ensure_ascii": False}, {"ensure_ascii": False}])
def test_one_file_read_by_many_tasks(spark, small_ranges, tmp_dir, layout):
    rows = hostile(120, 3)
    path = f"{tmp_dir}/pairs.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f, **layout)
    small_ranges(max(40, os.path.getsize(path) // 37))
    assert array_index(spark, path).count() > 30
    assert read(spark, path) == {"pairs.json": rows}
    assert read(spark, path, most_ranges=0) == {"pairs.json": rows}  # joined by a shuffle


def test_folder_of_files_empty_arrays_and_white_space(spark, small_ranges, tmp_dir):
    files = {"a.json": hostile(9, 1), "b.json": [], "c.json": hostile(1, 2), "d.json": [{}], "e.json": hostile(40, 4)}
    for i, (name, rows) in enumerate(files.items()):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(" \n" * i + json.dumps(rows, indent=i or None) + "\n\t " * i)
    small_ranges(150)
    assert read(spark, tmp_dir) == {k: v for k, v in files.items() if v}


@pytest.mark.parametrize("text", ['[{"a": 1}', '{"a": 1}', '[{"a": "x}]', '[{"a": 1}]]', '[{"a": 1}, 5]', '[5, {"a": 1}]', '[{"a": 1} {"b": 2}]', '["a"]', '[{"a": 1}] x', '[[{"a": 1}]]', "", "null"])
def test_what_is_no_array_of_objects_raises(spark, tmp_dir, text):
    path = f"{tmp_dir}/bad.json"
    with open(path, "w") as f:
        f.write(text)
    if text == "":
        assert array_elements(spark, path).count() == 0  # Spark has no byte range for it
        return
    with pytest.raises(Exception, match="JSON array|not an object|expected an object"):
        array_elements(spark, path).collect()
