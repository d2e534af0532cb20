import pytest
from pyspark.sql import functions as F

from pairforge.sources.jsonl import JsonLinesError, bad_lines, load_jsonl, parse_lines

VALID = ['{"messages":[]}', '{"a":1,"a":2}', ' {"x": "y"} ', '[1, 2]', '"s"', '5']
INVALID = ['{bad', "{'a':1}", '{"a":1} x', '{"a":01}', '{"a":1}]', '{"a":1},"b":2', '{"a":"x\ty"}', 'NaN']


def parsed(spark, lines):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    return {r["i"]: r for r in parse_lines(df).collect()}


def test_valid_lines_parse(spark):
    out = parsed(spark, VALID)
    assert all(out[i]["valid"] for i in range(len(VALID)))
    df = spark.createDataFrame([('{"a":1,"a":2}',)], "value string")
    assert parse_lines(df).select(F.try_variant_get("record", "$.a", "int")).first()[0] == 2


def test_invalid_lines_rejected(spark):
    out = parsed(spark, INVALID)
    assert not any(out[i]["valid"] for i in range(len(INVALID)))


def test_blank_lines_skipped(spark):
    out = parsed(spark, ["", "  \t ", '{"a":1}'])
    assert list(out) == [2]


def _write(tmp_dir, name, lines):
    p = f"{tmp_dir}/{name}"
    with open(p, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_failfast_names_file_and_physical_line(spark, tmp_dir):
    p = _write(tmp_dir, "a.jsonl", ['{"a":1}', "", '{"a":2}', "{bad", '{"a":3}'])
    with pytest.raises(JsonLinesError, match=r"line 4 of .*a\.jsonl"):
        load_jsonl(spark, p)
    good = _write(tmp_dir, "b.jsonl", ['{"a":1}', "", '{"a":2}'])
    assert load_jsonl(spark, good).count() == 2


def test_line_numbers_across_splits(spark, tmp_dir):
    lines = []
    bad = set()
    for i in range(1, 4001):
        if i % 997 == 0:
            lines.append("{oops " + "x" * 20)
            bad.add(i)
        elif i % 13 == 0:
            lines.append("")
        else:
            lines.append('{"n": %d, "pad": "%s"}' % (i, "p" * 30))
    p = _write(tmp_dir, "big.jsonl", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = {r["line_no"] for r in bad_lines(spark, p).collect()}
        with pytest.raises(JsonLinesError, match=r"line 997 of"):
            load_jsonl(spark, p)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == bad


def test_strictness_matches_python_on_fuzzed_lines(spark):
    import json
    import random

    from pairforge.functions.text import py_strip
    from pairforge.sources.jsonl import strict_json

    rnd = random.Random(5)

    def val(d=0):
        k = rnd.randint(0, 7 if d < 3 else 5)
        if k == 0:
            return None
        if k == 1:
            return rnd.random() < 0.5
        if k == 2:
            return rnd.randint(-10**6, 10**6)
        if k == 3:
            return rnd.uniform(-1e5, 1e5)
        if k in (4, 5):
            return 'sé"\\x'
        if k == 6:
            return [val(d + 1) for _ in range(rnd.randint(0, 3))]
        return {f"k{i}": val(d + 1) for i in range(rnd.randint(0, 3))}

    alphabet = list("{}[]\":,0123456789.-+eEtrufalsn \t\\/'xé") + ["\u0001"]
    lines = []
    for _ in range(1500):
        s = json.dumps(val(), ensure_ascii=rnd.random() < 0.5)
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            op, i = rnd.random(), rnd.randint(0, len(s))
            if op < 0.4:
                s = s[:i] + rnd.choice(alphabet) + s[i:]
            elif op < 0.7:
                s = s[:i] + s[i + 1:]
            else:
                s = s[:i] + rnd.choice(alphabet) + s[i + 1:]
        lines.append(s)
    df = spark.createDataFrame(list(enumerate(lines)), "i int, v string")
    valid, _ = strict_json(py_strip("v"))
    got = {r["i"]: r["ok"] for r in df.select("i", valid.alias("ok")).collect()}

    def py_valid(s):
        try:
            json.loads(s)
            return True
        except ValueError:
            return False

    mismatches = [s for i, s in enumerate(lines) if s.strip() and got[i] != py_valid(s.strip())]
    assert mismatches == []
    assert 0 < sum(got.values()) < len(lines)
