"""Lines beyond the JSON parser's limits are told apart from lines that are not JSON."""

import random

import pytest

from pairforge.sources.jsonl import INVALID, TOO_LONG, JsonLinesError, bad_lines, load_jsonl, parse_lines

DIGITS = "123456789" * 200
CASES = [
    ("[" * 1500 + "1" + "]" * 1500, TOO_LONG),
    ('{"a":' * 1500 + "null" + "}" * 1500, TOO_LONG),
    ('{"a": ' + DIGITS + "}", TOO_LONG),
    ('{"a": -' + DIGITS + "." + DIGITS + "e" + "5" * 3 + "}", TOO_LONG),
    ('{"' + "n\\u00e9" * 30_000 + '": 1}', TOO_LONG),
    ("[" * 1500 + "1" + "]" * 1499, INVALID),
    ("[" * 1500 + "1" + "]" * 1500 + "]", INVALID),
    ('{"k": [1, "s", {"a": [true, null, -0.5e-3]}], "b": ' + '[{"q" : ' * 700 + "[ ]" + "} ,{}, 1]" * 700 + "}", TOO_LONG),
    ('{"k": [1, "s", {"a": [true, null, -0.5e-3]}], "b": ' + '[{"q" : ' * 700 + "[ ]" + "} ,{}, 01]" * 700 + "}", INVALID),
    ('{"k": 1, "b": ' + '[{"q" : ' * 700 + "[ ]" + "} {}]" * 700 + "}", INVALID),
    ("[" * 1200 + "{[]: 1}" + "]" * 1200, INVALID),
    ("[" * 1200 + ", ".join(["1"] * 30_000) + "]" * 1200, TOO_LONG),
    ('{"a": 0' + DIGITS + "}", INVALID),
    ('{"a": ' + DIGITS + "x}", INVALID),
    ('{"' + "n" * 60_000 + "\t" + '": 1}', INVALID),
    ('{"' + "n" * 60_000 + "\\q" + '": 1}', INVALID),
    ('{"' + "n" * 60_000 + ": 1}", INVALID),
    ("{'" + "n" * 60_000 + "': 1}", INVALID),
    ('{"a": "' + "t\\n" * 30_000 + '"}', None),
    ("[" * 900 + '"' + "]" * 2000 + '"' + "]" * 900, None),
    ('{"a": ' + "9" * 900 + "}", None),
]


def test_statuses(spark, tmp_dir):
    order = list(range(len(CASES)))
    random.Random(1).shuffle(order)
    with open(f"{tmp_dir}/lines.jsonl", "w") as f:
        f.write("\n".join(CASES[i][0] for i in order))
    got = {r["line_no"]: r["status"] for r in bad_lines(spark, f"{tmp_dir}/lines.jsonl").collect()}
    assert got == {n + 1: CASES[i][1] for n, i in enumerate(order) if CASES[i][1]}


def test_the_first_bad_line_is_named(spark, tmp_dir):
    with open(f"{tmp_dir}/deep.jsonl", "w") as f:
        f.write('{"a": 1}\n\n' + CASES[0][0] + "\n{bad\n")
    with pytest.raises(JsonLinesError, match="JSON too long to parse on line 3"):
        load_jsonl(spark, f"{tmp_dir}/deep.jsonl")


def test_short_lines_have_no_such_status(spark):
    rows = parse_lines(spark.createDataFrame([("{bad",), ('{"a":1}',), ("[" * 20,)], "value string")).collect()
    assert [(r["valid"], r["too_long"]) for r in rows] == [(False, False), (True, False), (False, False)]
