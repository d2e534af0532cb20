from pyspark.sql import functions as F

from pairforge.operators.validate import length_stats, problem_head, validate_records, validation_summary
from pairforge.sources.jsonl import parse_lines


def problems(spark, lines):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    return {r["i"]: list(r["problems"]) for r in validate_records(parse_lines(df)).collect()}


def rec(*msgs):
    import json

    return json.dumps({"messages": list(msgs)})


def m(role, content="ok"):
    return {"role": role, "content": content}


def test_reference_problems(spark):
    out = problems(
        spark,
        [
            "{}",
            rec(m("system"), m("user"), m("assistant")),
            rec(m("user"), m("system"), m("assistant")),
            rec(m("system"), m("user"), m("assistant"), m("user")),
            rec(m("system"), {"content": "x"}, m("assistant")),
            rec(m("system"), m("user", " \n"), {"role": "assistant"}),
        ],
    )
    assert out[0] == ["missing 'messages' key"]
    assert out[1] == []
    assert out[2] == ["unexpected role order: ['user', 'system', 'assistant']"]
    assert out[3] == ["unexpected role order: ['system', 'user', 'assistant', 'user']"]
    assert out[4] == ["unexpected role order: ['system', None, 'assistant']"]
    assert out[5] == ["empty content for role 'user'", "empty content for role 'assistant'"]


def test_wrong_types_reported_not_raised(spark):
    out = problems(
        spark,
        [
            '{"messages": null}',
            '{"messages": ["hi"]}',
            rec(m("system", None), m("user", 5), m("assistant")),
            "[1]",
            "5",
        ],
    )
    assert out[0] == ["'messages' is not a list"]
    assert out[1] == ["unexpected role order: [None]", "empty content for role 'None'"]
    assert out[2] == ["empty content for role 'system'", "non-string content for role 'user'"]
    assert out[3] == ["missing 'messages' key"]
    assert out[4] == ["missing 'messages' key"]


def test_problem_head_first_five_and_more(spark):
    lines = []
    for i in range(12):
        lines.append("{}" if i % 3 != 2 else rec(m("system"), m("user"), m("assistant")))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i long, value string")
    head = problem_head(validate_records(parse_lines(df)), ["i"], 5).orderBy("idx").collect()
    bad = [i for i in range(12) if i % 3 != 2]
    assert [r["idx"] for r in head] == bad[:5]
    assert {r["more"] for r in head} == {len(bad) - 5}
    assert head[0]["problems"] == "missing 'messages' key"


def test_length_stats_upper_median_floor_mean(spark):
    lines = [rec(m("system"), m("user", " ".join(["w"] * n)), m("assistant", "a b")) for n in (1, 2, 3, 4)]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    st = {r["role"]: r for r in length_stats(parse_lines(df)).collect()}
    u = st["user"]
    assert (u["n"], u["min_words"], u["median_words"], u["max_words"], u["mean_words"]) == (4, 1, 3, 4, 2)
    empty = spark.createDataFrame([(rec(m("system")),)], "value string")
    st = {r["role"]: r for r in length_stats(parse_lines(empty)).collect()}
    assert st["user"]["n"] == 0 and st["user"]["median_words"] is None


def test_validation_summary(spark):
    rows = [("train", rec(m("system"), m("user", "a b c"), m("assistant", "d"))), ("val", "{}")]
    df = spark.createDataFrame(rows, "file string, value string")
    out = {r["file"]: r for r in validation_summary(validate_records(parse_lines(df)), "file").collect()}
    assert out["train"]["status"] == "all records valid"
    assert out["train"]["user_words"] == "min=3, median=3, max=3, mean=3"
    assert out["val"]["status"] == "PROBLEMS found in 1 records"
    assert out["val"]["user_words"] == "no data"


def test_typed_and_variant_paths_agree(spark):
    from pairforge.operators.validate import typed_record

    rows = [
        (1, [("system", "s"), ("user", "u"), ("assistant", "a")]),
        (2, [("user", "u"), ("system", " ")]),
        (3, [(None, "x"), ("user", None), ("assistant", "a b")]),
        (4, []),
    ]
    df = spark.createDataFrame(rows, "i int, messages array<struct<role:string,content:string>>")
    typed = {r["i"]: list(r["problems"]) for r in validate_records(df, "messages").collect()}
    var = {r["i"]: list(r["problems"]) for r in validate_records(df.select("i", typed_record(F.col("messages")).alias("record"))).collect()}
    assert typed == var
    assert typed[3] == ["unexpected role order: [None, 'user', 'assistant']", "empty content for role 'user'"]
    st_t = sorted(tuple(r) for r in length_stats(df, "messages").collect())
    st_v = sorted(tuple(r) for r in length_stats(df.select(typed_record(F.col("messages")).alias("record"))).collect())
    assert st_t == st_v


def test_token_budget_with_a_tokenizer_file(spark, tmp_dir):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from pairforge.operators.chat import ChatTemplate
    from pairforge.operators.token_limit import tokenizer_counter
    from pairforge.operators.validate import token_budget

    vocab = {"[UNK]": 0, "a": 1, "b": 2, "c": 3}
    tok = Tokenizer(models.WordLevel(vocab, unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    path = f"{tmp_dir}/tokenizer.json"
    tok.save(path)
    rows = [("train", [("user", "a b c"), ("assistant", "a")]), ("train", [("user", "a")]), ("val", [("user", "a b")])]
    df = spark.createDataFrame(rows, "split string, messages array<struct<role:string,content:string>>")
    plain = ChatTemplate(message="{content}\n", generation_cue="")
    out = {r["split"]: r for r in token_budget(df, 2, counter=tokenizer_counter(path, plain)).collect()}
    assert (out["train"]["records"], out["train"]["over_budget"], out["train"]["max_tokens"]) == (2, 1, 4)
    assert (out["val"]["over_budget"], out["val"]["max_tokens"]) == (0, 2)


def test_validator_matches_rules_on_random_records(spark):
    import json
    import random

    rnd = random.Random(9)
    absent = object()
    roles = ["system", "user", "assistant", "tool", absent, None, 7, True, "it's"]
    contents = ["some text", " \n", "", absent, None, 5, ["x"]]

    def message():
        if rnd.random() < 0.05:
            return "not an object"
        m = {}
        r, c = rnd.choice(roles), rnd.choice(contents)
        if r is not absent:
            m["role"] = r
        if c is not absent:
            m["content"] = c
        return m

    def record():
        x = rnd.random()
        if x < 0.05:
            return [1]
        if x < 0.1:
            return {"other": 1}
        if x < 0.15:
            return {"messages": rnd.choice([None, 5, "abc", {"a": 1}])}
        if x < 0.5:
            return {"messages": [{"role": r, "content": "c"} for r in ("system", "user", "assistant")]}
        return {"messages": [message() for _ in range(rnd.randint(0, 4))]}

    def expected(rec):
        # the rules as stated in operators/validate.py
        if not isinstance(rec, dict) or "messages" not in rec:
            return ["missing 'messages' key"]
        msgs = rec["messages"]
        if not isinstance(msgs, list):
            return ["'messages' is not a list"]
        get = lambda m, k: m.get(k) if isinstance(m, dict) else None
        found = [get(m, "role") for m in msgs]
        out = [] if found == ["system", "user", "assistant"] else [f"unexpected role order: {found}"]
        for m in msgs:
            c = m.get("content", "") if isinstance(m, dict) else ""
            role = get(m, "role")
            if c is None or (isinstance(c, str) and not c.strip()):
                out.append(f"empty content for role '{role}'")
            elif not isinstance(c, str):
                out.append(f"non-string content for role '{role}'")
        return out

    recs = [record() for _ in range(600)]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)], "i int, value string")
    got = {r["i"]: list(r["problems"]) for r in validate_records(parse_lines(df)).collect()}
    bad = [(recs[i], got[i], expected(recs[i])) for i in range(len(recs)) if got[i] != expected(recs[i])]
    assert bad == []


def test_length_stats_match_python_on_random_records(spark):
    import json
    import random

    rnd = random.Random(21)
    words = ["a", "bb", "ccc", "　", " ", "\n", "é"]
    recs = []
    for _ in range(400):
        msgs = []
        for _ in range(rnd.randint(0, 4)):
            m = {"role": rnd.choice(["system", "user", "assistant", "tool"])}
            if rnd.random() < 0.9:
                m["content"] = "".join(rnd.choice(words) for _ in range(rnd.randint(0, 30)))
            msgs.append(m)
        recs.append({"messages": msgs} if rnd.random() < 0.95 else {})
    df = spark.createDataFrame([(json.dumps(r, ensure_ascii=False),) for r in recs], "value string")
    got = {r["role"]: tuple(r)[1:] for r in length_stats(parse_lines(df)).collect()}
    for role in ("user", "assistant"):
        vals = sorted(
            len(m.get("content", "").split()) for r in recs for m in r.get("messages", []) if m["role"] == role
        )
        n = len(vals)
        want = (n, vals[0], vals[n // 2], vals[-1], sum(vals) // n) if n else (0, None, None, None, None)
        assert got[role] == want, role
