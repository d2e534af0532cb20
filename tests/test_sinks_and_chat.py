import json
import os

from pyspark.sql import functions as F

from pairforge.operators.chat import CHATML, ChatTemplate, chat_messages, prompt_messages, render_prompt, to_jsonl
from pairforge.operators.pairs import parquet_source, union_sources
from pairforge.sources.parquet import scan_ordered
from pairforge.sources.splits import write_pairs

L51 = "p" * 51


def test_scan_ordered_directories_keep_file_then_row_order(spark, tmp_dir):
    d1, d2 = f"{tmp_dir}/d1", f"{tmp_dir}/d2"
    spark.createDataFrame([(i,) for i in range(6)], "v int").repartition(3).write.parquet(d1)
    spark.createDataFrame([(100 + i,) for i in range(4)], "v int").coalesce(1).write.parquet(d2)
    rows = scan_ordered(spark, [d2, d1]).orderBy("path_ord", "file_path", "row_index").collect()
    assert [r["path_ord"] for r in rows] == [0] * 4 + [1] * 6
    assert [r["v"] for r in rows[:4]] == [100, 101, 102, 103]
    assert sorted(r["v"] for r in rows[4:]) == list(range(6))
    # inside one file rows keep their stored order
    per_file = {}
    for r in rows[4:]:
        per_file.setdefault(r["file_path"], []).append(r["row_index"])
    assert all(v == sorted(v) for v in per_file.values())


def test_pair_sink_round_trip(spark, tmp_dir):
    src = f"{tmp_dir}/src.parquet"
    spark.createDataFrame([("é" + L51, L51), ("x", L51)], "abstract string, summary string").write.parquet(src)
    pairs = union_sources([parquet_source(spark, "one", [src])])
    for fmt in ("parquet", "json"):
        out = f"{tmp_dir}/pairs_{fmt}"
        write_pairs(pairs, out, fmt)
        back = spark.read.format(fmt).load(out).collect()
        assert [(r["abstract"], r["plain_summary"]) for r in back] == [("é" + L51, L51)]
    # JSON keeps non-ASCII unescaped
    text = "".join(open(os.path.join(f"{tmp_dir}/pairs_json", f), encoding="utf-8").read()
                   for f in os.listdir(f"{tmp_dir}/pairs_json") if f.endswith(".json"))
    assert "é" in text


def test_chat_record_render_and_json(spark):
    df = spark.createDataFrame([("tech text", "plain text")], "a string, b string")
    rec = df.select(chat_messages(F.col("a"), F.col("b"), "SYS").alias("messages"))
    line = to_jsonl(rec).first()["value"]
    assert json.loads(line) == {"messages": [
        {"role": "system", "content": "SYS"}, {"role": "user", "content": "tech text"},
        {"role": "assistant", "content": "plain text"}]}
    prompt = df.select(render_prompt(prompt_messages(F.col("a"), "SYS"), CHATML).alias("p")).first()["p"]
    assert prompt == "<|im_start|>system\nSYS<|im_end|>\n<|im_start|>user\ntech text<|im_end|>\n<|im_start|>assistant\n"
    plain = ChatTemplate(message="[{role}] {content}\n", generation_cue="[assistant] ")
    p2 = df.select(render_prompt(prompt_messages(F.col("a"), "S"), plain).alias("p")).first()["p"]
    assert p2 == "[system] S\n[user] tech text\n[assistant] "
