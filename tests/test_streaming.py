import json
import os

from pairforge.session import scratch_path
from pairforge.streaming.validate_stream import start_problem_sink, stream_file_summary, stream_problems

GOOD = json.dumps({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]})


def test_streaming_validation(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.jsonl"), "w") as f:
        f.write("\n".join([GOOD, "{}", "{bad", "", GOOD]) + "\n")
    problems = stream_problems(spark, src)
    q = stream_file_summary(problems).writeStream.format("memory").queryName("pf_summary").outputMode("complete").start()
    out = scratch_path(spark, "stream-out")
    sink = start_problem_sink(problems, out, scratch_path(spark, "stream-ckpt"))
    try:
        q.processAllAvailable()
        sink.processAllAvailable()
        rows = spark.sql("select records, invalid from pf_summary").collect()
        assert [(r["records"], r["invalid"]) for r in rows] == [(4, 2)]
        got = sorted(r["problems"] for r in spark.read.parquet(out).collect())
        assert got == ["invalid JSON", "missing 'messages' key"]
    finally:
        q.stop()
        sink.stop()
