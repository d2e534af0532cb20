"""Resumable rewriting: each row once, whatever stops; bounded batches."""

import os
import random

import pandas as pd
import pytest

from pairforge.operators.rewrite import squeeze_factory
from pairforge.operators.rewrite_job import budgeted, ledger, open_shards, packed, rewrite_job, rewritten


def test_no_batch_is_over_the_budget():
    r = random.Random(1)
    for _ in range(300):
        sizes = [r.randrange(0, 40) for _ in range(r.randrange(0, 60))]
        budget = r.randrange(1, 200)
        got = packed(sizes, budget)
        assert sorted(i for b in got for i in b) == list(range(len(sizes)))
        assert all(len(b) == 1 or max(sizes[i] for i in b) * len(b) <= budget for b in got)


def test_results_come_in_the_rows_order():
    texts = pd.Series([f"{'w  ' * (i * 7 % 23)}row {i}" for i in range(50)], index=range(100, 150))
    calls = []

    def factory():
        inner = squeeze_factory()

        def run(s):
            calls.append([len(t.split()) for t in s])
            return inner(s)

        return run

    got = budgeted(factory, 60)()(texts)
    assert got.equals(squeeze_factory()(texts)) and len(calls) > 5
    assert all(len(c) == 1 or max(c) * len(c) <= 60 for c in calls)


def counting(folder, fail_on=None):
    """A rewriter that is different in each call, as a model that samples is."""

    def factory():
        import uuid

        def run(s):
            if fail_on is not None and any(fail_on in t for t in s):
                raise RuntimeError("stopped")
            mark = uuid.uuid4().hex
            with open(f"{folder}/{mark}", "w") as f:
                f.write("\n".join(s))
            return s + f" {mark}"

        return run

    return factory


def seen(folder):
    return [line for name in os.listdir(folder) for line in open(f"{folder}/{name}").read().split("\n")]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame([(i, f"text {i:03d}") for i in range(200)] + [(900, None), (901, "  ")], "doc_id int, text string")


def test_a_stopped_job_goes_on(spark, docs, tmp_dir):
    os.makedirs(f"{tmp_dir}/calls")
    out = f"{tmp_dir}/job"
    args = {"shards": 12, "wave": 3}
    assert rewrite_job(docs, out, counting(f"{tmp_dir}/calls"), most_waves=1, **args) == 9
    first = {r["doc_id"]: r["rewrite"] for r in rewritten(spark, out).collect()}
    left = {r["shard"] for r in open_shards(docs, out, ("doc_id",), "text", 12).collect()}
    assert len(left) == 9 and 0 < len(first) < 200
    # a failure in some later wave: earlier waves stay, the failed one is done again
    with pytest.raises(Exception, match="stopped"):
        rewrite_job(docs, out, counting(f"{tmp_dir}/calls", fail_on=f"text {max(set(range(200)) - set(first)):03d}"), **args)
    second = {r["doc_id"]: r["rewrite"] for r in rewritten(spark, out).collect()}
    assert first.items() <= second.items()
    assert rewrite_job(docs, out, counting(f"{tmp_dir}/calls"), **args) == 0
    third = {r["doc_id"]: r["rewrite"] for r in rewritten(spark, out).collect()}
    assert second.items() <= third.items() and set(third) == set(range(200))
    before = len(seen(f"{tmp_dir}/calls"))
    assert rewrite_job(docs, out, counting(f"{tmp_dir}/calls"), **args) == 0  # nothing to do
    assert len(seen(f"{tmp_dir}/calls")) == before and rewritten(spark, out).count() == 200


def test_changed_rows_are_done_again_and_others_stay(spark, docs, tmp_dir):
    os.makedirs(f"{tmp_dir}/calls")
    out = f"{tmp_dir}/job"
    rewrite_job(docs, out, counting(f"{tmp_dir}/calls"), shards=40, wave=40)
    old = {r["doc_id"]: r["rewrite"] for r in rewritten(spark, out).collect()}
    new = docs.filter("doc_id <> 7").selectExpr("doc_id", "if(doc_id = 5, 'new text', text) AS text")
    assert rewrite_job(new, out, counting(f"{tmp_dir}/calls"), shards=40, wave=40) == 0
    got = {r["doc_id"]: r["rewrite"] for r in rewritten(spark, out).collect()}
    assert set(got) == set(range(200)) - {7} and got[5].startswith("new text")
    assert 150 < sum(got[i] == old[i] for i in got) < 199
    assert ledger(spark, out).count() == 40


def test_nothing_is_done_yet(spark, tmp_dir):
    with pytest.raises(ValueError, match="nothing is done"):
        rewritten(spark, f"{tmp_dir}/none")
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert rewrite_job(empty, f"{tmp_dir}/empty", squeeze_factory) == 0
