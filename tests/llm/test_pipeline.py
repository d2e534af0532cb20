"""The pipeline's stages, each on its predecessor's rows."""

import corpus_pipeline as P
from pairforge.llm.common import saved, table
from tests.conftest import SF_SMALL


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    columns, n = docs.columns, docs.count()
    for name, stage in P.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF_SMALL), "t")
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and now <= ids, name
        if name != "mixing":
            assert docs.count() == len(now) and len(now) > 0.5 * n
        ids = now
    out = P.STAGES[-1][1](spark, docs, SF_SMALL)
    assert out.count() == docs.count()
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert P.run(spark, SF_SMALL).count() == out.count()
