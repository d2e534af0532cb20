"""The pipeline on nulls, empty texts, repeated rows, an empty table and columns
whose names differ by case alone."""

import collections

import pytest

import corpus_pipeline as pipeline
from tests.llm.test_small_cases import SCHEMA, docs, none, prose, rows  # noqa: F401  (fixtures)


def tables(spark, folder, documents, schema="doc_id bigint, text string, lang string, source string, n_chars bigint"):
    spark.createDataFrame(documents, schema).write.parquet(f"{folder}/documents.parquet")
    marked = [(i, i % 4 == 0) for i in range(400)]
    labels = [(i, int(bad)) for i, bad in marked] + [(None, 1), (5, None)]
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("b1", prose(7700, 30)), ("b2", None), (None, "x")], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def made():
    out = []
    for i in range(400):
        tone = "vile awful hateful" if i % 4 == 0 else "fine lovely gentle"
        out.append((i, f"{prose(i, 60)} {tone} {prose(-i, 20)}", "en", f"s{i % 3}", None))
    leak = f"{prose(500, 20)} fine lovely gentle {prose(7700, 30)} {prose(501, 20)}"
    return out + [
        (1000, None, None, None, None), (1001, "", "en", None, 0), (1002, " \n", "en", "s1", 2), (1003, leak, "en", "s1", 1),
        (1004, prose(1, 3000), "en", "s2", 1), (1005, prose(1, 3000) + " one more", "en", "s2", 1), (1006, prose(9, 80), "en", "s0", 1),
        (1006, prose(9, 80), "en", "s0", 1), (None, prose(10, 80), "en", "s0", 1),
    ]


def test_hostile_rows(spark, tmp_dir):
    folder = tables(spark, tmp_dir, made())
    frames, given = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES:
        out = stage(spark, given, folder)
        frames[name] = given = pipeline.saved(out, f"edge-{name}")
        if name != "token_files":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {k: collections.Counter(r["doc_id"] for r in f.select("doc_id").collect()) for k, f in frames.items()}
    clean = {i for i in range(400) if i % 4}
    assert len(clean - set(ids["toxicity"])) <= 6 and len({i for i in range(0, 400, 4)} & set(ids["toxicity"])) <= 6
    near = ids["near_duplicates"]
    assert near[1004] == 1 and 1005 not in near and near[1006] == 1 and near[None] == 1
    assert sum(near[i] for i in (1000, 1001, 1002)) == 1  # texts without words are one class
    assert 1003 in near and set(near) - set(ids["decontamination"]) == {1003}
    copies = ids["mixing"]
    assert set(copies) <= set(ids["decontamination"]) and max(copies.values()) <= 3
    assert frames["token_files"].count() == sum(copies.values()) == sum(1 for _ in frames["token_files"].collect())


def test_empty_table(spark, tmp_dir):
    folder = tables(spark, tmp_dir, [])
    assert pipeline.run(spark, folder).count() == 0


def test_clashing_names_pass_through(spark, tmp_dir, docs, rows):
    folder = tables(spark, tmp_dir, made()[:40])
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and 0 < out.count() <= 3 * len(rows), name
    assert pipeline.STAGES[-1][1](spark, docs, folder).count() == len(rows)
    assert SCHEMA.count("ext string") + SCHEMA.count("EXT string") == 2


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_stage_on_no_rows(spark, tmp_dir, none, stage):
    folder = tables(spark, tmp_dir, made()[:40])
    assert stage(spark, none, folder).count() == 0
