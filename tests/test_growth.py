"""What grows with the tables: bytes shuffled, and text held by a Python worker."""

import numpy as np
import pandas as pd
import pyarrow as pa

from pairforge.operators import rewrite as R
from pairforge.operators import token_limit as L
from pairforge.plans import build as B
from pairforge.plans import queries as Q
from pairforge.plans.views import pairs_doc
from pairforge.sources import json_array as J
from pairforge.sources.jsonl import line_numbers, read_lines
from pairforge.sources.splits import read_splits, write_splits
from tests.test_token_limit import FILE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def documents(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_pairs_doc_shuffles_once_and_keeps_join_semantics(spark, tmp_dir):
    """Ids across runs, below zero, missing, null and repeated; null texts."""
    ids = [*range(-70, 140), *range(300, 330), 64, 63, 127, 128, 128, -64, -65, None, None]
    rows = [(i, None if i is not None and i % 17 == 0 else f"t{i}-{n}") for n, i in enumerate(ids)]
    got = pairs_doc(spark, documents(spark, tmp_dir, rows))
    shuffles = plan(got).count("Exchange hashpartitioning")
    want = [(i, a, b) for i, a in rows for j, b in rows if i is not None and j == i + 1]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert shuffles == 1


def test_versions_share_one_union(spark, tmp_dir, monkeypatch):
    made = []
    whole = B.materialize_at
    monkeypatch.setattr(B, "materialize_at", lambda *a: made.append(1) or whole(*a))
    rows = {(r["version"], r["split"]): r["records"] for r in Q.q_publish_versions(spark, "/root/testdata/sf0.001").collect()}
    assert len(made) == 1 and rows[1, "train"] + rows[1, "val"] == rows[2, "train"] + rows[2, "val"] and rows[1, "val"] < rows[2, "val"]


def test_compressed_splits_read_back_equal(spark, tmp_dir):
    rec = spark.range(500).selectExpr("case when id % 5 = 0 then 'val' else 'train' end as split", "md5(cast(id as string)) as shuffle_hash", "array(named_struct('role', 'user', 'content', concat('x', id, repeat(' y', 200)))) as messages")
    size = {}
    for codec in ("none", "gzip"):
        write_splits(rec, f"{tmp_dir}/{codec}", compression=codec)
        size[codec] = spark.read.format("binaryFile").load(f"{tmp_dir}/{codec}").selectExpr("sum(length)").first()[0]
    a, b = (sorted(map(repr, read_splits(spark, f"{tmp_dir}/{c}").collect())) for c in size)
    assert a == b and len(a) == 500 and 5 * size["gzip"] < size["none"]


def test_numbering_lines_does_not_shuffle_them(spark, tmp_dir):
    spark.range(0, 900, numPartitions=3).selectExpr("cast(id as string) as value").write.text(tmp_dir + "/t")
    lines = read_lines(spark, tmp_dir + "/t")
    numbered = line_numbers(lines, lines)
    assert "SortMergeJoin" not in plan(numbered) and "BroadcastHashJoin" in plan(numbered)
    assert sorted(r["line_no"] for r in numbered.collect()) == sorted([*range(1, 301)] * 3)


def test_array_pieces_are_marked_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(J, "RUN_BYTES", 100)
    b = pa.RecordBatch.from_arrays([pa.array(["f"] * 50 + ["g"]), pa.array([0] * 51), pa.array(["x" * 30] * 49 + ["y" * 500, "z"])], ["file_path", "block_start", "value"])
    runs = list(J._ranges(b))
    assert [i for _, i, _ in runs] == [0, *[j for _, _, j in runs][:-1]] and runs[-1][2] == 51
    assert all(j - i == 1 or sum(map(len, b["value"][i:j].to_pylist())) <= 100 for _, i, j in runs)


def test_quotes_after_backslashes():
    texts = ['a"b\\"c\\\\"d', '\\\\\\"', '"', "", '\\"\\"x', '"\\\\\\\\"']
    m = J._Marks(pa.array(texts), False)
    odd, want = False, []
    for t in texts:
        want.append(odd)
        for i, c in enumerate(t):
            before = t[:i]
            odd ^= c == '"' and (len(before) - len(before.rstrip("\\"))) % 2 == 0
    assert m.odd.tolist() == want and bool(m.odd_end[-1]) == odd


def test_rewriters_get_bounded_slices(monkeypatch):
    monkeypatch.setattr(R, "SLICE_BYTES", 100)
    sizes = []

    def factory():
        return lambda s: sizes.append((len(s), s.str.len().sum())) or s.str.upper()

    texts = ["a" * 30] * 20 + ["b" * 500, None, "c"]
    todo = [i % 4 != 1 and t is not None for i, t in enumerate(texts)]
    b = pa.RecordBatch.from_arrays([pa.array(range(23)), pa.array(texts), pa.array(["old"] * 23), pa.array(todo)], ["id", "text", "before", "go"])
    out = pa.Table.from_batches(list(R._apply({"before": factory}, "text", "go")(iter([b])))).to_pydict()
    assert out["id"] == list(range(23)) and out["text"] == texts and list(out) == ["id", "text", "before"]
    assert out["before"] == [t.upper() if g else "old" for t, g in zip(texts, todo)]
    assert len(sizes) > 5 and all(n == 1 or chars <= 100 for n, chars in sizes)


def test_tokens_by_word_equal_the_tokenizers_own():
    tok = L._loaded(FILE)
    words = L.WordTokens.of(tok)
    rnd = np.random.default_rng(1)
    letters = list("aZ ÀéŉſŸÖ×ª'sS'T12.,;\t\n\r<|>½—日本́ \x0bİ")
    texts = ["".join(rnd.choice(letters, 60)) for _ in range(300)] + ["", None, "it's I'LL <|im_start|>x", "a<|endoftext|>b", "don't can'T we'Re " * 9]
    texts += ["Plain words, more of them. " * n for n in range(1, 9)]
    for limit in (1, 2, 7, 30, 1000):
        s = pd.Series(texts, dtype=object)
        got, want = (list(L._counted(tok, w, s, False, limit)) for w in (words, None))
        assert got == want
    assert sum(words.takes(t) for t in texts if t is not None) > 8


def test_known_words_are_not_encoded_again():
    class Counting:
        def __init__(self):
            self.tok, self.texts = L._loaded(FILE), 0

        def __getattr__(self, name):
            return getattr(self.tok, name)

        def encode_batch(self, texts, **k):
            self.texts += len(texts)
            return self.tok.encode_batch(texts, **k)

    tok = Counting()
    words = L.WordTokens.of(tok)
    got = list(L._counted(tok, words, pd.Series(["the same words again"] * 5000, dtype=object), False, 100))
    assert len(set(got)) == 1 and tok.texts == 1
