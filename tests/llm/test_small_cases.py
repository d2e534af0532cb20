"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
columns, for every operator; and each operator against brute force."""

import base64
import collections
import hashlib
import itertools
import random
import re
import struct
import zlib

import numpy as np
import pytest

import __spark_entry__  # noqa: F401  (ships the package to the workers)
from pairforge.llm import decontaminate, html_text, lines, mixing, near_dups, quality, substrings, tokens, toxicity, warc

WORDS = [f"w{i}" for i in range(300)]
SCHEMA = "doc_id bigint, text string, TEXT string, Doc_ID string, lang string, source string, score double, size int, n_words int"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    long = prose(1, 30_000)
    shared = prose(2, 60)
    line = "a line that three documents and more hold"
    texts = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, long), (6, long + " tail"), (7, long),
        (8, f"{prose(3, 50)} {shared} {prose(4, 50)}"), (9, f"{shared} {prose(5, 30)}\n{line}"), (10, f"{line}\nx\n  {line.upper()} "),
        (11, f"{line}\n{prose(6, 20)}\né" + "ü" * 20), (11, "a second row of the same id"), (12, "same row"), (12, "same row"),
        (None, f"{line}\nno id"), (13, "b a " * 40), (14, "# * $ " * 30), (15, prose(7, 9) + " " + prose(8, 40)),
        (16, prose(9, 100)), (17, prose(9, 100).replace("w1 ", "w2 ", 1)), (18, "İß é\x0b\x0c\x1c\xa0 <|endoftext|> it's"),
    ]
    return [(d, t, "clash", "x", "en", None if d in (4, 9) else f"s{(d or 0) % 3}", 0.5, 3, 4) for d, t in texts]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().split()


def test_html(spark):
    page = (
        "<html><title>T</title><body><header><a href=/>Home</a></header><div id='cookie-notice'>We use cookies on this site.</div>"
        "<article><h1>Head &amp; more</h1><p>A  long enough&nbsp;paragraph of the article, with a full stop.<div class=ad>Buy!</div><p>Second <b>bold</b>"
        "<form>Sign up</form></article><section id=comments><p>I liked this article a lot, thanks for it!</p></section><footer>&copy;</footer><script>x('</p>')</script>"
    )
    pages = spark.createDataFrame([(1, "u", page, "c"), (2, None, None, "c"), (3, "u", "", "c"), (None, "u", "<p", "c"), (1, "u", page, "c")], "page_id bigint, url string, html string, HTML string")
    got = sorted((tuple(r) for r in html_text.extract(pages).collect()), key=str)
    text = "Head & more\n\nA long enough paragraph of the article, with a full stop.\n\nSecond bold"
    want = [(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (3, "u", "", 0), (None, "u", "", 0)]
    assert got == sorted(want, key=str)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_minimum_cut_against_all_labellings():
    r = random.Random(1)
    for _ in range(150):
        n = r.randint(1, 8)
        cost = [r.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, r.random() * 2) for i in range(n) for j in range(i) if r.random() < 0.5]

        def value(label):
            return sum(max(0, c) if not k else max(0, -c) for c, k in zip(cost, label)) + sum(w for i, j, w in edges if label[i] != label[j])

        best = min(value(x) for x in itertools.product([0, 1], repeat=n))
        assert abs(value(html_text.minimum_cut(cost, edges)) - best) < 1e-9


def test_quality(docs, none, rows):
    led = quality.ledger(docs)
    got = sorted(((r["doc_id"], r["n_words"], r["n_repeat_words"], r["n_dup_lines"]) for r in led.collect()), key=str)
    want = []
    for d, t, *_ in rows:
        w = words_of(t)
        c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {i + k for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for k in range(8)}
        ls = [x for x in (t or "").split("\n") if words_of(x)]
        want.append((d, len(w), len(hit), len(ls) - len(set(ls))))
    assert got == sorted(want, key=str)
    ab = {r["rule"]: r for r in quality.ablations(led).collect()}
    failed = [r["failed"] for r in led.collect()]
    assert ab["symbols"]["n_failed"] == sum(f & quality.BIT["symbols"] > 0 for f in failed)
    assert quality.ledger(none).count() == 0 and len(quality.ablations(quality.ledger(none)).collect()) == len(quality.RULES)


def test_mixing(spark, docs, none, rows):
    a, b = (sorted(map(str, mixing.mix(docs).collect())) for _ in range(2))
    assert a == b and len(a) == len(rows)
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in mixing.mix(docs).collect())
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    copies = sum(r["copies"] for r in mixing.mix(docs).collect())
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(docs).count() == copies
    even = spark.range(3000).selectExpr("id AS doc_id", "repeat('a ', cast(1 + id % 50 as int)) AS text", "if(id % 3 = 0, 'x', if(id % 7 = 0, null, 'y')) AS source")
    for r in mixing.mix(even).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"]


def test_rounding_keeps_expectations():
    r = random.Random(3)
    size = sorted((r.randint(1, 50) for _ in range(12)), reverse=True)
    frac = [r.random() for _ in size]
    for f, q in ((mixing.pair_round, frac), (mixing.pair_round, [0.37] * 12)):
        total = np.zeros(12)
        for _ in range(20_000):
            out, left, p = f(size, q, [r.random() for _ in size])
            words = sum(s * x for s, x in zip(size, out)) + (size[left] * p if left >= 0 else 0)
            assert abs(words - sum(s * x for s, x in zip(size, q))) < 1e-6
            total += [p if i == left else x for i, x in enumerate(out)]
        assert np.abs(total / 20_000 - q).max() < 0.02


def test_toxicity(spark, docs, none, rows):
    r = random.Random(5)
    made = []
    for i in range(1500):
        bad = i % 6 == 0
        made.append((i, f"{prose(i, 40)} {r.choice(['vile', 'awful']) if bad else 'fine'} {prose(-i, 10)}", int(bad)))
    train = spark.createDataFrame(made, "doc_id bigint, text string, toxic int")
    labels = train.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (3, None), (99999, 1)], "doc_id bigint, toxic int"))
    got = toxicity.scored(train.select("doc_id", "text"), labels).join(train, "doc_id")
    held = [x for x in got.collect() if zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(x["score"] >= 0.5) == bool(x["toxic"]) for x in held]) > 0.97
    out = toxicity.scored(docs, labels, "s").collect()  # ``score`` is a column of docs already
    assert len(out) == len(rows) and all(0 <= x["s"] <= 1 for x in out)
    assert toxicity.scored(none, labels, "s").count() == 0
    assert all(x["s"] < 0.5 for x in toxicity.scored(docs, labels.limit(0), "s").collect())
    # rows that repeat a doc_id leave the model as it is
    again = train.select("doc_id", "text").union(spark.createDataFrame([(7, "~ a later text")] * 50 + [(made[8][0], made[8][1])], "doc_id bigint, text string"))
    for a, b in zip(toxicity.fit(train, labels), toxicity.fit(again, labels)):
        assert np.array_equal(a, b)


def test_lines(spark, docs, none, rows):
    hold = collections.defaultdict(set)

    def key(x):
        k = x.encode().strip().lower().decode()
        return k if len(k) >= 20 else None

    for d, t, *_ in rows:
        for x in (t or "").split("\n"):
            if d is not None and key(x):
                hold[key(x)].add(d)
    want = []
    for d, t, *_ in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if not (d is not None and key(x) and len(hold[key(x)]) >= 3 and max(hold[key(x)]) != d)]
        want.append((d, len(ls), len(ls) - len(kept), "\n".join(kept)))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in lines.dedup_lines(docs).collect())
    assert lines.dedup_lines(none).count() == 0


def test_line_runs_level_up_and_go_on(spark, tmp_dir):
    runs = lines.LineRuns(spark, tmp_dir, fanout=2)
    seen, counts = set(), collections.Counter()
    for b in range(5):
        batch = [(b * 10 + i, f"line number {(b * 3 + i) % 11} of the many lines") for i in range(6)]
        new = {r["key"] for r in lines.new_lines(runs, spark.createDataFrame(batch, "doc_id bigint, text string")).collect()}
        keys = {lines.line_key(t.encode()) for _, t in batch}
        assert new == keys - seen
        seen |= keys
        counts.update(lines.line_key(t.encode()) for _, t in batch)
        runs = lines.LineRuns(spark, tmp_dir, fanout=2)  # a later session
    assert all(len(level) < 2 for level in runs.levels) and len(runs.levels) > 2
    assert {r["key"]: r["n_docs"] for r in runs.merged().collect()} == dict(counts)


def item_words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def test_decontamination(spark, docs, none, rows):
    items = [(1, prose(2, 60).upper()), (2, "One"), (3, None), (None, "one"), (4, ""), (5, "b A b a b a b a b a b a"), (6, prose(8, 9)), (6, prose(8, 9))]
    bench = spark.createDataFrame([(*x, "z") for x in items], "item_id bigint, text string, Text string")
    win, spans = collections.defaultdict(set), set()
    for i, t in items:
        w = item_words(t)
        n = min(10, len(w))
        if n and i is not None:
            spans.add(n)
            for a in range(len(w) - n + 1):
                win[tuple(w[a : a + n])].add(str(i))
    want = []
    for d, t, *_ in rows:
        w, hit, ids = item_words(t), set(), set()
        for n in spans:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in win:
                    hit |= set(range(a, a + n))
                    ids |= win[tuple(w[a : a + n])]
        want.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    got = decontaminate.contamination(docs, bench).drop("tie").collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert decontaminate.clean(docs, bench).count() == sum(not x[5] for x in want)
    assert decontaminate.contamination(none, bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, bench.limit(0)).collect())


def test_substrings(docs, none, rows):
    count = collections.Counter(tuple(words_of(t)[i : i + 35]) for _, t, *_ in rows for i in range(len(words_of(t)) - 34))
    want = []
    for d, t, *_ in rows:
        w = words_of(t)
        gone = {i + k for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for k in range(35)}
        want.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    for options in ({}, {"hot_runs": 2, "sample": 1}):  # all anchors cold; all repeated ones hot
        got = substrings.remove_repeats(docs, **options).collect()
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert substrings.remove_repeats(none).count() == 0
    text = {d: words_of(t) for d, t, *_ in rows if d not in (11, 12)}
    for f in substrings.factors(docs).collect():
        a, b = text[f["doc_id"]], text[f["ref_doc_id"]]
        assert a[f["start"] :][: f["n_words"]] == b[f["ref_start"] :][: f["n_words"]] and f["n_words"] >= 35


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    el = rng.integers(0, 1 << 63, 300).astype(np.uint64)

    def sig(s, w=None):
        return near_dups.dart_signatures(np.zeros(len(s), np.int64), s, w, 1, 4000)[0]

    assert abs((sig(el[:200]) == sig(el[40:240])).mean() - 160 / 240) < 0.04
    a, b = rng.integers(1, 5, 200) + 0.5, rng.integers(1, 5, 200) * 1.0
    assert abs((sig(el[:200], a) == sig(el[:200], b)).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_near_duplicates(spark, docs, none):
    base = prose(50, 400).split()
    made = [(i, " ".join(base[:k] + [f"x{i}"] * (i % 9) + base[k:])) for i, k in ((i, 7 * i) for i in range(40))] + [(100 + i, prose(100 + i, 60)) for i in range(60)]
    sets = {i: {tuple(t.split()[a : a + 5]) for a in range(len(t.split()) - 4)} for i, t in made}
    name = {i: i for i in sets}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            name[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["doc_id"]: r["class_id"] for r in near_dups.classes(spark.createDataFrame(made, "doc_id bigint, text string")).collect()}
    assert got == {i: find(i) for i in sets}
    by = collections.defaultdict(set)
    for r in near_dups.classes(docs, counts=True).collect():
        by[r["doc_id"]].add(r["class_id"])
    assert by[1] == by[2] == by[3] == {1} and by[5] == by[6] == by[7] == {5} and by[12] == {12}
    kept = near_dups.one_per_class(docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(12) == 1 and not {2, 3, 6, 7} & set(ids) and None in ids
    assert near_dups.classes(none).count() == 0


def test_warc(spark, tmp_dir):
    made = [(1, "u 1\n", "same"), (2, "u2", "same"), (5, None, "same"), (5, "u5", "same"), (3, "u3", None), (4, "u4", ""), (None, "n", "same"), (6, "u6", "é" * 5000), (7, "u7", "x"), (7, "u7", "x")]
    pages = spark.createDataFrame([(*x, "c") for x in made], "page_id bigint, url string, html string, URL string").repartition(3)
    lead = {"same": 5, "": 4, "é" * 5000: 6, "x": 7}
    want = []
    for p, _, h in made:
        b, n = (h or "").encode(), lead[h or ""]
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if p == n else "revisit", None if p == n else n))
    warc.write_warc(pages, f"{tmp_dir}/a", file_bytes=1000, range_bytes=4000)
    got = [tuple(r)[:5] for r in warc.read_warc(spark, f"{tmp_dir}/a").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    warc.write_warc(pages.repartition(5), f"{tmp_dir}/b", file_bytes=1000, range_bytes=4000)
    a, b = ({r["file"]: r["crc"] for r in spark.read.parquet(f"{tmp_dir}/{x}/manifest").collect()} for x in "ab")
    assert a == b and len(a) > 1  # the same bytes
    warc.write_warc(pages, f"{tmp_dir}/c", min_bytes=100)
    assert {r["record_type"] for r in warc.read_warc(spark, f"{tmp_dir}/c").collect()} == {"response"}
    warc.write_warc(pages.limit(0), f"{tmp_dir}/d")
    assert warc.read_warc(spark, f"{tmp_dir}/d").count() == 0


def test_tokens(docs, none, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.tokenizer_path())
    got = sorted((tuple(r) for r in tokens.token_output(docs).collect()), key=lambda r: r[1])
    at, sizes = 0, collections.defaultdict(list)
    for d, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        sizes[d].append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    for d, start, n, crc in got:
        assert start == at and (n, crc) in sizes[d]
        sizes[d].remove((n, crc))
        at += n
    assert tokens.token_output(none).count() == 0


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tok, enc, r = Tokenizer.from_file(tokens.tokenizer_path()), tokens.Encoder(tokens.tokenizer_path()), random.Random(1)
    alpha = "aAbBeEéÉçß09 \n\t'’s.,#<|>endoftexẗ İſŉ—東\xa0tTmMlLrRvVdD!?"
    texts = ["".join(r.choice(alpha) for _ in range(r.randint(0, 40))) for _ in range(1500)] + ["it's '''s we'll I'M", "<|endoftext|> a"]
    for t, got in zip(texts, enc.encode(texts)):
        assert got.tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1]


def test_pieces_equal_the_tokenizers_rule():
    rule = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ſ]+|[0-9]|[^\\sa-z0-9À-ÖØ-öø-ſ]+")
    r = random.Random(2)
    texts = ["".join(r.choice("'''sStTmdrRevElLaéŒſ09 \n\t.,#") for _ in range(r.randint(0, 30))) for _ in range(3000)]
    texts += ["'", "''", "'r", "'re", "it's", "'sé", "'s's9", "", " ", "a'"]
    for part in (texts, texts[-1:], texts[-3:-1], []):
        pieces, bounds = tokens.split_pieces(part)
        got = pieces.to_pylist()
        assert [got[a:b] for a, b in zip(bounds, bounds[1:])] == [rule.findall(t.lower()) for t in part]
        assert tokens._strings(pieces) == got


def test_encoder_looks_a_piece_up_once_a_run(monkeypatch):
    asked, enc = [], tokens.Encoder(tokens.tokenizer_path())

    class Counting(tokens._Index):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

    enc.index = Counting()
    tok = enc.tok.from_file(tokens.tokenizer_path())
    texts = ["The cat, the dog and it's 12 cats. " * 500] * 20
    want = [*tok.encode(texts[0], add_special_tokens=False).ids, 1]
    assert all(x.tolist() == want for x in enc.encode(texts))
    assert len(asked) == len(set(asked)) == 11  # of 6,000 pieces a text
    # the bounds on a run's texts and on the pieces kept change no id
    monkeypatch.setattr(tokens, "RUN_CHARS", 100)
    monkeypatch.setattr(tokens, "MAX_CACHED", 5)
    mixed = [None, "", "’ the cat", *texts[:2], "<|endoftext|> a's", "new words, the old ones", "12"]
    want = [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in mixed]
    for _ in range(2):
        assert [x.tolist() for x in enc.encode(mixed)] == want


def test_variable_length_code():
    r = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (r.integers(0, 1 << 32, n) >> r.integers(0, 32, n)).astype(np.uint32)
        control, data = tokens.vbyte_encode(v)
        assert len(control) == -(-n // 4) and (tokens.vbyte_decode(control, data, n) == v).all()
