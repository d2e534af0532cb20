"""Benchmark decontamination by winnowing.

Words are [0-9a-z] and non-ASCII characters after A-Z are lower-cased. A window
is ``SPAN`` consecutive words of a benchmark item (the whole of a shorter one).
Of the k-gram hashes inside each window of a document only the smallest is kept
(winnowing); neighbouring windows mostly share theirs, so about one fingerprint
in four words is left, yet any shared window has a common one. Fingerprints of
documents and benchmark are joined; a match fixes where the window would start,
and is extended to all its words by comparing them. Only built-in functions
run on the texts.

Fingerprints of documents never leave their join: the benchmark's side is
broadcast while it is small (its size is checked), else both are shuffled.

Nulls: a null text has no words, items without id or words are ignored. Repeated
rows get equal rows, repeated items count once. Rows are matched by doc_id and a
hash of the text, so rows that share an id are judged by their own text. Empty
tables give no rows or no hits. Other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.common import pick, positional, saved, small, table
from pairforge.llm.quality import gram_hashes, hashes, let, split_words

SPAN = 10
GRAM = 4
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing
PLACE_BITS = 24
PLACE = (1 << PLACE_BITS) - 1


def item_words(text: Column) -> Column:
    """Words after lower-casing A-Z alone. ``lower`` is that for ASCII texts."""
    folded = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))
    return split_words(folded, SEPARATOR)


def gram_size(span: int) -> int:
    return min(GRAM, span)


def placed(g: Column) -> Column:
    """Hashes with their place in the low bits, so that a minimum tells both."""
    return F.transform(g, lambda x, i: x.bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.bitwiseAND(F.lit(PLACE)).cast("bigint")))


def winnowed(h: Column, span: int) -> Column:
    """Distinct (hash, place) values that are smallest in some window."""
    k = gram_size(span)
    w = span - k + 1

    def least(g: Column) -> Column:
        n = F.greatest(F.size(g) - (w - 1), F.lit(0))
        best = F.transform(F.slice(g, F.lit(1), n), lambda x, i: F.least(x, *[F.get(g, i + j) for j in range(1, w)]) if w > 1 else x)
        return F.array_distinct(best)

    return let(placed(gram_hashes(h, k)), least)


def item_windows(items: DataFrame, span: int = SPAN) -> DataFrame:
    """(item_id, span, window): the distinct windows of each item, as text."""
    rows = pick(items, "item_id", "text").filter("item_id IS NOT NULL").select(F.col("item_id").cast("string"), item_words(F.coalesce("text", F.lit(""))).alias("words"))
    rows = rows.filter(F.size("words") > 0).withColumn("span", F.least(F.size("words"), F.lit(span)))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("span") + 1))
    rows = rows.select("item_id", "span", "words", at.alias("at"))
    return rows.select("item_id", "span", F.array_join(F.slice("words", F.col("at"), F.col("span")), " ").alias("window")).distinct()


def window_prints(windows: DataFrame, spans: list[int]) -> DataFrame:
    """(span, print, shift, window): a row per place in the window that holds its
    smallest gram hash."""
    parts = []
    for span in spans:
        w = windows.filter(F.col("span") == span).select("span", "window").distinct()
        k = gram_size(span)
        g = let(hashes(F.split("window", " ")), lambda h: placed(gram_hashes(h, k)))  # noqa: B023
        w = w.select("span", "window", F.explode(F.array(g)).alias("g"))
        top = F.shiftright(F.array_min("g"), PLACE_BITS)
        w = w.select("span", "window", top.alias("print"), "g").select("span", "window", "print", F.explode("g").alias("x"))
        parts.append(
            w.filter(F.shiftright("x", PLACE_BITS) == F.col("print")).select("span", "print", F.col("x").bitwiseAND(F.lit(PLACE)).cast("int").alias("shift"), "window")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))


def candidates(docs: DataFrame, prints: DataFrame, spans: list[int]) -> DataFrame:
    """(doc_id, tie, at): possible window starts per document, from joined prints."""

    def of_hashes(h: Column) -> Column:
        arrays = [F.transform(winnowed(h, s), lambda x: F.struct(F.lit(s).alias("span"), x.alias("x"))) for s in spans]  # noqa: B023
        return F.struct(F.size(h).alias("n"), (F.concat(*arrays) if len(arrays) > 1 else arrays[0]).alias("f"))

    f = _keyed(docs).select("doc_id", "tie", F.explode(F.array(let(hashes(item_words(F.col("text"))), of_hashes))).alias("d"))
    f = f.select("doc_id", "tie", "d.n", F.explode("d.f").alias("f"))
    f = f.select("doc_id", "tie", "n", F.col("f.span").alias("span"), F.shiftright("f.x", PLACE_BITS).alias("print"), F.col("f.x").bitwiseAND(F.lit(PLACE)).cast("int").alias("place"))
    hit = f.join(small(prints), ["span", "print"])
    # a text of more words than the place bits can tell has several places to look at
    place = F.explode(F.sequence(F.col("place"), F.greatest(F.col("n") - 1, F.col("place")), F.lit(PLACE + 1)))
    hit = hit.select("doc_id", "tie", "span", "shift", "window", place.alias("place")).withColumn("start", F.col("place") - F.col("shift")).filter("start >= 0")
    one = F.struct("start", "span", "window")
    return hit.groupBy("doc_id", "tie").agg(F.collect_set(one).alias("at"))


def covered_words(spans: Column) -> Column:
    """Words inside the union of [start, start + span)."""
    ordered = F.sort_array(F.transform(spans, lambda c: F.struct(c["start"].alias("s"), (c["start"] + c["span"]).alias("e"))))
    total = F.aggregate(
        ordered,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), x["e"] - F.greatest(x["s"].cast("bigint"), acc["upto"]))).alias("n"),
            F.greatest(x["e"].cast("bigint"), acc["upto"]).alias("upto"),
        ),
    )
    return total["n"]


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """Per row: doc_id, tie, n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = saved(item_windows(items, span), "bench-windows")
    spans = sorted(r["span"] for r in windows.select("span").distinct().collect())  # 1 to ``span``
    rows = _keyed(docs)
    n_words = F.size(split_words(F.col("text"), RAW_SEPARATOR)).cast("bigint")
    none = F.sha2(F.lit("").cast("binary"), 256)
    if not spans:
        zero = F.lit(0).cast("bigint")
        return rows.select("doc_id", "tie", n_words.alias("n_words"), zero.alias("n_hit"), zero.alias("n_items"), none.alias("items_sha256"), F.lit(False).alias("contaminated"))
    prints = saved(window_prints(windows, spans), "bench-prints")
    found = saved(candidates(docs, prints, spans), "bench-candidates")
    found = found.withColumnsRenamed({"doc_id": "__doc", "tie": "__tie"})
    joined = rows.join(small(found), F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("tie") == F.col("__tie")), "left")

    def real(w: Column) -> Column:
        return F.filter("at", lambda c: F.array_join(F.slice(w, c["start"] + 1, c["span"]), " ") == c["window"])

    hits = F.when(F.col("at").isNotNull(), let(item_words(F.col("text")), real))
    judged = joined.select("doc_id", "tie", n_words.alias("n_words"), F.explode(F.array(F.struct(hits.alias("hits")))).alias("x"))
    judged = judged.select(
        "doc_id", "tie", "n_words",
        F.coalesce(covered_words(F.col("x.hits")), F.lit(0).cast("bigint")).alias("n_hit"),
        F.array_distinct(F.transform("x.hits", lambda c: c["window"])).alias("windows"),
    )
    judged = saved(judged, "bench-judged")
    of_doc = judged.filter("n_hit > 0").select("doc_id", "tie", F.explode("windows").alias("window")).join(small(windows), "window")
    of_doc = of_doc.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    of_doc = of_doc.select(F.col("doc_id").alias("__doc"), F.col("tie").alias("__tie"), F.size("items").cast("bigint").alias("n"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("sha"))
    out = judged.join(small(saved(of_doc, "bench-items")), F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("tie") == F.col("__tie")), "left")
    return out.select(
        "doc_id", "tie", "n_words", "n_hit",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("sha", none).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """The rows of ``docs`` without a benchmark window."""
    bad = contamination(docs, items, span).filter("contaminated").select(F.col("doc_id").alias("__doc"), F.col("tie").alias("__tie")).distinct()
    plain, back = positional(docs)
    at = F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__tie"))
    return back(plain.join(small(saved(bad, "bench-bad")), at, "left_anti"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tie")
