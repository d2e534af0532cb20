"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger holds the measurements and
one bit per failed rule; a policy is a named set of rules, so applying another
version, or asking what one rule costs, reads the ledger and not the texts.

Nulls: a null text has no words and fails ``few_words``. Empty texts do as well;
an empty table gives no rows; repeated rows get equal rows; other columns are
ignored. Only built-in functions run on the texts. Repeated windows are found
by 64-bit hashes inside one document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.common import pick, table

SEPARATOR = r"[\x20\x09-\x0D]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT = 30  # percent of words in repeated windows

# bit -> (name, failure as a condition on the measurements)
RULES: list[tuple[str, Callable[[], Column]]] = [
    ("few_words", lambda: F.col("n_words") < MIN_WORDS),
    ("repeated_windows", lambda: 100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")),
    ("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    ("repeated_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    ("stutter", lambda: 10 * F.col("n_stutter") > 3 * F.col("n_words")),
    ("short_or_long_words", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 25 * F.col("n_words"))),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
POLICIES = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["repeated_lines"],
    "v2": sum(BIT.values()),
}
POLICY = "v2"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutter"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is evaluated once (a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column, separator: str = SEPARATOR) -> Column:
    return F.array_remove(F.split(text, separator, -1), "")


def hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def gram_hashes(h: Column, k: int) -> Column:
    """Hash of the k entries from each place on; the array is k-1 shorter."""
    n = F.greatest(F.size(h) - (k - 1), F.lit(0))
    return F.transform(F.slice(h, F.lit(1), n), lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))


def covered(starts: Column, width: int) -> Column:
    """Places covered by windows of a width at the given ascending starts."""
    total = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("upto")),
        lambda acc, p: F.struct(
            (acc["n"] + (p + width) - F.greatest(p.cast("bigint"), acc["upto"])).alias("n"), (p + width).cast("bigint").alias("upto")
        ),
    )
    return total["n"]


def repeated_words(h: Column) -> Column:
    """Words inside windows that occur twice or more. Most texts have none, which
    a distinct count shows; else equal windows meet by sorting (hash, place)."""

    def of_windows(w: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            def repeated(x: Column, i: Column) -> Column:
                # i - 1 is -1 for the first: get gives null there
                return F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))

            return covered(F.sort_array(F.transform(F.filter(s, repeated), lambda x: x["at"])), WINDOW)

        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(let(ordered, of_sorted))

    return let(gram_hashes(h, WINDOW), of_windows)


def stutters(h: Column) -> Column:
    """Words equal to the word before them."""
    return F.size(F.filter(h, lambda x, i: F.coalesce(F.get(h, i - 1) == x, F.lit(False))))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each text."""
    text = F.coalesce("text", F.lit(""))
    words = split_words(text)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return let(
            hashes(w),
            lambda h: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                repeated_words(h).alias("n_repeat_words"),
                stutters(h).cast("bigint").alias("n_stutter"),
            ),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))

    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.inline(F.array(F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l")))),
    )
    return rows.select("doc_id", "n_symbols", "w.*", "l.*").select("doc_id", *MEASURES)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: a bit per failed rule."""
    bits = F.lit(0).cast("bigint")
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(fails(), F.lit(BIT[name]).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return measure(docs).withColumn("failed", bits)


def passes(policy: str | int, failed: str = "failed") -> Column:
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col(failed).bitwiseAND(F.lit(mask).cast("bigint")) == 0


def ablations(led: DataFrame, policy: str = POLICY) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that
    the policy would keep without it. One aggregation over the failure bits."""
    mask = POLICIES[policy]
    per_mask = led.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("bigint")).alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    parts = []
    for name, bit in BIT.items():
        if mask & bit:
            fails = F.col("failed").bitwiseAND(F.lit(bit).cast("bigint")) != 0
            parts += [
                F.struct(
                    F.lit(name).alias("rule"),
                    F.coalesce(F.sum(F.when(fails, F.col("n"))), F.lit(0)).alias("n_failed"),
                    F.coalesce(F.sum(F.when(F.col("failed") == bit, F.col("n"))), F.lit(0)).alias("n_failed_alone"),
                    F.coalesce(F.sum(F.when(F.col("failed").bitwiseAND(F.lit(mask & ~bit).cast("bigint")) == 0, F.col("n"))), F.lit(0)).alias("n_kept_without"),
                )
            ]
    return per_mask.agg(F.array(*parts).alias("r")).select(F.inline("r"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = ledger(table(spark, sf_dir, "documents"))
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), passes(POLICY).alias("kept"),
    )
