"""The corpus pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet into the shared folder and read again as the next one's
input. All but the last return the columns of ``documents``.

Rows without a text, with an empty one or without doc_id are scored, mixed and
tokenized like any other; such texts are clean. Texts without words are near
copies of each other, so one of them stays. Repeated rows are near copies too.
Columns are found by exact name, whatever others differ from it by case; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm import decontaminate, mixing, near_dups, tokens, toxicity
from pairforge.llm.common import saved, table
from pairforge.session import ship_by_value

ship_by_value()


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    out = toxicity.scored(docs, table(spark, sf_dir, "labels"), "__toxicity")
    places = [f"_c{i}" for i in range(len(docs.columns))]  # names may differ by case alone
    kept = out.toDF(*places, "__toxicity").filter(F.col("__toxicity") < 0.5)
    return kept.select(*places).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the smallest doc_id."""
    return near_dups.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.token_output(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]
ORACLE_SQL = None  # learned scores, hashed signatures and tokens: no SQL for these


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
