"""The training-data build as one Spark job chain.

sources -> column pick -> strip -> truncate -> length filter -> cap per source
-> union in source order -> chat record -> seeded exact split -> JSON lines.

Actions: one count and a few bounded histogram/sample passes for every cap and
for the split (see ``operators.select``), then the write. The union is written
as a Parquet table into the shared folder named by ``spark.checkpoint.dir``
before the split: the split's passes read only its key column, the write reads
the table instead of re-scanning and re-filtering every source, and a lost
executor costs a re-read, not a re-run of the whole chain.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.operators.chat import SYSTEM_PROMPT, format_chat
from pairforge.operators.pairs import PairSource, source_counts, union_sources
from pairforge.operators.sampling import group_split, train_val_split
from pairforge.plans.views import pairs_conv, pairs_doc
from pairforge.session import drop_scratch, literal_frame, scratch_path
from pairforge.sources.splits import write_pairs, write_splits
from pairforge.sources.versions import publish

# Caps and cuts are options of a source, off by default: the build takes every
# accepted pair. 10 % validation with seed 42.
TRUNCATE_EXAMPLE = 1500
VAL_RATIO = 0.1
SEED = 42
SEQUENCE_LIMIT = 1536  # tokens of a training record


def conv_source(spark: SparkSession, sf_dir: str, cap: int | None = None, truncate_input: int | None = None) -> PairSource:
    return PairSource(
        name="conv",
        frame=pairs_conv(spark, sf_dir),
        order=("conv_id", None, "turn"),
        key_cols=("conv_id", "turn"),
        cap=cap,
        truncate=truncate_input,
    )


def doc_source(spark: SparkSession, sf_dir: str, cap: int | None = None, truncate_input: int | None = None) -> PairSource:
    return PairSource(
        name="doc",
        frame=pairs_doc(spark, sf_dir),
        order=(None, None, "doc_id"),
        key_cols=("doc_id",),
        cap=cap,
        truncate=truncate_input,
    )


def default_sources(spark: SparkSession, sf_dir: str) -> list[PairSource]:
    return [conv_source(spark, sf_dir), doc_source(spark, sf_dir)]


def materialize(df: DataFrame, name: str = "pairs") -> DataFrame:
    """Cut the lineage: write ``df`` as a Parquet table into the shared folder
    named by ``spark.checkpoint.dir`` and read it back.

    Unlike ``DataFrame.checkpoint()`` (row-serialized blocks), later passes read
    the table columnar and pruned: the split's selection passes read only the
    row key, not the texts.
    """
    return materialize_at(df, name)[0]


def materialize_at(df: DataFrame, name: str = "pairs") -> tuple[DataFrame, str]:
    """``materialize``, and the table's path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path), path


@dataclass
class BuildResult:
    pairs: DataFrame  # union of prepared, capped pairs (written table when checkpointed)
    records: DataFrame  # pair_key, shuffle_hash, split, messages
    counts: DataFrame  # source counts
    path: str | None = None  # the scratch table of ``pairs``, for ``drop_scratch``


def build_records(
    sources: Sequence[PairSource],
    val_ratio: float = VAL_RATIO,
    seed: int = SEED,
    system_prompt: str = SYSTEM_PROMPT,
    checkpoint: bool = True,
    group_cols: Sequence[str] | None = None,
    pairs: DataFrame | None = None,
) -> BuildResult:
    """Pairs, chat records and counts. With ``group_cols`` (of ``abstract`` and
    ``plain_summary``) pairs that agree in them stay on one side of the split.
    Several builds of the same sources may share ``pairs``, their union as a written
    table, which is then the caller's to drop."""
    path = None
    if pairs is None:
        pairs = union_sources(sources)
        if checkpoint:
            pairs, path = materialize_at(pairs)
    texts = pairs.select("pair_key", "abstract", "plain_summary")
    if group_cols:
        records = group_split(texts, val_ratio, seed, group_cols)
    else:
        records = train_val_split(texts, val_ratio=val_ratio, seed=seed)
    records = format_chat(records, system_prompt, keep=("pair_key", "shuffle_hash", "split"))
    return BuildResult(pairs=pairs, records=records, counts=source_counts(pairs, sources), path=path)


def split_counts(records: DataFrame) -> DataFrame:
    """Records per split; both splits always present (0 when empty)."""
    spark = records.sparkSession
    names = literal_frame(spark, [("train",), ("val",)], "split string")
    per = records.groupBy("split").agg(F.count(F.lit(1)).alias("records"))
    return names.join(F.broadcast(per), "split", "left").select(
        "split", F.coalesce("records", F.lit(0)).cast("bigint").alias("records")
    )


def run_build(
    spark: SparkSession,
    sources: Sequence[PairSource],
    out_dir: str,
    val_ratio: float = VAL_RATIO,
    seed: int = SEED,
    pairs_dir: str | None = None,
    group_cols: Sequence[str] | None = None,
    versioned: bool = False,
    pairs: DataFrame | None = None,
    compression: str = "none",
) -> DataFrame:
    """Build and write ``out_dir/split=train|val`` JSON lines, and the pairs below
    ``pairs_dir`` if given; returns the split counts. Empty input writes no splits
    and reports 'no data'. ``versioned`` publishes the splits as a new version of
    ``out_dir`` (``sources.versions``) in place of overwriting it. ``pairs``: see
    ``build_records``; ``compression``: see ``write_splits``."""
    res = build_records(sources, val_ratio, seed, group_cols=group_cols, pairs=pairs)
    try:
        if pairs_dir is not None:
            write_pairs(res.pairs, pairs_dir)
        rows = split_counts(res.records).collect()  # two rows
        total = sum(r["records"] for r in rows)
        if total > 0 and versioned:
            publish(spark, out_dir, lambda folder: write_splits(res.records, folder, compression=compression))
        elif total > 0:
            write_splits(res.records, out_dir, compression=compression)
    finally:
        # the intermediate union table is not needed once the splits are written
        if res.path is not None:
            drop_scratch(spark, res.path)
    status = "written" if total > 0 else "no data"
    return literal_frame(spark, [(r["split"], r["records"], status) for r in rows], "split string, records bigint, status string")


def run_pipeline(
    spark: SparkSession,
    sources: Sequence[PairSource],
    out_dir: str,
    pairs_dir: str | None = None,
    val_ratio: float = VAL_RATIO,
    seed: int = SEED,
    compression: str = "none",
) -> DataFrame:
    """Build, write the pairs (when ``pairs_dir`` is given) and the splits, then
    validate the written files; returns the check's report per split."""
    from pairforge.plans.check import check_split_files

    run_build(spark, sources, out_dir, val_ratio, seed, pairs_dir, compression=compression)
    return check_split_files(spark, out_dir)
