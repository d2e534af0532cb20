"""Line deduplication over levelled sorted runs of line hashes.

A run is a Parquet table sorted by key within its hash partitions: per line key
the number of documents that hold it and the largest doc_id among them. Each
new batch of documents is reduced to one run; a merge join against the keys of
the runs so far marks those that are new (the anti-join's rows: ``fresh``), and
the run joins level 0. A key is fresh in one run only, so that side of the merge
has each key once; in later runs it only adds to the count. When a level holds
``FANOUT`` runs they are merged (counts summed, largest doc_id kept) into one run
of the next level, so a key is rewritten once per level, and there are few runs to
merge at any time. The list of runs is a small committed file, so a later session
can go on.

A table is deduplicated in batches of descending doc_id. The document that first
brings a key, the largest doc_id of the batch where it is fresh, keeps the key's
lines; every other document that holds it has a repeat, which goes if the runs
count ``MIN_DOCS`` documents in the end. There are ``BATCHES`` batches, or as many
as ``BATCH_KEYS`` lines each ask for.

A line's key is the line stripped of ASCII white space, A-Z in lower case; keys
under ``MIN_CHARS`` code points take no part. Keys are held as 128-bit hashes.

Null and empty texts are one empty line. A row without doc_id loses no line and
counts for none; rows of one doc_id are one document. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.common import column, frugal, pick, saved, small, table, tune
from pairforge.llm.shared_files import CommittedFile, locate
from pairforge.session import scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
FANOUT = 3
BATCHES = 7
BATCH_KEYS = 20_000_000_000  # a batch reads the runs once: more of them cost more
RUN_SCHEMA = "key binary, n_docs bigint, max_doc bigint, fresh boolean"


def line_key(line: bytes) -> bytes | None:
    """The hash of a line's key, or None if the key is too short."""
    k = line.strip().lower()
    if len(k) < MIN_CHARS or not k.isascii() and len(k.decode()) < MIN_CHARS:
        return None
    return xxhash.xxh3_128_digest(k)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        docs, keys = [], []
        for doc, text in zip(column(b, "doc_id").to_pylist(), column(b, "text").to_pylist()):
            own = {k for line in text.encode().split(b"\n") if (k := line_key(line))}
            keys += own
            docs += [doc] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(docs, pa.int64())], ["key", "doc_id"])


def line_keys(docs: DataFrame) -> DataFrame:
    """(key, doc_id), once per row and key."""
    tune(docs.sparkSession)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(frugal(_keys), "key binary, doc_id bigint")


class LineRuns:
    """The levelled runs below ``root``."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT):
        self.spark, self.root, self.fanout = spark, root, fanout
        self.levels: list[list[str]] = []
        self.turn = 0
        fs, base = locate(root)
        found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
        lists = sorted(f.path for f in found if f.type == pafs.FileType.File and f.base_name.startswith("runs-"))
        if lists:
            self.turn = int(lists[-1].rsplit("runs-", 1)[1].removesuffix(".json"))
            with fs.open_input_stream(lists[-1]) as f:
                self.levels = json.loads(f.read())

    def _commit(self) -> None:
        """Write the list of runs under the next number; the highest one counts."""
        self.turn += 1
        f = CommittedFile(self.root, f"runs-{self.turn:09d}.json")
        f.write(json.dumps(self.levels).encode())
        f.commit()

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def _read(self, names: list[str]) -> DataFrame:
        schema = self.spark.createDataFrame([], RUN_SCHEMA).schema
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{n}" for n in names]) if names else self.spark.createDataFrame([], RUN_SCHEMA)

    def _write(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"run-{level}-{len(self.runs())}-{hashlib.md5(json.dumps(self.levels).encode()).hexdigest()[:12]}"
        run.sortWithinPartitions("key").write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        self.levels[level].append(name)

    def merged(self, names: list[str] | None = None) -> DataFrame:
        """One row per key over the given runs (all runs)."""
        runs = self._read(self.runs() if names is None else names)
        return runs.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"), F.max("fresh").alias("fresh"))

    def mark(self, run: DataFrame) -> DataFrame:
        """A batch's run with ``fresh``: no earlier run holds the key."""
        if not self.runs():
            return run.withColumn("fresh", F.lit(True))
        known = self._read(self.runs()).filter("fresh").select("key", F.lit(False).alias("new")).hint("merge")
        return run.join(known, "key", "left").select(*run.columns, F.coalesce("new", F.lit(True)).alias("fresh"))

    def add(self, keys: DataFrame, merge: bool = True) -> str:
        """Add a batch of (key, doc_id); a document belongs to one batch only.
        Returns the folder of the batch's run (which a merge may supersede)."""
        run = keys.groupBy("key").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("max_doc"))
        self._write(self.mark(run), 0)
        own = f"{self.root}/{self.levels[0][-1]}"
        if merge:
            self.compact()
        return own

    def compact(self) -> None:
        """Merge the levels that are full, from the lowest up."""
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self.merged(full), level + 1)
            level += 1
        self._commit()


def new_lines(runs: LineRuns, docs: DataFrame) -> DataFrame:
    """Incremental use: add a batch; (key, doc_id) of its lines that no earlier
    run holds (of each key the largest doc_id)."""
    own = runs.add(saved(line_keys(docs), "line-keys"))
    return runs.spark.read.parquet(own).filter("fresh").select("key", F.col("max_doc").alias("doc_id"))


def repeats(batch: DataFrame, run: DataFrame) -> DataFrame:
    """Saved (key, doc_id) of a batch: all but the document that brings a key which
    is fresh in the batch's ``run``."""
    known = F.col("doc_id") != F.col("max_doc")
    some = run.filter("NOT fresh OR n_docs > 1").select("key", "fresh", "max_doc")  # most keys are one fresh line
    got = batch.join(small(saved(some, "line-known")), "key").filter(~F.col("fresh") | known)
    return saved(got.select("key", "doc_id"), "line-repeats")


def _descending(keys: DataFrame, batches: int) -> Iterator[DataFrame]:
    """(key, doc_id) in ranges of doc_id, the largest first; about equal in size."""
    n = max(batches, -(-keys.count() // BATCH_KEYS))
    cuts = sorted(set(keys.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.01)), reverse=True)  # n numbers
    above: float | None = None
    for cut in [*cuts, None]:
        part = keys if cut is None else keys.filter(F.col("doc_id") > int(cut))
        yield part if above is None else part.filter(F.col("doc_id") <= int(above))
        above = cut


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_lines, n_dropped, texts = [], [], []
        for text, drop in zip(column(b, "text").to_pylist(), column(b, "drop").to_pylist()):
            raw = (text or "").encode()
            lines = raw.split(b"\n")
            kept = lines
            if drop:
                gone = set(drop)
                kept = [x for x in lines if line_key(x) not in gone]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
            texts.append(raw.decode() if kept is lines else b"\n".join(kept).decode())
        yield pa.RecordBatch.from_arrays(
            [column(b, "doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept_text"],
        )


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text): keys in ``min_docs`` documents or
    more keep their lines only in the largest doc_id that holds them."""
    spark = docs.sparkSession
    keys = saved(line_keys(docs), "line-keys")
    runs = LineRuns(spark, scratch_path(spark, "line-runs"))
    found: DataFrame | None = None
    for batch in _descending(keys, batches):
        own = spark.read.parquet(runs.add(batch, merge=False))
        mine = repeats(batch, own)
        found = mine if found is None else found.unionByName(mine)
        runs.compact()
    hot = saved(runs.merged().filter(F.col("n_docs") >= min_docs).select("key"), "line-hot")
    drop = found.join(small(hot), "key").groupBy("doc_id").agg(F.collect_set("key").alias("drop"))
    drop = saved(drop, "line-drop")
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = rows.join(small(drop), "doc_id", "left").select("doc_id", "text", "drop")
    return rows.mapInArrow(frugal(_apply), "doc_id bigint, n_lines bigint, n_dropped bigint, kept_text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    )
