"""File sinks and sources for pairs and split JSON lines.

* ``write_pairs``: the pair sink (Parquet or JSON lines, overwrite).
* ``write_splits``: chat records as JSON lines, one directory per split
  (``partitionBy("split")``), so reading one split prunes the other.
* ``read_splits``: typed read of the split directories back into one frame with
  a ``split`` column.
* ``read_json_array``: a file holding one JSON array of pair objects, or a folder
  of such files; ``write_json_arrays`` writes one.
* ``path_report``: existence of each input path; missing ones are reported,
  not raised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.operators.chat import MESSAGE_TYPE
from pairforge.session import literal_frame, path_exists
from pairforge.sources.json_array import array_elements

RECORD_SCHEMA = f"messages {MESSAGE_TYPE}"
PAIR_SCHEMA = "abstract string, plain_summary string"


def write_pairs(pairs: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = pairs.select("source", "source_ord", "o_part", "o_file", "o_row", "pair_key", "abstract", "plain_summary").write.mode("overwrite")
    if fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def compressed(codec: str) -> dict[str, str]:
    """Writer options of a codec for text files."""
    return {"compression": codec, "zlib.compress.level": "BEST_SPEED"}


def write_splits(records: DataFrame, out_dir: str, max_records_per_file: int = 1_000_000, compression: str = "none") -> None:
    """JSON lines below ``split=<name>`` folders. Records that carry the seeded
    permutation (``shuffle_hash``) are written in its order: range partitioned
    and sorted, so file names, then lines, follow it. Files are plain text unless
    ``compression`` names a codec (gzip at its fastest level); each is then read by
    one task."""
    rows = records
    if "shuffle_hash" in records.columns:
        order = ["split", "shuffle_hash", *(c for c in ("pair_key",) if c in records.columns)]
        n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = records.repartitionByRange(n, *order).sortWithinPartitions(*order)
    (
        rows.select("split", "messages")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .options(**compressed(compression))
        .partitionBy("split")
        .json(out_dir)
    )


def read_splits(spark: SparkSession, out_dir: str, splits: Sequence[str] = ("train", "val")) -> DataFrame:
    """Typed read of the split directories; the partition column gives ``split``."""
    df = spark.read.schema(f"{RECORD_SCHEMA}, split string").json(out_dir)
    return df.filter(F.col("split").isin(list(splits)))


def write_json_arrays(rows: DataFrame, key: str, path: str, max_rows: int, compression: str = "gzip") -> None:
    """A folder of JSON array files of at most ``max_rows`` objects (the columns
    but ``key``, a whole number). File paths, then objects, follow ``key``."""
    group = F.expr(f"`{key}` div {max_rows}")
    w = Window.partitionBy("group").orderBy(key)
    # sorted by the partition columns and place, as the writer keeps it
    placed = rows.withColumn("group", group).repartitionByRange("group").withColumn("place", F.row_number().over(w) - 1)
    placed = placed.withColumn("last", F.lead("place").over(w).isNull() | (F.col("place") % max_rows == max_rows - 1))
    value = F.concat(
        F.when(F.col("place") % max_rows == 0, F.lit("[")).otherwise(F.lit(",")),
        F.to_json(F.struct(*[c for c in rows.columns if c != key])),
        F.when(F.col("last"), F.lit("]")).otherwise(F.lit("")),
    )
    # numbers of one width, so that paths sort as they do
    group, part = F.col("group") + 10**17, F.expr(f"place div {max_rows}") + 10**10
    placed = placed.select(group.alias("group"), part.alias("part"), "place", value.alias("value"))
    placed.sortWithinPartitions("group", "part", "place").select("group", "part", "value").write.partitionBy("group", "part").text(path, compression=compression)


# elements are parsed like JSON text elsewhere here: strictly, of any string length
STRICT = {"mode": "FAILFAST", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": str(2**31 - 1)}


def read_json_array(spark: SparkSession, path: str, schema: str = PAIR_SCHEMA) -> DataFrame | None:
    """A file holding one JSON array of objects, or a folder of them: the fields of
    ``schema`` with ``file_path`` and ``element`` (its place in the array); None
    (skipped) when missing. A file is read by many tasks (``array_elements``).
    """
    if not path_exists(spark, path):
        return None
    found = array_elements(spark, path)
    return found.select("file_path", "element", F.from_json("value", schema, STRICT).alias("r")).select("r.*", "file_path", "element")


def path_report(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per path: ``path, status`` with status 'ok' or 'missing'."""
    rows = [(p, "ok" if path_exists(spark, p) else "missing") for p in paths]
    return literal_frame(spark, rows, "path string, status string")
