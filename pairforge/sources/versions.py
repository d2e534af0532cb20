"""Versioned output: a failed write never takes the place of good data.

A version is written into a folder of its own and then named in a small catalog
below the output folder. Readers resolve a version from the catalog once and read
its folder, so they see a whole version or none, also while the next is written.
What a stopped write leaves behind is in no catalog entry and no reader's way.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.session import literal_frame, path_exists

CATALOG = "version bigint, folder string, note string"


class NoVersionError(LookupError):
    pass


def versions(spark: SparkSession, out: str) -> DataFrame:
    """The published versions: (version, folder, note), one row each."""
    if not path_exists(spark, f"{out}/_catalog"):
        return literal_frame(spark, [], CATALOG)
    rows = spark.read.schema(CATALOG).json(f"{out}/_catalog")
    # two writers that publish at the same time take the same number: one of them counts
    return rows.groupBy("version").agg(F.max_by(F.struct("folder", "note"), "folder").alias("r")).select("version", "r.*")


def publish(spark: SparkSession, out: str, write: Callable[[str], None], note: str = "") -> int:
    """Let ``write`` fill a new folder, then publish it; returns its version (from
    1). If ``write`` raises, nothing is published."""
    folder = f"data/{uuid.uuid4().hex}"
    write(f"{out}/{folder}")
    if not path_exists(spark, f"{out}/{folder}"):
        raise ValueError("nothing was written")
    version = (versions(spark, out).agg(F.max("version")).first()[0] or 0) + 1
    # Spark's commit of this one-row write is the moment of publishing
    literal_frame(spark, [(version, folder, note)], CATALOG).coalesce(1).write.mode("append").json(f"{out}/_catalog")
    return version


def resolve(spark: SparkSession, out: str, version: int | None = None) -> str:
    """The folder of a version (the latest by default), to read as often as needed."""
    known = versions(spark, out)
    pick = known.agg(F.max_by("folder", "version").alias("f")) if version is None else known.filter(F.col("version") == version).agg(F.max("folder").alias("f"))
    folder = pick.first()["f"]
    if folder is None:
        raise NoVersionError(f"no version {version or ''} in {out}".replace("  ", " "))
    return f"{out}/{folder}"
