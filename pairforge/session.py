"""Session helpers: a local session for tests/bench, and shared scratch paths.

Library functions never create a session; they take DataFrames (or the session
of a DataFrame). Scratch output always goes below ``spark.checkpoint.dir``,
which on a cluster names a shared folder; a private one is set only when the
session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on (all runtime SQL confs).
REQUIRED_CONF = {
    # JSON lines may repeat a key; like Python's json.loads the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Suggested settings for a large cluster (applied by the cluster's own session
# setup, not by this library): AQE sizes shuffle partitions from the data and
# splits skewed ones; 256 MB input splits and shuffle partitions keep tasks
# well inside executor memory for text rows of up to a few MB.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    **REQUIRED_CONF,
}


def ship_by_value() -> None:
    """Pickle this package's functions by value when Spark sends them to Python
    workers (``mapInPandas`` rewriters, pandas UDFs), so executors need no
    installed copy of the package; the alternative is ``--py-files``."""
    import pairforge
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(pairforge)


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "pairforge", event_log_dir: str | None = None
) -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on). With
    ``event_log_dir`` Spark writes its event log there (stage and task times)."""
    builder = SparkSession.builder
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set a private one only
    when the session has none (as in tests)."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="pairforge-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/pairforge/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Delete a table this library wrote with ``scratch_path``; refuses any other
    path. Returns whether something was deleted."""
    root = checkpoint_root(spark).rstrip("/") + "/pairforge/"
    if not path.startswith(root):
        raise ValueError(f"not a pairforge scratch path: {path}")
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame | None:
    """``df`` (a written table of narrow rows) marked for broadcasting if it has
    ``max_rows`` rows at most; otherwise None, and the caller joins by a shuffle."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= max_rows else None


def side_table(df: DataFrame, name: str, most_rows: int = 100_000) -> DataFrame:
    """``df`` (narrow rows, one per file or byte range) written to the scratch folder
    and marked for broadcasting up to ``most_rows``, so that the rows it is joined
    with are not shuffled."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    small = checked_broadcast(rows, most_rows)
    return rows if small is None else small


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for any scheme)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small frame of driver-side literals built JVM-side (no Python worker
    round trip, unlike ``createDataFrame`` from a list)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DataType

    st = DataType.fromDDL(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)]) for r in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def sf_table(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
