"""Text pairs: clean, length-filter, cap per source, union in source order.

A prepared pair row has the columns of ``PAIR_COLUMNS``:

* ``source`` / ``source_ord``: the source name and its position in the union;
* ``o_part, o_file, o_row``: the order inside the source (file order then row
  order for file sources, any unique order for table sources);
* ``pair_key``: a unique text key (source name + the source's key columns),
  used for seeded shuffling so that equal texts still get distinct places;
* ``abstract`` (technical text) and ``plain_summary`` (plain-language text).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import groupby

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.text import char_length, py_strip, stringify, truncate
from pairforge.operators.select import kth_key, le_key
from pairforge.session import literal_frame
from pairforge.sources.parquet import ordered_files, pick_columns, relative_path, resolve_columns, scan_texts, select_by_position

ORDER_COLS = ["o_part", "o_file", "o_row"]
PAIR_COLUMNS = ["source", "source_ord", *ORDER_COLS, "pair_key", "abstract", "plain_summary"]
MIN_CHARS = 50


@dataclass
class PairSource:
    """One source of pairs: a frame with an explicit unique order.

    ``order`` maps the frame to ``(o_part, o_file, o_row)``: each entry is a
    column name or None (constant). ``key_cols`` make ``pair_key`` unique within
    the source. ``cap`` keeps the first accepted pairs in that order (None: no
    cap). ``truncate`` cuts the input text to that many code points. A capped file
    source has no frame, but ``scan``s the files it is asked for.
    """

    name: str
    frame: DataFrame | None
    order: tuple[str | None, str | None, str | None]
    key_cols: Sequence[str]
    cap: int | None = None
    truncate: int | None = None
    enabled: bool = True
    columns: tuple[str, str] | None = field(default=None)
    # file sources: (path_ord, file) in scan order, for the early-stopping cap
    files: list[tuple[int, str]] | None = field(default=None, repr=False)
    scan: Callable[[list[tuple[int, str]]], DataFrame] | None = field(default=None, repr=False)

    def rows(self) -> DataFrame:
        return self.frame if self.frame is not None else self.scan(self.files)


def parquet_source(
    spark: SparkSession,
    name: str,
    paths: Sequence[str],
    cap: int | None = None,
    truncate_input: int | None = None,
    enabled: bool = True,
) -> PairSource:
    """Pair source over Parquet files in list order. Text columns are resolved
    once, from the first file that has both; other files are read where they have
    them, whatever their types (``scan_texts``)."""
    cols = resolve_columns(spark, paths)

    def scan(files: list[tuple[int, str]]) -> DataFrame:
        groups = [(o, [f for _, f in g]) for o, g in groupby(files, key=lambda x: x[0])]
        return scan_texts(spark, [g for _, g in groups], cols, ordinals=[o for o, _ in groups], roots=[paths[o] for o, _ in groups])

    return PairSource(
        name=name,
        frame=scan_texts(spark, paths, cols) if cap is None else None,
        scan=scan,
        order=("path_ord", "file_path", "row_index"),
        key_cols=("path_ord", "rel_path", "row_index"),
        cap=cap,
        truncate=truncate_input,
        enabled=enabled,
        columns=cols,
        files=ordered_files(spark, paths) if cap is not None else None,
    )


def json_array_source(spark: SparkSession, name: str, path: str, cap: int | None = None) -> PairSource | None:
    """Pair source over a file holding one JSON array of pair objects
    (``abstract``, ``plain_summary``), or over a folder of such files in path
    order; None when it is missing (skipped). Each file is read by many tasks and
    a pair's place is its element number in the array.
    """
    from pairforge.sources.splits import read_json_array

    df = read_json_array(spark, path)
    if df is None:
        return None
    pair = ("abstract", "plain_summary")
    frame = df.select(*pair, "file_path", relative_path(F.col("file_path"), path).alias("rel_path"), F.col("element").alias("row"))
    return PairSource(name=name, frame=frame, order=(None, "file_path", "row"), key_cols=("rel_path", "row"), cap=cap, columns=pair)


def clean_pair_columns(frame: DataFrame, columns: tuple[str, str] | None = None, truncate_input: int | None = None):
    """(abstract, plain_summary) expressions: stringify, strip, truncate input.

    Scalar columns are stringified; a list, map or struct text column is an
    error (its text form would be engine-specific)."""
    from pyspark.sql.types import ArrayType, MapType, StructType

    inp, out = columns or pick_columns(frame.columns)
    for c in (inp, out):
        dt = next(f.dataType for f in frame.schema.fields if f.name == c)
        if isinstance(dt, (ArrayType, MapType, StructType)):
            raise TypeError(f"text column {c!r} is not a scalar: {dt.simpleString()}")
    a = truncate(py_strip(stringify(F.col(f"`{inp}`"))), truncate_input)
    b = py_strip(stringify(F.col(f"`{out}`")))
    return a.alias("abstract"), b.alias("plain_summary")


def pair_filter(min_chars: int = MIN_CHARS):
    """Both sides non-empty and longer than ``min_chars`` code points (strict)."""
    return (char_length("abstract") > min_chars) & (char_length("plain_summary") > min_chars)


def prepare_pairs(src: PairSource, source_ord: int = 0, min_chars: int = MIN_CHARS) -> DataFrame:
    """Column pick -> stringify -> strip -> truncate -> length filter.

    No cap; see ``cap_pairs``. Narrow: one codegen stage after the scan.
    """
    frame = src.rows()
    cols = src.columns or pick_columns(frame.columns)
    if len({c.lower() for c in frame.columns}) != len(frame.columns):
        keep = [c for c in dict.fromkeys([*cols, *[o for o in src.order if o], *src.key_cols])]
        frame = select_by_position(frame, keep)
    a, b = clean_pair_columns(frame, cols, src.truncate)
    o_part, o_file, o_row = src.order
    return (
        frame.select(
            F.lit(src.name).alias("source"),
            F.lit(source_ord).cast("int").alias("source_ord"),
            (F.col(o_part) if o_part else F.lit(0)).cast("bigint").alias("o_part"),
            (F.col(o_file) if o_file else F.lit("")).cast("string").alias("o_file"),
            (F.col(o_row) if o_row else F.lit(0)).cast("bigint").alias("o_row"),
            F.concat_ws(":", F.lit(src.name), *[F.col(k).cast("string") for k in src.key_cols]).alias("pair_key"),
            a,
            b,
        )
        .filter(pair_filter(min_chars))
    )


def cap_pairs(pairs: DataFrame, cap: int | None, order_cols: Sequence[str] = ORDER_COLS) -> DataFrame:
    """First ``cap`` rows in ``order_cols`` order (exact; cap 0 keeps nothing).

    The threshold key comes from ``kth_key`` over a persisted key-only frame
    (never the texts); the result is one narrow filter on ``pairs``.
    """
    if cap is None:
        return pairs
    if cap <= 0:
        return pairs.limit(0)
    keys = pairs.select(*order_cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        t = kth_key(keys, order_cols, cap)
    finally:
        keys.unpersist()
    if t is None:
        return pairs
    return pairs.filter(le_key(order_cols, t, pairs))


def cap_file_source(src: PairSource, source_ord: int = 0, min_chars: int = MIN_CHARS, growth: int = 4) -> DataFrame:
    """Cap a file source without reading files past the cap.

    Accepted pairs are counted over a growing prefix of the ordered file list
    (1, growth, growth^2, ... files) until the prefix holds ``cap`` pairs or all
    files; the threshold is then selected inside that prefix only. Files after
    it are never opened, and the work stays within growth/(growth-1) of the
    prefix that is needed.
    """
    files = src.files or []
    cap = src.cap
    if cap is None or not files or cap <= 0:
        src = replace(src, frame=src.scan(files[:1])) if files and cap == 0 else src
        return cap_pairs(prepare_pairs(src, source_ord, min_chars), cap)
    take = 1
    while True:
        sub = replace(src, frame=src.scan(files[:take]), files=None)
        prepared = prepare_pairs(sub, source_ord, min_chars)
        keys = prepared.select(*ORDER_COLS).persist(StorageLevel.MEMORY_AND_DISK)
        n = keys.count()
        if n >= cap or take >= len(files):
            break
        keys.unpersist()
        take = min(len(files), take * growth)
    try:
        t = kth_key(keys, ORDER_COLS, cap, total=n)
    finally:
        keys.unpersist()
    return prepared if t is None else prepared.filter(le_key(ORDER_COLS, t, prepared))


def union_sources(sources: Sequence[PairSource], min_chars: int = MIN_CHARS) -> DataFrame:
    """Prepared and capped pairs of all enabled sources, in list order
    (``source_ord``), duplicates kept.

    File sources with a cap stop opening files once the cap is met
    (``cap_file_source``). The other capped sources are counted together: their
    key-only frames are unioned and persisted, one aggregation counts accepted
    pairs per source (a row per source), and only sources over their cap get a
    threshold, selected from the persisted keys.
    """
    prepared: dict[int, DataFrame] = {}
    table_capped: list[tuple[int, int]] = []
    for i, s in enumerate(sources):
        if not s.enabled:
            continue
        if s.files and s.cap is not None:
            prepared[i] = cap_file_source(s, i, min_chars)
            continue
        p = prepare_pairs(s, i, min_chars)
        if s.cap is not None and s.cap <= 0:
            p = p.limit(0)
        elif s.cap is not None:
            table_capped.append((i, s.cap))
        prepared[i] = p
    if not prepared:
        raise ValueError("no enabled source")
    if table_capped:
        keys = reduce(
            lambda x, y: x.unionByName(y),
            [prepared[i].select("source_ord", *ORDER_COLS) for i, _ in table_capped],
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = {r["source_ord"]: r["n"] for r in keys.groupBy("source_ord").agg(F.count(F.lit(1)).alias("n")).collect()}
            for i, cap in table_capped:
                n = counts.get(i, 0)
                if n <= cap:
                    continue
                t = kth_key(keys.filter(F.col("source_ord") == i), ORDER_COLS, cap, total=n)
                if t is not None:
                    prepared[i] = prepared[i].filter(le_key(ORDER_COLS, t, prepared[i]))
        finally:
            keys.unpersist()
    return reduce(lambda x, y: x.unionByName(y), [prepared[i] for i in sorted(prepared)])


def source_counts(pairs: DataFrame, sources: Sequence[PairSource]) -> DataFrame:
    """Rows per source plus a combined row (``source`` NULL, ``is_total`` true).

    Enabled sources with no rows show 0: the aggregate (partial, map-side) is
    joined to the source list, whose size is the number of sources.
    """
    spark = pairs.sparkSession
    listed = [(s.name, i, False) for i, s in enumerate(sources) if s.enabled] + [(None, None, True)]
    names = literal_frame(spark, listed, "source string, source_ord int, is_total boolean")
    per = pairs.rollup("source").agg(F.count(F.lit(1)).alias("pairs"), (F.grouping("source") == 1).alias("all"))
    per = per.select(F.col("source").alias("of"), "pairs", "all")
    at = (F.col("is_total") & F.col("all")) | (~F.col("is_total") & ~F.col("all") & (F.col("source") == F.col("of")))
    return names.join(F.broadcast(per), at, "left").select(
        "source", "source_ord", F.coalesce("pairs", F.lit(0)).cast("bigint").alias("pairs"), "is_total"
    )
