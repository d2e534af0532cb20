"""Elements of JSON array files, read by many tasks per file.

A file that holds one JSON array of objects has no lines to split at: it may be
pretty-printed or one line of any length. It is read as text cut at every ``}``,
which Spark splits by byte ranges like lines. A piece may begin inside a string or
at any depth, so a first pass sums up each byte range for both cases (it starts
outside or inside a string): quote parity, change of depth, and how many pieces
end at each depth. Running sums over the ranges (a row each) give every range its
true start: in a string or not, depth, number of elements before it. A second
pass then tells elements apart: one that is a single piece is complete, parts of
others are put together by element number.

Strictness is that of ``json.load`` on such a file: text that is not an array, an
element that is not an object, a truncated file or text after the array raise
``JsonArrayError``; the elements themselves are parsed by the caller. ``\\}`` is no
escape in JSON, so no piece begins inside one. An empty array has no elements.
Compressed files are one byte range each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.session import checked_broadcast, scratch_path

_RANGE = ["file_path", "block_start"]
_INDEX = "file_path string, block_start bigint, parity int, delta0 bigint, delta1 bigint, depths0 array<bigint>, ends0 array<bigint>, depths1 array<bigint>, ends1 array<bigint>"
_ELEMENTS = "file_path string, element bigint, part bigint, whole boolean, value string"
_BLANK = b" \t\n\r"
RUN_BYTES = 1 << 20  # of text that a task looks at together: its marks take several times that


class JsonArrayError(ValueError):
    pass


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, block_start, lid, value): the text between closing braces, in
    file order by ``lid`` within a byte range."""
    df = spark.read.option("lineSep", "}").text(path)
    return df.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("lid"), "value"
    )


class _Marks:
    """Quotes and brackets of some pieces that follow each other.

    ``odd[k]``: whether piece k begins after an odd number of quotes, counted from
    the first piece; ``odd_end``: the same at its end. ``inner[h][k]``: change of
    depth inside piece k if the first piece begins outside (h = 0) or inside
    (h = 1) a string; its closing brace is ``brace[h][k]``.
    """

    def __init__(self, values: pa.Array, odd: bool):
        offs = np.frombuffer(values.buffers()[1], np.int64 if pa.types.is_large_string(values.type) else np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
        data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offs[0] : offs[-1]]
        offs = offs - offs[0]
        quotes = np.flatnonzero(data == 34)
        slashes = np.flatnonzero(data == 92)
        if len(quotes) and len(slashes):
            # the run of backslashes that ends right before a quote: its place less its first one's
            first = np.maximum.accumulate(np.where(np.diff(slashes, prepend=-2) > 1, np.arange(len(slashes)), 0))
            last = np.searchsorted(slashes, quotes) - 1
            run = np.where((last >= 0) & (slashes[last] == quotes - 1), last - first[last] + 1, 0)
            quotes = quotes[run % 2 == 0]
        at = np.searchsorted(quotes, offs)
        self.odd = (at[:-1] + odd) % 2 == 1
        self.odd_end = (at[1:] + odd) % 2 == 1
        self.inner, self.brace = [], []
        change = np.zeros(256, np.int8)
        change[[123, 91]], change[[125, 93]] = 1, -1
        brackets = np.flatnonzero(change[data])
        in_odd = (np.searchsorted(quotes, brackets) + odd) % 2 == 1
        piece = np.searchsorted(offs, brackets, "right") - 1
        for h in (0, 1):
            own = in_odd if h else ~in_odd
            self.inner.append(np.bincount(piece[own], change[data[brackets[own]]], minlength=len(values))[: len(values)].astype(np.int64))
            self.brace.append(-(self.odd_end if h else ~self.odd_end).astype(np.int64))


def _string_column(b: pa.RecordBatch) -> pa.Array:
    return b.column(b.schema.get_field_index("value"))


def _ranges(b: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """((file, byte range), first, end) of the batch's runs of pieces, cut so that
    none but a single piece has more than ``RUN_BYTES``."""
    files, blocks = b.column(b.schema.get_field_index("file_path")).to_pylist(), b.column(b.schema.get_field_index("block_start")).to_pylist()
    upto = np.cumsum(pc.fill_null(pc.binary_length(_string_column(b)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    for j in range(1, len(files) + 1):
        if j == len(files) or blocks[j] != blocks[i] or files[j] != files[i] or upto[j] - (upto[i - 1] if i else 0) > RUN_BYTES:
            yield (files[i], blocks[i]), i, j
            i = j


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, odd, depth = None, False, [0, 0]
    ends: list[dict[int, int]] = [{}, {}]

    def row() -> pa.RecordBatch:
        lists = [x for h in (0, 1) for x in (list(ends[h]), list(ends[h].values()))]
        cols = [pa.array([now[0]], pa.string()), pa.array([now[1]], pa.int64()), pa.array([int(odd)], pa.int32()), *[pa.array([d], pa.int64()) for d in depth]]
        return pa.RecordBatch.from_arrays([*cols, *[pa.array([x], pa.list_(pa.int64())) for x in lists]], [f.split()[0] for f in _INDEX.split(", ")])

    for b in batches:
        for key, i, j in _ranges(b):
            if key != now:
                if now is not None:
                    yield row()
                now, odd, depth, ends = key, False, [0, 0], [{}, {}]
            m = _Marks(_string_column(b).slice(i, j - i), odd)
            for h in (0, 1):
                after = depth[h] + np.cumsum(m.inner[h] + m.brace[h])
                depth[h] = int(after[-1])
                for d, n in zip(*np.unique(after[m.brace[h] < 0], return_counts=True)):
                    ends[h][int(d)] = ends[h].get(int(d), 0) + int(n)
            odd = bool(m.odd_end[-1])
    if now is not None:
        yield row()


def _fail(file: str, element: int, what: str) -> None:
    raise JsonArrayError(f"{file}: {what} at element {element}")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, odd, depth, element = None, False, 0, 0
    for b in batches:
        lid = b.column(b.schema.get_field_index("lid"))
        starts = [b.column(b.schema.get_field_index(c)) for c in ("in_string", "depth", "element")]
        for key, i, j in _ranges(b):
            if key != now:
                now, odd = key, False
                inside, depth, element = (c[i].as_py() for c in starts)
            out: list[tuple] = []
            values = _string_column(b).slice(i, j - i)
            m = _Marks(values, odd)
            h = int(inside)
            after = depth + np.cumsum(m.inner[h] + m.brace[h])
            before = np.append(depth, after[:-1])
            opens = (~m.odd if h == 0 else m.odd) & (before <= 1)  # between elements, outside strings
            closes = (m.brace[h] < 0) & (after == 1)
            number = element + np.cumsum(closes) - closes
            for text, k, o, c, d, e, p in zip(values.to_pylist(), lid[i:j].to_pylist(), opens.tolist(), closes.tolist(), before.tolist(), number.tolist(), after.tolist()):
                if o:
                    head, brace, rest = text.partition("{")
                    mark = head.strip(" \t\n\r")
                    if not brace:  # after the last element
                        if mark.replace(" ", "").replace("\n", "").replace("\t", "").replace("\r", "") != ("[]" if d == 0 else "]") or p != -1:
                            _fail(now[0], e, "an element is not an object or the array does not end")
                        continue
                    if mark != ("[" if d == 0 else ","):
                        _fail(now[0], e, "expected an object")
                    text = brace + rest
                out.append((now[0], e, k, o and c, text + "}"))
            odd, depth, element = bool(m.odd_end[-1]), int(after[-1]), int(number[-1] + closes[-1])
            cols = list(zip(*out)) if out else [[]] * 5
            types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in _ELEMENTS.split(", ")])


def array_index(spark: SparkSession, path: str) -> DataFrame:
    """A written table with a row per byte range: (file_path, block_start,
    in_string, depth, element) where it starts. Raises if a file is no array."""
    out = scratch_path(spark, "array-index")
    pieces(spark, path).drop("lid").mapInArrow(_index, _INDEX).write.parquet(out)
    ranges = spark.read.parquet(out)
    order = Window.partitionBy("file_path").orderBy("block_start")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("parity").over(upto) % 2 == 1, F.lit(False))
    ranges = ranges.withColumn("in_string", inside).withColumn("delta", F.when(F.col("in_string"), F.col("delta1")).otherwise(F.col("delta0")))
    ranges = ranges.withColumn("depth", F.coalesce(F.sum("delta").over(upto), F.lit(0)))
    ends = F.when(F.col("in_string"), F.map_from_arrays("depths1", "ends1")).otherwise(F.map_from_arrays("depths0", "ends0"))
    ranges = ranges.withColumn("own", F.coalesce(F.try_element_at(ends, 1 - F.col("depth")), F.lit(0)))
    ranges = ranges.withColumn("element", F.coalesce(F.sum("own").over(upto), F.lit(0)))
    # the last piece of an array has no closing brace, though one is counted for it
    whole = ranges.groupBy("file_path").agg(F.sum("delta").alias("depth"), (F.sum("parity") % 2).alias("odd"))
    broken = [r["file_path"] for r in whole.filter("depth <> -1 OR odd = 1").select("file_path").limit(5).collect()]
    if broken:
        raise JsonArrayError(f"not one complete JSON array: {', '.join(sorted(broken))}")
    at = scratch_path(spark, "array-starts")
    ranges.select(*_RANGE, "in_string", "depth", "element").write.parquet(at)
    return spark.read.parquet(at)


def array_elements(spark: SparkSession, path: str, most_ranges: int = 100_000) -> DataFrame:
    """(file_path, element, value): the text of each array element, numbered from 0
    in its file. ``path`` is a file or a folder of such files.

    The start of each byte range is broadcast up to ``most_ranges`` of them;
    beyond that the pieces are shuffled to their range's start.
    """
    starts = array_index(spark, path)
    small = checked_broadcast(starts, most_ranges)
    rows = pieces(spark, path)
    if small is not None:
        placed = rows.join(small, _RANGE)
    else:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = rows.join(starts.hint("merge"), _RANGE).repartition(n, *_RANGE).sortWithinPartitions(*_RANGE, "lid")
    found = placed.mapInArrow(_elements, _ELEMENTS)
    whole = found.filter("whole").select("file_path", "element", "value")
    parts = found.filter("NOT whole").groupBy("file_path", "element").agg(F.array_sort(F.collect_list(F.struct("part", "value"))).alias("p"))  # the pieces of one object
    return whole.unionByName(parts.select("file_path", "element", F.array_join(F.transform("p", lambda x: x.value), "").alias("value")))
