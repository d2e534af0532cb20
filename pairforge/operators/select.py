"""Exact k-th key selection without a global sort or a single-partition window.

A cap, a split or a subsample of exact size needs the key of the k-th row in
some order. ``orderBy(..).limit(k)`` funnels partitions x k rows into one task
and a global ``row_number()`` pulls every row into one task; neither holds at
scale. Instead the threshold key is found with a few aggregation passes whose
results are bounded (a histogram or a sample), then a single narrow filter
``key <= threshold`` selects the rows.

The strategies:

* ``kth_hex_key``: the leading order column is a uniform hex digest (md5). A
  prefix histogram (up to 4 hex digits = 65,536 buckets per pass, partially
  aggregated map-side) narrows the candidates up to 65,536-fold per pass.
* ``kth_digest``: the same histogram for digests that may repeat.
* ``weight_threshold``: digests with weights, up to a given sum (a histogram of
  sums in place of counts).
* ``kth_key``: any order. Floyd-Rivest style: a bounded random sample brackets
  the target rank, one counting pass confirms the bracket, repeat until the
  bracket holds at most ``window_rows`` keys, which are then fetched.

Keys must be non-NULL and, but for ``kth_digest``, unique (callers add a row
key as last column). Every
driver-side collection is bounded by ``window_rows`` (a few hundred keys),
``MAX_SAMPLE`` or the 65,536-bucket histogram, independent of the data size;
there is no shortcut that fetches all keys of a larger input.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_ROWS = 400  # keys fetched in the end
SAMPLE_ROWS = 400  # keys of a sample, or a thousandth of the candidates if that is more
MAX_SAMPLE = 20_000
HEX_STEP = 4


def _lit(v, dtype) -> Column:
    return F.lit(v).cast(dtype)


def lex_cmp(cols: Sequence[str], vals: Sequence, dtypes: Sequence, op: str) -> Column:
    """Lexicographic ``(cols) op (vals)`` for op in <, <=, >, >=.

    The leading-column bound is added as an extra conjunct so Parquet can skip
    row groups with it.
    """
    strict = op in ("<", ">")
    less = op in ("<", "<=")

    def first(c, v, t):
        return F.col(c) < _lit(v, t) if less else F.col(c) > _lit(v, t)

    expr: Column | None = None
    for c, v, t in reversed(list(zip(cols, vals, dtypes))):
        if expr is None:
            if strict:
                expr = first(c, v, t)
            else:
                expr = F.col(c) <= _lit(v, t) if less else F.col(c) >= _lit(v, t)
        else:
            expr = first(c, v, t) | ((F.col(c) == _lit(v, t)) & expr)
    lead = F.col(cols[0]) <= _lit(vals[0], dtypes[0]) if less else F.col(cols[0]) >= _lit(vals[0], dtypes[0])
    return lead & expr


def _dtypes(df: DataFrame, cols: Sequence[str]) -> list:
    fields = {f.name: f.dataType for f in df.schema.fields}
    return [fields[c] for c in cols]


def _fetch_sorted(df: DataFrame, cols: Sequence[str], expected: int) -> list[tuple]:
    """All keys of a candidate set whose size is already known to be at most the
    window bound (from a count or a histogram), sorted on the driver."""
    rows = [tuple(r) for r in df.select(*cols).collect()]
    if len(rows) != expected:
        raise RuntimeError(f"selection window changed size: {len(rows)} != {expected}")
    rows.sort()
    return rows


def kth_key(
    df: DataFrame,
    order_cols: Sequence[str],
    k: int,
    *,
    total: int | None = None,
    window_rows: int = WINDOW_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> tuple | None:
    """Key tuple of the k-th smallest row (1-based) under ``order_cols``.

    Returns None when ``k`` >= the row count (every row qualifies). ``k`` must be
    positive.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    cols = list(order_cols)
    dtypes = _dtypes(df, cols)
    keys = df.select(*cols)
    if k == 1 and total is None:
        # The smallest key: one partial aggregate; None when there are no rows.
        row = keys.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*cols)).alias("m")).first()
        return None if row["n"] <= 1 else tuple(row["m"])
    n = keys.count() if total is None else total
    if k >= n:
        return None
    lo: tuple | None = None  # candidates: lo < key <= hi
    hi: tuple | None = None
    c, r = n, k
    for _ in range(64):
        cand = keys
        if lo is not None:
            cand = cand.filter(lex_cmp(cols, lo, dtypes, ">"))
        if hi is not None:
            cand = cand.filter(lex_cmp(cols, hi, dtypes, "<="))
        if c <= window_rows:
            return _fetch_sorted(cand, cols, c)[r - 1]
        frac = min(1.0, max(sample_rows, min(MAX_SAMPLE, c // 1000)) / c)
        sample = sorted(tuple(x) for x in cand.sample(False, frac, seed).collect())
        seed += 1
        m = len(sample)
        if m == 0:
            continue
        pos = r / c * m
        spread = 4.0 * math.sqrt(max(pos, 1.0) * max(1.0 - r / c, 1.0 / m)) + 2.0
        i_lo = int(math.floor(pos - spread))
        i_hi = int(math.ceil(pos + spread))
        new_lo = sample[i_lo] if i_lo >= 0 else None
        new_hi = sample[i_hi] if i_hi < m else None
        aggs = [F.count(F.lit(1)).alias("c")]
        if new_lo is not None:
            aggs.append(F.count_if(lex_cmp(cols, new_lo, dtypes, "<=")).alias("a"))
        if new_hi is not None:
            aggs.append(F.count_if(lex_cmp(cols, new_hi, dtypes, "<=")).alias("b"))
        row = cand.agg(*aggs).first()
        a = row["a"] if new_lo is not None else 0
        b = row["b"] if new_hi is not None else row["c"]
        if r <= a:
            hi, c = new_lo, a
        elif r > b:
            lo, r, c = new_hi, r - b, c - b
        else:
            if new_lo is not None:
                lo = new_lo
            if new_hi is not None:
                hi = new_hi
            r, c = r - a, b - a
    raise RuntimeError("selection did not converge")


def kth_hex_key(
    df: DataFrame,
    hex_col: str,
    tie_cols: Sequence[str],
    k: int,
    *,
    total: int | None = None,
    window_rows: int = WINDOW_ROWS,
    width: int | None = None,
) -> tuple | None:
    """Like ``kth_key`` for the order ``(hex_col, *tie_cols)`` where ``hex_col``
    is a uniform lowercase hex digest (``width`` characters; looked up when not
    given), using prefix histograms."""
    if k <= 0:
        raise ValueError("k must be positive")
    cols = [hex_col, *tie_cols]
    keys = df.select(*cols)
    n = keys.count() if total is None else total
    if k >= n:
        return None
    prefix, c, r = _narrow_hex(keys, hex_col, k, n, window_rows, width)
    cand = keys.filter(F.startswith(F.col(hex_col), F.lit(prefix)))
    if c <= window_rows:
        return _fetch_sorted(cand, cols, c)[r - 1]
    # Same digest on more rows than the window: order by tie columns only.
    return kth_key(cand, cols, r, total=c, window_rows=window_rows)


def kth_digest(
    df: DataFrame,
    hex_col: str,
    k: int,
    *,
    total: int | None = None,
    window_rows: int = WINDOW_ROWS,
    width: int | None = None,
) -> tuple[str, int] | None:
    """For digests that may repeat: the k-th smallest digest and how many of its
    rows are among the first ``k``. None when ``k`` >= the row count."""
    if k <= 0:
        raise ValueError("k must be positive")
    keys = df.select(hex_col)
    n = keys.count() if total is None else total
    if k >= n:
        return None
    prefix, c, r = _narrow_hex(keys, hex_col, k, n, window_rows, width)
    if c > window_rows:
        return prefix, r
    found = _fetch_sorted(keys.filter(F.startswith(F.col(hex_col), F.lit(prefix))), [hex_col], c)
    return found[r - 1][0], r - found.index(found[r - 1])


def weight_threshold(
    df: DataFrame,
    hex_col: str,
    weight: Column,
    target: int,
    *,
    window_rows: int = WINDOW_ROWS,
    width: int,
) -> str | None:
    """The largest digest up to which (itself included) all rows' weights add up to
    ``target`` at most; None when already the smallest digest's rows weigh more.

    Rows of one digest, however many, are one group that is never cut. Each pass
    is a histogram of sums by prefix; a bucket with a single digest ends the
    search. Weights are whole numbers, not negative.
    """
    keys = df.select(F.col(hex_col).alias("h"), weight.cast("bigint").alias("w"))
    prefix, last, left = "", None, target
    while len(prefix) < width:
        cand = keys if not prefix else keys.filter(F.startswith(F.col("h"), F.lit(prefix)))
        plen = min(len(prefix) + HEX_STEP, width)
        hist = cand.groupBy(F.substring("h", 1, plen).alias("p")).agg(
            F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")
        )
        crossed = None
        for b in sorted(hist.collect(), key=lambda x: x["p"]):  # 65,536 buckets at most
            if b["w"] > left:
                crossed = b
                break
            left, last = left - b["w"], b["hi"]
        if crossed is None or crossed["lo"] == crossed["hi"]:
            return last
        prefix = crossed["p"]
        if crossed["n"] <= window_rows:
            rows = keys.filter(F.startswith(F.col("h"), F.lit(prefix))).groupBy("h").agg(F.sum("w").alias("w")).collect()
            for r in sorted(rows, key=lambda x: x["h"]):
                if r["w"] > left:
                    return last
                left, last = left - r["w"], r["h"]
    return last


def _narrow_hex(keys: DataFrame, hex_col: str, k: int, n: int, window_rows: int, width: int | None) -> tuple[str, int, int]:
    """(prefix, rows, rank): the k-th of ``n`` digests is the rank-th of the rows
    with that prefix; at most ``window_rows`` of them, or all with one digest."""
    prefix, c, r = "", n, k
    while c > window_rows:
        cand = keys if not prefix else keys.filter(F.startswith(F.col(hex_col), F.lit(prefix)))
        if width is None:
            width = len(keys.select(hex_col).first()[0])
        if len(prefix) >= width:
            break
        # as many digits as leave about a window in a bucket, HEX_STEP at most
        step = max(1, min(HEX_STEP, math.ceil(math.log(c / window_rows, 16))))
        plen = min(len(prefix) + step, width)
        hist = (
            cand.groupBy(F.substring(F.col(hex_col), 1, plen).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        hist.sort(key=lambda x: x["p"])
        for h in hist:
            if r <= h["n"]:
                prefix, c = h["p"], h["n"]
                break
            r -= h["n"]
        else:  # pragma: no cover - counts are consistent
            raise RuntimeError("rank outside histogram")
    return prefix, c, r


def le_key(cols: Sequence[str], key: tuple, df: DataFrame) -> Column:
    """Predicate ``(cols) <= key`` for a key returned by the selection."""
    return lex_cmp(list(cols), list(key), _dtypes(df, cols), "<=")
