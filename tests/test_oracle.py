"""Every registered query against its DuckDB SQL on the smallest tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


NO_SQL = {"token_limit"}  # a tokenizer's output: tests/test_token_limit.py compares it with the tokenizer


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) - NO_SQL <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)
