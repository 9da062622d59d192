"""Every registered query against its DuckDB oracle on the smallest extract."""

import math
import os

import duckdb
import pytest
from conftest import SMOKE_DIR

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return float(v) if type(v).__name__ == "Decimal" else v


def _rows(rows, cols, order):
    idx = [cols.index(c) for c in order]
    out = [tuple(_norm(r[i]) for i in idx) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "nation_name"


@pytest.mark.parametrize("key", sorted(set(E.queries()) - (set(E.LLM_QUERIES) - set(E.LLM_SQL))))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SMOKE_DIR)
    srows = sdf.collect()
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(srows) > 0
        return
    cur = duck.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    order = sorted(ocols)
    assert _rows(srows, sdf.columns, order) == _rows(orows, ocols, order)


def test_every_query_has_an_oracle_or_is_documented():
    assert set(E.queries()) - set(E.oracle_sql()) - set(E.LLM_QUERIES) == set()
    assert os.path.exists(os.path.join(os.path.dirname(E.__file__), "README.md"))
