"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from graphvec.operators import vector
from graphvec.plans import catalog

D = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS FROM '{D}/{t}.parquet'")
    return c


def canon(rows):
    same = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(same(v) for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, D)
    cols = sorted(df.columns)
    got = canon(tuple(r) for r in df.select(*cols).collect())
    want = duck.execute(f"SELECT {', '.join(cols)} FROM ({catalog.SQL[name]})").fetchall()
    assert got == canon(want)


def test_approximate_recall(spark):
    p, q = catalog._points(spark, D), catalog._queries(spark, D)
    exact = {(r["qid"], r["id"]) for r in vector.batch_search(p, q, 5).collect()}
    near = {(r["qid"], r["id"]) for r in vector.approximate_search(p, q, 5).collect()}
    assert len(exact & near) >= 0.9 * len(exact)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 15
    assert set(entry.oracle_sql()) <= set(entry.queries())
