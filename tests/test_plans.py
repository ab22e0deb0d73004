"""Every named query against its SQL on DuckDB, at the smallest size."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()


def cell(v):
    if isinstance(v, (list, tuple)):
        return [cell(x) for x in v]
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def oracle(sf_dir):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL and not n.startswith(("op", "pipeline"))])
def test_query(spark, sf_dir, oracle, name):
    got = QUERIES[name](spark, sf_dir)
    want = oracle.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    left = sorted(repr([cell(r[c]) for c in sorted(names)]) for r in got.collect())
    right = sorted(repr([cell(dict(zip(names, r, strict=True))[c]) for c in sorted(names)]) for r in want.fetchall())
    assert left == right


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
