"""The queries that SQL can express, against DuckDB at the smallest size."""

import duckdb
import pytest

from lexarium.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_against_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = db.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert sorted(repr([r[c] for c in names]) for r in got.collect()) == sorted(repr(list(r)) for r in want.fetchall())
