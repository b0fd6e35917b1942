"""Queries of the subpackage give the same rows as their SQL twins in DuckDB."""

import duckdb
import pytest

from sensorlens.llm import registry

QUERIES, ORACLES = registry.load()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in "documents embeddings labels conversations".split():
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, sf_dir)
    assert set(got.columns) == set(names)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))
