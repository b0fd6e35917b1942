"""Every registered query with an SQL twin gives the same rows in DuckDB."""

import duckdb
import pytest

from sensorlens.plans import all_oracles, all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows(names, records):
    return sorted([repr(0.0 if r[n] == 0.0 and isinstance(r[n], float) else r[n]) for n in sorted(names)] for r in records)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    expected = [dict(zip(names, r)) for r in cursor.fetchall()]
    assert sorted(df.columns) == sorted(names)
    assert rows(names, [r.asDict() for r in df.collect()]) == rows(names, expected)


def test_entry(spark):
    import __spark_entry__ as entry

    profile = entry.entry(spark)
    assert profile.count() == len(profile.select("column").distinct().collect()) > 5
