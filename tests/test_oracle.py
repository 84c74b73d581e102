"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__

QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def rounded(value):
    return round(value, 9) if isinstance(value, float) else value


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = sorted(repr(tuple(rounded(r[c]) for c in columns)) for r in df.collect())
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(repr(tuple(rounded(r[i]) for i in order)) for r in cursor.fetchall())
    assert found == expected and found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and df.columns == ["qid", "component", "package", "position"]
