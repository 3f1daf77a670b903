"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations").split()


@pytest.fixture(scope="module")
def oracle():
    from conftest import DATA

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_every_query_has_sql():
    assert set(entry._own_queries()) == set(entry._own_oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(entry._own_oracle_sql()))
def test_query_matches_its_sql(spark, oracle, data, key):
    frame = entry.queries()[key](spark, data)
    found = oracle.execute(entry.oracle_sql()[key])
    names = [column[0] for column in found.description]
    assert sorted(names) == sorted(frame.columns)
    want = ordered(found.fetchall())
    assert ordered(tuple(r) for r in frame.select(*(f"`{n}`" for n in names)).collect()) == want
    assert want


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 7 and rows[0].max_price == max(r.max_price for r in rows)
