"""Every registered query that has SQL against DuckDB on the same tables.

``ORACLE_SF`` chooses another scale than the small one.
"""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as spark_entry

SF_DIR = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", list(spark_entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    result = duck.execute(spark_entry.oracle_sql()[name])
    expected = _bag([c[0] for c in result.description], result.fetchall())
    got = _bag(df.columns, (tuple(r) for r in df.collect()))
    assert got[0] == expected[0]
    assert got[1] == expected[1], (got[1] - expected[1], expected[1] - got[1])
    assert got[1], "no rows"


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
