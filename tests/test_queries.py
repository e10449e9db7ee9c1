"""Every registered query against its SQL in DuckDB, on the same tables.

``CHECK_SF_DIR`` names other tables than the smallest ones.
"""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def value(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    return sorted(columns), sorted(
        (tuple(value(row[i]) for i in order) for row in rows),
        key=lambda row: [(v is None, str(v)) for v in row],
    )


@pytest.mark.parametrize("name", list(entry_module.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = entry_module.queries()[name](spark, SF_DIR)
    got = normal(result.columns, result.collect())
    cursor = duck.execute(entry_module.oracle_sql()[name])
    expected = normal([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1]) and got[1]
    assert got[1] == expected[1]


def test_every_query_has_sql():
    assert entry_module.QUERIES.keys() == entry_module.ORACLES.keys()
    assert entry_module.queries().keys() >= entry_module.oracle_sql().keys()


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["brewery_type", "country", "state_province", "city", "num_breweries"]
    counts = [row.num_breweries for row in result.collect()]
    assert counts == sorted(counts, reverse=True)
