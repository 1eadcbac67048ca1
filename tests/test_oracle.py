"""Every registered query against the equivalent SQL in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point

TABLES = ("orders", "customer")


def normalised(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
        return repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def scale(request):
    return f"/root/testdata/{request.param}"


@pytest.fixture(scope="module")
def duck(scale):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{scale}/{table}.parquet'")
    return connection


OPTIONAL = entry_point.llm_queries.queries() if entry_point.llm_queries else {}
OWN = sorted(set(entry_point.queries()) - {"pipeline", *OPTIONAL})


@pytest.mark.parametrize("name", OWN)
def test_matches_sql(spark, duck, scale, name):
    result = entry_point.queries()[name](spark, scale)
    expected = duck.sql(entry_point.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    got = normalised(result.collect(), result.columns)
    want = normalised(expected.fetchall(), expected.columns)
    assert got and got == want


def test_every_query_has_sql():
    assert set(OWN) == set(entry_point.oracle_sql()) - {"pipeline", *OPTIONAL}


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5


# Row counts known for the derived tables, independent of both engines.
def test_anchors(spark):
    counts = {
        r["layer"]: r["stored_rows"]
        for r in entry_point.layer_row_counts(spark, "/root/testdata/sf0.01").collect()
    }
    assert counts == {"bronze": 15297, "silver": 15142, "gold": 5}
