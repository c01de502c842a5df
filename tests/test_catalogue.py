"""Every query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from helpers import SF_DIR

import __spark_entry__ as entry_points
from farelake.checks.queries import QUERIES

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, tables, name):
    got = entry_points.queries()[name](spark, SF_DIR)
    expected = tables.sql(entry_points.oracle_sql()[name])
    types = {c: str(t) for c, t in zip(expected.columns, expected.types, strict=True)}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema} == types
    columns = sorted(got.columns)
    got_rows = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
    assert got_rows == sorted(expected.select(*columns).fetchall(), key=repr)
    assert got_rows


def test_sorted_results_come_in_order(spark):
    by_month = [r.month for r in entry_points.queries()["sort_by_month"](spark, SF_DIR).collect()]
    assert by_month == sorted(by_month)
    for name in ("agg_route_frequency", "topk_routes"):
        counts = [r.n for r in entry_points.queries()[name](spark, SF_DIR).collect()]
        assert counts == sorted(counts, reverse=True)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
