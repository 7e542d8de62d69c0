"""Every sample query against its SQL in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from skytally.sample.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = [f[: -len(".parquet")] for f in os.listdir(SF_DIR)] if os.path.isdir(SF_DIR) else []
pytestmark = pytest.mark.skipif(not TABLES, reason="no sample tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def table(df):
    columns = sorted(df.columns)
    found = [tuple(map(plain, r)) for r in df[columns].astype(object).itertuples(index=False)]
    return columns, sorted(found, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = table(contract.queries()[name](spark, SF_DIR).toPandas())
    assert found == table(duck.execute(contract.oracle_sql()[name]).df())


def test_entry(spark):
    assert contract.entry(spark).columns == ["continent", "average_flight_distance"]


def test_reference_objects_are_written_by_all_tasks(spark, monkeypatch):
    def single(self, n):
        raise AssertionError(f"all objects in {n} task")

    monkeypatch.setattr(type(spark.range(0)), "coalesce", single)
    assert QUERIES["reference_objects"](spark, "/root/testdata/sf0.001").count() > 0


def test_reference_objects_are_dealt_over_tasks(spark, monkeypatch, tmp_path):
    from skytally.sample import queries

    monkeypatch.setattr(queries, "shared_dir", lambda s, purpose: str(tmp_path))
    assert QUERIES["reference_objects"](spark, "/root/testdata/sf0.001").count() > 0
    files = [f.name for f in (tmp_path / "objects").glob("part-*")]
    # One object a file; before, a small table was one split, so one task wrote them all.
    assert len({f.split("-")[1] for f in files}) == 4 and len(files) > 4
