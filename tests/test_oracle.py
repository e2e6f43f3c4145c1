"""Every registered query against its SQL, over whole tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from flightloom.operators import preview
from flightloom.sources import scan_where_in

FOLDER = "/root/testdata/sf0.01"
TABLES = ["lineitem", "orders", "customer", "events"]
# The training-data queries have their own tests.
OTHERS = {"pipeline", *(entry.llm_queries.queries() if entry.llm_queries else ())}
QUERIES = {n: f for n, f in entry.queries().items() if n not in OTHERS}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if n not in OTHERS}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if pd.isna(x):
            return None
        return repr(float(x)) if isinstance(x, float) else str(x)

    df = df[sorted(df.columns)]
    return sorted((tuple(map(cell, r)) for r in df.itertuples(index=False)), key=str)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER).toPandas()
    theirs = duck.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) == len(theirs)
    assert normal(ours) == normal(theirs)


def test_limits_return_rows_of_their_table(spark):
    samples = QUERIES["scan_samples"](spark, FOLDER)
    twenty = preview(samples)
    assert twenty.count() == 20
    assert twenty.exceptAll(samples).count() == 0
    three = scan_where_in(spark, "flight_samples", ["1998-08"], limit=3)
    assert [r.sub_part1 for r in three.collect()] == ["1998-08"] * 3
    assert three.columns == samples.columns


def test_entry_has_rows_and_schema(spark):
    result = entry.entry(spark)
    assert result.columns == [
        "adi_flight_record_number", "ems_system_id", "parameter_id", "value", "MaxOffset"
    ]
    assert result.count() == 1979
