"""Every registered query: against DuckDB where it has SQL, else that it gives rows."""

import compare
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    got = compare.spark_rows(df)
    if name in SQL:
        assert compare.difference(got, compare.duck_rows(duck, SQL[name])) is None
        assert compare.type_difference(df, duck, SQL[name]) is None
    else:
        assert got[1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_filter_and_columns_reach_the_scan(spark):
    from pyspark.sql import functions as F

    df = contract.queries()["select_present"](spark, SF)
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in _plan(df)
    profile = contract.queries()["season_profile"](spark, SF)
    assert "o_custkey" not in _plan(profile)
    kept = spark.read.parquet(f"{SF}/events.parquet")
    from airseries.operators.clean import drop_missing

    assert "IsNotNull(value)" in _plan(drop_missing(kept, "value").select(F.col("event_id")))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
