"""Every query of the library against its SQL twin, and what no plan on the way may contain."""

import os

import pytest

import __spark_entry__ as contract
from cohortrec.plans.check_sql import SQL
from cohortrec.plans.queries import QUERIES
from compare import DATA, compare, twin
from pyspark.sql import DataFrameWriter

SCALE = os.environ.get("COHORTREC_TEST_SF", "sf0.001")
SF_DIR = f"{DATA}/{SCALE}"
UNWANTED = ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython", "Scan ExistingRDD")


@pytest.fixture(scope="module")
def con():
    connection = twin(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_registered(spark):
    assert QUERIES.items() <= contract.queries().items() and SQL.items() <= contract.oracle_sql().items()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def written(monkeypatch):
    """The plans of all tables that a query writes on its way."""
    plans, write = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        plans.append(plan_of(self._df))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_twin(spark, con, written, name):
    df = QUERIES[name](spark, SF_DIR)
    for plan in [*written, plan_of(df)]:
        for unwanted in UNWANTED:
            assert unwanted not in plan
    assert compare(df, con, SQL[name]) == []


@pytest.mark.parametrize("name", ["clustered_profiles", "prediction_names", "recommend_all", "cohort_join", "headered_ingest"])
def test_without_broadcasts(spark, con, written, name):
    """As at a size where no side of a join is small, and with lists that are cut into parts."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES[name](spark, SF_DIR)
        for plan in [*written, plan_of(df)]:
            for unwanted in (*UNWANTED, "BroadcastHashJoin"):
                assert unwanted not in plan
        assert compare(df, con, SQL[name]) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["user_id", "movie_id", "title", "rn"]
    assert rows.count() > 0


def test_headered_lines_are_numbered_in_ranges(spark, written):
    """No window over all ratings of a movie."""
    df = QUERIES["headered_ingest"](spark, SF_DIR)
    text = "\n".join([*written, df._jdf.queryExecution().analyzed().toString()])
    assert "row_number" not in text and "_range" in text
