"""Every registered query equals its SQL over the same tables, and runs no Python."""

import importlib.util
import os

import pytest

from tillroll.workload.registry import ORACLE, QUERIES

from tests.oracle import connect, difference, duck_result, spark_result

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("entry_module", f"{ROOT}/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


ENTRY = _entry()


def test_entry_names_every_query_of_the_workload():
    assert set(QUERIES) <= set(ENTRY.queries()) and set(ORACLE) <= set(ENTRY.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_has_rows(spark):
    assert ENTRY.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
    assert difference(spark_result(df), duck_result(duck, ORACLE[name])) is None
