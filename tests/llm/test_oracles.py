"""The queries that SQL can express equal their SQL on whole tables."""

import pytest

from tests.oracle import connect, difference, duck_result, spark_result
from tillroll.llm import workload

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(workload.ORACLE))
def test_query_equals_sql(spark, name):
    df = workload.QUERIES[name](spark, SF)
    assert difference(spark_result(df), duck_result(connect(SF), workload.ORACLE[name])) is None
