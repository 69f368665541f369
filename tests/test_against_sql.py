"""Registered queries against their expected results in DuckDB, on whole tables."""

import pytest

from checks.compare import differences, duckdb_over
from checks.registry import MEASURE_PLANS, REGISTRY

SF_DIR = "/root/testdata/sf0.001"
# The single measures are parts of the families, which are compared whole.
NAMES = [name for name in REGISTRY if name not in MEASURE_PLANS and not name.endswith("_report")]


@pytest.fixture(scope="module")
def database():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, database, name):
    actual = REGISTRY[name].run(spark, SF_DIR).toPandas()
    assert differences(actual, database.execute(REGISTRY[name].expected).df()) == ""


def test_every_measure_has_a_query_and_sql():
    from checks.registry import EXPECTED_MEASURES

    assert set(MEASURE_PLANS) == set(EXPECTED_MEASURES)


def test_the_comparison_sees_differences(database):
    one = database.execute("SELECT 1 AS a, 2.5 AS b UNION ALL SELECT NULL, 3.5").df()
    assert differences(one, database.execute("SELECT 3.5 AS b, NULL AS a UNION ALL SELECT 2.5, 1").df()) == ""
    assert differences(one, database.execute("SELECT 1 AS a, 2.5 AS b UNION ALL SELECT NULL, 3.6").df())
    assert differences(one, database.execute("SELECT 1 AS a, 2.5 AS b UNION ALL SELECT 0, 3.5").df())
    assert differences(one, database.execute("SELECT 1 AS a, 2.5 AS b").df())
