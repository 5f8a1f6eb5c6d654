"""Every registered query against its SQL on the smallest tables, and the driver contract."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.registry import QUERIES
from checks.compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    text, _, ok = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, text


def test_entry(spark):
    df = entry.entry(spark)
    assert "weighted_pct" in df.columns and df.count() > 0


def test_no_pair_products_in_plans(spark):
    """No query over respondents or organizations is planned as a product of two tables."""
    for name in ("A6_count_respondents", "T2_T3_standardized_rates", "K5_rank_underserved_all", "M1_M4_ranked_organizations", "M5_keyword_search", "Q2_place_names"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
