"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as registry
import check_oracle
from workload.oracle import SQL
from workload.queries import ALL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, con, name):
    verdict, _ = check_oracle.compare(spark, con, name, FOLDER)
    assert verdict.startswith(("ok", "rows only"))


def test_every_query_has_its_sql():
    assert set(ALL) == set(SQL) <= set(registry.oracle_sql()) and set(ALL) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).columns[:6] == ["source_model", "model", "scenario", "region", "variable", "unit"]


@pytest.mark.parametrize("name", ["harmonize_wide", "unmapped_report", "normalize_regions", "pivot_strict", "harmonize_legacy_e2e"])
def test_plans_stay_in_the_engine(spark, name):
    plan = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "CartesianProduct", "NestedLoopJoin", "MapInArrow", "MapInPandas"):
        assert slow not in plan


def test_misses_leave_by_inner_joins(spark):
    plan = registry.queries()["harmonize_mapped"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") >= 3 and plan.count("Join LeftOuter") == 2
