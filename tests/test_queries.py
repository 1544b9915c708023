"""Every registered query against DuckDB, and the shape of every plan."""

import os

import pytest

import __spark_entry__ as driver
import check
from siltline.catalog import REGISTRY
from tests.conftest import plan_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


def test_contract():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.FLAGSHIP in driver.queries()


FOREIGN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@needs_tables
@pytest.mark.parametrize("name", list(REGISTRY))
def test_same_rows_as_sql(spark, con, name):
    """Also: no cross join and no Python in the plan."""
    df = REGISTRY[name].run(spark, SF_DIR)
    assert check.differences(df, con, name) == []
    assert [node for node in FOREIGN if node in plan_of(df)] == []


@needs_tables
def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(REGISTRY["g3_sum_by_three_keys"].run(spark, SF_DIR))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    plan = plan_of(REGISTRY["f7_orphans"].run(spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(p_type), Not(EqualTo(p_type,SMALL))" in plan and "ReadSchema: struct<l_partkey:bigint>" in plan
