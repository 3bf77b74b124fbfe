"""Plans that would not survive more data are caught here."""

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
#: Joins with a side of a checked size (areas, zones, anchors) by prefix, containment, box or interval.
NESTED_LOOPS = {"flt_05", "flt_05_text", "joi_11", "joi_12", "dat_01", "ext_07"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.startswith("p")))
def test_no_cross_products(spark, name):
    plan = plan_of(entry.queries()[name](spark, DATA))
    assert "CartesianProduct" not in plan
    assert name in NESTED_LOOPS or "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = plan_of(entry.queries()["ext_q6"](spark, DATA))
    assert "GreaterThanOrEqual(l_shipdate" in plan
    assert "PushedFilters" in plan and "GreaterThanOrEqual(l_discount" in plan and "l_tax" not in plan and "l_orderkey" not in plan
    plan = plan_of(entry.queries()["agg_24"](spark, DATA))
    assert "description" not in plan


def test_keyed_state_is_aggregated_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["src_20"](spark, DATA))
    assert "partial_max" in plan
