"""Guard the physical plans: the properties that matter at scale."""

import re

import pytest

from tests.conftest import SF_SMALL
from tillroll.registry import QUERIES

BATCH = sorted(k for k in QUERIES if not k.startswith(("stream_", "bronze_", "medallion", "refresh_", "csv_")))


def _plan(spark, name, broadcast=True):
    """Physical plan without adaptive changes; without broadcasts if asked, as
    it would be for large tables."""
    off = {"spark.sql.adaptive.enabled": "false"} | ({} if broadcast else {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    old = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def _scans(plan):
    """Table prefix of every file scan (l_, o_, c_, ...)."""
    return sorted(re.findall(r"FileScan parquet \[(\w+?)_", plan))


def test_filters_reach_the_scans(spark):
    plan = _plan(spark, "upsert_loyalty")
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(o_orderdate", plan)
    for name in ("monthly_trend", "kpi_totals"):
        plan = _plan(spark, name)
        assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_orderstatus,F\)", plan)


@pytest.mark.parametrize("name,scans", [
    ("monthly_trend", ["l", "o"]), ("order_status_summary", ["l", "o"]), ("kpi_totals", ["l", "o"]),
    ("revenue_by_category", ["l", "o", "p"]), ("revenue_by_region", ["c", "l", "n", "o", "r"])])
def test_reports_join_only_their_dimensions(spark, name, scans):
    plan = _plan(spark, name, broadcast=False)
    assert _scans(plan) == scans
    assert len(re.findall(r"SortMergeJoin", plan)) == len(scans) - 1


def test_null_ids_and_hot_categories_are_spread(spark):
    plan = _plan(spark, "clickstream_enriched", broadcast=False)
    join = next(x for x in plan.splitlines() if "SortMergeJoin" in x and "_pid" in x)
    assert "_key" in join and "LeftOuter" in join and "isnotnull" in join
    plan = _plan(spark, "personalized_offers", broadcast=False)
    joins = [x for x in plan.splitlines() if "SortMergeJoin" in x and "_part" in x]
    assert any("[category#" in x and ", _part#" in x for x in joins)


def test_column_pruning_on_lineitem(spark):
    plan = _plan(spark, "revenue_by_category")
    schemas = re.findall(r"ReadSchema: struct<(l_[^>]*)>", plan)
    assert schemas and all("l_comment" not in s and "l_shipdate" not in s for s in schemas)


def test_dashboard_widgets_scan_the_fact_once(spark):
    plan = _plan(spark, "dashboard_widgets")
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*spark_grouping_id", plan)) == 1


def test_percent_rank_has_no_unpartitioned_window_over_rows(spark):
    plan = _plan(spark, "top_decile_customers")
    assert "percent_rank" not in plan.lower()
    # every window without a partition key runs on the per-partition totals
    single = [x for x in plan.splitlines() if "Window [" in x and "windowspecdefinition(_pid" in x.replace("#", "").lower()]
    others = [x for x in plan.splitlines() if "Window [" in x and "PARTITION" not in x.upper() and x not in single]
    assert "Exchange SinglePartition" in plan
    for x in others:
        assert "_pid" in x or "_t" in x


@pytest.mark.parametrize("name", ["active_offers_topk", "recent_sessions_topk"])
def test_topk_limits_before_the_shuffle(spark, name):
    plan = _plan(spark, name)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_sessions_hold_no_sets(spark):
    plan = _plan(spark, "active_sessions")
    assert "collect_set" not in plan and "collect_list" not in plan
