"""Physical plans: pruned scans, map-side aggregation, no nested-loop joins."""

import os

import pytest

import __spark_entry__ as entry
from fleetlens.operators import features as X
from fleetlens.sources import roles

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PLANNED = [
    "sensor_stats_long", "sensor_features_wide", "fleet_master", "weighted_assignment", "stratified_split",
    "stratified_folds", "evaluation_by_fold", "threshold_sweep", "dashboard_extract", "risk_tier_summary",
    "monotonicity", "sensor_profile", "accounts_with_size", "orphan_vehicles",
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_nested_loop(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_scan_is_pruned_and_aggregation_partial(spark):
    wide = roles.readouts_wide(roles.table(spark, SF_DIR, "events"))
    text = plan(X.wide_features(wide))
    scan = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scan) == 1 and "props" not in scan[0] and "ts#" not in scan[0]
    assert "partial_count" in text and "SortAggregate" not in text and "Python" not in text


def test_statistics_need_one_shuffle(spark):
    text = plan(entry.queries()["sensor_stats_long"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text
