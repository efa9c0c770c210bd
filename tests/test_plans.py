"""What the physical plans must and must not contain."""

import os
import re

import pytest

from perennial.plans.queries import QUERIES
from perennial.session import RUNTIME_DEFAULTS

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(name for name in QUERIES if not name.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Pandas" not in plan and "EvalPython" not in plan and "Scan ExistingRDD" not in plan


def test_scores_read_only_their_columns(spark):
    plan = plan_of(QUERIES["timeless_scores_2y"](spark, SF_DIR))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert any("l_quantity" in s and "l_extendedprice" not in s for s in schemas)
    assert "IsNotNull(l_partkey)" in plan
    assert "Expand" not in plan


def test_scores_count_artists_in_two_steps(spark):
    plan = plan_of(QUERIES["decade_stats"](spark, SF_DIR))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)
    keys = [len([c for c in e.split(",") if "#" in c]) for e in exchanges]
    assert sorted(keys) == [2, 3]


@pytest.mark.parametrize("name", ["attribute_top10", "recent_songs", "event_details", "events_by_genre"])
def test_top_n_is_trimmed_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, SF_DIR))


def test_newest_filters_by_a_cut_off_moment_without_a_setting(spark):
    threshold = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(threshold, "1000")
    try:
        plan = plan_of(QUERIES["recent_songs"](spark, SF_DIR))
    finally:
        spark.conf.set(threshold, RUNTIME_DEFAULTS[threshold])
    assert re.search(r"Filter .*l_shipdate.* >= .*subquery", plan)


def test_heat_map_is_neither_collected_nor_pivoted(spark):
    plan = plan_of(QUERIES["attribute_heatmap"](spark, SF_DIR))
    assert "pivotfirst" not in plan and "collect_list" in plan and "subquery" in plan


def test_row_numbers_shuffle_counts_not_rows(spark):
    plan = plan_of(QUERIES["smoke_row_number"](spark, SF_DIR))
    below_window = plan[plan.index("Window") :]
    assert "partial_count" in below_window


def test_big_tables_are_joined_by_shuffle_when_no_side_is_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("timeless_scores_2y", "event_counts_by_genre", "matched_rollbacks"):
            plan = plan_of(QUERIES[name](spark, SF_DIR))
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ten_minute_means_read_the_songs_once(spark):
    df = QUERIES["popularity_10min"](spark, SF_DIR)
    df.collect()
    plan = plan_of(df).split("== Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_quantity" in line]
    assert len(scans) == 1
