"""Physical plans: what is scanned, how joins and windows run."""

import pytest

from cyclograph.workload import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [line for line in text.splitlines() if "FileScan parquet" in line]


def test_filters_and_columns_reach_the_scan(spark):
    (scan,) = scans(plan(spark, "src1_parquet_scan"))
    assert "PushedFilters: [IsNotNull(l_quantity)" in scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double" in scan


def test_written_marts_are_pruned_by_partition(spark):
    (scan,) = scans(plan(spark, "snk5_partitioned_mart"))
    assert "PartitionFilters: [isnotnull(date_key_month" in scan and "PushedFilters: [IsNotNull(date_key)" in scan


@pytest.mark.parametrize("name", ["prj2_clean_incidents", "prj3_staged_incidents", "prj6_staged_status", "ag7_ag8_wn2_stations"])
def test_latest_rows_are_picked_before_the_shuffle(spark, name):
    text = plan(spark, name)
    final, partial = text.index("row_number(), 1, Final"), text.index("row_number(), 1, Partial")
    assert final < text.index("Exchange hashpartitioning", final) < partial


@pytest.mark.parametrize(
    "name",
    ["jn1_nearby_incidents", "ag3_station_day", "jn11_trips_per_fiscal_period", "cal33_wn11_fiscal_periods", "dq70_wn7_within_n_stdevs", "q4_jn6_tk3_busy_station_hours", "wn14_quantile_over_partition"],
)
def test_joins_have_equality_keys(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_points_are_counted_before_they_meet_a_place(spark):
    text = plan(spark, "jn1_nearby_incidents")
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    for join in text.split("BroadcastHashJoin")[1:]:
        streamed = join[: join.index("BroadcastExchange")]
        assert "HashAggregate(keys=[date_key" in streamed and "partial_count(1)" in streamed


def test_station_day_joins_already_partitioned_sides(spark):
    text = plan(spark, "ag3_station_day")
    join = text.index("Join [station_id")
    # The aggregations that made the two sides stand between the join and any exchange.
    assert "HashAggregate(keys=[start_station_id" in text[join : text.index("Exchange", join)]


def test_correlation_reads_the_mart_once(spark):
    assert len(scans(plan(spark, "ag4_ag5_ag6_ag16_correlation"))) == len(scans(plan(spark, "ag3_station_day")))


@pytest.mark.parametrize("name", ["dq31_wn4_values_increasing", "dq31_increasing_per_expression", "dq32_decreasing_per_expression"])
def test_ordered_checks_shuffle_once(spark, name):
    text = plan(spark, name)
    assert text.count("Exchange ") == 1 and "Exchange hashpartitioning(__range" in text


@pytest.mark.parametrize("name", ["wn5_wn6_moving_statistics", "dq71_wn5_wn6_within_n_moving_stdevs", "dq71_moving_stdevs_per_expression"])
def test_moving_statistics_have_no_single_task_window(spark, name):
    text = plan(spark, name)
    assert "SinglePartition" not in text and "NestedLoop" not in text


def test_fused_suite_scans_once(spark):
    assert len(scans(plan(spark, "dq_suite_one_pass"))) == 1


def test_no_python_in_any_batch_plan(spark):
    for name in ("ag3_station_day", "prj9_station_read_facts", "cal30_date_dimension", "snk4_test_results"):
        assert "Python" not in plan(spark, name)
