"""Plan-shape checks: the properties the operators are designed around."""

import pytest

from paylens.operators import country_statistics, daily_volumes, detect_anomalies, top_senders
from paylens.operators.rollups import aggregation_sets
from paylens.plans.ingest import validated_from_raw
from paylens.sinks import scratch_path, write_parquet
from paylens.sources import read_processed
from tests.conftest import AS_OF, INVALID8, VALID5


@pytest.fixture(scope="module")
def processed(spark):
    from paylens.config import RAW_SCHEMA

    path = scratch_path(spark, "t-plans")
    write_parquet(validated_from_raw(spark.createDataFrame(VALID5 + INVALID8, RAW_SCHEMA), AS_OF), path,
                  ["year", "month"])
    return read_processed(spark, path)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_valid_filter_and_pruning_reach_the_scan(processed):
    plan = physical(daily_volumes(processed))
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line)
    assert "EqualTo(is_valid,true)" in scan
    schema = scan[scan.index("ReadSchema: struct<") + len("ReadSchema: struct<"):]
    schema = schema[: schema.index(">")]
    assert {f.split(":")[0] for f in schema.split(",")} == {"timestamp", "amount", "currency", "is_valid"}


def test_partition_filter_prunes_directories(processed):
    plan = physical(country_statistics(processed.where("year = 2024")))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan


def test_top_k_is_take_ordered(processed):
    plan = physical(top_senders(processed))
    assert "TakeOrderedAndProject(limit=20" in plan
    assert "rangepartitioning" not in plan


def test_aggregations_are_partial_then_final(processed):
    plan = physical(country_statistics(processed))
    assert "partial_count" in plan and "partial_stddev_samp" in plan


def test_grouping_sets_is_one_scan(processed):
    plan = physical(aggregation_sets(processed))
    assert plan.count("FileScan parquet") == 1 and "Expand" in plan


def test_anomaly_stats_are_a_subquery_not_a_join(processed):
    plan = physical(detect_anomalies(processed))
    assert "Subquery" in plan
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_quality_metrics_are_observed_in_the_write_stage(spark):
    from paylens.config import RAW_SCHEMA
    from paylens.plans.ingest import observed_for_write

    v = validated_from_raw(spark.createDataFrame(VALID5, RAW_SCHEMA), AS_OF)
    df, _ = observed_for_write(v, ["year", "month", "day"])
    plan = physical(df)
    # top-down: CollectMetrics is the parent of the rebalance exchange, i.e. it runs in the
    # result stage, whose task metrics Spark applies once per partition even on retries
    assert plan.index("CollectMetrics") < plan.index("Exchange")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_anomaly_table_with_given_statistics_reads_its_input_once(processed):
    plan = physical(detect_anomalies(processed, stats=(10.0, 2.0), ordered=False))
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan and "Subquery" not in plan


def test_bounded_aggregates_read_once(processed):
    from paylens.operators.rollups import bounded_sets

    plan = physical(bounded_sets(aggregation_sets(processed), 10))
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1 and "WindowGroupLimit" in plan


def test_temporal_operators_stay_in_the_jvm_without_pairwise_joins(processed):
    from paylens.operators import asof_join, near_in_time_duplicates, sender_velocity

    since = processed.selectExpr("sender_bic", "timestamp AS since", "amount AS level")
    for out in (sender_velocity(processed), near_in_time_duplicates(processed), asof_join(processed, since, ["sender_bic"], "timestamp", "since")):
        plan = physical(out)
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan
