"""The physical plans: pushdown, pruning, rank limits, no pairwise joins."""

import re

import pytest

import __spark_entry__ as contract
from telemetra.operators import joins, latest, quality, stats
from telemetra.plans import gold, reports
from telemetra.sources import roles

# Plans of queries that only return rows computed by earlier jobs say nothing, and running
# learners or streams twice would only cost time.
EXPENSIVE = {
    "train_gbt", "param_search", "model_score", "stream_hourly", "stream_hourly_append",
    "late_rows", "evolve_schema", "restart_idempotent", "ingest_folder", "ingest_json_stream",
    "ingest_parquet_stream", "stream_expect", "text_topk", "vector_topk_lsh", "end_to_end_status",
    "end_to_end_training", "refresh_metrics", "continuous_ingest", "gbt_first_splits",
    "model_metrics", "model_signature", "incremental_status", "incremental_training",
    "incremental_reads", "stream_label_by_interval", "stream_without_copies", "stored_update",
    "stored_update_before", "stored_delete", "stored_upsert", "stored_untouched",
    "text_index_topk", "text_index_rare_term", "vector_index_recall", "vector_index_self",
    "row_identity_loads", "checksum_ranges", "sketch_day_ranks", "sketch_fleet_ranks",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - EXPENSIVE))
def test_no_pairwise_join(spark, name):
    text = plan(contract.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_filter_and_columns_reach_the_scan(spark, folder):
    text = plan(gold.clean_readings(roles.telemetry(spark, folder)).select("asset_id", "energy"))
    assert re.search(r"PushedFilters: \[.*IsNotNull\(value\).*GreaterThan\(value,0\.0\)", text)
    assert re.search(r"ReadSchema: struct<user_id:bigint,value:double>", text)


def test_selected_asset_filters_below_the_aggregate(spark, folder):
    status = gold.current_status(roles.telemetry(spark, folder), roles.assets(spark, folder))
    text = plan(reports.asset_slice(status, 7))
    assert "EqualTo(user_id,7)" in text


def test_percentiles_are_not_computed_when_unused(spark, folder):
    hourly = gold.bucketed(roles.telemetry(spark, folder))
    text = plan(gold.current_features(hourly, roles.assets(spark, folder)))
    assert "percentile_approx" not in text


def test_rank_limit_before_the_shuffle(spark, folder):
    text = plan(latest.latest_per_key(roles.telemetry(spark, folder), ["asset_id"], "event_time"))
    assert text.count("WindowGroupLimit") == 2


def test_metrics_need_one_pass(spark, folder):
    rules = [quality.Expectation("a", "energy > 0"), quality.Expectation("b", "energy > 5")]
    text = plan(quality.expectation_metrics(roles.telemetry(spark, folder), rules))
    assert text.count("FileScan") == 1


def test_wide_stats_shuffle_once(spark, folder):
    readings = roles.telemetry_wide(spark, folder)
    text = plan(stats.bucket_stats(readings, "energy", ["channel_a"], "month"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_percentile_approx" in text


def test_facts_are_not_shuffled_for_small_metadata(spark, folder):
    readings, assets = roles.telemetry(spark, folder), roles.assets(spark, folder)
    facts_shuffled = r"Exchange hashpartitioning\(asset_id"
    assert not re.search(facts_shuffled, plan(joins.enrich(readings, assets)))
    assert "BroadcastHashJoin" in plan(joins.enrich(readings, assets))


def test_large_side_is_not_marked(spark, folder):
    assets = roles.assets(spark, folder)
    marked = joins.small_side(assets, limit=10)
    assert "ResolvedHint" not in marked._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in joins.small_side(assets)._jdf.queryExecution().analyzed().toString()
