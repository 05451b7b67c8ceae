"""Properties of the physical plans that decide how the jobs scale."""

from __future__ import annotations

import pytest

import compare
from listenlake.operators import gold, trends
from listenlake.plans import medallion, registry, rollups
from listenlake.session import work_dir
from listenlake.sinks import tables
from listenlake.sources import testdata


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    silver = registry.queries()["silver_events"](spark, sf_dir)
    return tables.write_silver(silver, work_dir(spark, "plans")).drop("event_date")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_mart_multiplies_rows(stored):
    for name, mart in medallion.gold_marts(stored, "2024-01-31").items():
        plan = plan_of(mart)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


@pytest.mark.parametrize(
    "mart",
    ["top_songs", "user_engagement", "artist_performance", "churn_risk", "peak_hours",
     "playlist_conversion", "user_loyalty", "dim_users", "dim_songs", "dim_date"],
)
def test_marts_aggregate_by_hash_with_a_partial_step(stored, mart):
    plan = plan_of(medallion.GOLD[mart](stored))
    assert "SortAggregate" not in plan
    assert plan.count("HashAggregate") >= 2


def test_country_stats_sorts_distinct_pairs_only(stored):
    plan = plan_of(gold.country_stats(stored))
    first = plan[plan.rindex("partial_max"):]
    assert first.count("HashAggregate") == 2 and "device_type" in first


def test_filters_and_columns_reach_the_scan(stored):
    plan = plan_of(gold.peak_hours(stored))
    assert "EqualTo(event_type,play)" in plan
    assert "ReadSchema: struct<event_type:string,country:string,event_ts:timestamp>" in plan


def test_rank_limit_runs_before_the_shuffle(stored):
    plan = plan_of(trends.weekly_top_songs(stored))
    assert plan.count("WindowGroupLimit") == 2


def test_top_n_needs_no_global_sort(stored):
    plan = plan_of(gold.top_n_songs(stored))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_rollup_marts_read_totals_only(spark, stored):
    root = work_dir(spark, "rollups")
    rollups.refresh(stored, root)
    for name, mart in rollups.marts(spark, root, "2024-01-31").items():
        assert "event_type" not in plan_of(mart), name


def test_operators_carry_no_broadcast_hint(spark, sf_dir):
    for df in (testdata.bronze(spark, sf_dir), registry.queries()["star_plays_by_genre"](spark, sf_dir)):
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("name", ["top_songs", "country_stats", "star_plays_by_genre", "dq_report"])
def test_same_rows_when_nothing_is_small_enough_to_broadcast(spark, sf_dir, name):
    query = registry.queries()[name]
    expected = compare.spark_rows(query(spark, sf_dir))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = query(spark, sf_dir)
        assert "BroadcastHashJoin" not in plan_of(df)
        assert compare.spark_rows(df) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
