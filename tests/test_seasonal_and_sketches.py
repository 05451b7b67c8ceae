"""Change points, seasonal recursion, mergeable distinct counts and buckets by user."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from listenlake import jobs
from listenlake.functions.measures import TOTALS
from listenlake.operators import forecast, gold, preferences, seasonal
from listenlake.plans import medallion, registry, rollups
from listenlake.session import work_dir
from listenlake.sinks import tables

START = dt.date(2024, 1, 1)


def series(spark, values, name="a"):
    rows = [(name, START + dt.timedelta(i), v) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "song_id string, ds date, y bigint")


def bend(i):
    return 50 + 4 * min(i, 30) - 3 * max(0, i - 30) + [0, 6, 3, -2, 1, 9, -4][i % 7]


BROKEN = [bend(i) for i in range(60)]


def errors(model):
    return np.array([r["yhat"] - r["y"] for r in model.collect() if r["y"] is not None])


def test_change_points_against_numpy(spark):
    got = seasonal.forecast_changepoints(series(spark, BROKEN).drop("song_id")).orderBy("ds").collect()
    u = np.arange(67) / 59
    basis = np.stack([np.ones(67), u] + [np.maximum(u - 0.8 * j / 7, 0) for j in range(1, 7)], axis=1)
    gram = basis[:60].T @ basis[:60] + np.diag([0, 0] + [seasonal.RIDGE] * 6)
    trend = basis @ np.linalg.solve(gram, basis[:60].T @ np.array(BROKEN))
    residual = np.array(BROKEN) - trend[:60]
    expected = [trend[i] + residual[i % 7 :: 7].mean() for i in range(67)]
    assert np.allclose([r["yhat"] for r in got], expected)
    assert [r["y"] for r in got] == BROKEN + [None] * 7


def test_change_points_beat_the_straight_line_on_a_broken_trend(spark):
    daily = series(spark, BROKEN).drop("song_id")
    bent = np.square(errors(seasonal.forecast_changepoints(daily))).mean()
    straight = np.square(errors(forecast.forecast_trend(daily))).mean()
    assert bent < straight / 4


def test_change_points_per_series_with_null_key_and_short_history(spark):
    both = series(spark, BROKEN).unionByName(series(spark, BROKEN[:2], None)).unionByName(series(spark, [3], "one"))
    got = seasonal.forecast_changepoints(both, ["song_id"])
    alone = seasonal.forecast_changepoints(series(spark, BROKEN).drop("song_id")).orderBy("ds").collect()
    mine = got.where("song_id = 'a'").orderBy("ds").collect()
    assert np.allclose([r["yhat"] for r in mine], [r["yhat"] for r in alone])
    assert got.where("song_id is null").count() == 9
    assert got.where("song_id = 'one'").count() == 0
    assert seasonal.forecast_changepoints(both.limit(0), ["song_id"]).count() == 0


def recursion(values, alpha, beta, gamma):
    week = values[:7]
    level, trend = sum(week) / len(week), 0.0
    season = [v - level for v in week] + [0.0] * (7 - len(week))
    sse = 0.0
    for t in range(7, len(values)):
        effect, ahead = season[t % 7], level + trend
        sse += (values[t] - ahead - effect) ** 2
        fresh = alpha * (values[t] - effect) + (1 - alpha) * ahead
        trend = beta * (fresh - level) + (1 - beta) * trend
        season[t % 7] = gamma * (values[t] - fresh) + (1 - gamma) * effect
        level = fresh
    return sse, [level + h * trend + season[(len(values) + h - 1) % 7] for h in range(1, 8)]


@pytest.mark.parametrize("values", [BROKEN, [4, None, None, 9, 2, 0, 5, None, 7, 8, 1], [3, 5], [6], BROKEN[:7]])
def test_seasonal_recursion_against_a_loop(spark, values):
    got = seasonal.forecast_seasonal(series(spark, values), ["song_id"]).orderBy("ds").collect()
    whole = [v or 0 for v in values]
    tried = [recursion(whole, *t) for t in seasonal.SMOOTHING]
    best = min(range(len(tried)), key=lambda i: (round(tried[i][0], 6), i))
    assert np.allclose([r["yhat"] for r in got], tried[best][1])
    assert {r["smoothing"] for r in got} == {best}
    assert got[0]["ds"] == START + dt.timedelta(len(values))
    if len(values) > 7:
        assert got[0]["mse"] == pytest.approx(tried[best][0] / (len(values) - 7))
    else:
        assert got[0]["mse"] is None


def test_seasonal_leaves_out_nulls_and_bears_an_empty_table(spark):
    daily = series(spark, [1, 2, 3]).unionByName(spark.createDataFrame([("a", None, 5), ("b", START, None)], "song_id string, ds date, y bigint"))
    got = seasonal.forecast_seasonal(daily, ["song_id"])
    assert {r["song_id"] for r in got.collect()} == {"a"} and got.count() == 7
    assert seasonal.forecast_seasonal(daily.limit(0), ["song_id"]).count() == 0


@pytest.fixture(scope="module")
def larger(spark):
    silver = registry.queries()["silver_events"](spark, "/root/testdata/sf0.1")
    return tables.write_silver(silver, work_dir(spark, "larger")).drop("event_date")


@pytest.mark.parametrize("first, last", [("2024-01-01", "2024-01-31"), ("2024-01-09", "2024-01-09"), ("2024-01-03", "2024-01-20")])
@pytest.mark.parametrize("keys", [[], ["country"], ["artist_name"], ["artist_name", "country"]])
def test_sketches_of_a_range_stay_within_the_bound(spark, larger, first, last, keys):
    days = rollups.listener_sketches(larger, rollups.SKETCHES["listeners_day"])
    got = {tuple(r[k] for k in keys): r["unique_listeners"] for r in rollups.unique_listeners(days, first, last, keys).collect()}
    exact = larger.where(F.to_date("event_ts").between(F.lit(first), F.lit(last))).groupBy(*keys).agg(F.count_distinct("user_id").alias("n"))
    wanted = {tuple(r[k] for k in keys): r["n"] for r in exact.collect()}
    assert set(got) == set(wanted)
    assert all(abs(got[k] - n) <= rollups.SKETCH_ERROR * n for k, n in wanted.items())


def test_a_range_without_events_has_no_listeners(spark, larger):
    days = rollups.listener_sketches(larger, rollups.SKETCHES["listeners_day"])
    assert rollups.unique_listeners(days, "1999-01-01", "1999-01-02", []).first()["unique_listeners"] == 0
    assert rollups.unique_listeners(days, "1999-01-01", "1999-01-02", ["country"]).count() == 0


def test_listeners_of_a_published_lake(spark, sf_dir):
    schema, lake = registry._bronze_schema(spark, "listeners"), work_dir(spark, "lake")
    medallion.build_lake(spark, registry._bronze(spark, sf_dir), lake, schema, registry.AS_OF, as_tables=True)
    got = medallion.listeners(spark, lake, "2024-01-02", "2024-01-28", []).first()["unique_listeners"]
    silver = tables.read_silver(spark, lake).where("event_date between '2024-01-02' and '2024-01-28'")
    n = silver.select("user_id").distinct().count()
    assert abs(got - n) <= rollups.SKETCH_ERROR * n


def test_marts_by_user_shuffle_nothing_over_buckets(spark, sf_dir):
    schema = registry._bronze_schema(spark, "plans")
    silver = registry.queries()["silver_events"](spark, sf_dir)
    stored = rollups.bucketed_user_days(silver, f"{schema}.user_day", buckets=8)
    for mart in (
        gold.churn_risk(stored, registry.AS_OF, TOTALS), gold.user_loyalty(stored), gold.user_loyalty_monthly(stored),
        gold.user_engagement(stored, TOTALS, ordered=False), preferences.preferred_device(stored, TOTALS),
    ):
        assert "Exchange" not in mart._jdf.queryExecution().executedPlan().toString()


def test_a_hot_user_adds_a_row_per_day_to_its_bucket(spark, silver_of):
    schema = registry._bronze_schema(spark, "hot")
    events = silver_of(*[{"user_id": "hot"}] * 300, *[{"user_id": f"u{i}"} for i in range(20)])
    stored = rollups.bucketed_user_days(events, f"{schema}.user_day", buckets=4)
    assert stored.where("user_id = 'hot'").count() == 1 and stored.agg(F.sum("events")).first()[0] == 320


def test_forecast_job_with_change_points(spark, sf_dir):
    root, schema = work_dir(spark, "silver"), registry._bronze_schema(spark, "bent")
    tables.write_silver(registry.queries()["silver_events"](spark, sf_dir), root)
    jobs.run(spark, ["forecast", "--silver", root, "--schema", schema, "--run-id", "r", "--model", "changepoints"])
    kind = spark.table(f"{schema}.forecast_runs").where("name = 'model_type'").first()["value"]
    assert kind == "trend with change points and weekday effect"
    assert spark.table(f"{schema}.daily_play_forecast").count() > 7
