from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from listenlake.operators import anomalies, forecast, gold, quality, recommend
from listenlake.session import work_dir
from listenlake.sinks import tables


def test_report_counts_each_kind_of_failure(spark):
    df = spark.createDataFrame(
        [("a", "like"), ("a", "hate"), ("b", "like"), (None, None), ("b", "play"), ("b", "skip")],
        "event_id string, event_type string",
    )
    rules = [
        quality.NotNull("event_id"), quality.Unique("event_id"),
        quality.AcceptedValues("event_type", ("play", "skip")),
    ]
    got = {
        (r["check"], r["column"]): (r["failures"], r["failing_rows"], r["passed"])
        for r in quality.dq_report(df, rules).collect()
    }
    assert got == {
        ("not_null", "event_id"): (1, 1, False),
        ("unique", "event_id"): (2, 5, False),
        ("accepted_values", "event_type"): (2, 3, False),
    }
    assert {tuple(r) for r in quality.dq_unexpected_values(df, rules).collect()} == {
        ("event_type", "like", 2), ("event_type", "hate", 1)
    }


def test_nulls_pass_unique_and_accepted_values_and_empty_input_passes(spark):
    rules = [quality.Unique("id"), quality.AcceptedValues("id", ("1",)), quality.NotNull("id")]
    nulls = spark.createDataFrame([(None,), (None,)], "id string")
    assert [r["check"] for r in quality.dq_report(nulls, rules).filter("NOT passed").collect()] == [
        "not_null"
    ]
    report = quality.dq_report(nulls.limit(0), rules)
    assert report.count() == 3 and report.filter("passed").count() == 3
    quality.enforce(report)


def test_gate_names_the_failed_checks(spark):
    df = spark.createDataFrame([("x",), ("x",)], "id string")
    with pytest.raises(quality.QualityError, match=r"unique\(id\): 1"):
        quality.enforce(quality.dq_report(df, [quality.Unique("id"), quality.NotNull("id")]))


def series(spark, values, start=dt.date(2024, 1, 1)):
    rows = [(start + dt.timedelta(i), v) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "ds date, y bigint")


VALUES = [100 + 3 * i + [0, 5, 9, -4, 2, 20, -11][i % 7] + (i * i) % 5 for i in range(40)]


def test_trend_model_against_numpy(spark):
    got = forecast.forecast_trend(series(spark, VALUES)).orderBy("ds").collect()
    t = np.arange(40)
    slope, intercept = np.polyfit(t, VALUES, 1)
    residual = np.array(VALUES) - (intercept + slope * t)
    weekly = [residual[d::7].mean() for d in range(7)]
    expected = [intercept + slope * i + weekly[i % 7] for i in range(47)]
    assert np.allclose([r["yhat"] for r in got], expected)
    band = 1.2816 * np.std(np.array(VALUES) - expected[:40], ddof=1)
    assert np.allclose([r["yhat_upper"] - r["yhat"] for r in got], band)
    assert np.allclose([r["yhat"] - r["yhat_lower"] for r in got], band)
    assert [r["y"] for r in got] == VALUES + [None] * 7


def test_fourier_model_against_least_squares(spark):
    got = forecast.forecast_fourier(series(spark, VALUES)).orderBy("ds").collect()
    design = np.zeros((47, 8))
    for i in range(47):
        design[i, i % 7] = 1
        design[i, 7] = i
    coefficients = np.linalg.lstsq(design[:40], np.array(VALUES, float), rcond=None)[0]
    assert np.allclose([r["yhat"] for r in got], design @ coefficients, atol=1e-6)


def test_gaps_stay_gaps_and_the_horizon_starts_after_the_last_day(spark):
    got = forecast.forecast_trend(series(spark, [5, None, 7, 9])).orderBy("ds").collect()
    assert [r["ds"].day for r in got] == [1, 3, 4, 5, 6, 7, 8, 9, 10, 11]


def test_too_little_history_gives_no_forecast(spark):
    one = series(spark, [5])
    assert forecast.forecast_trend(one).count() == 0
    assert forecast.forecast_fourier(one).count() == 0
    assert forecast.forecast_metrics(forecast.forecast_trend(one), one).count() == 0


def test_metrics_look_at_history_only(spark):
    daily = series(spark, VALUES)
    model = forecast.forecast_trend(daily)
    row = forecast.forecast_metrics(model, daily).first()
    gaps = np.array([r["yhat"] - r["y"] for r in model.collect() if r["y"] is not None])
    assert row["mae"] == round(float(np.abs(gaps).mean()), 2)
    assert row["rmse"] == round(float(np.sqrt((gaps**2).mean())), 2)
    assert (row["data_days"], row["total_plays"]) == (40, sum(VALUES))


def test_run_log_is_appended(spark):
    daily = series(spark, VALUES)
    metrics = forecast.forecast_metrics(forecast.forecast_trend(daily), daily)
    schema = work_dir(spark, "runs").rsplit("/", 1)[1].replace("-", "_")
    tables.ensure_schema(spark, schema)
    for run in ("one", "two"):
        tables.append_run(forecast.run_record(metrics, run, forecast.RUN_PARAMS), f"{schema}.runs")
    log = spark.table(f"{schema}.runs")
    counted = {(r["run_id"], r["kind"]): r["count"] for r in log.groupBy("run_id", "kind").count().collect()}
    assert counted == {(r, k): n for r in ("one", "two") for k, n in (("metric", 4), ("param", 5))}


def test_series_are_independent(spark):
    a, b = VALUES[:20], [v * 2 + 1 for v in VALUES[5:33]]
    both = series(spark, a).withColumn("song_id", F.lit("a")).unionByName(
        series(spark, b).withColumn("song_id", F.lit("b")))
    got = forecast.forecast_trend(both, ["song_id"])
    for name, values in (("a", a), ("b", b)):
        alone = forecast.forecast_trend(series(spark, values)).orderBy("ds").collect()
        mine = got.filter(F.col("song_id") == name).orderBy("ds").collect()
        assert np.allclose([r["yhat"] for r in mine], [r["yhat"] for r in alone])


def brute_bursts(events, seconds):
    peaks = {}
    for user in {u for u, _ in events}:
        times = sorted(s for u, s in events if u == user)
        peaks[user] = max(sum(1 for x in times if t - seconds < x <= t) for t in times)
    return peaks


def test_bursts_against_brute_force_with_a_hot_user(spark):
    rng = random.Random(3)
    events = [("hot", rng.randrange(3500, 3700)) for _ in range(400)]
    events += [("hot", rng.randrange(0, 20000)) for _ in range(400)]
    events += [(f"u{rng.randrange(40)}", rng.randrange(3000, 11000)) for _ in range(800)]
    df = spark.createDataFrame(events, "user_id string, s bigint").select(
        "user_id", F.timestamp_seconds("s").alias("event_ts"), F.lit("skip").alias("event_type")
    )
    for seconds in (60, 600):
        got = {r["user_id"]: r["peak_skips"] for r in anomalies.skip_bursts(df, 20, seconds).collect()}
        assert got == brute_bursts(events, seconds)


def test_twenty_skips_in_a_minute_make_a_bot(silver_of):
    def skips(user, n):
        return [
            {"user_id": user, "event_type": "skip", "timestamp": f"2024-01-01T00:59:{30 + i:02d}Z"}
            for i in range(n)
        ]

    got = anomalies.skip_bursts(silver_of(*skips("bot", 20), *skips("person", 19), {}))
    assert {tuple(r) for r in got.collect()} == {("bot", 20, True), ("person", 19, False)}


def test_dense_index_has_no_gap(spark):
    ids = [f"id-{i}" for i in range(5000)]
    df = spark.createDataFrame([(i,) for i in ids + ids[:100]], "id string")
    got = recommend.dense_index(df, "id", "n").collect()
    assert sorted(r["n"] for r in got) == list(range(5000)) and {r["id"] for r in got} == set(ids)
    again = recommend.dense_index(df.repartition(7), "id", "n").collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in again}


def test_recommendation_follows_the_group(silver_of):
    events = [
        {"user_id": f"{side}{u}", "song_id": f"{side}{s}"}
        for side in "xy" for u in range(6) for s in range(6) if u != s
    ]
    got = recommend.recommend_songs(silver_of(*events), n=6, rank=2, iterations=8).collect()
    assert len(got) == 12 * 6
    assert all(r["user_id"][0] == r["song_id"][0] for r in got if r["place"] <= 5)


def test_peak_hour_is_one_row_for_the_common_next_day(silver_of):
    silver = silver_of(*[
        {"timestamp": f"2024-01-{d:02d}T{h:02d}:00:00Z"}
        for d in range(1, 15) for h in (3, 8) for _ in range(3 if h == 8 else 1)
    ], {"timestamp": "2024-01-15T03:00:00Z"})
    hourly = gold.daily_series(silver, [F.hour("event_ts").alias("hour")])
    got = forecast.peak_hour_forecast(hourly).collect()
    assert [(str(r["ds"]), r["peak_hour"]) for r in got] == [("2024-01-16", 8)]
