from __future__ import annotations

import datetime as dt
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from listenlake.functions.measures import ratio2
from listenlake.operators import dedup, gold, preferences, star, trends
from listenlake.operators.silver import silver_events, silver_quarantine


def day(n: int, hour: int = 12) -> str:
    return f"2024-01-{n:02d}T{hour:02d}:00:00.000000Z"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_timestamp_texts(bronze_of):
    bronze = bronze_of(
        {"timestamp": "2024-01-01T10:00:00Z"},
        {"timestamp": "2024-01-01T10:00:00+07:00"},
        {"timestamp": "bad"},
        {"timestamp": ""},
        {"timestamp": None},
    )
    good = silver_events(bronze).orderBy("event_id").collect()
    assert [r["event_ts"] for r in good] == [
        dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 3)
    ]
    reasons = silver_quarantine(bronze).orderBy("event_id").select("reject_reason")
    assert rows(reasons) == [
        ("invalid timestamp",), ("invalid timestamp",), ("missing timestamp",)
    ]


def test_silver_and_quarantine_partition_bronze(bronze_of):
    bronze = bronze_of(
        {}, {"user_id": None}, {"song_id": None}, {"event_id": None, "user_id": None},
        {"timestamp": "x"}, {"user_id": ""},
    )
    good = silver_events(bronze)
    bad = silver_quarantine(bronze)
    assert good.count() == 2 and bad.count() == 4
    assert {r[0] for r in bad.select("reject_reason").collect()} == {
        "missing user_id", "missing song_id", "missing event_id", "invalid timestamp"
    }
    assert bad.columns[-2:] == ["reject_reason", "rejected_at"]


def test_ratio_rounds_halves_up(spark):
    pairs = [(a, b) for b in range(0, 81) for a in range(0, b + 1)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for a, b, r in df.select("a", "b", ratio2(F.col("a"), F.col("b"))).collect():
        expected = None if b == 0 else float(Fraction((200 * a + b) // (2 * b), 100))
        assert r == expected, (a, b)


def test_two_skip_rates(silver_of):
    silver = silver_of(
        {"event_type": "play"}, {"event_type": "skip"}, {"event_type": "skip"},
        {"event_type": "pause"},
    )
    assert gold.artist_performance(silver).first()["skip_rate"] == 2.0
    assert gold.churn_risk(silver, "2024-01-08").first()["skip_rate"] == 0.5


def test_no_plays_gives_null_ratio_and_sorts_first(silver_of):
    silver = silver_of({"song_id": "a", "event_type": "skip"}, {"song_id": "b"})
    got = rows(gold.playlist_conversion(silver).select("song_id", "conversion_rate"))
    assert got == [("a", None), ("b", 0.0)]


@pytest.mark.parametrize(
    "days, tier", [(1, "Casual"), (2, "Casual"), (3, "Regular"), (4, "Regular"), (5, "Power")]
)
def test_loyalty_edges(silver_of, days, tier):
    silver = silver_of(*[{"timestamp": day(i + 1, h)} for i in range(days) for h in (1, 2)])
    assert rows(gold.user_loyalty(silver)) == [("u1", days, tier)]


@pytest.mark.parametrize(
    "as_of, skips, plays, risk",
    [
        ("2024-01-08", 0, 10, "low"),
        ("2024-01-09", 0, 10, "high"),
        ("2024-01-08", 70, 30, "low"),
        ("2024-01-08", 71, 29, "medium"),
    ],
)
def test_churn_edges(silver_of, as_of, skips, plays, risk):
    kinds = ["skip"] * skips + ["play"] * plays
    silver = silver_of(*[{"event_type": k, "timestamp": day(1)} for k in kinds])
    assert gold.churn_risk(silver, as_of).first()["churn_risk"] == risk


def test_churn_uses_today_by_default(silver_of):
    row = gold.churn_risk(silver_of({"timestamp": day(1)})).first()
    assert row["days_inactive"] >= (dt.date(2026, 1, 1) - dt.date(2024, 1, 1)).days


def test_dim_date_weekday(silver_of):
    silver = silver_of({"timestamp": day(7)}, {"timestamp": day(8)}, {"timestamp": day(6)},
                       {"timestamp": day(7)})
    got = gold.dim_date(silver).orderBy("date_hour").select("day_of_week", "is_weekend")
    assert rows(got) == [(6, True), (0, True), (1, False)]


def test_top_device_is_the_last_name_and_the_other_mart_the_most_frequent(silver_of):
    silver = silver_of(
        {"device_type": "mobile"}, {"device_type": "mobile"}, {"device_type": "web"},
        {"country": None, "device_type": "desktop"},
    )
    stats = {r["country"]: r["top_device"] for r in gold.country_stats(silver).collect()}
    assert stats == {"VN": "web", None: "desktop"}
    best = {r["country"]: r["top_device"] for r in preferences.country_top_device(silver).collect()}
    assert best == {"VN": "mobile", None: "desktop"}


def test_device_ties_go_to_the_first_name(silver_of):
    silver = silver_of({"device_type": "web"}, {"device_type": "mobile"})
    assert rows(preferences.preferred_device(silver)) == [("u1", "mobile", 1)]


def test_dim_users_keeps_every_tuple(silver_of):
    silver = silver_of({"country": "VN"}, {"country": "US"}, {"country": "US"})
    assert gold.dim_users(silver).count() == 2


def test_peak_hours_counts_plays_only(silver_of):
    silver = silver_of({}, {"event_type": "skip"}, {"timestamp": day(7, 3)}, {"timestamp": day(8, 3)})
    assert rows(gold.peak_hours(silver)) == [("VN", 3, 2), ("VN", 10, 1)]


def test_marts_account_for_all_plays(silver_of):
    silver = silver_of(*[
        {"user_id": f"u{i % 3}", "song_id": f"s{i % 4}", "artist_name": f"A{i % 2}",
         "country": ["VN", "US"][i % 2], "event_type": ["play", "skip", "play", "pause"][i % 4],
         "timestamp": day(1 + i % 9, i % 24)}
        for i in range(60)
    ])
    plays = silver.filter("event_type = 'play'").count()

    def total(df, column):
        return df.agg(F.sum(column)).first()[0]

    assert total(gold.top_songs(silver), "total_plays") == plays
    assert total(gold.user_engagement(silver), "plays") == plays
    assert total(gold.artist_performance(silver), "total_plays") == plays
    assert total(gold.country_stats(silver), "total_plays") == plays
    assert total(gold.peak_hours(silver), "total_events") == plays
    assert total(gold.daily_plays(silver), "y") == plays
    assert total(star.star_join(silver), "plays") == plays
    assert total(trends.weekly_plays(silver), "plays") == plays


def test_week_after_a_gap_has_no_predecessor(silver_of):
    silver = silver_of({"timestamp": day(1)}, {"timestamp": day(8)}, {"timestamp": day(8)},
                       {"timestamp": day(22)})
    got = trends.song_trend_weekly(silver).orderBy("week").select("plays", "previous_plays", "change")
    assert rows(got) == [(1, 0, 1), (2, 1, 1), (1, 0, 1)]


def test_weekly_top_songs(silver_of):
    silver = silver_of(*[{"song_id": f"s{i}"} for i in range(5) for _ in range(i + 1)])
    got = trends.weekly_top_songs(silver, 2).orderBy("place").select("song_id", "plays", "place")
    assert rows(got) == [("s4", 5, 1), ("s3", 4, 2)]


def test_dedup_keeps_one_row_per_id_and_all_rows_without_id(bronze_of):
    bronze = bronze_of(
        {"event_id": "a", "age": 2}, {"event_id": "a", "age": 1}, {"event_id": "b"},
        {"event_id": None}, {"event_id": None},
    )
    got = dedup.dedup_events(bronze).select("event_id", "age").orderBy("event_id", "age")
    assert rows(got) == [(None, 20), (None, 20), ("a", 1), ("b", 20)]
    assert dedup.dedup_events(bronze).columns == bronze.columns


def test_union_then_filter_drops_null(spark):
    one = spark.sql("SELECT 1 AS id")
    both = one.unionByName(spark.sql("SELECT CAST(NULL AS INT) AS id"))
    assert both.count() == 2 and rows(both.filter("id = 1")) == [(1,)]
