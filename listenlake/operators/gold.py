"""Gold marts over silver events.

All of them are hash aggregates with a map-side partial step, so a song, user or
country that holds a third of all events reaches its final task as one partial
row per map task.  Exact distinct counts are planned by Spark on the pair
(group, value) first, which spreads a hot group over all tasks.  Sorted marts add
their grain as tie-break: a range sort cannot split equal keys, and a count such
as ``plays`` has few distinct values.

A mart with an ``m`` argument also runs over the totals of ``plans.rollups``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.functions.measures import EVENTS, Measures, ratio2
from listenlake.functions.times import as_of_date, is_weekend, weekday

SONG = ["song_id", "song_name", "artist_name"]

# Tier thresholds.
POWER_DAYS = 5
REGULAR_DAYS = 3
IDLE_DAYS = 7
SKIP_RATE_LIMIT = 0.7


def top_songs(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    return (
        silver.groupBy(*SONG)
        .agg(m.plays().alias("total_plays"), m.skips().alias("total_skips"))
        .orderBy(F.desc("total_plays"), *SONG)
    )


def user_engagement(
    silver: DataFrame, m: Measures = EVENTS, ordered: bool = True
) -> DataFrame:
    """The largest mart. ``ordered=False`` saves the shuffle of its final sort where
    the order is of no use, as in a stored table."""
    day = F.date_trunc("day", "event_ts").alias("day")
    totals = (
        silver.groupBy("user_id", "device_type", "country", day)
        .agg(
            m.plays().alias("plays"),
            m.skips().alias("skips"),
            m.playlist_adds().alias("playlist_adds"),
        )
        .select("user_id", "device_type", "country", "plays", "skips", "playlist_adds", "day")
    )
    if not ordered:
        return totals
    return totals.orderBy(F.desc("plays"), "user_id", "device_type", "country", "day")


def artist_performance(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    """``skip_rate`` here is skips per play and may exceed 1."""
    return silver.groupBy("artist_name").agg(
        m.plays().alias("total_plays"),
        m.skips().alias("total_skips"),
        ratio2(m.skips(), m.plays()).alias("skip_rate"),
        F.count_distinct("user_id").alias("unique_listeners"),
    )


def churn_tier(days_inactive: Column, skip_rate: Column) -> Column:
    return (
        F.when(days_inactive > IDLE_DAYS, "high")
        .when(skip_rate > SKIP_RATE_LIMIT, "medium")
        .otherwise("low")
    )


def churn_risk(
    silver: DataFrame, as_of: str | date | Column | None = None, m: Measures = EVENTS
) -> DataFrame:
    """``skip_rate`` here is skips per event of any type."""
    per_user = silver.groupBy("user_id").agg(
        F.to_date(F.max("event_ts")).alias("last_active_date"),
        ratio2(m.skips(), m.events()).alias("skip_rate"),
    )
    idle = F.datediff(as_of_date(as_of), F.col("last_active_date"))
    return per_user.select(
        "user_id",
        "last_active_date",
        idle.alias("days_inactive"),
        "skip_rate",
        churn_tier(idle, F.col("skip_rate")).alias("churn_risk"),
    )


def country_stats(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    """``top_device`` is the last device name in text order, as the mart defines it;
    ``preferences.country_top_device`` gives the most frequent one.

    A maximum of texts would turn the whole aggregate into a sort of all events, so
    it is taken over (country, device) counts, and two hash aggregates of two or
    three columns each meet in a join of one row per country.  The filter uses the
    counts: a bare ``distinct`` below a maximum is optimised away again.
    """
    totals = silver.groupBy("country").agg(
        m.plays().alias("total_plays"), F.count_distinct("user_id").alias("unique_users")
    )
    devices = (
        silver.groupBy(F.col("country").alias("_country"), "device_type")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 0")
        .groupBy("_country")
        .agg(F.max("device_type").alias("top_device"))
    )
    return totals.join(devices, F.col("country").eqNullSafe(F.col("_country"))).drop("_country")


def peak_hours(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    return (
        silver.filter(m.has_plays())
        .groupBy("country", F.hour("event_ts").alias("hour"))
        .agg(m.plays().alias("total_events"))
        .orderBy("country", F.desc("total_events"), "hour")
    )


def playlist_conversion(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    return (
        silver.groupBy(*SONG)
        .agg(
            m.plays().alias("plays"),
            m.playlist_adds().alias("playlist_adds"),
            ratio2(m.playlist_adds(), m.plays()).alias("conversion_rate"),
        )
        .orderBy(F.desc_nulls_first("conversion_rate"), *SONG)
    )


def loyalty_tier(active_days: Column) -> Column:
    return (
        F.when(active_days >= POWER_DAYS, "Power")
        .when(active_days >= REGULAR_DAYS, "Regular")
        .otherwise("Casual")
    )


def _loyalty(silver: DataFrame, grain: list[str | Column]) -> DataFrame:
    days = silver.groupBy(*grain).agg(
        F.count_distinct(F.to_date("event_ts")).alias("active_days")
    )
    return days.withColumn("loyalty_tier", loyalty_tier(F.col("active_days")))


def user_loyalty(silver: DataFrame) -> DataFrame:
    return _loyalty(silver, ["user_id"])


def user_loyalty_monthly(silver: DataFrame) -> DataFrame:
    """Loyalty by active days within each calendar month."""
    return _loyalty(silver, ["user_id", F.to_date(F.date_trunc("month", "event_ts")).alias("month")])


def listening_overview(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    return silver.agg(
        m.plays().alias("total_plays"),
        m.skips().alias("total_skips"),
        m.playlist_adds().alias("total_playlist_adds"),
        F.count_distinct("user_id").alias("active_users"),
    )


def daily_plays(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    return daily_series(silver, m=m).select("ds", "y").orderBy("ds")


def daily_series(
    silver: DataFrame, keys: list[str | Column] | None = None, m: Measures = EVENTS
) -> DataFrame:
    """Plays per day (``ds``, ``y``), per key if any are given."""
    return silver.groupBy(*(keys or []), F.to_date("event_ts").alias("ds")).agg(
        m.plays().alias("y")
    )


def top_n_songs(silver: DataFrame, n: int = 10) -> DataFrame:
    """The report's leading songs: a per-task top-n, then one merge of n rows each."""
    return top_songs(silver).limit(n)


def song_skip_rate(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    return (
        silver.groupBy(*SONG)
        .agg(
            m.plays().alias("total_plays"),
            m.skips().alias("total_skips"),
            ratio2(m.skips(), m.plays()).alias("skip_rate"),
        )
        .orderBy(F.desc_nulls_last("skip_rate"), *SONG)
    )


def dim_users(silver: DataFrame) -> DataFrame:
    """Distinct user tuples; country and device vary by event, so a user may have many."""
    return silver.select(
        "user_id", "country", "device_type", "subscription_type", "age"
    ).distinct()


def dim_songs(silver: DataFrame) -> DataFrame:
    return silver.select(*SONG, "genre", "duration_seconds").distinct()


def dim_devices(silver: DataFrame) -> DataFrame:
    return silver.select("device_type").distinct()


def dim_date(silver: DataFrame) -> DataFrame:
    """One row per hour with events; deduplicates hours before deriving their parts."""
    hours = silver.select(F.date_trunc("hour", "event_ts").alias("date_hour")).distinct()
    return hours.select(
        "date_hour",
        F.to_date("date_hour").alias("date_day"),
        F.hour("date_hour").alias("hour"),
        weekday(F.col("date_hour")).alias("day_of_week"),
        is_weekend(F.col("date_hour")).alias("is_weekend"),
    )
