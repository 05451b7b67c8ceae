"""Daily totals that most marts can be built from.

A full rebuild reads every event once per mart.  Here each new day of silver is
read once per rollup, its totals replace that day's folder, and the marts read
totals only.  A day that is delivered again, or corrected, is simply refreshed
again.

========================  ===================================================
``user_day``              user, device, country, subscription, age, day
``song_day``              song, genre, duration, day
``country_hour``          country, hour
``artist_user_day``       artist, user, day
``listeners_day``         artist, country, day: a sketch of the users (``SKETCHES``)
========================  ===================================================

Each keeps ``event_ts`` as the start of its day or hour, so the marts' own time
expressions work on it unchanged.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listenlake.functions.measures import EVENTS, TOTALS
from listenlake.operators import gold, preferences, star, trends

GRAIN: dict[str, tuple[list[str], str]] = {
    "user_day": (["user_id", "device_type", "country", "subscription_type", "age"], "day"),
    "song_day": ([*gold.SONG, "genre", "duration_seconds"], "day"),
    "country_hour": (["country"], "hour"),
    "artist_user_day": (["artist_name", "user_id"], "day"),
}

# Rollups that hold a mergeable sketch of users in place of counts.
SKETCHES: dict[str, list[str]] = {"listeners_day": ["artist_name", "country"]}
LISTENERS = (
    StructType().add("artist_name", "string").add("country", "string").add("listeners", "binary").add("event_date", "date")
)
# Two to this power registers: 1.6 % standard error, and three times that as the bound.
SKETCH_POWER = 12
SKETCH_ERROR = 0.05


def totals(silver: DataFrame, keys: list[str], unit: str) -> DataFrame:
    moment: Column = F.date_trunc(unit, "event_ts").alias("event_ts")
    return (
        silver.groupBy(*keys, moment)
        .agg(
            EVENTS.plays().alias("plays"),
            EVENTS.skips().alias("skips"),
            EVENTS.playlist_adds().alias("playlist_adds"),
            EVENTS.events().alias("events"),
        )
        .withColumn("event_date", F.to_date("event_ts"))
    )


def refresh(silver_days: DataFrame, root: str) -> None:
    """Replace the rollup folders of the days that occur in ``silver_days``.

    ``silver_days`` must hold these days completely.  Silver stored by
    ``event_date`` and filtered on it is read for these days only.
    """
    for name, rows in daily(silver_days).items():
        (
            rows.hint("rebalance", "event_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date")
            .parquet(f"{root}/{name}")
        )


def daily(silver: DataFrame) -> dict[str, DataFrame]:
    """Every rollup over these events, with its ``event_date``."""
    counted = {name: totals(silver, *grain) for name, grain in GRAIN.items()}
    return counted | {name: listener_sketches(silver, keys) for name, keys in SKETCHES.items()}


def listener_sketches(silver: DataFrame, keys: list[str]) -> DataFrame:
    """A sketch of the distinct users per key and day; a user counts whatever the event."""
    return silver.groupBy(*keys, F.to_date("event_ts").alias("event_date")).agg(
        F.hll_sketch_agg("user_id", SKETCH_POWER).alias("listeners")
    )


def unique_listeners(sketches: DataFrame, first: str | date, last: str | date, keys: list[str]) -> DataFrame:
    """Distinct users of a range of days (both included), estimated from the daily sketches.

    ``sketches`` is the stored ``listeners_day``, and ``keys`` is any part of artist_name and country, none for one row over all.  Only the
    range's folders are read.  Up to some hundred users the number is exact; beyond that it
    lies within ``SKETCH_ERROR`` in about 997 of 1000 cases.  The exact marts stay the default.
    """
    days = sketches.where(
        F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )
    merged = F.hll_sketch_estimate(F.hll_union_agg("listeners"))
    return days.groupBy(*keys).agg(F.coalesce(merged, F.lit(0)).cast("bigint").alias("unique_listeners"))


def bucketed_user_days(silver: DataFrame, table: str, buckets: int = 64) -> DataFrame:
    """The ``user_day`` totals as a table in buckets by user, which is returned.

    Marts by user (churn, loyalty, engagement, preferred device) aggregate it without a
    shuffle.  Totals go in and not events, so a user who holds a third of all events adds
    a row per day and attribute set, and no bucket grows with one user's events.
    """
    keys, unit = GRAIN["user_day"]
    # One task per bucket writes one file.
    rows = totals(silver, keys, unit).repartition(buckets, "user_id")
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, "user_id").saveAsTable(table)
    return silver.sparkSession.table(table)


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def marts(spark: SparkSession, root: str, as_of: str | date | None = None) -> dict[str, DataFrame]:
    """The marts over the rollups stored below ``root``."""
    return marts_of({name: read(spark, root, name) for name in GRAIN}, as_of)


def marts_of(rolled: dict[str, DataFrame], as_of: str | date | None = None, ordered: bool = True) -> dict[str, DataFrame]:
    """The marts that totals are enough for, with the same rows as over silver."""
    user_day, song_day, country_hour = (rolled[n] for n in ("user_day", "song_day", "country_hour"))
    return {
        "top_songs": gold.top_songs(song_day, TOTALS),
        "user_engagement": gold.user_engagement(user_day, TOTALS, ordered),
        "artist_performance": gold.artist_performance(rolled["artist_user_day"], TOTALS),
        "churn_risk": gold.churn_risk(user_day, as_of, TOTALS),
        "country_stats": gold.country_stats(user_day, TOTALS),
        "peak_hours": gold.peak_hours(country_hour, TOTALS),
        "playlist_conversion": gold.playlist_conversion(song_day, TOTALS),
        "user_loyalty": gold.user_loyalty(user_day),
        "user_loyalty_monthly": gold.user_loyalty_monthly(user_day),
        "dim_users": gold.dim_users(user_day),
        "dim_songs": gold.dim_songs(song_day),
        "dim_date": star.keyed_dim_date(country_hour),
        "dim_devices": gold.dim_devices(user_day),
        "daily_plays": gold.daily_plays(country_hour, TOTALS),
        "listening_overview": gold.listening_overview(user_day, TOTALS),
        "song_skip_rate": gold.song_skip_rate(song_day, TOTALS),
        "preferred_device": preferences.preferred_device(user_day, TOTALS),
        "country_top_device": preferences.country_top_device(user_day, TOTALS),
        "song_trend_weekly": trends.song_trend_weekly(song_day, TOTALS),
        "weekly_top_songs": trends.weekly_top_songs(song_day, m=TOTALS),
    }
