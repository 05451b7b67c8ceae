"""Star schema: fact table with keys into the dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.functions.measures import plays
from listenlake.operators.gold import dim_date, dim_songs


def date_key(ts: str | Column) -> Column:
    """Hour of an event as a number, yyyyMMddHH."""
    return F.date_format(ts, "yyyyMMddHH").cast("bigint")


def fact_play_events(silver: DataFrame) -> DataFrame:
    return silver.select(
        "event_id",
        "user_id",
        "song_id",
        "device_type",
        date_key("event_ts").alias("date_key"),
        "event_type",
        "event_ts",
    )


def keyed_dim_date(silver: DataFrame) -> DataFrame:
    return dim_date(silver).select(date_key("date_hour").alias("date_key"), "*")


def plays_by_genre_and_weekend(
    fact: DataFrame, songs: DataFrame, dates: DataFrame
) -> DataFrame:
    """Star join, after the fact table is summed per key pair: the joins move totals,
    not events, and no song is hot any more."""
    totals = fact.groupBy("song_id", "date_key").agg(plays().alias("plays"))
    return (
        totals.join(songs.select("song_id", "genre"), "song_id")
        .join(dates.select("date_key", "is_weekend"), "date_key")
        .groupBy("genre", "is_weekend")
        .agg(F.sum("plays").alias("plays"))
    )


def star_join(silver: DataFrame) -> DataFrame:
    return plays_by_genre_and_weekend(
        fact_play_events(silver), dim_songs(silver), keyed_dim_date(silver)
    )
