"""Songs week by week."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlake.functions.measures import EVENTS, Measures
from listenlake.operators.gold import SONG


def weekly_plays(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    """Plays per song and week (``week`` is its Monday)."""
    week = F.to_date(F.date_trunc("week", "event_ts")).alias("week")
    return silver.groupBy(*SONG, week).agg(m.plays().alias("plays"))


def song_trend_weekly(silver: DataFrame, m: Measures = EVENTS) -> DataFrame:
    """This week against the calendar week before (0 plays if it had no events).

    The window runs over weekly totals, so a partition holds one row per week.
    """
    by_song = Window.partitionBy(*SONG).orderBy("week")
    before = F.lag("week").over(by_song) == F.date_sub("week", 7)
    previous = F.when(before, F.lag("plays").over(by_song)).otherwise(0)
    return weekly_plays(silver, m).select(
        *SONG,
        "week",
        "plays",
        previous.alias("previous_plays"),
        (F.col("plays") - previous).alias("change"),
    )


def weekly_top_songs(silver: DataFrame, n: int = 10, m: Measures = EVENTS) -> DataFrame:
    """Leading ``n`` songs of each week.

    Spark applies the rank limit inside each task before it shuffles by week, so a
    week's group holds at most ``n`` rows per task.
    """
    in_week = Window.partitionBy("week").orderBy(F.desc("plays"), *SONG)
    ranked = weekly_plays(silver, m).withColumn("place", F.row_number().over(in_week))
    return ranked.filter(F.col("place") <= n)
