"""Users that skip faster than people do."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlake.functions.measures import skips

# A bot skips this often within this many seconds.
BOT_SKIPS = 20
BOT_SECONDS = 60



def skip_bursts(
    silver: DataFrame, threshold: int = BOT_SKIPS, seconds: int = BOT_SECONDS
) -> DataFrame:
    """Per skipping user the largest number of skips in any window of ``seconds``.

    A window ends at a skip and reaches back less than ``seconds``, to the microsecond.
    Skips are first counted per user and moment.  A user's moments are then cut into
    slices of ``seconds``, each of which is also given to the next one as context, so a
    window partition never exceeds two slices, even for a user who makes a third of
    all events.  The context rows see too few skips in the foreign slice, but the
    maximum takes their full sum from their own.
    """
    width = seconds * 1_000_000
    per_moment = (
        silver.filter(F.col("event_type") == "skip")
        .groupBy("user_id", F.unix_micros("event_ts").alias("moment"))
        .agg(skips().alias("n"))
    )
    own = F.floor(F.col("moment") / width)
    sliced = per_moment.withColumn("slice", F.explode(F.array(own, own + 1)))
    window = (
        Window.partitionBy("user_id", "slice").orderBy("moment").rangeBetween(1 - width, 0)
    )
    peak = F.max("in_window")
    return (
        sliced.withColumn("in_window", F.sum("n").over(window))
        .groupBy("user_id")
        .agg(peak.alias("peak_skips"), (peak >= threshold).alias("is_bot"))
    )
