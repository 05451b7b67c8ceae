"""Event-time operators over a silver stream.

Each one has a map-side partial aggregate before its shuffle, so a hot user or a
busy minute sends one row per task.  The watermark bounds the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from listenlake.functions.measures import plays, skips
from listenlake.operators.anomalies import BOT_SECONDS, BOT_SKIPS

LATENESS = "10 minutes"
_MARK = "event_ts timestamp, event_type string"
# States that the users of ``skip_bots`` share, and skips looked at together.
BOT_GROUPS = 2048
SKIPS_AT_ONCE = 200_000


def plays_per_minute(
    silver: DataFrame, width: str = "1 minute", lateness: str = LATENESS
) -> DataFrame:
    """Plays in tumbling windows: (window_start, window_end, plays)."""
    counted = (
        silver.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", width).alias("w"))
        .agg(plays().alias("plays"))
    )
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "plays"
    )


def skip_windows(
    silver: DataFrame,
    threshold: int = BOT_SKIPS,
    seconds: int = BOT_SECONDS,
    slide: str = "30 seconds",
    lateness: str = LATENESS,
) -> DataFrame:
    """Skips per user in sliding windows, flagged at ``threshold``.

    The watermark follows the skips, not the other events.

    A slide of half the width puts a skip into two windows.  ``skip_bots`` and the batch
    operator ``anomalies.skip_bursts`` look at every window position.
    """
    counted = (
        silver.filter(F.col("event_type") == "skip")
        .withWatermark("event_ts", lateness)
        .groupBy("user_id", F.window("event_ts", f"{seconds} seconds", slide).alias("w"))
        .agg(skips().alias("skips"))
    )
    return counted.select(
        "user_id",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "skips",
        (F.col("skips") >= threshold).alias("is_bot"),
    )


def unique_events(
    silver: DataFrame,
    key: str = "event_id",
    lateness: str = LATENESS,
    spread: Column | None = None,
) -> DataFrame:
    """First arrival of each ``key`` within the watermark.

    ``spread`` (for example a hash of partition and offset, modulo a small number)
    divides the copies of a hot key over several tasks in a first pass; the second
    pass then sees at most one copy per value of ``spread``.
    """
    marked = silver.withWatermark("event_ts", lateness)
    if spread is not None:
        marked = marked.withColumn("_spread", spread)
        marked = marked.dropDuplicatesWithinWatermark([key, "_spread"]).drop("_spread")
    return marked.dropDuplicatesWithinWatermark([key])


def _burst_ends(user: np.ndarray, moment: np.ndarray, threshold: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(user, moment) of the first burst of each user that has one; rows are sorted by both."""
    last = np.arange(threshold - 1, len(user))
    first = last - (threshold - 1)
    close = last[(user[last] == user[first]) & (moment[last] - moment[first] < width)]
    whose, at = np.unique(user[close], return_index=True)
    return whose, moment[close][at]


def _flag_bots(threshold: int, seconds: int):
    width = seconds * 1_000_000

    def gathered(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, rows = [], 0
        for chunk in chunks:
            parts.append(chunk[["user_id", "moment"]])
            rows += len(chunk)
            if rows >= SKIPS_AT_ONCE:
                yield pd.concat(parts, ignore_index=True)
                parts, rows = [], 0
        if parts:
            yield pd.concat(parts, ignore_index=True)

    def flag(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        users, counts, times, bots = state.get if state.exists else ([], [], [], [])
        if state.hasTimedOut:
            # No window reaches the skips any more; a flag stays for good.
            state.update(([], [], [], bots)) if bots else state.remove()
            return
        names = np.repeat(np.array(users, dtype=object), np.array(counts, dtype=np.int64))
        moments = np.array(times, dtype=np.int64)
        flagged = set(bots)
        for chunk in gathered(chunks):
            names = np.concatenate([names, chunk["user_id"].to_numpy(dtype=object)])
            moments = np.concatenate([moments, chunk["moment"].to_numpy(np.int64)])
            code, known = pd.factorize(names)
            # Users flagged before take no part; their code is looked up once.
            free = ~np.fromiter((u in flagged for u in known), bool, len(known))[code]
            code, moments = code[free], moments[free]
            order = np.lexsort((moments, code))
            code, moments = code[order], moments[order]
            whose, ends = _burst_ends(code, moments, threshold, width)
            if len(whose):
                found = [known[c] for c in whose]
                flagged.update(found)
                yield pd.DataFrame({"user_id": found, "moment": ends})
                stay = ~np.isin(code, whose)
                code, moments = code[stay], moments[stay]
            names = np.asarray(known, dtype=object)[code]
        # What still comes is not older than the watermark, so a window reaches back no farther.
        mark = state.getCurrentWatermarkMs()
        late = moments > mark * 1000 - width
        names, moments = names[late], moments[late]
        start = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else np.empty(0, np.int64)
        held = (names[start].tolist(), np.diff(np.r_[start, len(names)]).tolist(), moments.tolist(), sorted(flagged))
        if not len(names) and not flagged:
            state.remove()
            return
        state.update(held)
        if len(moments):
            state.setTimeoutTimestamp(max(int(moments.max()) // 1000 + seconds * 1000, mark + 1))

    return flag


def skip_bots(
    silver: DataFrame, threshold: int = BOT_SKIPS, seconds: int = BOT_SECONDS, lateness: str = LATENESS,
    groups: int = BOT_GROUPS,
) -> DataFrame:
    """Users with ``threshold`` skips in less than ``seconds``, each once: (user_id, flagged_at).

    Every window position counts, also across micro-batches and for skips that arrive out of
    order within the watermark.  Users are dealt by hash to ``groups`` states, so the cost of a
    call is shared by many users; a state holds the skip times of its users that a window may
    still reach, and its flags.  The rows of a group pass by in bounded chunks.
    """
    skipped = (
        silver.filter((F.col("event_type") == "skip") & F.col("user_id").isNotNull())
        .withWatermark("event_ts", lateness)
        .select(
            "user_id", "event_ts", F.unix_micros("event_ts").alias("moment"),
            F.pmod(F.xxhash64("user_id"), F.lit(groups)).alias("_group"),
        )
    )
    flagged = skipped.groupBy("_group").applyInPandasWithState(
        _flag_bots(threshold, seconds), "user_id string, moment long",
        "users array<string>, counts array<long>, times array<long>, bots array<string>",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
    return flagged.select("user_id", F.timestamp_micros("moment").alias("flagged_at"))


def with_closing_marker(silver: DataFrame, folder: str) -> DataFrame:
    """The stream together with a second source, ``folder``, into which ``close`` puts a marker.

    A watermark trails the last event, so windows at the end of a stream that stops are
    never closed.  A marker in the far future moves the watermark past all of them.
    """
    spark = silver.sparkSession
    marks = spark.readStream.schema(_MARK).parquet(folder)
    return silver.unionByName(marks, allowMissingColumns=True)


def open_marker_folder(spark: SparkSession, folder: str) -> str:
    """An empty marker folder: a file source needs its path."""
    spark.createDataFrame([], _MARK).write.mode("append").parquet(folder)
    return folder


def close(spark: SparkSession, folder: str, at: str = "9999-01-01 00:00:00") -> None:
    """End the stream: run the query once more on its checkpoint, and all windows are emitted.

    Only for a stream to which nothing is added afterwards: it would all be late.
    """
    # A skip by nobody: it moves the watermark of skips too, and its own window stays open.
    marker = spark.range(1).select(F.lit(at).cast("timestamp").alias("event_ts"), F.lit("skip").alias("event_type"))
    marker.coalesce(1).write.mode("append").parquet(folder)
