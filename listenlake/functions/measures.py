"""Aggregate expressions over listening events, or over totals of events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def events_of(kind: str) -> Column:
    """Number of events of one type; 0, not NULL, when there are none."""
    return F.count_if(F.col("event_type") == kind)


def plays() -> Column:
    return events_of("play")


def skips() -> Column:
    return events_of("skip")


def playlist_adds() -> Column:
    return events_of("add_to_playlist")


def all_events() -> Column:
    return F.count(F.lit(1))


@dataclass(frozen=True)
class Measures:
    """How to count plays, skips, playlist adds and events in a relation."""

    plays: Callable[[], Column]
    skips: Callable[[], Column]
    playlist_adds: Callable[[], Column]
    events: Callable[[], Column]
    has_plays: Callable[[], Column]


# One row per event.
EVENTS = Measures(
    plays, skips, playlist_adds, all_events, lambda: F.col("event_type") == "play"
)

# Rows that carry totals already, see plans.rollups.
TOTALS = Measures(
    lambda: F.sum("plays"),
    lambda: F.sum("skips"),
    lambda: F.sum("playlist_adds"),
    lambda: F.sum("events"),
    lambda: F.col("plays") > 0,
)


def ratio2(part: Column, whole: Column) -> Column:
    """``part / whole`` to two decimals, NULL when ``whole`` is 0."""
    return F.round(part / F.nullif(whole, F.lit(0)), 2)
