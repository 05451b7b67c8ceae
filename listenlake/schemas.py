"""Fixed schemas of the event at every stage of the lake."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(names: list[str], types: dict[str, DataType]) -> StructType:
    return StructType([StructField(n, types.get(n, StringType()), True) for n in names])


_TYPES: dict[str, DataType] = {
    "age": IntegerType(),
    "duration_seconds": IntegerType(),
    "release_year": IntegerType(),
    "kafka_ingest_time": TimestampType(),
    "processed_at": TimestampType(),
    "event_ts": TimestampType(),
}

# Field names and order of the event record.
LEGACY_COLUMNS = [
    "event_id", "user_id", "song_id", "artist_name", "song_name",
    "event_type", "device_type", "country", "timestamp",
]
PROFILE_COLUMNS = [
    "username", "age", "subscription_type", "registration_date",
    "genre", "duration_seconds", "release_year", "album_name",
]
REJECT_COLUMNS = ["_reject_reason", "_rejected_at"]
STAMP_COLUMNS = ["kafka_ingest_time", "processed_at"]

# Accepted domains.
EVENT_TYPES = ["play", "pause", "skip", "add_to_playlist"]
SUBSCRIPTION_TYPES = ["free", "premium"]
COUNTRIES = ["US", "UK", "CA", "AU", "IN", "DE", "VN", "JP"]

EVENT_COLUMNS = LEGACY_COLUMNS + PROFILE_COLUMNS
QUARANTINE_COLUMNS = LEGACY_COLUMNS + REJECT_COLUMNS
SILVER_COLUMNS = [("event_ts" if c == "timestamp" else c) for c in EVENT_COLUMNS]

EVENT = _struct(EVENT_COLUMNS, _TYPES)
LEGACY_EVENT = _struct(LEGACY_COLUMNS, _TYPES)
CLEAN_LANDING = _struct(EVENT_COLUMNS + STAMP_COLUMNS, _TYPES)
QUARANTINE_LANDING = _struct(EVENT_COLUMNS + STAMP_COLUMNS + REJECT_COLUMNS, _TYPES)
QUARANTINE = _struct(QUARANTINE_COLUMNS, _TYPES)
SILVER = _struct(SILVER_COLUMNS, _TYPES)


def ddl(schema: StructType) -> str:
    """Column list for CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
