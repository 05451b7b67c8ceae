from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from listenlake import schemas
from listenlake.functions.keys import song_key
from listenlake.operators import conform, parse, validate

GOOD = {
    "event_id": "e", "user_id": "u", "song_id": "s", "artist_name": "a", "song_name": "n",
    "event_type": "play", "device_type": "web", "country": "US",
    "timestamp": "2024-01-01T00:00:00.000001Z", "username": "x", "age": 20,
    "subscription_type": "free", "registration_date": "2020-01-01", "genre": "g",
    "duration_seconds": 1, "release_year": 2000, "album_name": "al",
}
WHEN = dt.datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture(scope="module")
def messages(spark):
    def make(*texts):
        rows = [(None if t is None else bytearray(t.encode()), WHEN) for t in texts]
        return spark.createDataFrame(rows, "value binary, timestamp timestamp")

    return make


def changed(**change):
    return json.dumps({**GOOD, **change})


def test_good_message_gives_all_fields(messages):
    row = parse.parse_messages(messages(json.dumps(GOOD))).first().asDict()
    assert {k: row[k] for k in GOOD} == GOOD
    assert row["kafka_ingest_time"] == WHEN
    assert row["processed_at"] is not None


@pytest.mark.parametrize("text", ["junk", '{"event_id":"e","user', "[1]", "null", "", None])
def test_unreadable_message_is_kept_as_nulls(messages, text):
    parsed = parse.parse_messages(messages(text))
    row = parsed.select(*schemas.EVENT_COLUMNS).first()
    assert all(v is None for v in row)
    assert validate.quarantine(parsed).first()["_reject_reason"] == "missing_event_id"


@pytest.mark.parametrize("age", ["zz", "7", 3.5])
def test_wrong_type_costs_only_that_field(messages, age):
    parsed = parse.parse_messages(messages(changed(age=age)))
    row = validate.clean(parsed).first()
    assert row["age"] is None and row["event_id"] == "e" and row["album_name"] == "al"


def test_number_for_text_is_kept(messages):
    assert parse.parse_messages(messages(changed(event_id=5))).first()["event_id"] == "5"


@pytest.mark.parametrize(
    "absent, reason",
    [
        (["event_id", "user_id"], "missing_event_id"),
        (["user_id", "song_id"], "missing_user_id"),
        (["song_id"], "missing_song_id"),
        (["timestamp"], "missing_timestamp"),
    ],
)
def test_first_missing_field_names_the_reason(messages, absent, reason):
    text = json.dumps({k: v for k, v in GOOD.items() if k not in absent})
    rejected = validate.quarantine(parse.parse_messages(messages(text)))
    assert [r["_reject_reason"] for r in rejected.collect()] == [reason]
    assert isinstance(rejected.first()["_rejected_at"], str)


def test_split_is_disjoint_and_complete(messages):
    texts = [json.dumps(GOOD), "junk", changed(song_id=None), changed(user_id="")]
    parsed = parse.parse_messages(messages(*texts))
    good, bad = validate.split(parsed)
    assert (good.count(), bad.count()) == (2, 2)
    strict_good, strict_bad = validate.split(parsed, strict=True)
    assert (strict_good.count(), strict_bad.count()) == (1, 3)
    zones = validate.with_zone(parsed).groupBy("zone").count().collect()
    assert {r["zone"]: r["count"] for r in zones} == {"clean": 2, "quarantine": 2}


def test_contract_keeps_the_raw_text(messages):
    texts = [json.dumps(GOOD), "junk", changed(age="zz"), changed(song_id=None), "", "[1]"]
    rows = parse.parse_with_contract(messages(*texts)).collect()
    assert [r["violation"] for r in rows] == [
        None, "malformed_json", "wrong_type", "missing_song_id", "malformed_json",
        "malformed_json",
    ]
    assert [r["raw"] for r in rows] == texts


def test_message_text_is_parsed_once(messages):
    plan = validate.clean(parse.parse_messages(messages("{}")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1


def test_conform_fills_and_drops(spark):
    landing = spark.createDataFrame([("e", 1)], "event_id string, other int")
    bronze = conform.to_bronze(landing)
    assert bronze.columns == schemas.EVENT_COLUMNS
    assert bronze.first()["age"] is None
    assert conform.to_legacy_bronze(landing).columns == schemas.LEGACY_COLUMNS
    rejected = conform.to_bronze_quarantine(landing)
    assert rejected.columns == schemas.QUARANTINE_COLUMNS
    assert rejected.first()["_reject_reason"] == "unknown"


def test_song_key_is_a_version_5_uuid(spark):
    import uuid

    pairs = [("BTS", "Dynamite"), ("Beyoncé", "Déjà Vu"), ("Sơn Tùng", "Chạy Ngay Đi"), ("", "")]
    df = spark.createDataFrame(pairs, "artist string, song string")
    got = [r[0] for r in df.select(song_key(F.col("artist"), F.col("song"))).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{a}::{s}")) for a, s in pairs]
    assert got[0] == "d9070fa6-b525-5c7c-8d73-752cfedf184c"


def test_contract_drift_names_every_key(spark):
    from listenlake.operators.parse import contract_drift

    texts = [
        '{"event_id":"1","age":7,"mood":"x"}', '{"event_id":2,"age":null,"device":{"a":{"b":1}}}', '{"age":7.5,"tags":[]}',
        '{"age":true,"mood":"y"}', '{"age":"7"}', "junk", "", None, "[1]", "null", '"text"', "{}",
    ]
    rows = spark.createDataFrame([(t.encode() if t is not None else None,) for t in texts], "value binary")
    got = {(r["key"], r["seen_type"], r["expected_type"]): r["rows"] for r in contract_drift(rows).collect()}
    assert got == {
        ("mood", "text", None): 2, ("event_id", "integer", "text"): 1, ("device", "object", None): 1, ("age", "number", "integer"): 1,
        ("tags", "array", None): 1, ("age", "boolean", "integer"): 1, ("age", "text", "integer"): 1, (None, "malformed", None): 3,
        (None, "array", None): 1, (None, "null", None): 1, (None, "text", None): 1,
    }
    assert contract_drift(rows.limit(0)).count() == 0


def test_only_whole_iso_texts_are_timestamps(spark):
    from listenlake.functions.times import parse_event_ts

    good = {"2024-01-05": "2024-01-05 00:00:00", "2024-01-05T10:00:00Z": "2024-01-05 10:00:00", "2024-01-05 10:00": "2024-01-05 10:00:00",
            "2024-01-05T10:00:00.123456+07:00": "2024-01-05 03:00:00.123456"}
    bad = ["10:00", "2024", "2024-01", "T10:00", "", " 2024-01-05", "2024-13-01", "2024-01-05T25:00:00Z", "12", "now", "epoch", None]
    rows = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    got = {r["t"]: r["ts"] for r in rows.select("t", parse_event_ts(rows.t).cast("string").alias("ts")).collect()}
    assert got == {**good, **dict.fromkeys(bad)}
