from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listenlake import schemas
from listenlake.operators.parse import parse_messages
from listenlake.sources.files import file_messages
from listenlake.sources.landing import read_ndjson
from listenlake.streaming import ingest, windows


def event(i, **change):
    base = {"event_id": f"e{i}", "user_id": "u", "song_id": "s", "country": "VN",
            "timestamp": "2024-01-01T00:00:00Z"}
    return json.dumps({k: v for k, v in {**base, **change}.items() if v is not None})


def put(path, name, *texts):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(texts) + "\n")


def test_two_queries_route_everything_once(spark, tmp_path):
    put(tmp_path / "in", "1.txt", event(1), event(2, user_id=None), "junk")

    def run():
        parsed = parse_messages(file_messages(spark, str(tmp_path / "in"), 1))
        for query in ingest.start_zone_queries(
            parsed, str(tmp_path / "clean"), str(tmp_path / "bad"),
            str(tmp_path / "ck1"), str(tmp_path / "ck2"), None, None,
        ):
            query.awaitTermination()
        clean = read_ndjson(spark, str(tmp_path / "clean"), schemas.CLEAN_LANDING)
        bad = read_ndjson(spark, str(tmp_path / "bad"), schemas.QUARANTINE_LANDING)
        return clean.count(), sorted(r["_reject_reason"] for r in bad.collect())

    assert run() == (1, ["missing_event_id", "missing_user_id"])
    assert run() == (1, ["missing_event_id", "missing_user_id"])
    put(tmp_path / "in", "2.txt", event(3), event(4, song_id=None))
    assert run() == (2, ["missing_event_id", "missing_song_id", "missing_user_id"])


def test_single_scan_with_country_folders(spark, tmp_path):
    put(tmp_path / "in", "1.txt", event(1), event(2, country="US"), event(3, song_id=None), "x")
    parsed = parse_messages(file_messages(spark, str(tmp_path / "in")))
    ingest.start_zones_single_scan(
        parsed, str(tmp_path / "out"), str(tmp_path / "ck"), None, by_country=True
    ).awaitTermination()
    assert (tmp_path / "out/zone=clean/country=US").is_dir()
    without = StructType([f for f in schemas.QUARANTINE_LANDING.fields if f.name != "country"])
    folders = StructType().add("zone", "string").add("country", "string")
    got = read_ndjson(spark, str(tmp_path / "out"), without, folders)
    counted = {(r["zone"], r["country"]): r["count"] for r in got.groupBy("zone", "country").count().collect()}
    assert counted == {
        ("clean", "VN"): 1, ("clean", "US"): 1, ("quarantine", "VN"): 1, ("quarantine", None): 1
    }


def test_hourly_archive_keeps_every_line(spark, tmp_path):
    put(tmp_path / "in", "1.txt", event(1), "junk", event(2))
    ingest.start_hourly_archive(
        file_messages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"), None,
        records_per_file=2,
    ).awaitTermination()
    stored = spark.read.text(str(tmp_path / "out"))
    assert sorted(r["value"] for r in stored.collect()) == sorted([event(1), "junk", event(2)])
    assert {"date", "hour"} < set(stored.columns)


def test_dead_letters_keep_the_raw_text(spark, tmp_path):
    bad = [event(2, age="old"), "junk", event(3, song_id=None)]
    put(tmp_path / "in", "1.txt", event(1), *bad)
    ingest.start_dead_letters(
        file_messages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"), None
    ).awaitTermination()
    got = {r["raw"]: r["violation"] for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert got == dict(zip(bad, ["wrong_type", "malformed_json", "missing_song_id"]))


def test_table_load_takes_each_file_once(spark, tmp_path):
    def run(checkpoint="ck", landing="in"):
        ingest.start_table_load(
            spark, str(tmp_path / landing), schemas.EVENT, str(tmp_path / "table"), str(tmp_path / checkpoint)
        ).awaitTermination()
        return sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "table")).collect())

    put(tmp_path / "in", "1.json", event(1), "junk")
    assert run() == ["e1"]
    assert run() == ["e1"]
    put(tmp_path / "in", "2.json", event(2))
    assert run() == ["e1", "e2"]
    # A new checkpoint counts its batches from 0 again and replaces none of the old ones.
    put(tmp_path / "more", "3.json", event(3))
    assert run("fresh", "more") == ["e1", "e2", "e3"]


def typed_stream(spark, path):
    return spark.readStream.schema(
        "event_id string, user_id string, event_type string, event_ts timestamp"
    ).option("maxFilesPerTrigger", 1).json(str(path))


def drain(spark, df, tmp_path):
    df.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "ck")
    ).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / "out"))


def silver_line(i, ts, kind="play", user="u"):
    return json.dumps({"event_id": f"e{i}", "user_id": user, "event_type": kind, "event_ts": ts})


def test_minute_windows_close_behind_the_watermark(spark, tmp_path):
    put(tmp_path / "in", "1.json", silver_line(1, "2024-01-01T00:00:10Z"),
        silver_line(2, "2024-01-01T00:00:50Z"), silver_line(3, "2024-01-01T00:00:55Z", "skip"),
        silver_line(4, "2024-01-01T00:01:05Z"), silver_line(5, "2024-01-01T00:12:00Z"))
    got = drain(spark, windows.plays_per_minute(typed_stream(spark, tmp_path / "in")), tmp_path)
    assert [(str(r["window_start"])[11:16], r["plays"]) for r in got.orderBy("window_start").collect()] == [
        ("00:00", 2), ("00:01", 1)
    ]


def test_skip_windows_flag_fast_skippers(spark, tmp_path):
    burst = [silver_line(i, f"2024-01-01T00:00:{i:02d}Z", "skip", "bot") for i in range(20)]
    slow = [silver_line(90, "2024-01-01T00:00:05Z", "skip", "person")]
    later = [silver_line(91, "2024-01-01T01:00:00Z", "skip", "person")]
    put(tmp_path / "in", "1.json", *burst, *slow, *later)
    got = drain(spark, windows.skip_windows(typed_stream(spark, tmp_path / "in")), tmp_path)
    flagged = {(r["user_id"], r["is_bot"]) for r in got.collect()}
    assert flagged == {("bot", True), ("person", False)}


def test_unique_events_across_batches(spark, tmp_path):
    line = silver_line(1, "2024-01-01T00:00:10Z")
    put(tmp_path / "in", "1.json", line, line, silver_line(2, "2024-01-01T00:00:11Z"))
    put(tmp_path / "in", "2.json", line, silver_line(3, "2024-01-01T00:00:12Z"))
    spread = F.pmod(F.hash("user_id"), F.lit(4))
    unique = windows.unique_events(typed_stream(spark, tmp_path / "in"), spread=spread)
    got = drain(spark, unique, tmp_path)
    assert sorted(r["event_id"] for r in got.collect()) == ["e1", "e2", "e3"]


def test_ending_of_one_query_stops_the_others(spark, tmp_path):
    put(tmp_path / "in", "1.txt", event(1))
    parsed = parse_messages(file_messages(spark, str(tmp_path / "in")))
    spark.streams.resetTerminated()
    queries = ingest.start_zone_queries(
        parsed, str(tmp_path / "c"), str(tmp_path / "q"), str(tmp_path / "k1"), str(tmp_path / "k2"),
        None, "1 hour",
    )
    ingest.await_any(spark, list(queries))
    assert not any(q.isActive for q in queries)


def at(second, micros=0):
    return f"2024-01-01T{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}.{micros:06d}Z"


def test_bots_are_flagged_at_every_window_position(spark, tmp_path):
    """Bursts across micro-batches, across two slides, out of order; 19 skips or 60 seconds are none."""
    n = iter(range(10_000))

    def skips(user, times):
        return [silver_line(next(n), at(*(t if isinstance(t, tuple) else (t,))), "skip", user) for t in times]

    across = [15 + 3 * i for i in range(20)]  # 57 seconds, in no window that starts at a half minute
    edge = [(100, 0), *[(130, i) for i in range(18)], (160, 0)]  # the first and last are 60 seconds apart
    inside = [(100, 0), *[(130, i) for i in range(18)], (159, 999_999)]
    put(tmp_path / "in", "1.json", *skips("across", across[:7]), *skips("late", range(200, 210)), *skips("person", range(19)),
        *skips("edge", edge), *skips("inside", inside[:4]), *skips("hot", [50] * 3000), *skips("apart", range(0, 10)))
    put(tmp_path / "in", "2.json", *skips("across", across[7:]), *skips("inside", inside[4:]), *skips("late", range(260, 262)), *skips("apart", range(600, 619)))
    put(tmp_path / "in", "3.json", *skips("late", range(210, 221)), *skips("hot", [51] * 50), silver_line(next(n), at(999), "play", "person"))
    got = drain(spark, windows.skip_bots(typed_stream(spark, tmp_path / "in")), tmp_path).collect()
    assert sorted(r["user_id"] for r in got) == ["across", "hot", "inside", "late"]


def test_closing_marker_emits_the_last_windows(spark, tmp_path):
    put(tmp_path / "in", "1.json", silver_line(1, at(10)), silver_line(2, at(70), "skip"), silver_line(3, at(130)))
    marks = windows.open_marker_folder(spark, str(tmp_path / "marks"))
    for operator, name in ((windows.plays_per_minute, "a"), (windows.skip_windows, "b")):
        df = operator(windows.with_closing_marker(typed_stream(spark, tmp_path / "in"), marks))
        open_ = drain(spark, df, tmp_path / name).count()
        windows.close(spark, marks)
        closed = drain(spark, df, tmp_path / name)
        assert (open_, closed.count()) == {"a": (0, 3), "b": (0, 2)}[name]
        assert closed.where("window_start > '2025-01-01'").count() == 0
        marks = windows.open_marker_folder(spark, str(tmp_path / "marks2"))
