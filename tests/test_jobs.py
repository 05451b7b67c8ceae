"""The command line, from message files to the forecast."""

from __future__ import annotations

import json

import pytest

from listenlake import jobs


def message(i, day, kind="play", **change):
    base = {
        "event_id": f"e{i}", "user_id": f"u{i % 3}", "song_id": "s", "artist_name": "A",
        "song_name": "S", "event_type": kind, "device_type": "web", "country": "VN",
        "timestamp": f"2024-01-{day:02d}T10:00:00.000000Z", "subscription_type": "free",
    }
    return json.dumps({**base, **change})


def test_all_jobs_in_order_and_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [message(i, 1 + i % 5, ["play", "skip"][i % 2]) for i in range(40)]
    (tmp_path / "in/1.txt").write_text("\n".join([*lines, "junk", message(99, 1, user_id=None)]))
    bronze, gold = "jobs_bronze", "jobs_gold"
    silver = str(tmp_path / "silver")

    def everything():
        jobs.run(spark, ["ingest", "--files", str(tmp_path / "in"), "--out", str(tmp_path / "zones"),
                         "--checkpoint", str(tmp_path / "ck"), "--once"])
        jobs.run(spark, ["load", "--clean", str(tmp_path / "zones/zone=clean"), "--quarantine",
                         str(tmp_path / "zones/zone=quarantine"), "--schema", bronze])
        jobs.run(spark, ["build", "--bronze", bronze, "--silver", silver, "--gold", gold,
                         "--as-of", "2024-01-31"])
        jobs.run(spark, ["forecast", "--silver", silver, "--schema", gold, "--run-id", "r"])

    for done in (1, 2):
        everything()
        assert spark.table(f"{bronze}.listening_events").count() == 40
        assert spark.table(f"{bronze}.listening_events_quarantine").count() == 2
        assert spark.table(f"{gold}.top_songs").collect()[0]["total_plays"] == 20
        assert spark.table(f"{gold}.daily_play_forecast").count() == 5 + 7
        assert spark.table(f"{gold}.forecast_runs").count() == 9 * done


def test_refresh_stores_the_same_marts_as_build(spark, bronze_of, tmp_path):
    from listenlake.sinks import tables

    tables.ensure_schema(spark, "refresh_bronze")
    events = [{"timestamp": f"2024-01-0{d}T00:00:00Z", "user_id": f"u{d % 2}"} for d in range(1, 8)]
    tables.load_bronze(bronze_of(*events), "refresh_bronze.listening_events")
    common = ["--bronze", "refresh_bronze", "--as-of", "2024-01-31"]
    jobs.run(spark, ["build", *common, "--silver", str(tmp_path / "a"), "--gold", "built"])
    for first, last in (("2024-01-01", "2024-01-04"), ("2024-01-04", "2024-01-07")):
        jobs.run(spark, ["refresh", *common, "--silver", str(tmp_path / "b"), "--gold", "refreshed",
                         "--rollups", str(tmp_path / "r"), "--first", first, "--last", last])
    for name in ("top_songs", "user_loyalty", "churn_risk", "peak_hours", "dim_date"):
        built, refreshed = spark.table(f"built.{name}"), spark.table(f"refreshed.{name}")
        assert sorted(map(str, built.collect())) == sorted(map(str, refreshed.collect())), name


def test_one_day_gives_no_forecast(spark, silver_of, capsys, tmp_path):
    from listenlake.sinks.tables import write_silver

    write_silver(silver_of({}), str(tmp_path / "silver"))
    jobs.run(spark, ["forecast", "--silver", str(tmp_path / "silver"), "--schema", "one_day"])
    assert "no forecast" in capsys.readouterr().out
    assert not spark.catalog.tableExists("one_day.daily_play_forecast")


def test_source_must_be_named(spark):
    with pytest.raises(SystemExit):
        jobs.run(spark, ["ingest", "--out", "o", "--checkpoint", "c"])


def test_two_paces_and_dead_letters(spark, tmp_path):
    (tmp_path / "in").mkdir()
    texts = [message(1, 1), message(2, 1, user_id=None), "junk", message(3, 1, age="old")]
    (tmp_path / "in/1.txt").write_text("\n".join(texts))
    for extra in ([], ["--two-queries"]):
        out = tmp_path / f"out{len(extra)}"
        jobs.run(spark, ["ingest", "--files", str(tmp_path / "in"), "--out", str(out), "--checkpoint", str(tmp_path / f"ck{len(extra)}"),
                         "--once", "--dead-letters", str(tmp_path / f"dead{len(extra)}"), *extra])
        assert spark.read.json(str(out / "zone=clean")).count() == 2
        assert spark.read.json(str(out / "zone=quarantine")).count() == 2
        letters = {r["raw"]: r["violation"] for r in spark.read.json(str(tmp_path / f"dead{len(extra)}")).collect()}
        assert letters == {texts[1]: "missing_user_id", "junk": "malformed_json", texts[3]: "wrong_type"}
