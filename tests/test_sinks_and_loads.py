from __future__ import annotations

import json

import pytest
from pyspark.sql.types import DateType, IntegerType, StructType

from listenlake import schemas
from listenlake.operators import quality
from listenlake.operators.silver import silver_events
from listenlake.plans import medallion, rollups
from listenlake.session import work_dir
from listenlake.sinks import landing, tables
from listenlake.sources import catalog
from listenlake.sources.kafka import kafka_options
from listenlake.sources.landing import read_ndjson


def lines(path, *texts):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(texts) + "\n")


def new_schema(spark):
    name = work_dir(spark, "schema").rsplit("/", 1)[1].replace("-", "_")
    tables.ensure_schema(spark, name)
    tables.ensure_schema(spark, name)
    return name


def test_missing_prefix_is_an_empty_relation(spark, tmp_path):
    got = read_ndjson(spark, str(tmp_path / "none"), schemas.EVENT)
    assert got.count() == 0 and got.schema == schemas.EVENT


def test_reader_drops_only_what_is_no_object(spark, tmp_path):
    good = {"event_id": "1", "age": 7}
    lines(
        tmp_path / "zone/a/b/x.json",
        json.dumps(good), "junk", '{"event_id": "2", "age": "zz"}', "", "[1]", '"text"',
        '{"event_id": "3", "extra": 1}',
    )
    lines(tmp_path / "zone/y.json", '{"event_id": "4"}')
    lines(tmp_path / "zone/z.txt", '{"event_id": "5"}')
    got = read_ndjson(spark, str(tmp_path / "zone"), schemas.EVENT)
    assert sorted((r["event_id"], r["age"]) for r in got.collect()) == [
        ("1", 7), ("2", None), ("3", None), ("4", None)
    ]
    assert got.count() == 4


def test_folders_become_typed_columns(spark, tmp_path):
    root = tmp_path / "bronze"
    lines(root / "date=2024-01-05/hour=07/x.json", '{"event_id": "1"}')
    lines(root / "date=2024-01-06/hour=23/x.json", '{"event_id": "2"}')
    folders = StructType().add("date", DateType()).add("hour", IntegerType())
    got = read_ndjson(spark, str(root), schemas.LEGACY_EVENT, folders)
    assert [r["event_id"] for r in got.filter("hour = 23").collect()] == ["2"]
    assert dict(got.dtypes)["date"] == "date" and dict(got.dtypes)["hour"] == "int"


def test_json_writer_leaves_nulls_out(spark, bronze_of, tmp_path):
    landing.write_ndjson(bronze_of({"age": None}), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    assert "age" not in text and "event_id" in text


def test_records_per_file_and_unfinished_file(spark, bronze_of, tmp_path):
    landing.write_by_ingest_hour(
        bronze_of(*[{}] * 25).coalesce(1), str(tmp_path / "out"), records_per_file=10
    )
    files = list((tmp_path / "out").glob("date=*/hour=*/*.json"))
    assert sorted(len(f.read_text().splitlines()) for f in files) == [5, 10, 10]
    assert files[0].parent.name[-2:].isdigit()


def test_bronze_load_is_idempotent(spark, bronze_of):
    table = f"{new_schema(spark)}.events"
    first = bronze_of({"event_id": "a"}, {"event_id": "a"}, {"event_id": "b", "timestamp": "bad"})
    tables.load_bronze(first, table)
    tables.load_bronze(first, table)
    more = bronze_of({"event_id": "b", "timestamp": "bad"}, {"event_id": "c"})
    tables.load_bronze(more, table)
    got = spark.table(table)
    assert sorted(r["event_id"] for r in got.collect()) == ["a", "b", "c"]
    assert got.columns == schemas.EVENT_COLUMNS + ["event_date"]
    assert silver_events(got).count() == 2


def test_plain_append_makes_copies(spark, bronze_of):
    table = f"{new_schema(spark)}.events"
    for _ in range(2):
        tables.load_bronze(bronze_of({"event_id": "a"}), table, once=False)
    assert spark.table(table).count() == 2


def test_quarantine_load_keeps_rows_without_any_key(spark):
    table = f"{new_schema(spark)}.rejects"
    rows = [(None, None, None), (None, "missing_event_id", "2024-01-01 00:00:00"),
            ("e", "missing_song_id", "2024-01-01 00:00:00")]
    landing_rows = spark.createDataFrame(
        rows, "event_id string, _reject_reason string, _rejected_at string"
    )
    tables.load_bronze_quarantine(landing_rows, table)
    tables.load_bronze_quarantine(landing_rows, table)
    got = sorted((str(r["event_id"]), r["_reject_reason"]) for r in spark.table(table).collect())
    assert got == [("None", "missing_event_id"), ("None", "unknown"), ("e", "missing_song_id")]


def test_equal_rejects_are_all_kept_and_loaded_once(spark):
    table = f"{new_schema(spark)}.rejects"
    stamp = "2024-01-01 00:00:00"
    same = spark.range(1000).selectExpr(
        "CAST(NULL AS STRING) AS event_id", "'missing_event_id' AS _reject_reason",
        f"'{stamp}' AS _rejected_at",
    )
    for _ in range(2):
        tables.load_bronze_quarantine(same, table)
    assert spark.table(table).count() == 1000
    later = same.limit(10).selectExpr("event_id", "_reject_reason", "'2024-01-01 01:00:00' AS _rejected_at")
    tables.load_bronze_quarantine(later.unionByName(same.limit(5)), table)
    assert spark.table(table).count() == 1010


def test_load_reads_only_the_touched_days(spark, bronze_of):
    table = f"{new_schema(spark)}.events"
    tables.load_bronze(
        bronze_of(*[{"timestamp": f"2024-01-{d:02d}T00:00:00Z"} for d in range(1, 11)]), table
    )
    incoming = bronze_of({"timestamp": "2024-01-03T00:00:00Z"}).selectExpr(
        "*", "to_date(timestamp) AS event_date"
    )
    held = tables.held_days(spark, f"{table}_rows", "event_date", incoming)
    assert held.count() == 1
    scan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan


def test_landing_zones_to_bronze_twice(spark, tmp_path):
    event = {"event_id": "1", "user_id": "u", "song_id": "s", "timestamp": "2024-01-01T00:00:00Z"}
    lines(tmp_path / "clean/x.json", json.dumps(event))
    schema = new_schema(spark)
    for _ in range(2):
        medallion.load_landing(spark, str(tmp_path / "clean"), str(tmp_path / "none"), schema)
    assert catalog.source(spark, schema, "listening_events").count() == 1
    assert catalog.source(spark, schema, "listening_events_quarantine").count() == 0


def test_catalog_query_lowers_names(spark, silver_of):
    got = catalog.query(spark, "SELECT COUNT(*) AS N, max(age) AS Oldest FROM {s}", s=silver_of({}))
    assert got.columns == ["n", "oldest"]


def test_build_lake_as_views_and_gate(spark, bronze_of):
    views = medallion.build_lake(
        spark, bronze_of({}, {"timestamp": "bad"}), work_dir(spark, "silver"), "v", "2024-01-31"
    )
    assert spark.table("v_top_songs").count() == 1
    assert views["quarantine_events"].count() == 1
    with pytest.raises(quality.QualityError, match=r"unique\(event_id\): 1"):
        medallion.build_lake(
            spark, bronze_of({"event_id": "x"}, {"event_id": "x"}), work_dir(spark, "silver"), "w"
        )
    assert not spark.catalog.tableExists("w_top_songs")


def test_silver_refresh_of_one_day_keeps_the_others(spark, silver_of):
    path = work_dir(spark, "silver")
    days = [{"timestamp": f"2024-01-0{d}T00:00:00Z"} for d in (1, 2, 3)]
    tables.write_silver(silver_of(*days), path)
    again = silver_of({"timestamp": "2024-01-02T00:00:00Z"}, {"timestamp": "2024-01-02T01:00:00Z"})
    stored = tables.write_silver(again, path, only_given_days=True)
    per_day = {str(r["event_date"]): r["count"] for r in stored.groupBy("event_date").count().collect()}
    assert per_day == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1}
    assert tables.write_silver(again, path).count() == 2


def test_day_filter_prunes_silver_folders(spark, silver_of):
    stored = tables.write_silver(silver_of({}), work_dir(spark, "silver"))
    plan = stored.filter("event_date = '2024-01-07'").select("user_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "ReadSchema: struct<user_id:string>" in text


def test_rollup_marts_equal_direct_marts(spark, silver_of):
    kinds = ["play", "skip", "play", "pause", "add_to_playlist"]
    silver = silver_of(*[
        {"user_id": f"u{i % 7}", "song_id": f"s{i % 5}", "artist_name": f"A{i % 3}",
         "device_type": ["web", "mobile"][i % 2], "country": ["VN", "US", "JP"][i % 3],
         "event_type": kinds[i % 5], "timestamp": f"2024-01-{1 + i % 20:02d}T{i % 24:02d}:30:00Z"}
        for i in range(300)
    ]).cache()
    root = work_dir(spark, "rollups")
    rollups.refresh(silver.filter("event_ts < '2024-01-12'"), root)
    rollups.refresh(silver.filter("event_ts >= '2024-01-08'"), root)
    direct = medallion.gold_marts(silver, "2024-01-31")
    from listenlake.operators import gold, trends

    direct["daily_plays"] = gold.daily_plays(silver)
    direct["listening_overview"] = gold.listening_overview(silver)
    direct["user_loyalty_monthly"] = gold.user_loyalty_monthly(silver)
    direct["weekly_top_songs"] = trends.weekly_top_songs(silver)
    for name, mart in rollups.marts(spark, root, "2024-01-31").items():
        assert mart.schema.simpleString() == direct[name].schema.simpleString(), name
        assert mart.exceptAll(direct[name]).count() == 0, name
        assert direct[name].exceptAll(mart).count() == 0, name
    silver.unpersist()


def test_day_by_day_refresh_equals_a_full_build(spark, bronze_of):
    events = [
        {"user_id": f"u{i % 4}", "event_type": ["play", "skip"][i % 2],
         "timestamp": f"2024-01-{1 + i % 6:02d}T{i % 24:02d}:00:00Z"}
        for i in range(60)
    ]
    table = f"{new_schema(spark)}.events"
    tables.load_bronze(bronze_of(*events[:40]), table)
    silver, totals = work_dir(spark, "silver"), work_dir(spark, "totals")
    medallion.refresh_days(spark, spark.table(table), "2024-01-01", "2024-01-06", silver, totals)
    late = [{**e, "event_id": f"late{i}"} for i, e in enumerate(events[40:]) if "-06T" in e["timestamp"]]
    tables.load_bronze(bronze_of(*late), table)
    marts = medallion.refresh_days(
        spark, spark.table(table), "2024-01-06", "2024-01-06", silver, totals, "2024-01-31"
    )
    full = medallion.gold_marts(silver_events(spark.table(table).drop("event_date")), "2024-01-31")
    for name in ("churn_risk", "user_engagement", "top_songs", "country_stats"):
        assert sorted(map(str, marts[name].collect())) == sorted(map(str, full[name].collect())), name
    assert tables.read_silver(spark, silver).count() == 40 + len(late)


def test_kafka_options():
    assert kafka_options("host:1", "topic", max_offsets_per_trigger=1000) == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }
    assert "maxOffsetsPerTrigger" not in kafka_options("host:1", "topic")
