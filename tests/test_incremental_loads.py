"""Loads and releases that become visible as a whole, mostly through the command line."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from listenlake import jobs, schemas
from listenlake.operators.quality import QualityError
from listenlake.plans import medallion
from listenlake.session import work_dir
from listenlake.sinks import loads, releases, tables
from listenlake.streaming import ingest


def event(i, day=1, **change):
    base = {
        "event_id": f"e{i}", "user_id": f"u{i % 3}", "song_id": "s", "artist_name": "A", "song_name": "S",
        "event_type": "play", "device_type": "web", "country": "VN",
        "timestamp": f"2024-01-{day:02d}T10:00:00.000000Z", "subscription_type": "free",
    }
    return json.dumps({**base, **change})


def put(path, *texts):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(texts) + "\n")


@pytest.fixture
def schema(spark):
    name = work_dir(spark, "inc").rsplit("/", 1)[1].replace("-", "_")
    tables.ensure_schema(spark, name)
    return name


def load(spark, folder, schema, *more):
    jobs.run(spark, ["load", "--clean", f"{folder}/clean", "--quarantine", f"{folder}/bad", "--schema", schema, *more])


def ids(spark, schema):
    return sorted(r["event_id"] for r in spark.table(f"{schema}.listening_events").collect())


def test_load_reads_new_files_only_and_an_id_once_whatever_its_day(spark, schema, tmp_path):
    put(tmp_path / "clean/1.json", event(1), event(2), event(2, 5), "junk")
    put(tmp_path / "bad/1.json", '{"_reject_reason": "missing_event_id"}', '{"_reject_reason": "missing_event_id"}')
    load(spark, tmp_path, schema)
    first = {r["event_id"]: r["event_date"] for r in spark.table(f"{schema}.listening_events").collect()}
    put(tmp_path / "clean/2.json", event(1, 9), event(3, 9), event(3, 8), event(4))
    for _ in range(2):
        load(spark, tmp_path, schema)
    assert ids(spark, schema) == ["e1", "e2", "e3", "e4"]
    assert spark.table(f"{schema}.listening_events_quarantine").count() == 2
    days = {r["event_id"]: r["event_date"] for r in spark.table(f"{schema}.listening_events").collect()}
    assert {k: days[k] for k in first} == first
    assert spark.table(f"{schema}.loads").count() == 2
    files = spark.table(f"{schema}.loaded_files")
    assert files.count() == files.select("path").distinct().count() == 3
    # A file that is written anew is a new file.
    put(tmp_path / "clean/2.json", event(5), event(3, 9))
    load(spark, tmp_path, schema)
    assert ids(spark, schema) == ["e1", "e2", "e3", "e4", "e5"]


def test_a_failed_check_leaves_bronze_and_ledger_as_they_were(spark, schema, tmp_path):
    put(tmp_path / "clean/1.json", event(1))
    load(spark, tmp_path, schema)
    put(tmp_path / "clean/2.json", event(2), event(3, event_type="like"))
    put(tmp_path / "bad/2.json", '{"event_id": "x"}')
    for _ in range(2):
        with pytest.raises(QualityError, match="accepted_values"):
            load(spark, tmp_path, schema)
        assert ids(spark, schema) == ["e1"]
        assert spark.table(f"{schema}.listening_events_quarantine").count() == 0
    load(spark, tmp_path, schema, "--no-gate")
    load(spark, tmp_path, schema)
    assert ids(spark, schema) == ["e1", "e2", "e3"]
    assert spark.table(f"{schema}.listening_events_quarantine").count() == 1


def test_a_load_that_dies_before_its_commit_is_repeated_whole(spark, schema, tmp_path, monkeypatch):
    put(tmp_path / "clean/1.json", event(1), event(2))

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(loads, "commit", die)
        with pytest.raises(RuntimeError, match="driver lost"):
            load(spark, tmp_path, schema)
    assert ids(spark, schema) == []
    load(spark, tmp_path, schema)
    assert ids(spark, schema) == ["e1", "e2"]


def test_ids_are_looked_up_without_a_shuffle_of_the_stored_ones(spark, schema, bronze_of):
    table = f"{schema}.events"
    tables.load_bronze(bronze_of({}, {}), table)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = bronze_of({"event_id": "n"}).withColumn("_hash", F.lit(1).cast("long"))
        held = spark.table(f"{table}_ids").select("event_id")
        narrow = rows.groupBy("event_id").agg(F.min("_hash"))
        plan = narrow.join(held, "event_id", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert "SelectedBucketsCount: 64 out of 64" in plan
    assert plan.count("Exchange hashpartitioning(event_id") == 1 and "SortMergeJoin" in plan
    assert loads.unseen(bronze_of({"event_id": "e0"}, {"event_id": "n"}).withColumn("_hash", F.lit(1).cast("long")), table, "event_id").count() == 1


def test_zone_by_country_keeps_the_country_and_uncommitted_files_stay_out(spark, schema, tmp_path):
    put(tmp_path / "in/1.txt", event(1), event(2, country="US"), event(3, country=None), event(4, country="Côte d'X/Y+1"), event(5, song_id=None))
    zones = tmp_path / "zones"
    jobs.run(spark, ["ingest", "--files", str(tmp_path / "in"), "--out", str(zones), "--checkpoint", str(tmp_path / "ck"), "--once", "--by-country"])
    put(zones / "zone=clean/country=US/part-left-by-a-dead-batch.json", event(99))
    for _ in range(2):
        jobs.run(spark, ["load", "--clean", str(zones / "zone=clean"), "--quarantine", str(zones / "zone=quarantine"), "--schema", schema, "--no-gate"])
    got = {r["event_id"]: r["country"] for r in spark.table(f"{schema}.listening_events").collect()}
    assert got == {"e1": "VN", "e2": "US", "e3": None, "e4": "Côte d'X/Y+1"}
    assert spark.table(f"{schema}.listening_events_quarantine").count() == 1


def test_a_new_checkpoint_brings_no_copies(spark, tmp_path):
    def run(checkpoint):
        ingest.start_table_load(
            spark, str(tmp_path / "in"), schemas.EVENT, str(tmp_path / "table"), str(tmp_path / checkpoint)
        ).awaitTermination()
        return sorted(str(r["event_id"]) for r in spark.read.parquet(str(tmp_path / "table")).collect())

    put(tmp_path / "in/1.json", event(1), event(1, 3), event(2))
    assert run("a") == ["e1", "e2"]
    put(tmp_path / "in/2.json", event(2, 7), event(3))
    assert run("b") == ["e1", "e2", "e3"]
    assert run("a") == ["e1", "e2", "e3"]


# Releases


def test_a_release_is_read_whole_and_only_one_job_publishes_it(spark, tmp_path):
    root = str(tmp_path / "lake")
    day = lambda d, n: spark.range(n).select(F.lit(d).cast("date").alias("event_date"), "id")
    base = releases.current(spark, root)
    assert base.number == 0
    folders = releases.stage(day("2024-01-01", 2).unionByName(day("2024-01-02", 3)), root, "x", "event_date")
    one = releases.publish(spark, base, {"x": folders, "y": releases.stage(spark.range(5), root, "y")})
    with pytest.raises(releases.ReleaseConflict):
        releases.publish(spark, base, {"x": []})
    assert releases.current(spark, root) == one
    # The second day loses its rows, the third is new.
    fresh = releases.stage(day("2024-01-03", 4), root, "x", "event_date")
    two = releases.publish(spark, one, {"x": releases.replaced(folders, fresh, "event_date", "2024-01-02", "2024-01-03")})
    schema = day("2024-01-01", 1).schema
    count = lambda r: {str(k["event_date"]): k["count"] for k in releases.read(spark, r, "x", schema).groupBy("event_date").count().collect()}
    assert count(one) == {"2024-01-01": 2, "2024-01-02": 3} and count(two) == {"2024-01-01": 2, "2024-01-03": 4}
    assert releases.read(spark, two, "none", schema).count() == 0
    assert two.folders["y"] == one.folders["y"]
    unpublished = releases.stage(spark.range(1), root, "y")
    gone = releases.expire(spark, root, keep=1)
    assert [releases.part(f, "event_date") for f in gone] == ["2024-01-02"]
    assert releases.current(spark, root) == two and count(two) == {"2024-01-01": 2, "2024-01-03": 4}
    assert spark.read.parquet(*unpublished).count() == 1


def shown(spark, lake, gold):
    names = ["top_songs", "daily_plays", "fact_play_events", "quarantine_events", "dim_date"]
    return (releases.current(spark, lake).number, tables.read_silver(spark, lake).count(),
            {n: sorted(map(str, spark.table(f"{gold}.{n}").collect())) for n in names})


def test_failed_build_and_refresh_change_nothing(spark, schema, bronze_of, tmp_path):
    lake, gold = str(tmp_path / "lake"), f"{schema}_gold"
    events = [{"timestamp": f"2024-01-0{d}T00:00:00Z", "user_id": f"u{d % 2}"} for d in range(1, 6)] + [{"timestamp": "bad"}]
    tables.load_bronze(bronze_of(*events), f"{schema}.listening_events")
    common = ["--bronze", schema, "--as-of", "2024-01-31", "--silver", lake, "--gold", gold]
    jobs.run(spark, ["build", *common])
    before = shown(spark, lake, gold)
    assert before[:2] == (1, 5) and len(before[2]["fact_play_events"]) == 5 and len(before[2]["quarantine_events"]) == 1
    assert "date_key" in spark.table(f"{gold}.dim_date").columns
    more = bronze_of({"event_id": "late", "timestamp": "2024-01-05T01:00:00Z", "country": "XX"}, {"event_id": "odd", "timestamp": "worse"})
    tables.load_bronze(more, f"{schema}.listening_events")
    refresh = ["refresh", *common, "--rollups", str(tmp_path / "rollups"), "--first", "2024-01-05", "--last", "2024-01-05"]
    for job in (["build", *common], refresh):
        with pytest.raises(QualityError, match=r"accepted_values\(country\)"):
            jobs.run(spark, job)
        assert shown(spark, lake, gold) == before
    jobs.run(spark, [*refresh, "--no-gate"])
    after = shown(spark, lake, gold)
    assert after[:2] == (2, 6) and len(after[2]["fact_play_events"]) == 6 and len(after[2]["quarantine_events"]) == 2
    jobs.run(spark, ["build", *common, "--no-gate"])
    again = shown(spark, lake, gold)
    drop_stamp = lambda rows: sorted(r.split("rejected_at")[0] for r in rows)
    assert again[:2] == (3, 6) and again[2]["top_songs"] == after[2]["top_songs"] and again[2]["dim_date"] == after[2]["dim_date"]
    assert drop_stamp(again[2]["quarantine_events"]) == drop_stamp(after[2]["quarantine_events"])


def test_a_refreshed_day_without_events_goes(spark, bronze_of):
    lake = work_dir(spark, "lake")
    dated = bronze_of(*[{"timestamp": f"2024-01-0{d}T00:00:00Z"} for d in (1, 2, 3)]).withColumn("event_date", tables.day_of(F.col("timestamp")))
    medallion.refresh_days(spark, dated, "2024-01-01", "2024-01-03", lake, f"{lake}/r")
    marts = medallion.refresh_days(spark, dated.where("event_date <> '2024-01-02'"), "2024-01-02", "2024-01-02", lake, f"{lake}/r")
    assert [str(r["ds"]) for r in marts["daily_plays"].collect()] == ["2024-01-01", "2024-01-03"]
    assert tables.read_silver(spark, lake).count() == 2


def test_a_build_reads_silver_a_few_times_only(spark, bronze_of, monkeypatch):
    reads = []
    read = releases.read
    monkeypatch.setattr(releases, "read", lambda s, r, name, schema: (reads.append(name), read(s, r, name, schema))[1])
    written = []
    stage = releases.stage
    monkeypatch.setattr(releases, "stage", lambda df, root, name, by=None: (
        written.append((name, "silver/" in df._jdf.queryExecution().optimizedPlan().toString() or "silver" in "".join(df.inputFiles()))), stage(df, root, name, by))[1])
    medallion.build_lake(spark, bronze_of({}), work_dir(spark, "lake"), work_dir(spark, "g").rsplit("/", 1)[1].replace("-", "_"), "2024-01-31", as_tables=True)
    assert sum(over for _, over in written) <= 6 and len(written) >= 20
