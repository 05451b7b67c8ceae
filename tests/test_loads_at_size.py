"""Loads, builds and streams whose cost must not sit in one task, one key or a second evaluation."""

from __future__ import annotations

import pytest

from listenlake.plans import medallion, registry
from listenlake.session import work_dir
from listenlake.sinks import landing, loads, tables
from listenlake.streaming import windows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_hours_file_is_written_from_finished_rows(spark, sf_dir, monkeypatch):
    plans = []
    write = landing.write_ndjson
    monkeypatch.setattr(landing, "write_ndjson", lambda df, *a, **k: (plans.append(plan_of(df)), write(df, *a, **k))[1])
    rows = registry.queries()["bronze_load_incremental"](spark, sf_dir).collect()
    assert sorted(r["files"] for r in rows) == [1, 1, 1]
    assert len(plans) == 3
    for plan in plans:
        # One task does no join, sort or parse: it is handed rows by a shuffle.
        assert "Coalesce" not in plan and "Exchange SinglePartition" in plan
        assert "Join" not in plan and "Sort" not in plan and "from_json" not in plan


@pytest.fixture
def table(spark):
    name = work_dir(spark, "size").rsplit("/", 1)[1].replace("-", "_")
    tables.ensure_schema(spark, name)
    return f"{name}.events"


def ids(spark, table):
    return sorted((str(r["event_id"]), r["age"]) for r in spark.table(table).select("event_id", "age").collect())


def test_whole_rows_are_not_shuffled_by_id_to_find_the_new_ones(spark, table, bronze_of, monkeypatch):
    plans = []
    append = loads.append
    monkeypatch.setattr(loads, "append", lambda df, name: (plans.append(plan_of(df)) if name.endswith("_rows") else None, append(df, name))[1])
    many = [{"event_id": f"a{i}"} for i in range(8)]
    tables.load_bronze(bronze_of(*many, {"event_id": "a1", "age": 3}, {"event_id": None}, {"event_id": None}), table)
    expected = sorted([*((f"a{i}", 20) for i in range(8) if i != 1), ("None", 20), ("None", 20)])
    assert [r for r in ids(spark, table) if r[0] != "a1"] == expected
    assert len([r for r in ids(spark, table) if r[0] == "a1"]) == 1
    # Few new ids among many that are held.
    tables.load_bronze(bronze_of(*many, {"event_id": "b"}, {"event_id": "c"}, {"event_id": "c"}, {"event_id": None}), table)
    assert [r[0] for r in ids(spark, table)] == ["None", "None", "None", *(f"a{i}" for i in range(8)), "b", "c"]
    # Nothing but held ids.
    tables.load_bronze(bronze_of(*many), table)
    assert len(ids(spark, table)) == 13
    assert len(plans) == 3 and not any("SortMergeJoin" in p for p in plans)


def test_builds_and_refreshes_read_bronze_from_files(spark, sf_dir, monkeypatch):
    given = []
    build, refresh = medallion.build_lake, medallion.refresh_days
    monkeypatch.setattr(medallion, "build_lake", lambda s, bronze, *a, **k: (given.append(bronze), build(s, bronze, *a, **k))[1])
    monkeypatch.setattr(medallion, "refresh_days", lambda s, bronze, *a, **k: (given.append(bronze), refresh(s, bronze, *a, **k))[1])
    registry.queries()["publish_after_gate"](spark, sf_dir)
    registry.queries()["refresh_emptied_day"](spark, sf_dir)
    assert len(given) == 6
    for bronze in given:
        assert "Join" not in plan_of(bronze)
    for dated in given[2:]:
        assert "PartitionFilters: [isnotnull(event_date" in plan_of(dated.where("event_date = date'2024-01-14'"))


def test_users_of_a_stream_share_states(spark, tmp_path):
    rows = [(f"u{u}", "skip", f"2024-01-01 00:00:{s:02d}") for u in range(40) for s in range(20 if u % 4 == 0 else 19)]
    events = spark.createDataFrame(rows, "user_id string, event_type string, at string").selectExpr("user_id", "event_type", "cast(at as timestamp) event_ts")
    events.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (
        windows.skip_bots(stream, lateness="1 day", groups=3).writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["user_id"] for r in got) == sorted(f"u{u}" for u in range(0, 40, 4))
    assert {r["flagged_at"].second for r in got} == {19}
    # One state per group of users, not one per user.
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 3
