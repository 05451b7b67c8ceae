"""Landing to gold as one batch job."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from listenlake import schemas
from listenlake.operators import gold, preferences, quality, star, trends
from listenlake.operators.silver import silver_events, silver_quarantine
from listenlake.plans import rollups
from listenlake.sinks import loads, releases, tables

GOLD: dict[str, Callable[[DataFrame], DataFrame]] = {
    "top_songs": gold.top_songs,
    "user_engagement": gold.user_engagement,
    "artist_performance": gold.artist_performance,
    "churn_risk": gold.churn_risk,
    "country_stats": gold.country_stats,
    "peak_hours": gold.peak_hours,
    "playlist_conversion": gold.playlist_conversion,
    "user_loyalty": gold.user_loyalty,
    "dim_users": gold.dim_users,
    "dim_songs": gold.dim_songs,
    "dim_date": star.keyed_dim_date,
    "dim_devices": gold.dim_devices,
    "fact_play_events": star.fact_play_events,
    "preferred_device": preferences.preferred_device,
    "country_top_device": preferences.country_top_device,
    "song_trend_weekly": trends.song_trend_weekly,
    "song_skip_rate": gold.song_skip_rate,
}


def gold_marts(
    silver: DataFrame, as_of: str | date | None = None, ordered: bool = True
) -> dict[str, DataFrame]:
    """All marts over one silver relation, still lazy."""
    marts = {name: build(silver) for name, build in GOLD.items()}
    marts["churn_risk"] = gold.churn_risk(silver, as_of)
    marts["user_engagement"] = gold.user_engagement(silver, ordered=ordered)
    return marts


BRONZE_RULES = [
    quality.NotNull("timestamp") if r == quality.NotNull("event_ts") else r for r in quality.SILVER_RULES
]


def load_landing(
    spark: SparkSession, clean_path: str, quarantine_path: str, bronze: str, gate: bool = True
) -> str | None:
    """What is new in both landing zones into the bronze schema; the load's id.

    Only files that no load has read yet are parsed, and an event id is stored once
    whatever its day.  Both zones and the ledger become visible together; a failed check
    leaves the schema's views and the ledger as they were, and the next run takes the
    same files again.  Without new files nothing is written.
    """
    tables.ensure_schema(spark, bronze)
    events, rejects = f"{bronze}.listening_events", f"{bronze}.listening_events_quarantine"
    loads.ensure_target(spark, events, schemas.EVENT, "event_date", "event_id")
    loads.ensure_target(spark, rejects, schemas.QUARANTINE, "rejected_date")
    # The driver holds the names of the new files, as any scan of them does.
    clean, dirty = (loads.new_files(spark, bronze, p).collect() for p in (clean_path, quarantine_path))
    if not clean and not dirty:
        return None
    load_id = loads.new_load()
    if clean:
        landed = loads.read_files(spark, clean, schemas.CLEAN_LANDING)
        loads.stage(tables.bronze_rows(landed), events, load_id, "event_date", "event_id")
    if dirty:
        landed = loads.read_files(spark, dirty, schemas.QUARANTINE_LANDING)
        loads.stage(tables.bronze_quarantine_rows(landed), rejects, load_id, "rejected_date")
    loads.record_files(spark, bronze, load_id, clean + dirty)
    if gate:
        quality.enforce(quality.dq_report(loads.staged(spark, events, load_id), BRONZE_RULES))
    loads.commit(spark, bronze, load_id)
    return load_id


# Silver, rollups, facts and rejects are laid out by event day; marts are replaced as a whole.
DAY = "event_date"


def _dated(silver: DataFrame) -> DataFrame:
    return silver.withColumn(DAY, F.to_date("event_ts"))


def _in(rows: DataFrame) -> StructType:
    """The columns of a dated dataset, the day last."""
    return StructType([f for f in rows.schema.fields if f.name != DAY] + [StructField(DAY, DateType())])


def build_lake(
    spark: SparkSession,
    bronze_events: DataFrame,
    silver_path: str,
    gold_schema: str,
    as_of: str | date | None = None,
    as_tables: bool = False,
    gate: bool = True,
    at_once: int = 4,
) -> dict[str, DataFrame]:
    """Bronze to gold: write silver, check it, build the marts, then publish all at once.

    ``silver_path`` is the root of the lake, which holds its releases (``sinks.releases``).
    Silver is a new version that nobody reads until the checks have passed; a failed check
    or task leaves silver and every mart as they were.  Tables are built from rollups, so
    silver is read once per rollup and for the fact table.  ``at_once`` datasets are written
    at a time, so that the small last tasks of one do not leave the cluster idle.
    """
    base = releases.current(spark, silver_path)
    changed = {"silver": releases.stage(_dated(silver_events(bronze_events)), silver_path, "silver", DAY)}
    silver = releases.read(spark, releases.candidate(base, changed), "silver", tables.STORED_SILVER)
    if gate:
        quality.enforce(quality.dq_report(silver))
    if not as_tables:
        releases.publish(spark, base, changed)
        marts = gold_marts(silver, as_of)
        marts["quarantine_events"] = silver_quarantine(bronze_events)
        return {name: tables.save_view(df, f"{gold_schema}_{name}") for name, df in marts.items()}
    undated = silver.drop(DAY)
    dated = rollups.daily(undated)
    dated["fact_play_events"] = _dated(star.fact_play_events(undated))
    dated["quarantine_events"] = silver_quarantine(bronze_events).withColumn(DAY, tables.day_of(F.col("timestamp")))
    changed |= _staged(dated, silver_path, DAY, at_once)
    return _publish_marts(spark, base, changed, dated, silver_path, gold_schema, as_of, at_once)


def _staged(frames: dict[str, DataFrame], root: str, by: str | None, at_once: int) -> dict[str, list[str]]:
    with ThreadPoolExecutor(at_once) as pool:
        written = pool.map(lambda item: (item[0], releases.stage(item[1], root, item[0], by)), frames.items())
        return dict(written)


def _publish_marts(
    spark: SparkSession, base: releases.Release, changed: dict[str, list[str]], dated: dict[str, DataFrame],
    root: str, gold_schema: str, as_of: str | date | None, at_once: int,
) -> dict[str, DataFrame]:
    """Build the marts over the staged rollups, switch the pointer, let the catalog follow."""
    draft = releases.candidate(base, changed)
    rolled = {name: releases.read(spark, draft, name, _in(dated[name])) for name in rollups.GRAIN}
    marts = rollups.marts_of(rolled, as_of, ordered=False)
    release = releases.publish(spark, base, changed | _staged(marts, root, None, at_once))
    tables.ensure_schema(spark, gold_schema)
    shown = {name: None for name in marts} | {"fact_play_events": DAY, "quarantine_events": DAY}
    for name, by in shown.items():
        frame = marts[name] if name in marts else dated[name]
        releases.point_table(spark, release, name, f"{gold_schema}.{name}", frame, by)
    return {name: spark.table(f"{gold_schema}.{name}") for name in shown}


def refresh_days(
    spark: SparkSession,
    bronze_table: DataFrame,
    first: str,
    last: str,
    silver_path: str,
    rollup_root: str,
    as_of: str | date | None = None,
    gate: bool = True,
    gold_schema: str | None = None,
    at_once: int = 4,
) -> dict[str, DataFrame]:
    """Bring silver and the rollups up to date for some event days, then give the marts.

    ``bronze_table`` is laid out by ``event_date``: only these days are read, parsed,
    checked and counted again.  Their new versions take the place of what the last release
    names for them, also where a day has no events any more; a failed check changes
    nothing.  With ``gold_schema`` the marts are part of the same release and become its
    tables, the same that ``build_lake`` makes.
    """
    base = releases.current(spark, silver_path)
    days = F.col(DAY).between(first, last)
    fresh = _dated(silver_events(bronze_table.filter(days).drop(DAY)))
    staged = releases.stage(fresh, silver_path, "silver", DAY)
    checked = releases.read(spark, releases.Release(base.root, 0, {"silver": staged}), "silver", tables.STORED_SILVER)
    if gate:
        quality.enforce(quality.dq_report(checked))
    undated = checked.drop(DAY)
    dated = rollups.daily(undated)
    parts = {"silver": staged} | _staged(dated, rollup_root, DAY, at_once)
    if gold_schema:
        # Events without a valid time lie under the day that stands for none.
        rejects = silver_quarantine(bronze_table.filter(days | (F.col(DAY) == F.lit(tables.NO_DAY).cast("date"))))
        facts = {"fact_play_events": _dated(star.fact_play_events(undated)), "quarantine_events": rejects}
        dated |= facts
        parts |= _staged(facts, silver_path, DAY, at_once)
    changed = {name: releases.replaced(base.folders.get(name, []), new, DAY, first, last) for name, new in parts.items()}
    if gold_schema:
        timeless = [f for f in changed["quarantine_events"] if releases.part(f, DAY) != tables.NO_DAY]
        changed["quarantine_events"] = timeless + [f for f in parts["quarantine_events"] if releases.part(f, DAY) == tables.NO_DAY]
        return _publish_marts(spark, base, changed, dated, silver_path, gold_schema, as_of, at_once)
    release = releases.publish(spark, base, changed)
    rolled = {name: releases.read(spark, release, name, _in(dated[name])) for name in rollups.GRAIN}
    return rollups.marts_of(rolled, as_of)


def listeners(spark: SparkSession, lake: str, first: str, last: str, keys: list[str]) -> DataFrame:
    """Distinct users of a range of days from the sketches of a published lake."""
    release = releases.current(spark, lake)
    return rollups.unique_listeners(releases.read(spark, release, "listeners_day", rollups.LISTENERS), first, last, keys)
