"""Named queries: each takes a session and a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StructType

from listenlake import schemas
from listenlake.functions.keys import song_key
from listenlake.functions.measures import TOTALS
from listenlake.operators import (
    anomalies,
    conform,
    dedup,
    forecast,
    gold,
    parse,
    preferences,
    quality,
    recommend,
    seasonal,
    star,
    trends,
    validate,
)
from listenlake.operators.parse import parse_messages, parse_with_contract
from listenlake.operators.silver import silver_events, silver_quarantine
from listenlake.plans import medallion, rollups
from listenlake.session import pin_utc, work_dir
from listenlake.sinks import landing as landing_sink
from listenlake.sinks import tables
from listenlake.sources import testdata
from listenlake.sources.catalog import query, source
from listenlake.sources.files import file_messages
from listenlake.sources.landing import read_ndjson
from listenlake.streaming import ingest, windows

Query = Callable[[SparkSession, str], DataFrame]

# The test events end on 2024-01-30.
AS_OF = "2024-01-31"
RUN_ID = "daily-plays"

_REGISTRY: dict[str, Query] = {}


def _register(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_utc(spark), sf_dir)

    _REGISTRY[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.bronze(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_events(_bronze(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_messages(testdata.messages(_bronze(spark, sf_dir), damaged=True))


def _silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_events(testdata.bronze(spark, sf_dir, testdata.events_stream(spark, sf_dir)))


def _finish(started: StreamingQuery) -> None:
    started.awaitTermination()


def _drain(stream: DataFrame, spark: SparkSession, label: str) -> DataFrame:
    """Run a stream over all that is there into Parquet and read the result."""
    root = work_dir(spark, label)
    _finish(
        stream.writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


# --- sources, parsing and routing -------------------------------------------------


@_register
def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir)


@_register
def landing_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).drop("processed_at")


@_register
def landing_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.clean(_parsed(spark, sf_dir)).drop("processed_at")


@_register
def landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.quarantine(_parsed(spark, sf_dir)).drop("processed_at", "_rejected_at")


@_register
def landing_clean_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict routing, with a blank user id on some rows."""
    blanked = _bronze(spark, sf_dir).withColumn(
        "user_id",
        F.when(F.col("event_id").cast("bigint") % 127 == 0, F.lit(" ")).otherwise(F.col("user_id")),
    )
    parsed = parse_messages(testdata.messages(blanked))
    return validate.with_zone(parsed, strict=True).select(
        "event_id", "user_id", "song_id", "timestamp", "zone", "_reject_reason"
    )


@_register
def zone_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of both zones, then the rows of one event type per zone."""
    good, bad = validate.split(_parsed(spark, sf_dir))
    both = good.select("event_type", F.lit("clean").alias("zone")).unionByName(
        bad.select("event_type", F.lit("quarantine").alias("zone"))
    )
    return (
        both.filter(F.col("event_type") == "play")
        .groupBy("zone")
        .agg(F.count(F.lit(1)).alias("plays"))
    )


@_register
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = parse_with_contract(testdata.messages(_bronze(spark, sf_dir), damaged=True))
    return checked.filter(F.col("violation").isNotNull()).select(
        "event_id", "user_id", "song_id", "timestamp", "violation"
    )


@_register
def contract_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown keys, drifted types and unreadable texts among messages, by name and number."""
    return parse.contract_drift(testdata.with_drift(testdata.messages(_bronze(spark, sf_dir), damaged=True)))


@_register
def silver_timestamp_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times of texts that are whole, cut, foreign or none."""
    return silver_events(testdata.with_timestamp_texts(_bronze(spark, sf_dir))).select("event_id", "event_ts")


@_register
def ndjson_clean_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the clean zone as NDJSON and load it back into the bronze columns."""
    root = work_dir(spark, "clean")
    landing_sink.write_ndjson(validate.clean(_parsed(spark, sf_dir)), root)
    return conform.to_bronze(read_ndjson(spark, root, schemas.CLEAN_LANDING))


@_register
def ndjson_quarantine_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "quarantine")
    landing_sink.write_ndjson(validate.quarantine(_parsed(spark, sf_dir)), root)
    rows = conform.to_bronze_quarantine(read_ndjson(spark, root, schemas.QUARANTINE_LANDING))
    return rows.drop("_rejected_at")


@_register
def ndjson_drop_undecodable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw message lines, some of them cut short, as a loader reads them."""
    root = work_dir(spark, "raw")
    raw = testdata.messages(_bronze(spark, sf_dir), damaged=True)
    raw.select(F.col("value").cast("string")).write.text(root)
    return read_ndjson(spark, root, schemas.EVENT, file_glob="*.txt")


@_register
def ndjson_hourly_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour folders by arrival time, read back with typed folder columns (9 fields)."""
    root = work_dir(spark, "archive")
    arrived = _parsed(spark, sf_dir)
    landing_sink.write_by_ingest_hour(
        arrived.select(*schemas.LEGACY_COLUMNS, "kafka_ingest_time"),
        root,
        F.col("kafka_ingest_time"),
        records_per_file=1_000_000,
    )
    folders = StructType().add("date", DateType()).add("hour", IntegerType())
    return read_ndjson(spark, root, schemas.LEGACY_EVENT, folders)


@_register
def clean_zone_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean zone in country folders, read back whole."""
    root = work_dir(spark, "by-country")
    landing_sink.write_ndjson(validate.clean(_parsed(spark, sf_dir)), root, ["country"])
    without = StructType([f for f in schemas.EVENT.fields if f.name != "country"])
    folders = StructType().add("country", "string")
    rows = read_ndjson(spark, root, without, folders)
    return rows.select(*schemas.EVENT_COLUMNS)


def _kept(made: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """A test input made once and read from files afterwards, as a job finds its input."""
    path = work_dir(made.sparkSession, label)
    writer = (made.hint("rebalance", by) if by else made).write
    (writer.partitionBy(by) if by else writer).parquet(path)
    columns = StructType([f for f in made.schema.fields if f.name != by] + [f for f in made.schema.fields if f.name == by])
    return made.sparkSession.read.schema(columns).parquet(path).select(*made.columns)


def _bronze_schema(spark: SparkSession, label: str) -> str:
    root = work_dir(spark, label)
    name = root.rsplit("/", 1)[1].replace("-", "_")
    tables.ensure_schema(spark, name, root)
    return name


def _bronze_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze laid out by event day, as refreshes expect it."""
    dated = _bronze(spark, sf_dir).withColumn("event_date", tables.day_of(F.col("timestamp")))
    return _kept(dated, "bronze-days", "event_date")


@_register
def bronze_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load events that partly come twice, and load them again: each id stays once."""
    schema = _bronze_schema(spark, "bronze")
    sent = _kept(testdata.messages(testdata.with_copies(_bronze(spark, sf_dir))), "messages")
    incoming = validate.clean(parse_messages(sent))
    for _ in range(2):
        tables.load_bronze(incoming, f"{schema}.listening_events")
    return source(spark, schema, "listening_events").drop("event_date")


@_register
def bronze_load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain append, twice: every row is there two times."""
    schema = _bronze_schema(spark, "append")
    incoming = validate.clean(_parsed(spark, sf_dir))
    for _ in range(2):
        tables.load_bronze(incoming, f"{schema}.listening_events", once=False)
    return (
        source(spark, schema, "listening_events")
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@_register
def bronze_load_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files loaded, then some events delivered anew under another day: each id stays
    as it came first."""
    schema, root = _bronze_schema(spark, "redelivered"), work_dir(spark, "landing")
    first = validate.clean(_parsed(spark, sf_dir))
    landing_sink.write_ndjson(first, f"{root}/clean")
    medallion.load_landing(spark, f"{root}/clean", f"{root}/none", schema)
    moved = F.regexp_replace("timestamp", "^2024-01-0", "2024-02-0")
    again = first.where(F.col("event_id").cast("bigint") % 7 == 0).withColumn("timestamp", moved)
    landing_sink.write_ndjson(again, f"{root}/clean", ["country"])
    for _ in range(2):
        medallion.load_landing(spark, f"{root}/clean", f"{root}/none", schema)
    return source(spark, schema, "listening_events").drop("event_date")


@_register
def bronze_load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four hourly runs, the last without anything new: what each read and stored."""
    schema, root = _bronze_schema(spark, "hourly"), work_dir(spark, "landing")
    clean = _kept(validate.clean(_parsed(spark, sf_dir)), "clean")
    part = F.col("event_id").cast("bigint") % 3
    for hour in range(4):
        if hour < 3:
            # Each run also delivers the events of the run before once more, in one file. Its
            # writer is handed finished rows: they stream through it and none are held.
            due = clean.where((part == hour) | (part == hour - 1)).repartition(1)
            landing_sink.write_ndjson(due, f"{root}/clean")
        medallion.load_landing(spark, f"{root}/clean", f"{root}/none", schema)
    rows = spark.table(f"{schema}.listening_events_rows").groupBy("load_id").agg(
        F.min(part).alias("part"), F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids")
    )
    files = spark.table(f"{schema}.loaded_files").groupBy("load_id").agg(F.count_distinct("path").alias("files"))
    return rows.join(files, "load_id").select("part", "files", "events", "ids")


@_register
def quarantine_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _bronze_schema(spark, "rejects")
    stamp = F.col("kafka_ingest_time")
    incoming = validate.quarantine(_parsed(spark, sf_dir), rejected_at=stamp)
    for _ in range(2):
        tables.load_bronze_quarantine(incoming, f"{schema}.rejected")
    return source(spark, schema, "rejected").drop("rejected_date", "_rejected_at")


@_register
def legacy_bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _bronze_schema(spark, "legacy")
    tables.load_legacy_bronze(validate.clean(_parsed(spark, sf_dir)), f"{schema}.events")
    return source(spark, schema, "events")


# --- silver -----------------------------------------------------------------------


def _silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_quarantine(_bronze(pin_utc(spark), sf_dir)).drop("rejected_at")


_REGISTRY["silver_quarantine"] = _silver_quarantine


@_register
def silver_parquet_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver stored in day folders, read back whole."""
    stored = tables.write_silver(_silver(spark, sf_dir), work_dir(spark, "silver"))
    return stored.drop("event_date")


# --- gold -------------------------------------------------------------------------


def _over_silver(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(_silver(pin_utc(spark), sf_dir))

    _REGISTRY[name] = run


_over_silver("silver_events", lambda s: s)
_over_silver("top_songs", gold.top_songs)
_over_silver("user_engagement", gold.user_engagement)
_over_silver("artist_performance", gold.artist_performance)
_over_silver("churn_risk", lambda s: gold.churn_risk(s, AS_OF))
_over_silver("country_stats", gold.country_stats)
_over_silver("peak_hours", gold.peak_hours)
_over_silver("playlist_conversion", gold.playlist_conversion)
_over_silver("user_loyalty", gold.user_loyalty)
_over_silver("user_loyalty_monthly", gold.user_loyalty_monthly)
_over_silver("dim_users", gold.dim_users)
_over_silver("dim_songs", gold.dim_songs)
_over_silver("dim_date", gold.dim_date)
_over_silver("dim_devices", gold.dim_devices)
_over_silver("daily_plays", gold.daily_plays)
_over_silver("listening_overview", gold.listening_overview)
_over_silver("top10_songs", gold.top_n_songs)
_over_silver("song_skip_rate", gold.song_skip_rate)
_over_silver("preferred_device", preferences.preferred_device)
_over_silver("country_top_device", preferences.country_top_device)
_over_silver("song_trend_weekly", trends.song_trend_weekly)
_over_silver("weekly_top_songs", trends.weekly_top_songs)
_over_silver("fact_play_events", star.fact_play_events)
_over_silver("star_plays_by_genre", star.star_join)
_over_silver("skip_bursts", anomalies.skip_bursts)
_over_silver(
    "song_keys",
    lambda s: gold.dim_songs(s).select(
        "song_id", song_key(F.col("artist_name"), F.col("song_name")).alias("song_uuid")
    ),
)


@_register
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_events(testdata.with_copies(_bronze(spark, sf_dir)))


@_register
def similar_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.similar_songs(_silver(spark, sf_dir))


@_register
def recommend_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates from similar songs; users with many songs are split."""
    return recommend.recommend_similar(_silver(spark, sf_dir), heavy=3)


@_register
def recommend_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.recommend_songs(_silver(spark, sf_dir))


@_register
def catalog_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a mart published as a view and over a silver relation by name."""
    songs = tables.save_view(gold.top_songs(_silver(spark, sf_dir)), "listenlake_top_songs")
    return query(
        spark,
        """SELECT ARTIST_NAME, COUNT(*) AS SONGS, SUM(TOTAL_PLAYS) AS TOTAL_PLAYS
           FROM {songs} GROUP BY ARTIST_NAME""",
        songs=songs,
    )


# Per mart of a build the columns whose sums are compared, besides its rows.
MART_SUMS = {
    "top_songs": ["total_plays", "total_skips"], "user_engagement": ["plays", "skips", "playlist_adds"],
    "artist_performance": ["total_plays", "total_skips", "skip_rate", "unique_listeners"],
    "churn_risk": ["days_inactive", "skip_rate"], "country_stats": ["total_plays", "unique_users"],
    "peak_hours": ["hour", "total_events"], "playlist_conversion": ["plays", "playlist_adds", "conversion_rate"],
    "user_loyalty": ["active_days"], "user_loyalty_monthly": ["active_days"], "dim_users": ["age"],
    "dim_songs": ["duration_seconds"], "dim_date": ["hour", "day_of_week"], "dim_devices": [], "daily_plays": ["y"],
    "listening_overview": ["total_plays", "total_skips", "total_playlist_adds", "active_users"], "song_skip_rate": ["total_skips", "skip_rate"],
    "preferred_device": ["events"], "country_top_device": ["events"], "song_trend_weekly": ["plays", "previous_plays", "change"],
    "weekly_top_songs": ["plays", "place"], "fact_play_events": ["date_key"], "quarantine_events": ["age"],
}


def _mart_sums(built: dict[str, DataFrame]) -> DataFrame:
    """(mart, measure, total): rows, and per measure a hundred times its sum as a whole number."""
    def of_mart(name: str) -> DataFrame:
        sums = [F.struct(F.lit(c).alias("measure"), F.round(F.sum(F.col(c) * 100)).cast("bigint").alias("total")) for c in MART_SUMS[name]]
        rows = F.struct(F.lit("rows").alias("measure"), F.count(F.lit(1)).alias("total"))
        return built[name].agg(F.array(rows, *sums).alias("all")).select(F.lit(name).alias("mart"), F.inline("all"))

    return reduce(DataFrame.unionByName, [of_mart(name) for name in MART_SUMS])


@_register
def gold_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to a published lake with all marts as tables; rows and sums of each."""
    schema = _bronze_schema(spark, "gold")
    built = medallion.build_lake(
        spark, _bronze(spark, sf_dir), work_dir(spark, "lake"), schema, AS_OF, as_tables=True
    )
    return _mart_sums(built)


@_register
def publish_after_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake is built, then two jobs over dirty events fail their checks: what was published stays."""
    schema, lake = _bronze_schema(spark, "published"), work_dir(spark, "lake")
    bronze = _bronze_days(spark, sf_dir)
    medallion.build_lake(spark, bronze.drop("event_date"), lake, schema, AS_OF, as_tables=True)
    dated = testdata.with_foreign_types(testdata.with_copies(bronze))
    for job in (
        lambda: medallion.build_lake(spark, dated.drop("event_date"), lake, schema, AS_OF, as_tables=True),
        lambda: medallion.refresh_days(
            spark, dated, "2024-01-10", "2024-01-20", lake, f"{lake}/rollups", AS_OF, gold_schema=schema
        ),
    ):
        try:
            job()
            raise RuntimeError("the gate let dirty events through")
        except quality.QualityError:
            pass
    shown = _mart_sums({name: source(spark, schema, name) for name in MART_SUMS})
    silver = tables.read_silver(spark, lake).agg(F.lit("silver").alias("mart"), F.lit("rows").alias("measure"), F.count(F.lit(1)).alias("total"))
    return shown.unionByName(silver)


@_register
def refresh_emptied_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake refreshed in two steps, then once more for days of which one has lost all events
    and another half of them: (event_date, events, plays) from silver and from a mart."""
    schema, lake = _bronze_schema(spark, "emptied"), work_dir(spark, "lake")
    dated = _bronze_days(spark, sf_dir)
    day = F.col("event_date")
    corrected = dated.where((day != "2024-01-12") & ((day != "2024-01-13") | (F.col("event_id").cast("bigint") % 2 == 0)))
    for rows, first, last in ((dated, "2024-01-01", "2024-01-15"), (dated, "2024-01-14", "2024-02-29"), (corrected, "2024-01-11", "2024-01-13")):
        medallion.refresh_days(spark, rows, first, last, lake, f"{lake}/rollups", AS_OF, gold_schema=schema)
    events = tables.read_silver(spark, lake).groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))
    plays = source(spark, schema, "daily_plays").select(F.col("ds").alias("event_date"), F.col("y").alias("plays"))
    return events.join(plays, "event_date", "full")


def _rollups(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Rollups of all days in two refreshes; the second one repeats a week of the first."""
    root = work_dir(spark, "rollups")
    stored = tables.write_silver(_silver(spark, sf_dir), f"{root}/silver")
    half = "cast(datediff(max(event_date), min(event_date)) div 2 as int)"
    low, middle, later, high = stored.agg(
        F.min("event_date"), F.expr(f"date_add(min(event_date), {half})"),
        F.expr(f"date_add(min(event_date), {half} + 6)"), F.max("event_date"),
    ).first()
    for first, last in ((low, later), (middle, high)):
        days = F.col("event_date").between(F.lit(first), F.lit(last))
        rollups.refresh(stored.filter(days).drop("event_date"), root)
    return rollups.marts(spark, root, AS_OF)


@_register
def rollup_churn_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollups(spark, sf_dir)["churn_risk"]


@_register
def rollup_artist_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollups(spark, sf_dir)["artist_performance"]


@_register
def unique_listeners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listeners per artist over eleven days, from the rollups' sketches alone, held against the exact number."""
    root, first, last = work_dir(spark, "sketches"), "2024-01-05", "2024-01-15"
    stored = tables.write_silver(_silver(spark, sf_dir), f"{root}/silver").drop("event_date")
    rollups.refresh(stored, root)
    sketched = rollups.unique_listeners(rollups.read(spark, root, "listeners_day"), first, last, ["artist_name"])
    exact = (
        stored.where(F.to_date("event_ts").between(F.lit(first), F.lit(last)))
        .groupBy("artist_name").agg(F.count_distinct("user_id").alias("exact"))
    )
    gap = F.abs(F.col("unique_listeners") - F.col("exact"))
    both = exact.join(sketched, exact["artist_name"].eqNullSafe(sketched["artist_name"]), "full").select(
        exact["artist_name"], "exact", F.coalesce(gap <= rollups.SKETCH_ERROR * F.col("exact"), F.lit(False)).alias("within_bound")
    )
    return both


def _bucketed(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    """A mart over daily totals in buckets by user, which it aggregates without a shuffle."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = _bronze_schema(pin_utc(spark), "buckets")
        return operator(rollups.bucketed_user_days(_silver(spark, sf_dir), f"{schema}.user_day"))

    _REGISTRY[name] = run


_bucketed("bucketed_churn_risk", lambda t: gold.churn_risk(t, AS_OF, TOTALS))
_bucketed("bucketed_user_loyalty", gold.user_loyalty)
_bucketed("bucketed_user_engagement", lambda t: gold.user_engagement(t, TOTALS, ordered=False))
_bucketed("bucketed_preferred_device", lambda t: preferences.preferred_device(t, TOTALS))


# --- quality ----------------------------------------------------------------------


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_events(
        testdata.with_foreign_types(testdata.with_copies(_bronze(spark, sf_dir)))
    )


@_register
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_report(_silver(spark, sf_dir))


@_register
def dq_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_report(_dirty(spark, sf_dir))


@_register
def dq_report_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules over rows that were not filtered yet, so NULL checks fail as well."""
    rules = [quality.NotNull(c) for c in ("event_id", "user_id", "song_id", "timestamp")]
    return quality.dq_report(_bronze(spark, sf_dir), [*rules, quality.Unique("event_id")])


@_register
def dq_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_values(_dirty(spark, sf_dir))


@_register
def dq_unexpected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_unexpected_values(_dirty(spark, sf_dir))


# --- forecast ---------------------------------------------------------------------


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Engines differ in the last digits of a double; adding 0.0 drops a minus on zero."""
    return df.withColumns(
        {c: F.round(c, digits) + F.lit(0.0) for c in ("yhat", "yhat_lower", "yhat_upper") if c in df.columns}
    )


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_series(_silver(spark, sf_dir))


@_register
def forecast_trend_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(forecast.forecast_trend(_daily(spark, sf_dir)).drop("y"))


@_register
def forecast_last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(forecast.latest_rows(forecast.forecast_trend(_daily(spark, sf_dir)).drop("y")))


@_register
def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir)
    return forecast.forecast_metrics(forecast.forecast_trend(daily), daily)


@_register
def forecast_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's metrics and parameters, appended to and read from the run log."""
    daily = _daily(spark, sf_dir)
    metrics = forecast.forecast_metrics(forecast.forecast_trend(daily), daily)
    schema = _bronze_schema(spark, "runs")
    tables.append_run(
        forecast.run_record(metrics, RUN_ID, forecast.RUN_PARAMS), f"{schema}.forecast_runs"
    )
    return source(spark, schema, "forecast_runs")


@_register
def forecast_fourier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(forecast.forecast_fourier(_daily(spark, sf_dir)).drop("y"), 3)


@_register
def forecast_by_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = gold.daily_series(_silver(spark, sf_dir), ["song_id"])
    return _rounded(forecast.forecast_trend(daily, ["song_id"]).drop("y"))


@_register
def forecast_changepoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(seasonal.forecast_changepoints(_daily(spark, sf_dir)).drop("y"), 4)


@_register
def forecast_seasonal_by_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = gold.daily_series(_silver(spark, sf_dir), ["song_id"])
    ahead = seasonal.forecast_seasonal(daily, ["song_id"]).withColumn("mse", F.round("mse", 4))
    return _rounded(ahead, 4)


@_register
def forecast_peak_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = gold.daily_series(_silver(spark, sf_dir), [F.hour("event_ts").alias("hour")])
    return forecast.peak_hour_forecast(hourly)


@_register
def forecast_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Future rows written back as a table."""
    schema = _bronze_schema(spark, "forecast")
    ahead = forecast.forecast_trend(_daily(spark, sf_dir)).filter(F.col("y").isNull()).drop("y")
    return _rounded(tables.save_table(ahead, f"{schema}.daily_play_forecast"))


# --- streaming --------------------------------------------------------------------


def _message_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    raw = testdata.messages(_bronze(spark, sf_dir), damaged=True)
    raw.select(F.col("value").cast("string")).write.text(f"{root}/in")
    return parse_messages(file_messages(spark, f"{root}/in", max_files_per_trigger=64))


_ZONE_COLUMNS = ["event_id", "user_id", "song_id", "timestamp", "zone", "_reject_reason"]


@_register
def stream_zones_single_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "zones")
    parsed = _message_files(spark, sf_dir, root)
    _finish(ingest.start_zones_single_scan(parsed, f"{root}/out", f"{root}/checkpoint", None))
    folders = StructType().add("zone", "string")
    landed = read_ndjson(spark, f"{root}/out", schemas.QUARANTINE_LANDING, folders)
    return landed.select(*_ZONE_COLUMNS)


@_register
def stream_zones_two_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "two")
    parsed = _message_files(spark, sf_dir, root)
    started = ingest.start_zone_queries(
        parsed,
        f"{root}/clean",
        f"{root}/quarantine",
        f"{root}/checkpoint-clean",
        f"{root}/checkpoint-quarantine",
        None,
        None,
    )
    for one in started:
        _finish(one)
    good = read_ndjson(spark, f"{root}/clean", schemas.CLEAN_LANDING).select(
        "*", F.lit("clean").alias("zone"), F.lit(None).cast("string").alias("_reject_reason")
    )
    bad = read_ndjson(spark, f"{root}/quarantine", schemas.QUARANTINE_LANDING).withColumn(
        "zone", F.lit("quarantine")
    )
    return good.select(*_ZONE_COLUMNS).unionByName(bad.select(*_ZONE_COLUMNS))


@_register
def stream_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files into a table by a checkpointed stream, started twice."""
    root = work_dir(spark, "load")
    landing_sink.write_ndjson(validate.clean(_parsed(spark, sf_dir)), f"{root}/clean")
    for _ in range(2):
        _finish(
            ingest.start_table_load(
                spark, f"{root}/clean", schemas.EVENT, f"{root}/bronze", f"{root}/checkpoint"
            )
        )
    return spark.read.parquet(f"{root}/bronze").drop("load_id")


def _drain_closed(
    spark: SparkSession, silver: DataFrame, label: str, operator: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Run an operator over a stream that ends: all there is, then the closing marker."""
    root = work_dir(spark, label)
    marks = windows.open_marker_folder(spark, f"{root}/marks")
    result = operator(windows.with_closing_marker(silver, marks))
    for closing in (False, True):
        if closing:
            windows.close(spark, marks)
        _finish(
            result.writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    return spark.read.schema(result.schema).parquet(f"{root}/out")


@_register
def stream_plays_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drain_closed(spark, _silver_stream(spark, sf_dir), "minutes", windows.plays_per_minute)


@_register
def stream_skip_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drain_closed(spark, _silver_stream(spark, sf_dir), "skips", windows.skip_windows)


@_register
def skip_bursts_bot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bursts among users of whom some skip at a bot's pace and some just below it."""
    return anomalies.skip_bursts(testdata.with_bursts(_silver(spark, sf_dir)))


@_register
def stream_skip_bots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a stream in several micro-batches, files in no order of time."""
    root = work_dir(spark, "bots")
    events = testdata.with_bursts(_silver(spark, sf_dir))
    skips = events.filter(F.col("event_type") == "skip").select("user_id", "event_type", "event_ts")
    skips.repartition(5, "event_ts").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(skips.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    # The files are shuffled, so the watermark has to wait for the whole month.
    return _drain(windows.skip_bots(stream, lateness="60 days"), spark, "flags").select("user_id")


@_register
def stream_unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = testdata.bronze(spark, sf_dir, testdata.events_stream(spark, sf_dir))
    twice = testdata.with_copies(bronze, mark="delivery")
    typed = silver_events(twice.withColumn("album_name", F.col("delivery").cast("string")))
    unique = windows.unique_events(typed, spread=F.col("album_name"))
    return _drain(unique.drop("album_name"), spark, "unique")
