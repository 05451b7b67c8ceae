"""Bronze events derived from the star-schema test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listenlake.schemas import EVENT_COLUMNS

# The test tables' event types stand for view and purchase = play,
# click = skip, signup = add_to_playlist, error = pause; every so many ids lack a field.
_BRONZE_SQL = """
SELECT
  IF(e.event_id % 101 = 0, NULL, CAST(e.event_id AS STRING)) AS event_id,
  IF(e.event_id % 103 = 0, NULL, CAST(c.c_custkey AS STRING)) AS user_id,
  IF(e.event_id % 107 = 0, NULL, CAST(p.p_partkey AS STRING)) AS song_id,
  p.p_brand AS artist_name,
  p.p_name AS song_name,
  CASE WHEN e.event_type IN ('view', 'purchase') THEN 'play'
    WHEN e.event_type = 'click' THEN 'skip'
    WHEN e.event_type = 'signup' THEN 'add_to_playlist'
    WHEN e.event_type = 'error' THEN 'pause' END AS event_type,
  ELT(CAST(e.event_id % 3 AS INT) + 1, 'mobile', 'desktop', 'web') AS device_type,
  ELT(c.c_nationkey % 8 + 1, 'US', 'UK', 'CA', 'AU', 'IN', 'DE', 'VN', 'JP') AS country,
  CASE WHEN e.event_id % 109 = 0 THEN NULL
    WHEN e.event_id % 113 = 0 THEN 'not-a-timestamp'
    ELSE DATE_FORMAT(e.ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END AS timestamp,
  c.c_name AS username,
  CAST(16 + c.c_custkey % 30 AS INT) AS age,
  IF(c.c_custkey % 3 = 2, 'premium', 'free') AS subscription_type,
  CAST(DATE_ADD(DATE'2021-01-01', CAST(c.c_custkey % 1000 AS INT)) AS STRING)
    AS registration_date,
  p.p_type AS genre,
  CAST(180 + p.p_size AS INT) AS duration_seconds,
  CAST(2000 + p.p_partkey % 25 AS INT) AS release_year,
  CONCAT('Album ', CAST(p.p_partkey % 10 AS STRING)) AS album_name
FROM (
  SELECT event_id, event_type, ts,
    CAST(GET_JSON_OBJECT(props, '$.k') AS BIGINT) AS part_key,
    user_id * 10 + event_id % 10 AS cust_key
  FROM {events}
) e
JOIN {part} p ON e.part_key = p.p_partkey
JOIN {customer} c ON e.cust_key = c.c_custkey
"""

_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once, not at every use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A small table kept in one row group is read by one task; hand its rows to all
    cores. A scan that has enough tasks already stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def events_stream(
    spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The events table as an unbounded file stream."""
    reader = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def bronze(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """17-column bronze events; pass ``events`` to use a stream in place of the table.

    The two joins carry no broadcast hint: Spark broadcasts a dimension only
    when its measured size is below the threshold, and otherwise shuffles with
    AQE splitting the hot song and user keys.
    """
    if events is None:
        events = spread(table(spark, sf_dir, "events"), "event_id")
    return spark.sql(
        _BRONZE_SQL,
        events=events,
        part=table(spark, sf_dir, "part"),
        customer=table(spark, sf_dir, "customer"),
    )


def with_copies(bronze_events: DataFrame, mark: str | None = None) -> DataFrame:
    """Bronze as an at-least-once source delivers it: some events come twice.

    ``mark`` names a column that tells the deliveries of an event apart.
    """
    again = F.coalesce(F.col("event_id").cast("bigint") % 97 == 0, F.lit(False))
    times = F.when(again, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = bronze_events.select("*", F.explode(times).alias(mark or "_copy"))
    return rows if mark else rows.drop("_copy")


def with_foreign_types(bronze_events: DataFrame) -> DataFrame:
    """Bronze with an event type outside the accepted domain on some rows."""
    foreign = F.col("event_id").cast("bigint") % 127 == 0
    return bronze_events.withColumn(
        "event_type", F.when(foreign, F.lit("like")).otherwise(F.col("event_type"))
    )


def with_bursts(silver: DataFrame) -> DataFrame:
    """Silver in which some users skip in series: every skip of theirs comes 25 times.

    Steps of 2.5 seconds put 24 skips into less than a minute, steps of 3.158 seconds exactly 20,
    and steps of 3.2 seconds only 19.
    """
    number = F.col("user_id").cast("bigint")
    step = F.element_at(F.array(F.lit(2_500_000), F.lit(3_157_894), F.lit(3_200_000)), (number % 3 + 1).cast("int"))
    bursts = (F.col("event_type") == "skip") & (number % 7 == 0)
    series = F.when(bursts, F.sequence(F.lit(0), F.lit(24))).otherwise(F.array(F.lit(0)))
    rows = silver.withColumn("_at", F.explode(series))
    moved = F.timestamp_micros(F.unix_micros("event_ts") + F.col("_at") * step)
    return rows.withColumn("event_ts", F.when(bursts, moved).otherwise(F.col("event_ts"))).drop("_at")


def messages(bronze_events: DataFrame, damaged: bool = False) -> DataFrame:
    """Events as a message log delivers them: binary JSON plus an arrival time.

    ``damaged`` cuts some JSON texts short, so that they do not parse, and puts a
    text into the numeric ``age`` of some others.
    """
    text = F.to_json(F.struct(*EVENT_COLUMNS))
    if damaged:
        number = F.col("event_id").cast("bigint")
        text = (
            F.when(number % 131 == 0, F.substring(text, 1, 20))
            .when(number % 137 == 0, F.regexp_replace(text, r'"age":\d+', '"age":"unknown"'))
            .otherwise(text)
        )
    arrival = F.coalesce(
        F.try_to_timestamp(F.col("timestamp")), F.lit("2024-01-31 00:00:00").cast("timestamp")
    )
    return bronze_events.select(text.cast("binary").alias("value"), arrival.alias("timestamp"))


def with_drift(sent: DataFrame) -> DataFrame:
    """Messages of which some have a new key, a nested one, a fraction, a flag or a list."""
    text = F.col("value").cast("string")
    number = F.get_json_object(text, "$.event_id").try_cast("bigint")
    extra = {
        11: '"mood":"calm"', 13: '"device":{"os":"x","v":2}', 17: '"tags":["a",1]', 19: '"score":0.5', 23: '"offline":true',
    }
    fields = F.concat(*[F.when(number % step == 0, F.lit(f",{field}")).otherwise(F.lit("")) for step, field in extra.items()])
    length = F.when(number % 29 == 0, F.lit(r'"duration_seconds":\d+')).otherwise(F.lit("^$"))
    text = F.regexp_replace(text, length, F.lit('"duration_seconds":null'))
    text = F.regexp_replace(text, F.lit(r"\}$"), F.concat(F.coalesce(fields, F.lit("")), F.lit("}")))
    return sent.withColumn("value", text.cast("binary"))


# Texts that stand in for event times, by event id modulo ten; every tenth keeps its own.
TIMESTAMP_TEXTS = [
    "10:00", "2024", "2024-01-05", "2024-01-05 10:00:00", "2024-01-05T10:00:00+07:00", "T10:00", "",
    "2024-13-01T00:00:00Z", " 2024-01-05T10:00:00Z ",
]


def with_timestamp_texts(bronze_events: DataFrame) -> DataFrame:
    """Bronze whose timestamps are whole, cut, foreign or no timestamps at all."""
    place = (F.col("event_id").cast("bigint") % 10).cast("int")
    text = F.get(F.array(*[F.lit(t) for t in TIMESTAMP_TEXTS]), place)
    return bronze_events.withColumn("timestamp", F.coalesce(text, F.col("timestamp")))
