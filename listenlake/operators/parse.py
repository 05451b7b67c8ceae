"""From message bytes to typed event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from listenlake import schemas
from listenlake.functions.reasons import complete, landing_reason

_RAW = "_raw_record"


def _with_raw(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(_RAW, StringType(), True)])


def expand_json(
    df: DataFrame,
    text: Column,
    schema: StructType,
    keep: list[str | Column],
    drop_undecodable: bool = False,
) -> DataFrame:
    """Parse ``text`` once and put the fields next to the ``keep`` columns.

    ``inline_outer`` over a one-element array makes the parse a step of its own,
    so that a later filter on a parsed field does not parse the text again.
    """
    parsed = F.from_json(text, _with_raw(schema), {"columnNameOfCorruptRecord": _RAW})
    if drop_undecodable:
        df = df.filter(F.trim(text) != "")
    rows = df.select(*keep, F.inline_outer(F.array(parsed)))
    if drop_undecodable:
        # The raw text is only set where something did not fit the schema, so the
        # check for "is it an object at all" runs on those few lines alone.
        rows = rows.filter(F.col(_RAW).isNull() | F.json_object_keys(_RAW).isNotNull())
    names = [c for c in rows.columns if c != _RAW]
    return rows.select(*names)


def parse_messages(messages: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Message log (``value``, ``timestamp``) to 17 event fields and two time stamps.

    Text that does not parse gives NULL in every field, so no message is lost.
    """
    stamp = F.current_timestamp() if processed_at is None else processed_at
    parsed = expand_json(
        messages,
        F.col("value").cast("string"),
        schemas.EVENT,
        [F.col("timestamp").alias("kafka_ingest_time")],
    )
    return parsed.select(
        *schemas.EVENT_COLUMNS, "kafka_ingest_time", stamp.alias("processed_at")
    )


def parse_with_contract(messages: DataFrame) -> DataFrame:
    """Like ``parse_messages``, plus the raw text and the contract violation.

    ``violation`` is NULL for a message that fits; otherwise ``malformed_json``
    (not an object), ``wrong_type`` (a field had another type) or
    ``missing_<field>`` (a required field is absent).
    """
    text = F.col("value").cast("string")
    parsed = F.from_json(text, _with_raw(schemas.EVENT), {"columnNameOfCorruptRecord": _RAW})
    rows = messages.select(
        text.alias("raw"),
        F.col("timestamp").alias("kafka_ingest_time"),
        F.inline_outer(F.array(parsed)),
    )
    violation = (
        F.when(F.col(_RAW).isNotNull() & F.json_object_keys(_RAW).isNull(), "malformed_json")
        .when(F.col("raw").isNull() | (F.trim("raw") == ""), "malformed_json")
        .when(F.col(_RAW).isNotNull(), "wrong_type")
        .when(~complete(), landing_reason())
    )
    return rows.select(
        *schemas.EVENT_COLUMNS, "kafka_ingest_time", "raw", violation.alias("violation")
    )


# Names of the types a JSON value can have, by the start of its VARIANT schema.
_JSON_TYPES = {
    "OBJECT": "object", "ARRAY": "array", "STRING": "text", "BIGINT": "integer", "DECIMAL": "number",
    "DOUBLE": "number", "BOOLEAN": "boolean", "VOID": "null",
}


def contract_drift(messages: DataFrame, contract: StructType = schemas.EVENT) -> DataFrame:
    """What messages carry beside their contract: (key, seen_type, expected_type, rows).

    Every key of every message is looked at as a VARIANT, so keys nobody listed, values of
    another type and nested ones are found by name.  ``expected_type`` is NULL for a key that
    the contract does not know; a text that is no JSON object has key NULL.  JSON nulls fit
    any field.
    """
    spark = messages.sparkSession
    text = F.col("value").cast("string")
    # A generator keeps the text from being parsed once per use of ``v``.
    parsed = messages.select(F.explode(F.array(F.try_parse_json(text))).alias("v"))
    shape = F.schema_of_variant("v")
    fits = F.coalesce(shape.startswith("OBJECT"), F.lit(False))
    entries = spark.sql(
        "SELECT e.key, schema_of_variant(e.value) AS shape FROM {objects} o, LATERAL variant_explode(o.v) e",
        objects=parsed.filter(fits),
    )
    broken = parsed.filter(~fits).select(F.lit(None).cast("string").alias("key"), F.coalesce(F.schema_of_variant("v"), F.lit("none")).alias("shape"))
    # Few (key, shape) pairs: counted map-side, then named.
    seen = entries.unionByName(broken).groupBy("key", "shape").agg(F.count(F.lit(1)).alias("rows"))
    kind = F.regexp_extract("shape", "^[A-Z]+", 0)
    named = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in _JSON_TYPES.items()], F.lit("malformed"))
    wanted = {f.name: "text" if isinstance(f.dataType, StringType) else "integer" for f in contract.fields}
    expected = F.coalesce(*[F.when(F.col("key") == k, F.lit(v)) for k, v in wanted.items()])
    typed = seen.select("key", named.alias("seen_type"), expected.alias("expected_type"), "rows")
    strange = F.col("expected_type").isNull() | ~F.col("seen_type").isin("null") & (F.col("seen_type") != F.col("expected_type"))
    return typed.filter(strange).groupBy("key", "seen_type", "expected_type").agg(F.sum("rows").alias("rows"))
