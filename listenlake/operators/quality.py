"""Declarative data checks over a relation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.schemas import COUNTRIES, EVENT_TYPES, SUBSCRIPTION_TYPES


@dataclass(frozen=True)
class NotNull:
    column: str
    check = "not_null"


@dataclass(frozen=True)
class Unique:
    column: str
    check = "unique"


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple[str, ...]
    check = "accepted_values"

    def foreign(self) -> Column:
        """The value if it is outside the domain, else NULL; NULL itself passes."""
        return F.when(~F.col(self.column).isin(*self.values), F.col(self.column))


Rule = NotNull | Unique | AcceptedValues

SILVER_RULES: list[Rule] = [
    NotNull("event_id"),
    Unique("event_id"),
    NotNull("user_id"),
    NotNull("song_id"),
    AcceptedValues("event_type", tuple(EVENT_TYPES)),
    NotNull("event_ts"),
    AcceptedValues("subscription_type", tuple(SUBSCRIPTION_TYPES)),
    AcceptedValues("country", tuple(COUNTRIES)),
]


class QualityError(RuntimeError):
    """At least one check failed."""


def duplicate_values(df: DataFrame, column: str = "event_id") -> DataFrame:
    """Non-NULL values that occur more than once, with the number of copies."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def _one_pass(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every rule but ``unique``, as (check, column, value, rows), in one scan.

    Rows are first grouped by their foreign values.  Good rows share one group, so
    each map task sends out a single row for them, whatever the input size.
    """
    domains = [r for r in rules if isinstance(r, AcceptedValues)]
    required = [r for r in rules if isinstance(r, NotNull)]
    grouped = df.groupBy(*[r.foreign().alias(f"bad_{r.column}") for r in domains]).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(r.column).isNull()).alias(f"null_{r.column}") for r in required],
    )
    cells = [
        F.struct(
            F.lit(r.check).alias("check"),
            F.lit(r.column).alias("column"),
            F.lit(None).cast("string").alias("value"),
            F.col(f"null_{r.column}").alias("rows"),
        )
        for r in required
    ] + [
        F.struct(
            F.lit(r.check).alias("check"),
            F.lit(r.column).alias("column"),
            F.col(f"bad_{r.column}").cast("string").alias("value"),
            F.when(F.col(f"bad_{r.column}").isNotNull(), F.col("rows"))
            .otherwise(F.lit(0))
            .alias("rows"),
        )
        for r in domains
    ]
    return (
        grouped.select(F.inline(F.array(*cells)))
        .groupBy("check", "column", "value")
        .agg(F.sum("rows").alias("rows"))
        .filter("rows > 0")
    )


def dq_unexpected_values(df: DataFrame, rules: list[Rule] = SILVER_RULES) -> DataFrame:
    """Values outside their accepted domain: (column, value, rows)."""
    domains: list[Rule] = [r for r in rules if isinstance(r, AcceptedValues)]
    return _one_pass(df, domains).select("column", "value", "rows")


def dq_report(df: DataFrame, rules: list[Rule] = SILVER_RULES) -> DataFrame:
    """One row per check: (check, column, failures, failing_rows, passed).

    ``failures`` counts NULL rows for ``not_null``, repeated values for ``unique``
    and distinct foreign values for ``accepted_values``.
    """
    found = _one_pass(df, [r for r in rules if not isinstance(r, Unique)]).select(
        "check",
        "column",
        F.when(F.col("value").isNull(), F.col("rows")).otherwise(1).alias("failures"),
        F.col("rows").alias("failing_rows"),
    )
    for rule in rules:
        if isinstance(rule, Unique):
            found = found.unionByName(
                duplicate_values(df, rule.column).select(
                    F.lit(rule.check).alias("check"),
                    F.lit(rule.column).alias("column"),
                    F.lit(1).cast("bigint").alias("failures"),
                    F.col("copies").alias("failing_rows"),
                )
            )
    # One zero per rule keeps the rules that found nothing in the report.
    none = F.lit(0).cast("bigint")
    listed = [
        F.struct(
            F.lit(r.check).alias("check"),
            F.lit(r.column).alias("column"),
            none.alias("failures"),
            none.alias("failing_rows"),
        )
        for r in rules
    ]
    zeros = df.sparkSession.range(1).select(F.inline(F.array(*listed)))
    return (
        found.unionByName(zeros)
        .groupBy("check", "column")
        .agg(F.sum("failures").alias("failures"), F.sum("failing_rows").alias("failing_rows"))
        .withColumn("passed", F.col("failures") == 0)
    )


def enforce(report: DataFrame) -> None:
    """Stop the job when a check failed. Reads one row per rule, never events."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        text = ", ".join(f"{r['check']}({r['column']}): {r['failures']}" for r in failed)
        raise QualityError(text)
