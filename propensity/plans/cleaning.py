"""Typing, validation, quarantine and derived time parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators.clean import coerce, derive_time_parts, keep_earliest, quarantine, violation_counts
from propensity.plans import sql
from propensity.plans.bindings import EVENT_TEXT, EVENTS, event_text, table
from propensity.plans.registry import query

_TYPED = f"WITH {sql.EVENT_TEXT}, {sql.TYPED}"
_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {broken} THEN '{rule}' END" for rule, broken in sql.EVENT_RULES) + ")"
_TIME = "yyyy-MM-dd HH:mm:ss"


def _shown(df: DataFrame, *more: str) -> DataFrame:
    at = F.date_format("ts", _TIME).alias("ts")
    return df.select("source_row_number", "event_id", at, "event_type", "value", "user_id", "purchased", *more)


@query(f"""{_TYPED} SELECT source_row_number, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value, user_id,
  purchased FROM typed""")
def clean_text_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cells from text under the three blank rules."""
    return _shown(coerce(event_text(spark, sf_dir), EVENT_TEXT))


@query(_TYPED + " " + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) FILTER ({broken}) AS rows FROM typed" for rule, broken in sql.EVENT_RULES
))
def validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break each rule."""
    return violation_counts(event_text(spark, sf_dir), EVENT_TEXT)


@query(f"{_TYPED} SELECT source_row_number, {_REASONS} AS reasons FROM typed WHERE {_REASONS} <> ''")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows set aside, with every rule they break."""
    _, bad = quarantine(event_text(spark, sf_dir), EVENT_TEXT)
    return bad.select("source_row_number", F.concat_ws(",", "reasons").alias("reasons"))


@query(f"""{_TYPED}, kept AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts, source_row_number) AS nth
  FROM typed WHERE {_REASONS} = '')
SELECT source_row_number, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value, user_id, purchased,
       CAST(hour(ts) AS DOUBLE) AS created_hour, CAST(isodow(ts) - 1 AS DOUBLE) AS created_day_of_week
FROM kept WHERE nth = 1""")
def clean_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean frame of the rows that pass: typed, earliest per id, time parts derived."""
    good, _ = quarantine(event_text(spark, sf_dir), EVENT_TEXT)
    clean = derive_time_parts(keep_earliest(good, EVENT_TEXT), EVENT_TEXT)
    return _shown(clean, "created_hour", "created_day_of_week")


@query("""SELECT event_id, CAST(hour(ts) AS DOUBLE) AS created_hour, CAST(isodow(ts) - 1 AS DOUBLE) AS created_day_of_week,
  strftime(ts, '%Y-%m') AS month FROM events""")
def derive_time_parts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour, weekday (Monday = 0) and month of every event."""
    parts = derive_time_parts(table(spark, sf_dir, "events"), EVENTS)
    return parts.select("event_id", "created_hour", "created_day_of_week", F.date_format("ts", "yyyy-MM").alias("month"))
