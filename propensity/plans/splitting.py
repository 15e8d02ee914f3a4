"""Chronological split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators.integrity import overlap
from propensity.operators.order import quantiles
from propensity.operators.split import chronological_split, cutoffs, split_summary
from propensity.plans import sql
from propensity.plans.bindings import EVENTS, ORDER_LEADS, kept_order_leads, table
from propensity.plans.registry import query

_PARTS = f"WITH {sql.LEADS}, {sql.split('leads')}"
_EVENT_PARTS = f"WITH leads AS (SELECT event_id, ts AS created_at, event_type FROM events), {sql.split('leads')}"


@query(f"{_PARTS} SELECT strftime(t1, '%Y-%m-%d') AS train_cutoff, strftime(t2, '%Y-%m-%d') AS validation_cutoff FROM cuts")
def split_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two cutoff dates, chosen on the whole table."""
    leads = kept_order_leads(spark, sf_dir)
    first, second = chronological_split(leads, ORDER_LEADS, check=False).cutoffs
    return spark.createDataFrame([(f"{first:%Y-%m-%d}", f"{second:%Y-%m-%d}")], "train_cutoff string, validation_cutoff string")


@query(f"{_EVENT_PARTS} SELECT epoch_us(t1) AS train_micros, epoch_us(t2) AS validation_micros FROM cuts")
def split_cutoffs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a table without equal times, to the microsecond."""
    pair = cutoffs(table(spark, sf_dir, "events"), EVENTS.time)
    return spark.createDataFrame([pair], "train_micros long, validation_micros long")


@query(f"""{_PARTS} SELECT split, count(*) AS rows, CAST(sum(converted) AS BIGINT) AS positives,
  round(avg(converted), 9) AS prevalence, strftime(min(created_at), '%Y-%m-%d') AS created_min,
  strftime(max(created_at), '%Y-%m-%d') AS created_max FROM parts GROUP BY split""")
def split_summary_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, positives, prevalence and time span of each part."""
    summary = split_summary(chronological_split(kept_order_leads(spark, sf_dir), ORDER_LEADS, check=False), ORDER_LEADS)
    return summary.withColumns(
        {
            "prevalence": F.round("prevalence", 9),
            "created_min": F.date_format("created_min", "yyyy-MM-dd"),
            "created_max": F.date_format("created_max", "yyyy-MM-dd"),
        }
    )


@query(f"{_PARTS} SELECT lead_id, split FROM parts")
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of every row."""
    return chronological_split(kept_order_leads(spark, sf_dir), ORDER_LEADS, check=False).frame.select("lead_id", "split")


@query(f"""{_PARTS} SELECT 'train-validation' AS parts, count(*) AS shared FROM (
  SELECT lead_id FROM parts WHERE split = 'train' INTERSECT SELECT lead_id FROM parts WHERE split = 'validation')
UNION ALL SELECT 'train-test', count(*) FROM (
  SELECT lead_id FROM parts WHERE split = 'train' INTERSECT SELECT lead_id FROM parts WHERE split = 'test')
UNION ALL SELECT 'validation-test', count(*) FROM (
  SELECT lead_id FROM parts WHERE split = 'validation' INTERSECT SELECT lead_id FROM parts WHERE split = 'test')""")
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids shared by two parts: none."""
    split = chronological_split(kept_order_leads(spark, sf_dir), ORDER_LEADS, check=False)

    def shared(a: str, b: str) -> DataFrame:
        both = overlap(split.part(a), split.part(b), "lead_id")
        return both.agg(F.count("*").alias("shared")).select(F.lit(f"{a}-{b}").alias("parts"), "shared")

    return shared("train", "validation").unionByName(shared("train", "test")).unionByName(shared("validation", "test"))


_QUANTILE_COLUMNS = ("total_price", "line_count", "quantity")


@query(f"""WITH {sql.LEADS}, cells AS ({sql.cells("leads", _QUANTILE_COLUMNS)}), {sql.points("q", "cells", sql.DECILES)}
SELECT feature, CAST(k AS INTEGER) AS decile, value FROM q""")
def exact_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interpolated deciles, equal to the last bit."""
    shares = [k * 0.1 for k in range(10)] + [1.0]
    found = quantiles(kept_order_leads(spark, sf_dir), _QUANTILE_COLUMNS, shares)
    rows = [(c, k, x) for c, xs in found.items() for k, x in enumerate(xs)]
    return spark.createDataFrame(rows, "feature string, decile int, value double")
