"""Ranking, tiers, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators import quality
from propensity.operators.clean import keep_earliest
from propensity.operators.scoring import rank_leads, top_leads
from propensity.plans import sql
from propensity.plans.bindings import LINE_RECORDS, line_records, order_leads, rational_score
from propensity.plans.registry import query

FRACTION = 0.1

_LISTED = f"""WITH {sql.LEADS},
listed AS (
  SELECT lead_id, floor(x / (x + 2e5) * 1e6) / 1e6 AS purchase_probability
  FROM (SELECT lead_id, total_price + 1000 * coalesce(quantity, 0) AS x FROM leads)),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY purchase_probability DESC, lead_id) AS priority_rank, count(*) OVER () AS n FROM listed),
tiered AS (
  SELECT lead_id, purchase_probability, priority_rank,
         CASE WHEN priority_rank <= ceil(CAST(n AS DOUBLE) * 0.1e0) THEN 'call' ELSE 'backlog' END AS priority_tier
  FROM ranked)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("total_price") + 1000 * F.coalesce("quantity", F.lit(0.0))
    return order_leads(spark, sf_dir).select("lead_id", rational_score(value, 200000.0).alias("score"))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_leads(_scored(spark, sf_dir), FRACTION, id="lead_id")


@query(f"{_LISTED} SELECT * FROM tiered")
def rank_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order scored, globally ranked and cut at the call capacity."""
    return _listed(spark, sf_dir)


@query(f"""{_LISTED} SELECT priority_tier, count(*) AS rows, min(priority_rank) AS first_rank, max(priority_rank) AS last_rank
FROM tiered GROUP BY priority_tier""")
def tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir).groupBy("priority_tier").agg(
        F.count("*").alias("rows"), F.min("priority_rank").alias("first_rank"), F.max("priority_rank").alias("last_rank")
    )


@query(f"{_LISTED} SELECT * FROM tiered ORDER BY priority_rank LIMIT 100")
def top_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the hundred best leads."""
    return top_leads(_scored(spark, sf_dir), FRACTION, 100, id="lead_id")


@query(f"""WITH {sql.LINES}
SELECT record_id, strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_partkey, l_suppkey, l_extendedprice, returned FROM (
  SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS nth
  FROM records) WHERE nth = 1""")
def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest record per id."""
    return keep_earliest(line_records(spark, sf_dir), LINE_RECORDS).select(
        "record_id",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "returned",
    )


@query(f"""WITH {sql.LINES}
SELECT 'duplicate_rows' AS measure,
       (SELECT count(*) FROM records) - (SELECT count(*) FROM (SELECT DISTINCT * FROM records)) AS duplicates
UNION ALL SELECT 'duplicate_ids', (SELECT count(*) FROM records) - (SELECT count(DISTINCT record_id) FROM records)""")
def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = line_records(spark, sf_dir)
    return quality.duplicate_counts(records, LINE_RECORDS, records.columns)


@query(f"""WITH {sql.LINES}
SELECT record_id, count(*) AS rows, min(returned) AS low, max(returned) AS high FROM records
GROUP BY record_id HAVING min(returned) < max(returned)""")
def target_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.conflicting_targets(line_records(spark, sf_dir), LINE_RECORDS)


@query(f"""WITH {sql.LINES},
kept AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS nth
         FROM records)
SELECT 'raw' AS stage, round(avg(returned), 9) AS prevalence FROM records
UNION ALL SELECT 'deduplicated', round(avg(returned), 9) FROM kept WHERE nth = 1""")
def prevalence_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = line_records(spark, sf_dir)
    stages = quality.prevalence_before_after(records, keep_earliest(records, LINE_RECORDS), LINE_RECORDS)
    return stages.select("stage", F.round("prevalence", 9).alias("prevalence"))
