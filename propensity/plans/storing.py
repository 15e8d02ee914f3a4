"""Ingestion, stored tables and their constraints, built from the order leads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators.integrity import Constraints, absent_rows, constraint_violations, upsert
from propensity.operators.scoring import rank_leads
from propensity.plans import sql
from propensity.plans.bindings import (
    EVENT_TEXT,
    ORDER_LEADS_TEXT,
    event_text,
    line_records,
    order_leads,
    scored_orders,
    table,
)
from propensity.plans.registry import query
from propensity.session import materialize, shared_dir
from propensity.sources.store import CONSTRAINTS, ScoringBatch, Store, latest_scores, now, top_leads
from propensity.sources.text_files import number_rows, read_text_csv, write_text_csv
from propensity.spec import ROW_NUMBER, DataContractError


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stores/{uuid.uuid4().hex}"


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as scored batches: one per nation, completed when its last order came in; some failed."""
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    batches = orders.groupBy(F.col("c_nationkey").cast("string").alias("scoring_batch_id")).agg(
        F.max("o_orderdate").alias("completed_at"),
        F.when(F.min("c_nationkey") % 3 == 0, "failed").otherwise("succeeded").alias("status"),
    )
    scores = orders.select(
        F.col("c_nationkey").cast("string").alias("scoring_batch_id"),
        F.col("o_orderkey").cast("string").alias("lead_id"),
        F.col("o_orderkey").alias("priority_rank"),
        F.col("o_totalprice").alias("amount"),
    )
    return scores, batches


_BATCHES = """batches AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS scoring_batch_id, max(o_orderdate) AS completed_at,
         CASE WHEN min(c_nationkey) % 3 = 0 THEN 'failed' ELSE 'succeeded' END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey),
scores AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS scoring_batch_id, CAST(o_orderkey AS VARCHAR) AS lead_id,
         o_orderkey AS priority_rank, o_totalprice AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey),
newest AS (
  SELECT scoring_batch_id FROM batches WHERE status = 'succeeded'
  ORDER BY completed_at DESC, scoring_batch_id DESC LIMIT 1)"""


@query(f"WITH {_BATCHES} SELECT * FROM scores WHERE scoring_batch_id = (SELECT scoring_batch_id FROM newest)")
def latest_batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the newest succeeded batch."""
    return latest_scores(*_batches(spark, sf_dir))


@query(f"""WITH {_BATCHES} SELECT * FROM scores WHERE scoring_batch_id = (SELECT scoring_batch_id FROM newest)
ORDER BY priority_rank LIMIT 100""")
def top_of_latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of its first hundred rows."""
    return top_leads(*_batches(spark, sf_dir))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS source_hash, max(o_orderkey) AS newest FROM orders GROUP BY o_custkey
HAVING o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders that are not registered yet (those of one segment are)."""
    known = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    arrived = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("source_hash"))
    return absent_rows(
        arrived.agg(F.max("o_orderkey").alias("newest")),
        known.select(F.col("c_custkey").cast("string").alias("source_hash")),
        ["source_hash"],
    )


@query("""SELECT coalesce(n.column_name, o.column_name) AS column_name, coalesce(n.description, o.description) AS description
FROM (SELECT c_name AS column_name, c_mktsegment AS description FROM customer) o
FULL JOIN (SELECT c_name AS column_name, 'order ' || max(o_orderkey) AS description
           FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' GROUP BY c_name) n
ON o.column_name = n.column_name""")
def upsert_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions by customer, replaced for those with a pending order."""
    customers = table(spark, sf_dir, "customer")
    old = customers.select(F.col("c_name").alias("column_name"), F.col("c_mktsegment").alias("description"))
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    new = (
        pending.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_name").alias("column_name"))
        .agg(F.concat(F.lit("order "), F.max("o_orderkey").cast("string")).alias("description"))
    )
    return upsert(old, new, ["column_name"])


_LINE_RULES = Constraints(
    not_null=("record_id", "l_quantity"),
    unique=(("record_id",), ("record_id", "l_partkey", "l_suppkey")),
    checks={"quantity": "l_quantity > 1", "tax": "l_tax <= 0.07"},
    references={("l_partkey",): ("part", ("p_partkey",)), ("order_key",): ("orders", ("o_orderkey",))},
)


@query(f"""WITH {sql.LINES} SELECT 'not_null:record_id' AS "constraint", count(*) FILTER (record_id IS NULL) AS violations FROM records
UNION ALL SELECT 'not_null:l_quantity', count(*) FILTER (l_quantity IS NULL) FROM records
UNION ALL SELECT 'check:quantity', count(*) FILTER (NOT l_quantity > 1) FROM records
UNION ALL SELECT 'check:tax', count(*) FILTER (NOT l_tax <= 0.07e0) FROM records
UNION ALL SELECT 'unique:record_id', count(*) FROM (SELECT 1 FROM records GROUP BY record_id HAVING count(*) > 1)
UNION ALL SELECT 'unique:record_id,l_partkey,l_suppkey', count(*) FROM (
  SELECT 1 FROM records GROUP BY record_id, l_partkey, l_suppkey HAVING count(*) > 1)
UNION ALL SELECT 'references:l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'references:order_key', count(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def constraint_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken not-null, check, unique and reference constraints of the line records."""
    records = line_records(spark, sf_dir).withColumn("order_key", F.split_part("record_id", F.lit("-"), F.lit(1)).cast("long"))
    parents = {
        "part": table(spark, sf_dir, "part"),
        "orders": table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'"),
    }
    return constraint_violations(records, _LINE_RULES, parents)


_CSV = tuple(EVENT_TEXT.columns)


@query(f"""WITH {sql.EVENT_TEXT} SELECT {', '.join(_CSV)}, row_number() OVER (ORDER BY source_row_number) AS source_row_number
FROM raw""")
def ingest_numbered_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as text files in id order, read back strictly and numbered in file order."""
    folder = _folder(spark)
    ordered = event_text(spark, sf_dir).orderBy("source_row_number").select(*_CSV)
    write_text_csv(ordered, folder)
    return number_rows(read_text_csv(spark, folder, _CSV)).select(*_CSV, ROW_NUMBER)


@query(f"""WITH {sql.SCORED}, ranked AS (
  SELECT id AS lead_id, score AS purchase_probability, row_number() OVER (ORDER BY score DESC, id) AS priority_rank,
         count(*) OVER () AS n FROM scored)
SELECT lead_id, purchase_probability, priority_rank,
       CASE WHEN priority_rank <= ceil(CAST(n AS DOUBLE) * 0.1e0) THEN 'call' ELSE 'backlog' END AS priority_tier FROM ranked""")
def stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked orders written twice under one batch id, with lineage, and read back once."""
    store = Store(spark, _folder(spark))
    store.initialize()
    moment = now()
    batch = ScoringBatch(str(uuid.uuid4()), "rule-v1", "orders", moment, moment, moment)
    store.register_source("orders", "orders.parquet", table(spark, sf_dir, "orders").count())
    ranked = _with_lineage(rank_leads(scored_orders(spark, sf_dir), 0.1), batch)
    store.write_scores(ranked, batch)
    store.write_scores(ranked, batch)
    return store.load_latest_scores().select("lead_id", "purchase_probability", "priority_rank", "priority_tier")


def _with_lineage(ranked: DataFrame, batch: ScoringBatch) -> DataFrame:
    lineage = {
        "scoring_batch_id": F.lit(batch.scoring_batch_id),
        "scored_at": F.lit(batch.completed_at),
        "model_version": F.lit(batch.model_version),
        "data_as_of": F.lit(batch.data_as_of),
    }
    return ranked.withColumns(lineage)


@query("""SELECT 'good' AS batch, '' AS broken, (SELECT count(*) FROM orders) AS visible
UNION ALL SELECT 'probability', 'check:purchase_probability', 0
UNION ALL SELECT 'rank', 'unique:scoring_batch_id,priority_rank', 0
UNION ALL SELECT 'tier', 'check:priority_tier', 0
UNION ALL SELECT 'missing', 'not_null:lead_id', 0
UNION ALL SELECT 'source', 'references:source_hash', 0""")
def guarded_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that break one rule each are refused with the rule's name and stay invisible; the good one is stored."""
    store = Store(spark, _folder(spark))
    store.initialize()
    moment = now()
    store.register_source("orders", "orders.parquet", table(spark, sf_dir, "orders").count())
    ranked = materialize(rank_leads(scored_orders(spark, sf_dir), 0.1))
    second = F.col("priority_rank") == 2
    versions = {
        "good": ranked,
        "probability": ranked.withColumn("purchase_probability", F.when(second, 1.7).otherwise(F.col("purchase_probability"))),
        "rank": ranked.withColumn("priority_rank", F.when(second, 1).otherwise(F.col("priority_rank")).cast("long")),
        "tier": ranked.withColumn("priority_tier", F.when(second, "maybe").otherwise(F.col("priority_tier"))),
        "missing": ranked.withColumn("lead_id", F.when(~second, F.col("lead_id"))),
        "source": ranked,
    }
    outcomes = []
    for name, rows in versions.items():
        batch = ScoringBatch(name, "rule-v1", "unknown" if name == "source" else "orders", moment, moment, moment)
        broken = ""
        try:
            store.write_scores(_with_lineage(rows, batch), batch)
        except DataContractError as error:
            broken = str(error).split("breaks ")[1].rsplit(" (", 1)[0]
        outcomes.append((name, broken))
    committed = store.table("scoring_batches").select(F.col("scoring_batch_id").alias("batch"), F.col("row_count").alias("visible"))
    found = spark.createDataFrame(outcomes, "batch string, broken string")
    return found.join(committed, "batch", "left").select("batch", "broken", F.coalesce("visible", F.lit(0).cast("long")).alias("visible"))


@query(f"""WITH {sql.LEADS} SELECT (SELECT count(*) FROM leads) AS rows, 1 AS batches, 0 AS violations""")
def stored_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order leads ingested twice from text: one batch, every row once, no constraint broken."""
    folder = _folder(spark)
    leads = order_leads(spark, sf_dir).select(*ORDER_LEADS_TEXT.columns)
    write_text_csv(leads, f"{folder}/input")
    store = Store(spark, f"{folder}/tables", ORDER_LEADS_TEXT)
    store.initialize()
    store.ingest_csv(f"{folder}/input")
    source_hash = store.ingest_csv(f"{folder}/input")
    raw, _ = store.load_raw(source_hash)
    broken = constraint_violations(
        store.table("raw_leads"), CONSTRAINTS["raw_leads"], {"ingestion_batches": store.table("ingestion_batches")}
    )
    facts = [
        raw.agg(F.count("*").alias("v")).select(F.lit("rows").alias("k"), "v"),
        store.table("ingestion_batches").agg(F.count("*").alias("v")).select(F.lit("batches").alias("k"), "v"),
        broken.agg(F.sum("violations").alias("v")).select(F.lit("violations").alias("k"), "v"),
    ]
    long = facts[0].unionByName(facts[1]).unionByName(facts[2])
    return long.agg(
        F.max(F.when(F.col("k") == "rows", F.col("v"))).alias("rows"),
        F.max(F.when(F.col("k") == "batches", F.col("v"))).cast("int").alias("batches"),
        F.max(F.when(F.col("k") == "violations", F.col("v"))).cast("int").alias("violations"),
    )
