"""The given tables seen as tables to be ranked."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.session import materialize, prepare_session
from propensity.spec import ROW_NUMBER, TableSpec

ORDER_LEADS = TableSpec(
    id="lead_id",
    time="created_at",
    target="converted",
    numeric=("total_price", "account_balance", "line_count", "quantity", "max_discount", "discounted"),
    categorical=("priority", "segment", "nation"),
    binary=("discounted",),
    ranges={
        "total_price": (0, 1_000_000_000),
        "account_balance": (-10_000, 10_000),
        "line_count": (0, 10_000),
        "max_discount": (0, 100),
    },
    questionable=("total_price", "max_discount", "discounted"),
    tie_break=("lead_id",),
)

# The same leads as a text file would hold them.
ORDER_LEADS_TEXT = replace(
    ORDER_LEADS,
    source_columns=("lead_id", "created_at", *ORDER_LEADS.categorical, *ORDER_LEADS.numeric, "converted"),
    tie_break=(ROW_NUMBER,),
)

LINE_RECORDS = TableSpec(
    id="record_id",
    time="l_shipdate",
    target="returned",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_linestatus",),
    tie_break=("l_partkey", "l_suppkey", "l_extendedprice"),
    derive_time_parts=False,
)

EVENTS = TableSpec(
    id="event_id",
    time="ts",
    target="purchased",
    numeric=("value", "user_id"),
    categorical=("event_type",),
    ranges={"value": (0, 60), "user_id": (0, 1_000_000)},
    tie_break=("event_id",),
)

DOCUMENTS = TableSpec(
    id="doc_id",
    time="",
    target="toxic",
    numeric=("n_chars",),
    categorical=("lang", "source"),
    derive_time_parts=False,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def order_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its customer, nation and line totals; orders without lines keep nulls."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").cast("double").alias("line_count"),
            F.sum("l_quantity").alias("quantity"),
            F.max("l_discount").alias("max_discount"),
        )
    )
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )
    return joined.select(
        F.col("o_orderkey").cast("string").alias("lead_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"),
        F.col("o_totalprice").alias("total_price"),
        F.col("c_acctbal").alias("account_balance"),
        "line_count",
        "quantity",
        "max_discount",
        (F.col("max_discount") >= 0.08).cast("double").alias("discounted"),
        (F.col("o_orderstatus") == "F").cast("int").alias("converted"),
    )


def kept_order_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, joined once and written, for queries that pass over the leads several times."""
    return materialize(order_leads(spark, sf_dir))


def rational_score(value: Column, half: float, digits: int = 6) -> Column:
    """A score in [0, 1) made of + − × ÷ and floor only, so that every engine gets the same bits."""
    scale = float(10**digits)
    return F.floor(value / (value + half) * scale) / scale


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label, score, created_at) from the orders table alone, with a score that has many ties."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        rational_score(F.col("o_totalprice"), 200000.0, 4).alias("score"),
        F.col("o_orderdate").alias("created_at"),
    )


def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, keyed by order and line number, with real duplicates."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("record_id"),
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_linestatus",
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )


def event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw text in which blanks, junk and out-of-range cells were put by rule on the id."""
    e = table(spark, sf_dir, "events")
    key = F.col("event_id")
    value = (
        F.when(key % 97 == 0, "  ")
        .when(key % 89 == 0, "")
        .when(key % 83 == 0, "1d")
        .when(key % 79 == 0, "nan")
        .when(key % 73 == 0, "1e3")
        .otherwise(F.floor(F.col("value") * 100).cast("long").cast("string"))
    )
    kind = F.when(key % 61 == 0, "").when(key % 59 == 0, " ").otherwise(F.col("event_type"))
    at = F.when(key % 101 == 0, "12:30").when(key % 103 == 0, "").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return e.select(
        F.when(key % 113 == 0, " ").otherwise(key.cast("string")).alias("event_id"),
        at.alias("ts"),
        kind.alias("event_type"),
        value.alias("value"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(key % 107 == 0, "2").otherwise((F.col("event_type") == "purchase").cast("int").cast("string")).alias("purchased"),
        key.alias("source_row_number"),
    )


EVENT_TEXT = TableSpec(
    id="event_id",
    time="ts",
    target="purchased",
    numeric=("value", "user_id"),
    categorical=("event_type",),
    ranges={"value": (0, 60_00), "user_id": (0, 1_000_000)},
)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their label where there is one; the text itself is not read."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
