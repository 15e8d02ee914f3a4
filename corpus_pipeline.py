"""From raw documents to packed training sequences: each stage works on all that the one before it kept.

Stages keep the columns of ``documents`` (doc_id, text, lang, source, n_chars), the last one returns token pieces with their places in
sequences. Other columns are kept whatever their names are: the four filtering stages carry a row in one struct. Rows are told apart by a number of their own, so null and repeated ids are no matter. An empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm.decontaminate import decontaminate
from propensity.llm.near_duplicates import near_duplicates
from propensity.llm.packing import packed_documents
from propensity.llm.quality import selected
from propensity.llm.secrets import secret_spans
from propensity.session import materialize, small_batches

ROW = "row_number"


def wrapped(docs: DataFrame) -> DataFrame:
    """(doc_id, text, whole): the other columns are in ``whole`` by their places, so no name of a stage's own meets one of theirs."""
    small_batches(docs.sparkSession)
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    return docs.select("doc_id", "text", F.struct(*others).alias("whole"))


def unwrapped(rows: DataFrame, docs: DataFrame, **values) -> DataFrame:
    """The columns of ``docs`` from ``wrapped`` rows, with ``values`` in place of some."""
    return rows.select(*[values.get(c, F.col("text") if c == "text" else F.col(f"whole.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def numbered(docs: DataFrame) -> DataFrame:
    """The wrapped rows with a number each, written once so that the numbers hold in every later job."""
    return materialize(wrapped(docs).withColumn(ROW, F.monotonically_increasing_id()))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of good quality is below one half go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return unwrapped(selected(wrapped(docs), labels).where("keep"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id stays."""
    rows = numbered(docs)
    classes = near_duplicates(rows.select(F.struct("doc_id", ROW).alias("key"), "text"), "key")
    return unwrapped(rows.join(classes.where("first").select(f"key.{ROW}"), ROW, "left_semi"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    rows = numbered(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = decontaminate(rows, items, doc_id=ROW).where("n_hit > 0").select(ROW)
    return unwrapped(rows.join(hit, ROW, "left_anti"), docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    rows = secret_spans(wrapped(docs), marked="marked")
    values = {"text": F.coalesce("marked", "text")}
    if "n_chars" in docs.columns:
        kept = F.col(f"whole.c{docs.columns.index('n_chars')}")
        values["n_chars"] = F.when(F.col("marked").isNotNull(), F.length("marked").cast("long")).otherwise(kept)
    return unwrapped(rows, docs, **values)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    small_batches(spark)
    return packed_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]
#: Model fits, sketches and tokenizers are no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; what a stage returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
