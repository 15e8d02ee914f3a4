"""Data-quality measures over the bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators import quality
from propensity.plans import sql
from propensity.plans.bindings import (
    EVENT_TEXT,
    ORDER_LEADS,
    event_text,
    kept_order_leads,
    labelled_documents,
    order_leads,
    table,
)
from propensity.plans.registry import query
from propensity.operators.clean import derive_time_parts
from propensity.spec import HOUR, WEEKDAY

_NUMERIC = ("total_price", "account_balance", "line_count", "quantity", "max_discount")


@query(f"""WITH {sql.EVENT_TEXT} """ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL OR {c} = '') AS missing FROM raw" for c in EVENT_TEXT.columns
))
def missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty raw cells per column; whitespace is not empty here."""
    return quality.missing_counts(event_text(spark, sf_dir), EVENT_TEXT.columns)


@query(f"""WITH {sql.LEADS} """ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM leads" for c in ORDER_LEADS.categorical
))
def cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cardinality(order_leads(spark, sf_dir), ORDER_LEADS.categorical)


_COUNTED = """SELECT 'customer' AS "column", CAST(o_custkey AS VARCHAR) AS value, count(*) AS rows FROM orders GROUP BY ALL
  UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY ALL"""


@query(f"""SELECT "column", coalesce(value, 'nan') AS value, rows FROM ({_COUNTED})
WHERE rows < (SELECT greatest(20, CAST(floor(count(*) * 0.001e0) AS BIGINT)) FROM orders)""")
def rare_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and priorities seen too rarely."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("customer"), F.col("o_orderpriority").alias("priority")
    )
    return quality.rare_categories(orders, ["customer", "priority"])


@query(f"""WITH {sql.LEADS}, cells AS ({sql.cells("leads", _NUMERIC)}), {sql.points("quartiles", "cells", sql.QUARTILES)},
fences AS (SELECT feature, max(CASE WHEN k = 0 THEN value END) AS q1, max(CASE WHEN k = 1 THEN value END) AS q3
           FROM quartiles GROUP BY feature)
SELECT c.feature AS "column", count(*) FILTER (value < q1 - 3.0 * (q3 - q1) OR value > q3 + 3.0 * (q3 - q1)) AS outliers
FROM cells c JOIN fences f ON c.feature = f.feature GROUP BY c.feature""")
def outlier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values beyond three interquartile ranges."""
    return quality.outlier_counts(kept_order_leads(spark, sf_dir), _NUMERIC)


@query("""WITH q AS (
  SELECT a.value AS q1, b.value AS q3 FROM
    (SELECT quantile_cont(value, 0.25) AS value FROM events) a, (SELECT quantile_cont(value, 0.75) AS value FROM events) b)
SELECT 'value' AS "column", count(*) FILTER (value < q1 - 0.5 * (q3 - q1) OR value > q3 + 0.5 * (q3 - q1)) AS outliers
FROM events CROSS JOIN q""")
def outlier_counts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a narrow reach, so that there are some."""
    return quality.outlier_counts(table(spark, sf_dir, "events"), ["value"], reach=0.5)


@query(f"""WITH {sql.LEADS} SELECT strftime(created_at, '%Y-%m') AS month, count(converted) AS rows,
round(avg(converted), 9) AS rate FROM leads GROUP BY month""")
def monthly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = quality.monthly_rate(order_leads(spark, sf_dir), ORDER_LEADS)
    return rates.withColumn("rate", F.round("rate", 9))


def _decile_sql(column: str) -> str:
    return f"""WITH {sql.LEADS}, cells AS ({sql.cells("leads", (column,))}), {sql.bins("bins", "cells")}
SELECT CAST(bin + 1 AS INTEGER) AS bucket, count(*) AS rows, round(avg(converted), 9) AS rate
FROM leads JOIN bins ON ({column} > lo OR bin = 0) AND ({column} <= hi OR bin = bins - 1) WHERE {column} IS NOT NULL GROUP BY bin"""


def _decile(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    rates = quality.decile_rate(kept_order_leads(spark, sf_dir), column, "converted")
    return rates.withColumn("rate", F.round("rate", 9))


@query(_decile_sql("total_price"))
def decile_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversion by decile of a continuous column."""
    return _decile(spark, sf_dir, "total_price")


@query(_decile_sql("line_count"))
def decile_rate_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversion by decile of a column whose decile edges repeat."""
    return _decile(spark, sf_dir, "line_count")


_SENTINELS = ("1d", "nan", "12:30", "-999", "unknown")


@query(f"WITH {sql.EVENT_TEXT} " + " UNION ALL ".join(
    f"SELECT '{s}' AS sentinel, CAST(sum("
    + " + ".join(f"CAST(trim({c}) = '{s}' AS BIGINT)" for c in EVENT_TEXT.columns)
    + ") AS BIGINT) AS cells FROM raw"
    for s in _SENTINELS
))
def sentinel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sentinel_counts(event_text(spark, sf_dir), EVENT_TEXT.columns, _SENTINELS)


@query("""WITH docs AS (SELECT d.doc_id, lang, source, CAST(toxic AS VARCHAR) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)),
counts AS (
  SELECT 'lang' AS "column", lang AS value, count(*) AS n FROM docs GROUP BY ALL
  UNION ALL SELECT 'source', source, count(*) FROM docs GROUP BY ALL
  UNION ALL SELECT 'toxic', toxic, count(*) FROM docs GROUP BY ALL)
SELECT "column", round(max(n) / sum(n), 9) AS top_share FROM counts GROUP BY "column" HAVING max(n) / sum(n) >= 0.3""")
def near_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns dominated by one value."""
    found = quality.near_constant(labelled_documents(spark, sf_dir), ["lang", "source", "toxic"], share=0.3)
    return found.withColumn("top_share", F.round("top_share", 9))


@query("""SELECT round(avg(CAST(regexp_full_match(c_name, 'Customer#[0-9]{9}') AS DOUBLE)), 9) AS pattern_share,
  max(CAST(right(c_name, 9) AS BIGINT)) - min(CAST(right(c_name, 9) AS BIGINT)) + 1 = count(DISTINCT c_name) AS sequential,
  count(*) - count(DISTINCT c_name) AS repeated_ids FROM customer""")
def id_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.id_pattern(table(spark, sf_dir, "customer"), "c_name", r"^Customer#\d{9}$")
    return found.withColumn("pattern_share", F.round("pattern_share", 9))


_LINE_COLUMNS = ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_suppkey")


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS groups, coalesce(sum(n), 0)::BIGINT AS rows FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY {", ".join(x for x in _LINE_COLUMNS if x != c)} HAVING count(DISTINCT {c}) > 1)"""
    for c in _LINE_COLUMNS
))
def near_duplicate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines that agree in all listed columns but one."""
    return quality.near_duplicate_records(table(spark, sf_dir, "lineitem"), _LINE_COLUMNS)


_EFFECT_NUMERIC = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, coalesce(abs(avg({x}) FILTER (converted = 1) - avg({x}) FILTER (converted = 0))
    / nullif(sqrt((var_pop({x}) FILTER (converted = 1) + var_pop({x}) FILTER (converted = 0)) / 2), 0), 0) AS effect FROM leads"""
    for c, x in [(n, n) for n in ORDER_LEADS.numeric] + [(HOUR, "hour(created_at)"), (WEEKDAY, "isodow(created_at)")]
)
_EFFECT_CATEGORIES = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, sqrt(sum((pos - n * rate) * (pos - n * rate) / n) / any_value(rate * (1 - rate) * rows)) AS effect
  FROM (SELECT count(*) AS n, sum(converted) AS pos FROM leads GROUP BY {c})
  CROSS JOIN (SELECT avg(converted) AS rate, count(*) AS rows FROM leads)"""
    for c in ORDER_LEADS.categorical
)


@query(f"WITH {sql.LEADS} SELECT feature, round(effect, 9) AS effect FROM ({_EFFECT_NUMERIC} UNION ALL {_EFFECT_CATEGORIES})")
def effect_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each feature alone separates the two classes."""
    leads = derive_time_parts(order_leads(spark, sf_dir), ORDER_LEADS)
    return quality.effect_screen(leads, ORDER_LEADS).withColumn("effect", F.round("effect", 9))


_RAW_COLUMNS = ORDER_LEADS.columns


def _per_column(metric: str, columns, expression: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{metric}' AS metric, '{c}' AS \"column\", CAST({expression.format(c=c)} AS VARCHAR) AS value FROM leads" for c in columns
    )


_ALL_NUMERIC = ORDER_LEADS.numeric
_QUALITY_SQL = f"""WITH {sql.LEADS}, cells AS ({sql.cells("leads", _ALL_NUMERIC)}), {sql.points("quartiles", "cells", sql.QUARTILES)},
fences AS (SELECT feature, max(CASE WHEN k = 0 THEN value END) AS q1, max(CASE WHEN k = 1 THEN value END) AS q3
           FROM quartiles GROUP BY feature),
facts AS (
  SELECT count(*) AS rows, round(avg(converted), 9) AS prevalence, min(created_at) AS date_min, max(created_at) AS date_max,
         count(*) - count(DISTINCT lead_id) AS ids FROM leads)
SELECT 'rows_raw' AS metric, NULL AS "column", CAST(rows AS VARCHAR) AS value FROM facts
UNION ALL SELECT 'rows_clean', NULL, CAST(rows AS VARCHAR) FROM facts
UNION ALL SELECT 'columns', NULL, '{len(_RAW_COLUMNS)}'
UNION ALL SELECT 'target_prevalence', NULL, CAST(prevalence AS VARCHAR) FROM facts
UNION ALL SELECT 'date_min', NULL, CAST(date_min AS VARCHAR) FROM facts
UNION ALL SELECT 'date_max', NULL, CAST(date_max AS VARCHAR) FROM facts
UNION ALL SELECT 'duplicate_ids', NULL, CAST(ids AS VARCHAR) FROM facts
UNION ALL SELECT 'duplicate_rows', NULL, CAST(rows - (SELECT count(*) FROM (SELECT DISTINCT * FROM leads)) AS VARCHAR) FROM facts
UNION ALL {_per_column("missing_counts", _RAW_COLUMNS, "count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '')")}
UNION ALL {_per_column("cardinality", ORDER_LEADS.categorical, "count(DISTINCT {c})")}
UNION ALL SELECT 'outliers', c.feature, CAST(count(*) FILTER (value < q1 - 3.0 * (q3 - q1) OR value > q3 + 3.0 * (q3 - q1)) AS VARCHAR)
FROM cells c JOIN fences f ON c.feature = f.feature GROUP BY c.feature
UNION ALL SELECT 'rare_categories', "column", value FROM (
  """ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce({c}, 'nan') AS value, count(*) AS n FROM leads GROUP BY {c}" for c in ORDER_LEADS.categorical
) + """) WHERE n < (SELECT greatest(20, CAST(floor(rows * 0.001e0) AS BIGINT)) FROM facts)"""


@query(_QUALITY_SQL)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report as text values (the prevalence to nine digits)."""
    leads = kept_order_leads(spark, sf_dir)
    report = quality.quality_report(leads, derive_time_parts(leads, ORDER_LEADS), ORDER_LEADS)
    short = F.round(F.col("value").try_cast("double"), 9).cast("string")
    is_rate = F.col("metric") == "target_prevalence"
    return report.withColumn("value", F.when(is_rate, short).otherwise(F.col("value")))
