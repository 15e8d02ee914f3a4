"""Metrics of scored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators import metrics
from propensity.operators.bootstrap import bootstrap_interval, bootstrap_replicates, resampled
from propensity.operators.models import comparison
from propensity.operators.order import order_statistics
from propensity.operators.split import chronological_split
from propensity.plans import sql
from propensity.plans.bindings import ORDER_LEADS, kept_order_leads, rational_score, scored_orders
from propensity.plans.registry import query
from propensity.session import materialize
from propensity.spec import TableSpec

THRESHOLD, SEED, SAMPLES = 0.45, 42, 200
_SCORED = f"WITH {sql.SCORED}"
_TEST = f"{_SCORED}, {sql.split('scored')}, test AS (SELECT id, label, score FROM parts WHERE split = 'test')"

SCORED_SPEC = TableSpec(id="id", time="created_at", target="label", numeric=(), categorical=())


def scored_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later window of the scored orders, which is what intervals are computed on."""
    return chronological_split(scored_orders(spark, sf_dir), SCORED_SPEC, check=False).part("test")


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


_PROBABILITY = ("average_precision", "roc_auc", "log_loss", "brier_score")


@query(f"{_SCORED} SELECT {sql.PROBABILITY_METRICS} FROM ({sql.steps('scored')})")
def probability_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average precision, ROC-AUC, log loss and Brier score of a heavily tied score."""
    return rounded(metrics.probability_metrics(scored_orders(spark, sf_dir)), *_PROBABILITY)


@query(f"""{_SCORED} SELECT score, n, CAST(pos AS BIGINT) AS pos, CAST(cum_n AS BIGINT) AS cum_n, CAST(cum_pos AS BIGINT) AS cum_pos
FROM ({sql.steps('scored')})""")
def score_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running rows and positives down the distinct scores."""
    return metrics.score_steps(scored_orders(spark, sf_dir))


_CELLS = ("tn", "fp", "fn", "tp")
THRESHOLD_SQL = f"""SELECT rows, round(prevalence, 9) AS prevalence, {THRESHOLD}e0 AS operating_threshold,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1, tn, fp, fn, tp FROM (
  SELECT count(*) AS rows, avg(label) AS prevalence, count(*) FILTER (score < {THRESHOLD}e0 AND label = 0) AS tn,
    count(*) FILTER (score >= {THRESHOLD}e0 AND label = 0) AS fp, count(*) FILTER (score < {THRESHOLD}e0 AND label = 1) AS fn,
    count(*) FILTER (score >= {THRESHOLD}e0 AND label = 1) AS tp FROM scored)"""


@query(f"{_SCORED} {THRESHOLD_SQL}")
def threshold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts, precision, recall and F1 at a fixed threshold."""
    report = metrics.threshold_report(scored_orders(spark, sf_dir), THRESHOLD)
    return rounded(report, "prevalence", "precision", "recall", "f1")


def _capacity_sql(source: str, by: str = "", levels: str = "(0.01e0), (0.05e0), (0.1e0), (0.2e0)") -> str:
    keys, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""SELECT {keys}fraction, any_value(k) AS k,
    round(sum(label) FILTER (place <= k) / any_value(k), 9) AS precision_at_k,
    round(coalesce(sum(label) FILTER (place <= k) / nullif(sum(label), 0), 0), 9) AS recall_at_k,
    round(coalesce((sum(label) FILTER (place <= k) / any_value(k)) / nullif(sum(label) / count(*), 0), 0), 9) AS lift_at_k
  FROM (SELECT {keys}label, fraction, CAST(ceil(CAST(n AS DOUBLE) * fraction) AS BIGINT) AS k, place FROM (
    SELECT {keys}label, row_number() OVER ({part}ORDER BY score DESC, id) AS place, count(*) OVER ({part}) AS n FROM {source})
    CROSS JOIN (VALUES {levels}) f(fraction))
  GROUP BY {keys}fraction"""


@query(f"""{_SCORED} SELECT 'top_' || CAST(CAST(floor(fraction * 100) AS BIGINT) AS VARCHAR) || 'pct' AS level, *
FROM ({_capacity_sql('scored')})""")
def capacity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and lift at four capacities."""
    return rounded(metrics.capacity_table(scored_orders(spark, sf_dir)), "precision_at_k", "recall_at_k", "lift_at_k")


@query(f"""{_SCORED}, cells AS (SELECT 'score' AS feature, score AS value FROM scored),
{sql.points("q", "cells", "SELECT 0 AS k, 1 - 0.1e0 AS share")} SELECT value AS threshold FROM q""")
def score_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score above which the top tenth lies."""
    found = metrics.score_threshold(scored_orders(spark, sf_dir), 0.1)
    return spark.createDataFrame([(found,)], "threshold double")


@query(f"{_TEST}, {sql.replicates('test', SAMPLES, SEED)} SELECT replicate, round(average_precision, 9) AS average_precision, round(roc_auc, 9) AS roc_auc FROM replicates")
def bootstrap_replicate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both metrics of all 200 Poisson resamples of the later window."""
    found = bootstrap_replicates(scored_test(spark, sf_dir), SEED, SAMPLES, resample="poisson")
    return rounded(found, "average_precision", "roc_auc")


_ENDS = " UNION ALL ".join(
    f"""SELECT '{m}' AS metric, round(quantile_cont({m}, 0.025), 9) AS low, round(quantile_cont({m}, 0.975), 9) AS high,
    CAST(count(*) AS INTEGER) AS replicates FROM replicates"""
    for m in ("average_precision", "roc_auc")
)


@query(f"{_TEST}, {sql.replicates('test', SAMPLES, SEED)} {_ENDS}")
def bootstrap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """95 % intervals of average precision and ROC-AUC, by Poisson resamples."""
    return rounded(bootstrap_interval(scored_test(spark, sf_dir), SEED, SAMPLES, resample="poisson"), "low", "high")


@query(f"""{_TEST} SELECT CAST(r.k AS INTEGER) AS replicate, n.drawn
FROM (SELECT unnest(range(1, {SAMPLES} + 1)) AS k) AS r, (SELECT count(*) AS drawn FROM test) AS n""")
def bootstrap_exact_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each exact resample of the later window draws: as many as there are."""
    draws = resampled(scored_test(spark, sf_dir), SEED, SAMPLES).select(F.posexplode("draws").alias("at", "times"))
    return draws.groupBy((F.col("at") + 1).alias("replicate")).agg(F.sum("times").alias("drawn"))


@query()
def bootstrap_exact_replicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both metrics of all 200 exact resamples of the later window."""
    return rounded(bootstrap_replicates(scored_test(spark, sf_dir), SEED, SAMPLES), "average_precision", "roc_auc")


# Four rule-based scorers stand in for fitted models, so that every engine gets the same bits.
_RULES = ("dummy_prior", "logistic_regression", "price_rule", "balance_rule")


def _rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(kept_order_leads(spark, sf_dir), ORDER_LEADS, check=False)
    balance = rational_score(F.col("account_balance") + 1000.0, 5000.0, 3)
    quantity = rational_score(F.coalesce("quantity", F.lit(0.0)) + 1.0, 100.0)
    scores = {
        "dummy_prior": F.lit(0.33),
        "logistic_regression": quantity,
        "price_rule": rational_score(F.col("total_price"), 400000.0),
        "balance_rule": balance,
    }
    models = F.array(*[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in scores.items()])
    scored = split.part("validation").select(
        F.col("lead_id").alias("id"), F.col("converted").alias("label"), F.inline(models)
    )
    return materialize(scored)


_COMPARED = f"""WITH {sql.LEADS}, {sql.split('leads')},
v AS (SELECT * FROM parts WHERE split = 'validation'),
scores AS (
  SELECT 'dummy_prior' AS model, lead_id AS id, converted AS label, 0.33e0 AS score FROM v
  UNION ALL SELECT 'logistic_regression', lead_id, converted,
    floor((coalesce(quantity, 0) + 1) / (coalesce(quantity, 0) + 1 + 100) * 1e6) / 1e6 FROM v
  UNION ALL SELECT 'price_rule', lead_id, converted, floor(total_price / (total_price + 4e5) * 1e6) / 1e6 FROM v
  UNION ALL SELECT 'balance_rule', lead_id, converted,
    floor((account_balance + 1000) / (account_balance + 1000 + 5e3) * 1e3) / 1e3 FROM v),
whole AS (SELECT model, {sql.PROBABILITY_METRICS} FROM ({sql.steps('scores', 'model')}) GROUP BY model),
top AS ({_capacity_sql('scores', 'model', '(0.1e0)')}),
compared AS (
  SELECT whole.*, precision_at_k, recall_at_k, lift_at_k,
         list_position(['dummy_prior', 'logistic_regression', 'price_rule', 'balance_rule'], model) AS position
  FROM whole JOIN top USING (model))"""


@query(f"{_COMPARED} SELECT * REPLACE (CAST(position AS BIGINT) AS position) FROM compared")
def compare_scorers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several scorers measured side by side on the validation window."""
    found = comparison(_rule_scores(spark, sf_dir), list(_RULES))
    return rounded(found, *_PROBABILITY, "precision_at_k", "recall_at_k", "lift_at_k")


@query(f"""{_COMPARED}, leader AS (
  SELECT * FROM compared WHERE model <> 'dummy_prior' ORDER BY average_precision DESC, position LIMIT 1),
plain AS (SELECT * FROM compared WHERE model = 'logistic_regression')
SELECT CASE WHEN leader.average_precision - plain.average_precision <= 0.01e0 AND plain.log_loss - leader.log_loss <= 0.01e0
            THEN 'logistic_regression' ELSE leader.model END AS selected FROM leader CROSS JOIN plain""")
def select_model_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selection rule on that comparison."""
    chosen = metrics.select_model(comparison(_rule_scores(spark, sf_dir), list(_RULES)))
    return spark.createDataFrame([(chosen,)], "selected string")


@query(f"""{_SCORED}, pairs AS (SELECT s.score, CAST(l.toxic AS INTEGER) AS label, CAST(l.doc_id AS VARCHAR) AS id
  FROM scored s JOIN labels l ON s.id = CAST(l.doc_id AS VARCHAR))
SELECT (SELECT count(*) FROM pairs) AS rows_labeled, average_precision, brier_score FROM (
  SELECT {sql.PROBABILITY_METRICS} FROM ({sql.steps('pairs')}))""")
def delayed_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of earlier scores once labels have arrived for some of them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.col("doc_id").cast("string").alias("id"), F.col("toxic").alias("label")
    )
    joined = scored_orders(spark, sf_dir).select("id", "score").join(labels, "id")
    return rounded(metrics.delayed_performance(joined), "average_precision", "brier_score")


@query(f"""{_SCORED}, placed AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS place, count(*) OVER () AS n FROM scored)
SELECT share, score AS value FROM placed JOIN (VALUES (0.05e0), (0.5e0), (0.95e0)) s(share)
  ON place = CAST(round_even((n - 1) * share, 0) AS BIGINT)""")
def nearest_order_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at the nearest place of three shares of a tied score."""
    pairs = [(share, "nearest") for share in (0.05, 0.5, 0.95)]
    found = order_statistics(scored_orders(spark, sf_dir), {"score": pairs})["score"]
    return spark.createDataFrame([(share, found[(share, how)]) for share, how in pairs], "share double, value double")


_REPORT = f"""{_SCORED}, whole AS (SELECT {sql.PROBABILITY_METRICS} FROM ({sql.steps('scored')})),
at_threshold AS ({THRESHOLD_SQL}),
levels AS (SELECT 'top_' || CAST(CAST(floor(fraction * 100) AS BIGINT) AS VARCHAR) || 'pct' AS level, *
           FROM ({_capacity_sql('scored')}))""" + " ".join(
    f"{'' if i == 0 else 'UNION ALL'} SELECT '{metric}' AS metric, {level} AS level, CAST({metric} AS DOUBLE) AS value FROM {source}"
    for i, (source, level, metric) in enumerate(
        [("whole", "CAST(NULL AS VARCHAR)", m) for m in _PROBABILITY]
        + [("at_threshold", "NULL", m) for m in ("rows", "prevalence", "operating_threshold", "precision", "recall", "f1", *_CELLS)]
        + [("levels", "level", m) for m in ("k", "precision_at_k", "recall_at_k", "lift_at_k")]
    )
)


@query(_REPORT)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of the above as one long report."""
    return rounded(metrics.classification_report(scored_orders(spark, sf_dir), THRESHOLD), "value")
