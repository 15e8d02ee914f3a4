"""Baselines and drift between the training window and the later window of the order leads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators import drift
from propensity.operators.clean import derive_time_parts
from propensity.operators.split import Split, chronological_split
from propensity.plans import sql
from propensity.plans.bindings import ORDER_LEADS, order_leads, rational_score
from propensity.plans.measuring import rounded
from propensity.plans.registry import query
from propensity.session import materialize

_NUMERIC = ORDER_LEADS.numeric_features
_CATEGORICAL = ORDER_LEADS.categorical

_PARTS = f"""WITH {sql.LEADS}, {sql.split('leads')},
derived AS (
  SELECT *, CAST(hour(created_at) AS DOUBLE) AS created_hour, CAST(isodow(created_at) - 1 AS DOUBLE) AS created_day_of_week,
         floor(total_price / (total_price + 2e5) * 1e6) / 1e6 AS prediction FROM parts),
train AS (SELECT * FROM derived WHERE split = 'train'),
test AS (SELECT * FROM derived WHERE split = 'test'),
then_cells AS ({sql.cells('train', _NUMERIC + ('prediction',))}),
now_cells AS ({sql.cells('test', _NUMERIC + ('prediction',))})"""
_BINS = f"{_PARTS}, {sql.bins('bins', 'then_cells')}, then_bins AS ({sql.binned('bins', 'then_cells')}), now_bins AS ({sql.binned('bins', 'now_cells')})"


def _categories(source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, coalesce({c}, '__MISSING__') AS category,
    count(*) / (SELECT count(*) FROM {source}) AS frequency FROM {source} GROUP BY {c}"""
        for c in _CATEGORICAL
    )


_SHARES = f"{_PARTS}, then_shares AS ({_categories('train')}), now_shares AS ({_categories('test')})"
_TERM = "(greatest(c, 1e-6) - greatest(r, 1e-6)) * ln(greatest(c, 1e-6) / greatest(r, 1e-6))"
_NUMERIC_PSI = f"""SELECT feature, sum({_TERM}) AS psi FROM (
  SELECT t.feature, t.count / greatest(sum(t.count) OVER f, 1) AS r, n.count / greatest(sum(n.count) OVER f, 1) AS c
  FROM then_bins t JOIN now_bins n ON t.feature = n.feature AND t.bin = n.bin WINDOW f AS (PARTITION BY t.feature))
GROUP BY feature"""
_CATEGORICAL_PSI = f"""SELECT feature, sum({_TERM}) AS psi FROM (
  SELECT coalesce(t.feature, n.feature) AS feature, coalesce(t.frequency, 0) AS r, coalesce(n.frequency, 0) AS c
  FROM then_shares t FULL JOIN now_shares n ON t.feature = n.feature AND t.category = n.category) GROUP BY feature"""


def _split(spark: SparkSession, sf_dir: str) -> Split:
    score = rational_score(F.col("total_price"), 200000.0)
    leads = derive_time_parts(order_leads(spark, sf_dir), ORDER_LEADS).withColumn("score", score)
    return chronological_split(materialize(leads), ORDER_LEADS, check=False)


def _edges(train: DataFrame) -> dict:
    return drift.histogram_edges(train, _NUMERIC)


@query(f"{_BINS} SELECT feature, CAST(bin AS INTEGER) AS bin, lo, hi, count FROM then_bins WHERE feature <> 'prediction'")
def numeric_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decile histograms of the training window."""
    return drift.numeric_baseline(_split(spark, sf_dir).part("train"), _NUMERIC)


@query(f"{_SHARES} SELECT feature, category, round(frequency, 9) AS frequency FROM then_shares")
def categorical_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category shares of the training window."""
    return rounded(drift.categorical_baseline(_split(spark, sf_dir).part("train"), _CATEGORICAL), "frequency")


@query(f"{_BINS} SELECT feature, round(psi, 9) AS psi FROM ({_NUMERIC_PSI}) WHERE feature <> 'prediction'")
def numeric_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stability index of each numeric feature."""
    split = _split(spark, sf_dir)
    edges = _edges(split.part("train"))
    baseline = drift.numeric_baseline(split.part("train"), _NUMERIC, edges)
    return rounded(drift.numeric_psi(baseline, split.part("test"), edges), "psi")


@query(f"{_SHARES} SELECT feature, round(psi, 9) AS psi FROM ({_CATEGORICAL_PSI})")
def categorical_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stability index of each categorical feature."""
    split = _split(spark, sf_dir)
    baseline = drift.categorical_baseline(split.part("train"), _CATEGORICAL)
    return rounded(drift.categorical_psi(baseline, drift.categorical_baseline(split.part("test"), _CATEGORICAL)), "psi")


@query(f"""{_BINS} SELECT count(*) AS rows, round(avg(prediction), 9) AS mean, round(stddev_pop(prediction), 9) AS std,
  (SELECT round(psi, 9) FROM ({_NUMERIC_PSI}) WHERE feature = 'prediction') AS psi FROM test""")
def prediction_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, mean, deviation and stability index of the scores."""
    split = _split(spark, sf_dir)
    train = split.part("train").withColumnRenamed("score", drift.PREDICTION)
    edges = drift.histogram_edges(train, [drift.PREDICTION])
    baseline = drift.numeric_baseline(train, [drift.PREDICTION], edges)
    return rounded(drift.prediction_drift(baseline, split.part("test"), edges), "mean", "std", "psi")


_RANGES = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count(*) AS rows, avg(CAST({c} IS NULL AS DOUBLE)) AS missing_rate, {f'min({c})' if c in _NUMERIC else 'CAST(NULL AS DOUBLE)'} AS low,
  {f'max({c})' if c in _NUMERIC else 'CAST(NULL AS DOUBLE)'} AS high FROM train"""
    for c in (*_NUMERIC, *_CATEGORICAL)
)
_NOW = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, avg(CAST({c} IS NULL AS DOUBLE)) AS missing_rate,
  {f"coalesce(count(*) FILTER ({c} < (SELECT min({c}) FROM train) OR {c} > (SELECT max({c}) FROM train)) / nullif(count({c}), 0), 0)" if c in _NUMERIC else 'CAST(NULL AS DOUBLE)'} AS outside,
  {'CAST(NULL AS DOUBLE)' if c in _NUMERIC else f"count(*) FILTER ({c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM train WHERE {c} IS NOT NULL)) / count(*)"} AS unseen
  FROM test"""
    for c in (*_NUMERIC, *_CATEGORICAL)
)
_VALUE_DRIFT = f"""SELECT n.feature, n.missing_rate, n.missing_rate - t.missing_rate AS missing_rate_delta,
  outside AS outside_range_rate, unseen AS unseen_category_rate FROM ({_NOW}) n JOIN ({_RANGES}) t USING (feature)"""


@query(f"{_PARTS} SELECT feature, rows, round(missing_rate, 9) AS missing_rate, low, high FROM ({_RANGES})")
def feature_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing rate, smallest and largest value in the training window."""
    return rounded(drift.feature_ranges(_split(spark, sf_dir).part("train"), _NUMERIC, _CATEGORICAL), "missing_rate")


def _baseline(split: Split) -> drift.Baseline:
    return drift.build_baseline(split.part("train"), ORDER_LEADS, score="score")


@query(f"""{_PARTS} SELECT feature, round(missing_rate, 9) AS missing_rate, round(missing_rate_delta, 9) AS missing_rate_delta,
  round(outside_range_rate, 9) AS outside_range_rate, round(unseen_category_rate, 9) AS unseen_category_rate FROM ({_VALUE_DRIFT})""")
def value_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, out-of-range and unseen values against the baseline."""
    split = _split(spark, sf_dir)
    test = split.part("test")
    shares = drift.categorical_baseline(test, _CATEGORICAL)
    found = drift.value_drift(_baseline(split), test, shares, _NUMERIC, _CATEGORICAL)
    return rounded(found, *found.columns[1:])


_REPORT = f"""{_BINS}, then_shares AS ({_categories('train')}), now_shares AS ({_categories('test')}), changes AS ({_VALUE_DRIFT}),
report AS (
  SELECT 'numeric' AS kind, feature, 'psi' AS metric, psi AS value FROM ({_NUMERIC_PSI}) WHERE feature <> 'prediction'
  UNION ALL SELECT 'categorical', feature, 'psi', psi FROM ({_CATEGORICAL_PSI})
  UNION ALL SELECT 'values', feature, 'missing_rate', missing_rate FROM changes
  UNION ALL SELECT 'values', feature, 'missing_rate_delta', missing_rate_delta FROM changes
  UNION ALL SELECT 'values', feature, 'outside_range_rate', outside_range_rate FROM changes WHERE outside_range_rate IS NOT NULL
  UNION ALL SELECT 'values', feature, 'unseen_category_rate', unseen_category_rate FROM changes WHERE unseen_category_rate IS NOT NULL
  UNION ALL SELECT 'predictions', 'prediction', 'rows', CAST(count(*) AS DOUBLE) FROM test
  UNION ALL SELECT 'predictions', 'prediction', 'mean', avg(prediction) FROM test
  UNION ALL SELECT 'predictions', 'prediction', 'std', stddev_pop(prediction) FROM test
  UNION ALL SELECT 'predictions', 'prediction', 'psi', psi FROM ({_NUMERIC_PSI}) WHERE feature = 'prediction')"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _split(spark, sf_dir)
    test = split.part("test")
    return drift.drift_report(_baseline(split), test, ORDER_LEADS, scores=test)


@query(f"{_REPORT} SELECT kind, feature, metric, round(value, 9) AS value FROM report")
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All drift measures of features and scores."""
    return rounded(_report(spark, sf_dir), "value")


@query(f"""{_REPORT} SELECT kind, feature, metric, round(value, 9) AS value, "limit" FROM report
JOIN (VALUES ('psi', 0.0001e0), ('missing_rate_delta', 0.0001e0), ('outside_range_rate', 0.0e0)) l(metric, "limit") USING (metric)
WHERE abs(value) > "limit" """)
def drift_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures beyond their limits (tight ones here, so that there are some)."""
    limits = {"psi": 0.0001, "missing_rate_delta": 0.0001, "outside_range_rate": 0.0}
    return rounded(drift.drift_warnings(_report(spark, sf_dir), limits), "value")


_FLAG_PSI = f"""{_PARTS}, then_shares AS (
  SELECT coalesce(CAST(discounted AS VARCHAR), '__MISSING__') AS category, count(*) / (SELECT count(*) FROM train) AS frequency
  FROM train GROUP BY 1),
now_shares AS (
  SELECT coalesce(CAST(discounted AS VARCHAR), '__MISSING__') AS category, count(*) / (SELECT count(*) FROM test) AS frequency
  FROM test GROUP BY 1)
SELECT 'discounted' AS feature, round(sum({_TERM}), 9) AS psi FROM (
  SELECT coalesce(t.frequency, 0) AS r, coalesce(n.frequency, 0) AS c
  FROM then_shares t FULL JOIN now_shares n ON t.category = n.category)"""


@query(_FLAG_PSI)
def binary_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 0/1 feature measured as a category; as a number its one bin can never drift."""
    split = _split(spark, sf_dir)
    _, categorical = drift.feature_lists(ORDER_LEADS, binary_as_categorical=True)
    flags = [c for c in categorical if c in ORDER_LEADS.binary]
    baseline = drift.categorical_baseline(split.part("train"), flags)
    return rounded(drift.categorical_psi(baseline, drift.categorical_baseline(split.part("test"), flags)), "psi")
