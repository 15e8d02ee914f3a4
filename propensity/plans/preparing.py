"""Feature preparation learned on the training window and applied to all rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators import features
from propensity.operators.clean import coerce
from propensity.operators.split import Split, chronological_split
from propensity.operators.vocabulary import TargetEncoder
from propensity.plans import sql
from propensity.plans.bindings import EVENT_TEXT, ORDER_LEADS, event_text, order_leads, table
from propensity.plans.measuring import rounded
from propensity.plans.registry import query
from propensity.session import materialize

_GAPS = ("line_count", "quantity", "max_discount")
_SCALED = ("total_price", "account_balance", "line_count__missing", "line_count")
_PARTS = f"WITH {sql.LEADS}, {sql.split('leads')}, train AS (SELECT * FROM parts WHERE split = 'train')"
_MIDDLES = ", ".join(f"(SELECT median({c}) FROM train) AS {c}" for c in _GAPS)


def _split(spark: SparkSession, sf_dir: str) -> Split:
    return chronological_split(materialize(order_leads(spark, sf_dir)), ORDER_LEADS, check=False)


def _prepared(split: Split, columns: tuple[str, ...], scale: bool = False) -> DataFrame:
    """All rows through the numeric stages that models are fitted with."""
    train = split.part("train")
    learned = features.Learned(features.medians(train, columns), tuple(features.missing_at_fit(train, columns)), None, {})
    stages, _ = features.numeric_stages(train, columns, learned, scale)
    return PipelineModel(stages).transform(split.frame)


@query(f"""{_PARTS}, m AS (SELECT {_MIDDLES}) SELECT lead_id,
  {', '.join(f"round(coalesce(p.{c}, m.{c}), 9) AS {c}" for c in _GAPS)} FROM parts p CROSS JOIN m""")
def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps filled with the exact training medians."""
    filled = _prepared(_split(spark, sf_dir), _GAPS).select("lead_id", *[F.col(f"n_{c}").alias(c) for c in _GAPS])
    return rounded(filled, *_GAPS)


@query(f"""{_PARTS} SELECT lead_id,
  {', '.join(f"CAST({c} IS NULL AS DOUBLE) AS {c}__missing" for c in _GAPS)} FROM parts""")
def missing_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0/1 marks for the columns that had a gap in the training window (total_price had none)."""
    marked = _prepared(_split(spark, sf_dir), ("total_price", *_GAPS))
    marks = [c for c in marked.columns if c.startswith("m_")]
    return marked.select("lead_id", *[F.col(c).alias(f"{c[2:]}__missing") for c in marks])


@query(f"""WITH {sql.EVENT_TEXT}, {sql.TYPED},
mode AS (SELECT event_type AS fill FROM typed WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT source_row_number, coalesce(event_type, fill) AS event_type FROM typed CROSS JOIN mode""")
def mode_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty categories filled with the most frequent one."""
    typed = coerce(event_text(spark, sf_dir), EVENT_TEXT)
    fill = features.modes(typed, ["event_type"])["event_type"]
    return typed.select("source_row_number", features.filled("event_type", fill).alias("event_type"))


@query(f"""{_PARTS}, m AS (SELECT {_MIDDLES}),
filled AS (
  SELECT p.lead_id, split, total_price, account_balance, CAST(p.line_count IS NULL AS DOUBLE) AS line_count__missing,
         coalesce(p.line_count, m.line_count) AS line_count FROM parts p CROSS JOIN m),
s AS (SELECT {', '.join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in _SCALED)}
      FROM filled WHERE split = 'train')
SELECT lead_id, {', '.join(f"round(({c} - m_{c}) / s_{c}, 9) + 0 AS {c}" for c in _SCALED)} FROM filled CROSS JOIN s""")
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imputed values and their indicators on the training scale."""
    scaled = _prepared(_split(spark, sf_dir), ("total_price", "account_balance", "line_count"), scale=True)
    names = {"line_count__missing": "z_m_line_count"}
    return scaled.select("lead_id", *[(F.round(names.get(c, f"z_n_{c}"), 9) + 0.0).alias(c) for c in _SCALED])


_FREQUENT = """counts AS (
  SELECT 'customer' AS "column", CAST(o_custkey AS VARCHAR) AS value, count(*) AS n FROM orders GROUP BY ALL
  UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY ALL),
words AS (
  SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS place FROM counts WHERE n >= 20),
pooled AS (SELECT 'customer' AS "column", (SELECT count(*) FROM words WHERE "column" = 'customer') AS place)"""


@query(f"""WITH {_FREQUENT} SELECT o_orderkey, "column", CAST(coalesce(w.place, p.place) AS INTEGER) AS code
FROM (SELECT o_orderkey, 'customer' AS "column", CAST(o_custkey AS VARCHAR) AS value FROM orders
      UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders)
LEFT JOIN words w USING ("column", value) LEFT JOIN pooled p USING ("column")""")
def one_hot_infrequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot places; categories seen fewer than twenty times share the last place."""
    columns = ["customer", "priority"]
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer"), F.col("o_orderpriority").alias("priority")
    )
    counts = features.category_counts(orders, columns)
    (stage,), widths = features.one_hot_stages(orders, columns, features.Learned({}, (), counts, features.modes_of(counts, columns)))
    return _codes(stage.transform(orders), "o_orderkey", {c: F.when(F.col(f"i_{c}") < widths[f"i_{c}"], F.col(f"i_{c}")) for c in columns})


def _codes(encoded: DataFrame, id: str, codes: dict[str, Column]) -> DataFrame:
    """(id, column, code) of several code columns."""
    cells = [F.struct(F.lit(c).alias("column"), code.cast("int").alias("code")) for c, code in codes.items()]
    return encoded.select(id, F.inline(F.array(*cells)))


@query(f"""{_PARTS}, words AS (
  SELECT 'segment' AS "column", segment AS value FROM train WHERE segment <> 'MACHINERY' GROUP BY ALL
  UNION ALL SELECT 'nation', nation FROM train WHERE segment <> 'MACHINERY' GROUP BY ALL),
places AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS place FROM words)
SELECT lead_id, "column", CAST(coalesce(place, -1) AS INTEGER) AS code
FROM (SELECT lead_id, 'segment' AS "column", segment AS value FROM leads UNION ALL SELECT lead_id, 'nation', nation FROM leads)
LEFT JOIN places USING ("column", value)""")
def ordinal_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes in sorted order; the segment left out of the fit counts as unseen (-1)."""
    split, columns = _split(spark, sf_dir), ["segment", "nation"]
    train = split.part("train").where("segment <> 'MACHINERY'")
    counts = features.category_counts(train, columns)
    stages, names = features.ordinal_stages(train, columns, features.Learned({}, (), counts, features.modes_of(counts, columns)))
    return _codes(PipelineModel(stages).transform(split.frame), "lead_id", {c: F.col(k) for c, k in zip(columns, names, strict=True)})


_MEANS = ("priority", "segment", "nation")
_CELLS_OF = " UNION ALL ".join(f"SELECT lead_id, split, '{c}' AS \"column\", coalesce({c}, 'missing') AS value, CAST(converted AS BIGINT) AS y FROM parts" for c in _MEANS)


@query(f"""{_PARTS}, prior AS (SELECT avg(converted) AS p FROM train), cells AS ({_CELLS_OF}),
before AS (SELECT *, count(*) OVER w AS n, coalesce(sum(y) OVER w, 0) AS pos FROM cells WHERE split = 'train'
           WINDOW w AS (PARTITION BY "column", value ORDER BY sha256('42:' || lead_id), lead_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
whole AS (SELECT "column", value, count(*) AS n, sum(y) AS pos FROM cells WHERE split = 'train' GROUP BY ALL)
SELECT lead_id, "column", round((pos + p) / (n + 1), 9) AS code FROM before CROSS JOIN prior
UNION ALL SELECT lead_id, "column", round(CASE WHEN n IS NULL THEN p ELSE (pos + p) / (n + 1) END, 9)
FROM cells LEFT JOIN whole USING ("column", value) CROSS JOIN prior WHERE split <> 'train'""")
def target_mean_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target means of the categories: of the rows before each in the training window, of the whole window for later rows."""
    split = _split(spark, sf_dir)
    train = split.part("train")
    stage = TargetEncoder.fitted(train, _MEANS, dict.fromkeys(_MEANS, features.FILLED_CATEGORY), "converted")
    rows = stage.ordered(train, "lead_id", "converted").unionByName(stage.transform(split.frame.where("split <> 'train'").select(*train.columns)))
    cells = [F.struct(F.lit(c).alias("column"), F.round(f"t_{c}", 9).alias("code")) for c in _MEANS]
    return rows.select("lead_id", F.inline(F.array(*cells)))


def _basis_sql(j: int) -> str:
    t, s = f"(u + {3 - j})", f"(4 - (u + {3 - j}))"
    return f"""round(CASE WHEN {t} < 0 OR {t} >= 4 THEN 0 WHEN {t} < 1 THEN pow({t}, 3) / 6
      WHEN {t} < 2 THEN (-3 * pow({t}, 3) + 12 * pow({t}, 2) - 12 * {t} + 4) / 6
      WHEN {t} < 3 THEN (-3 * pow({s}, 3) + 12 * pow({s}, 2) - 12 * {s} + 4) / 6
      ELSE pow({s}, 3) / 6 END, 9) AS total_price_b{j}"""


@query(f"""{_PARTS}, ends AS (SELECT min(total_price) AS lo, max(total_price) AS hi FROM train),
places AS (SELECT lead_id, (least(greatest(total_price, lo), hi) - lo) / ((hi - lo) / 3) AS u FROM parts CROSS JOIN ends)
SELECT lead_id, {', '.join(_basis_sql(j) for j in range(5))} FROM places""")
def spline_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five cubic spline columns of the price, knots from the training window."""
    split = _split(spark, sf_dir)
    low, high = split.part("train").agg(F.min("total_price"), F.max("total_price")).first()
    basis = features.spline_columns(split.frame, "total_price", low, high)
    names = [f"total_price_b{j}" for j in range(5)]
    return rounded(basis.select("lead_id", *names), *names)
