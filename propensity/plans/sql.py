"""Shared SQL text of the checks: the bindings as common table expressions."""

from __future__ import annotations

from propensity.operators.bootstrap import GOLDEN, MIX_1, MIX_2, poisson_cuts

LEADS = """leads AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS lead_id, o_orderdate AS created_at, o_orderpriority AS priority,
         c_mktsegment AS segment, n_name AS nation, o_totalprice AS total_price, c_acctbal AS account_balance,
         line_count, quantity, max_discount, CAST(max_discount >= 0.08e0 AS DOUBLE) AS discounted,
         CAST(o_orderstatus = 'F' AS INTEGER) AS converted
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS line_count, sum(l_quantity) AS quantity,
                    max(l_discount) AS max_discount
             FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)"""

SCORED = """scored AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
         floor(o_totalprice / (o_totalprice + 2e5) * 1e4) / 1e4 AS score, o_orderdate AS created_at
  FROM orders)"""


def split(source: str) -> str:
    """``cuts`` and ``parts``: the chronological split of a relation with a created_at column."""
    return f"""cuts AS (
  SELECT max(CASE WHEN place = CAST(round_even((n - 1) * 0.7e0, 0) AS BIGINT) THEN created_at END) AS t1,
         max(CASE WHEN place = CAST(round_even((n - 1) * 0.85e0, 0) AS BIGINT) THEN created_at END) AS t2
  FROM (SELECT created_at, row_number() OVER (ORDER BY created_at) - 1 AS place, count(*) OVER () AS n FROM {source})),
parts AS (
  SELECT s.*, CASE WHEN created_at < t1 THEN 'train' WHEN created_at < t2 THEN 'validation' ELSE 'test' END AS split
  FROM {source} s CROSS JOIN cuts)"""


LINES = """records AS (
  SELECT l_orderkey || '-' || l_linenumber AS record_id, l_shipdate, l_partkey, l_suppkey, l_quantity,
         l_extendedprice, l_discount, l_tax, l_linestatus, CAST(l_returnflag = 'R' AS INTEGER) AS returned
  FROM lineitem)"""

EVENT_TEXT = """raw AS (
  SELECT CASE WHEN event_id % 113 = 0 THEN ' ' ELSE CAST(event_id AS VARCHAR) END AS event_id,
         CASE WHEN event_id % 101 = 0 THEN '12:30' WHEN event_id % 103 = 0 THEN ''
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
         CASE WHEN event_id % 61 = 0 THEN '' WHEN event_id % 59 = 0 THEN ' ' ELSE event_type END AS event_type,
         CASE WHEN event_id % 97 = 0 THEN '  ' WHEN event_id % 89 = 0 THEN '' WHEN event_id % 83 = 0 THEN '1d'
              WHEN event_id % 79 = 0 THEN 'nan' WHEN event_id % 73 = 0 THEN '1e3'
              ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS value,
         CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN event_id % 107 = 0 THEN '2' WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS purchased,
         event_id AS source_row_number
  FROM events)"""


def _parsed(column: str) -> str:
    number = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match(trim({column}), '{number}') THEN CAST(trim({column}) AS DOUBLE) END"


def _malformed(column: str) -> str:
    return f"(trim({column}) <> '' AND lower(trim({column})) <> 'nan' AND ({_parsed(column)}) IS NULL)"


TYPED = f"""typed AS (
  SELECT source_row_number, CASE WHEN trim(event_id) <> '' THEN event_id END AS event_id,
         CASE WHEN length(ts) = 19 THEN CAST(ts AS TIMESTAMP) END AS ts, nullif(event_type, '') AS event_type,
         {_parsed("value")} AS value, {_parsed("user_id")} AS user_id, {_parsed("purchased")} AS purchased,
         {_malformed("value")} AS bad_value, {_malformed("user_id")} AS bad_user,
         {_malformed("purchased")} AS bad_purchased, ts <> '' AND length(ts) <> 19 AS bad_ts
  FROM raw)"""

# (rule, condition on typed) in reporting order.
EVENT_RULES = (
    ("malformed:value", "bad_value"),
    ("malformed:user_id", "bad_user"),
    ("malformed:purchased", "bad_purchased"),
    ("malformed:ts", "bad_ts"),
    ("id_missing", "event_id IS NULL"),
    ("time_missing", "ts IS NULL"),
    ("target_invalid", "coalesce(purchased NOT IN (0, 1), true)"),
    ("range:value", "coalesce(value NOT BETWEEN 0 AND 6000, false)"),
    ("range:user_id", "coalesce(user_id NOT BETWEEN 0 AND 1000000, false)"),
)


def cells(source: str, columns: tuple[str, ...], where: str = "true") -> str:
    """(feature, value) rows of numeric columns."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source} WHERE {c} IS NOT NULL AND {where}" for c in columns
    )


def points(name: str, source: str, shares: str) -> str:
    """Exact interpolated quantiles of (feature, value) rows, with the same arithmetic on both sides."""
    return f"""{name}_ordered AS (
  SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS place FROM {source}),
{name}_at AS (
  SELECT feature, k, (n - 1) * share AS spot
  FROM (SELECT feature, count(*) AS n FROM {source} GROUP BY feature) CROSS JOIN ({shares})),
{name} AS (
  SELECT a.feature, a.k, CASE WHEN spot - floor(spot) < 0.5e0 THEN lo.value + (hi.value - lo.value) * (spot - floor(spot))
                              ELSE hi.value - (hi.value - lo.value) * (1 - (spot - floor(spot))) END AS value
  FROM {name}_at a JOIN {name}_ordered lo ON lo.feature = a.feature AND lo.place = CAST(floor(spot) AS BIGINT)
  JOIN {name}_ordered hi ON hi.feature = a.feature AND hi.place = CAST(ceil(spot) AS BIGINT))"""


DECILES = "SELECT k, CASE WHEN k = 10 THEN 1e0 ELSE k * 0.1e0 END AS share FROM range(11) t(k)"
QUARTILES = "SELECT k, 0.25e0 + k * 0.5e0 AS share FROM range(2) t(k)"


def bins(name: str, source: str) -> str:
    """Decile bins of (feature, value) rows: (feature, bin, lo, hi, bins)."""
    return f"""{points(name + "_points", source, DECILES)},
{name}_edges AS (
  SELECT feature, value FROM {name}_points GROUP BY feature, value
  UNION ALL SELECT feature, max(value) + 1 FROM {name}_points GROUP BY feature HAVING min(value) = max(value)),
{name} AS (
  SELECT feature, bin, lo, hi, bins FROM (
    SELECT feature, row_number() OVER w - 1 AS bin, value AS lo, lead(value) OVER w AS hi,
           count(*) OVER (PARTITION BY feature) - 1 AS bins
    FROM {name}_edges WINDOW w AS (PARTITION BY feature ORDER BY value)) WHERE hi IS NOT NULL)"""


def binned(bins_name: str, source: str) -> str:
    """(feature, bin, lo, hi, count), the outer edges taken as infinite."""
    return f"""SELECT b.feature, b.bin, any_value(lo) AS lo, any_value(hi) AS hi, count(value) AS count
  FROM {bins_name} b LEFT JOIN {source} c ON c.feature = b.feature
    AND (c.value >= b.lo OR b.bin = 0) AND (c.value < b.hi OR b.bin = b.bins - 1)
  GROUP BY b.feature, b.bin"""


def steps(source: str, by: str = "") -> str:
    """One row per distinct score with running totals, best first."""
    keys, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""SELECT {keys}score, n, pos,
    sum(n) OVER ({part}ORDER BY score DESC) AS cum_n, sum(pos) OVER ({part}ORDER BY score DESC) AS cum_pos
  FROM (SELECT {keys}score, count(*) AS n, sum(label) AS pos FROM {source} GROUP BY {keys}score)"""


PROBABILITY_METRICS = """round(sum(pos * (cum_pos / cum_n)) / sum(pos), 9) AS average_precision,
  round(sum((n - pos) * (cum_pos - pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos)), 9) AS roc_auc,
  round(sum(-(pos * ln(greatest(least(score, 1 - 2.220446049250313e-16), 2.220446049250313e-16))
        + (n - pos) * ln(1 - greatest(least(score, 1 - 2.220446049250313e-16), 2.220446049250313e-16)))) / sum(n), 9) AS log_loss,
  round(sum(pos * (1 - score) * (1 - score) + (n - pos) * score * score) / sum(n), 9) AS brier_score"""


def _mix(x: str, name: str, source: str) -> str:
    """Three nested selects that apply the 32-bit mixing to ``x``."""
    return f"""SELECT * EXCLUDE (m), xor(m, m >> 16) AS {name} FROM (
      SELECT * REPLACE ((xor(m, m >> 13) * CAST({MIX_2} AS UBIGINT)) % 4294967296 AS m) FROM (
        SELECT * REPLACE ((xor(m, m >> 16) * CAST({MIX_1} AS UBIGINT)) % 4294967296 AS m) FROM (
          SELECT *, {x} AS m FROM {source})))"""


def replicates(source: str, samples: int, seed: int) -> str:
    """(replicate, average_precision, roc_auc) of a Poisson(1) bootstrap of (id, label, score) rows."""
    weight = " + ".join(f"CAST(drawn >= {cut} AS INTEGER)" for cut in poisson_cuts())
    return f"""seeded AS (
  SELECT label, score, CAST('0x' || substr(d, 1, 8) AS UBIGINT) AS high, CAST('0x' || substr(d, 9, 8) AS UBIGINT) AS low
  FROM (SELECT label, score, md5(id || '|{seed}') AS d FROM {source})),
copies AS (SELECT *, CAST(r AS INTEGER) AS replicate FROM seeded CROSS JOIN range(1, {samples + 1}) t(r)),
inner_mix AS ({_mix(f"(low + CAST(replicate AS UBIGINT) * CAST({GOLDEN} AS UBIGINT)) % 4294967296", "first", "copies")}),
outer_mix AS ({_mix("xor(high, first)", "drawn", "inner_mix")}),
weighted AS (SELECT replicate, score, label, {weight} AS w FROM outer_mix),
groups AS (SELECT replicate, score, sum(w) AS n, sum(w * label) AS pos FROM weighted WHERE w > 0 GROUP BY replicate, score),
ranked AS (
  SELECT *, sum(n) OVER p AS cum_n, sum(pos) OVER p AS cum_pos FROM groups
  WINDOW p AS (PARTITION BY replicate ORDER BY score DESC)),
replicates AS (
  SELECT replicate, sum(pos * (cum_pos / cum_n)) / sum(pos) AS average_precision,
         sum((n - pos) * (cum_pos - pos / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(n - pos)) AS roc_auc
  FROM ranked GROUP BY replicate HAVING sum(pos) > 0 AND sum(n - pos) > 0)"""
