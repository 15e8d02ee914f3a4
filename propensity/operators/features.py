"""Feature preparation learned on the training rows and kept as standard Spark ML stages.

Learned values (medians, means) become literals of ``SQLTransformer`` stages, vocabularies are tables of a ``TableEncoder``, so a fitted
preparation saves and loads as a plain ``PipelineModel`` and no list of categories passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.functions import values as v
from propensity.operators.order import quantiles
from propensity.operators.quality import top_values, value_counts
from propensity.operators.vocabulary import SparseAssembler, TableEncoder, TargetEncoder, vocabulary_table
from propensity.session import materialize
from propensity.spec import TableSpec

MIN_FREQUENCY = 20
FILLED_CATEGORY = "missing"
VECTOR = "features"
# Up to this length a one-hot vector names each of its places.
ONE_HOT_WIDTH = 10_000


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians, the mean of the middle two for an even count."""
    return {c: q[0] for c, q in quantiles(df, columns, [0.5]).items()}


def missing_at_fit(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that get a missing indicator: those with a null in the training rows."""
    if not columns:
        return []
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, rows), counted once and kept: modes and vocabularies are read from it."""
    return materialize(value_counts(df, columns))


def modes_of(counts: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    found = {r["column"]: r["value"] for r in top_values(counts).collect()}
    return {c: found.get(c) for c in columns}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-null value; the smallest one on a tie."""
    return modes_of(value_counts(df, columns), columns)


def filled_counts(counts: DataFrame, fill: Mapping[str, str | None]) -> DataFrame:
    """Counts after the most-frequent fill: the nulls of a column join its most frequent value."""
    fills = F.create_map(*[x for c, m in fill.items() for x in (F.lit(c), F.lit(m).cast("string"))])
    value = F.coalesce("value", F.try_element_at(fills, F.col("column"))).alias("value")
    return counts.select("column", value, "rows").where("value is not null").groupBy("column", "value").agg(
        F.sum("rows").alias("rows")
    )


def filled(column: str, value: float | str | None) -> Column:
    return F.coalesce(F.col(column), F.lit(value)) if value is not None else F.col(column)


def scales(df: DataFrame, expressions: Mapping[str, Column]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation (1 where it is 0) of expressions, in one pass."""
    aggregates = []
    for name, e in expressions.items():
        aggregates += [F.avg(e).alias(f"m:{name}"), F.stddev_pop(e).alias(f"s:{name}")]
    row = df.agg(*aggregates).first()
    return {name: (row[f"m:{name}"] or 0.0, row[f"s:{name}"] or 1.0) for name in expressions}


def encoder(counts: DataFrame, columns: Sequence[str], fill: Mapping[str, str | None], min_frequency: int = 1) -> TableEncoder:
    """The stage that gives each filled category its place among those seen at least ``min_frequency`` times after the fill."""
    return TableEncoder.of(vocabulary_table(filled_counts(counts, fill), min_frequency), columns, fill)


def pooled_columns(counts: DataFrame, fill: Mapping[str, str | None], min_frequency: int) -> set[str]:
    """Columns with categories below ``min_frequency``, which share a place."""
    rare = filled_counts(counts, fill).where(F.col("rows") < min_frequency)
    return {r["column"] for r in rare.select("column").distinct().collect()}


# --- fitted stages ------------------------------------------------------------------------------


def _sql(expressions: Mapping[str, str]) -> SQLTransformer:
    columns = ", ".join(f"{e} AS `{name}`" for name, e in expressions.items())
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def _filled_sql(column: str, value: float | None) -> str:
    return f"coalesce(CAST(`{column}` AS DOUBLE), {v.number_sql(value if value is not None else 0.0)})"


@dataclass(frozen=True)
class Learned:
    """What the training rows say about single columns; shared by all preparations of one table."""

    medians: dict[str, float | None]
    missing: tuple[str, ...]
    counts: DataFrame | None
    modes: dict[str, str | None]


def learn(train: DataFrame, spec: TableSpec) -> Learned:
    """Medians, columns with gaps, category counts and modes of all features."""
    counts = category_counts(train, spec.categorical) if spec.categorical else None
    return Learned(
        medians=medians(train, spec.numeric_features),
        missing=tuple(missing_at_fit(train, spec.numeric_features)),
        counts=counts,
        modes=modes_of(counts, spec.categorical) if counts is not None else {},
    )


def numeric_stages(
    train: DataFrame, columns: Sequence[str], learned: Learned, scale: bool, splines: bool = False
) -> tuple[list, list[str]]:
    """Median fill and indicators, then optionally the spline basis, then optionally standardisation."""
    middle, flags = learned.medians, learned.missing
    used = [c for c in columns if middle[c] is not None]  # a column without any value is left out
    if not used:
        return [], []
    plain = {f"n_{c}": _filled_sql(c, middle[c]) for c in used}
    plain |= {f"m_{c}": f"CAST(`{c}` IS NULL AS DOUBLE)" for c in flags if c in used}
    stages, names = [_sql(plain)], list(plain)
    if not scale:
        return stages, names
    frame = stages[0].transform(train)
    if splines:
        ends = frame.agg(*[f(F.col(n)).alias(f"{k}:{n}") for n in names for k, f in (("lo", F.min), ("hi", F.max))]).first()
        basis_stages, names = _spline_stages({n: (ends[f"lo:{n}"], ends[f"hi:{n}"]) for n in names})
        stages += basis_stages
        for stage in basis_stages:
            frame = stage.transform(frame)
    moments = scales(frame, {n: F.col(n) for n in names})
    stages.append(_sql({f"z_{n}": f"(`{n}` - {v.number_sql(m)}) / {v.number_sql(s)}" for n, (m, s) in moments.items()}))
    return stages, [f"z_{n}" for n in names]


def _spline_stages(ends: Mapping[str, tuple[float, float]]) -> tuple[list, list[str]]:
    """Spline basis as three stages (place, cubes, weighted sums), so that no expression repeats another."""
    places, cubes, basis = {}, {}, {}
    for n, (low, high) in ends.items():
        places[f"u_{n}"] = v.spline_place(n, low, high)
        powers = {f"q{m}_{n}": e for m, e in enumerate(v.spline_cubes(f"u_{n}"))}
        cubes |= powers
        basis |= {f"b{j}_{n}": e for j, e in enumerate(v.spline_basis(list(powers)))}
    return [_sql(step) for step in (places, cubes, basis)], list(basis)


def one_hot_stages(
    train: DataFrame, columns: Sequence[str], learned: Learned, min_frequency: int = MIN_FREQUENCY
) -> tuple[list, dict[str, int]]:
    """Most-frequent fill and places; returns the stage and each code's width. Unseen values share the pooled place or have none."""
    if not columns:
        return [], {}
    stage = encoder(learned.counts, columns, learned.modes, min_frequency)
    pooled = pooled_columns(learned.counts, learned.modes, min_frequency)
    widths = {f"i_{c}": stage.facts[c]["size"] + int(c in pooled) for c in columns}
    return [stage], {c: w for c, w in widths.items() if w}  # a column without any value is left out


def assembled(train: DataFrame, stages: list, numbers: Sequence[str], widths: Mapping[str, int]) -> list:
    """Stages that put numbers and one-hot codes into one vector; wide ones are written as sparse indices."""
    if sum(widths.values()) > ONE_HOT_WIDTH:
        return [SparseAssembler.of(numbers, widths, VECTOR)]
    encoders, indexed = [], train.limit(0)
    for stage in stages:
        indexed = stage.transform(indexed)
    for drop in (True, False):  # the last code means "other": dropped, unless values were pooled in it
        group = [c for c, w in widths.items() if (_code_values(indexed, c) > w) == drop]
        if group:
            encoders.append(OneHotEncoder(inputCols=group, outputCols=[f"o_{c}" for c in group], dropLast=drop).fit(indexed))
    return [*encoders, VectorAssembler(inputCols=[*numbers, *[f"o_{c}" for c in widths]], outputCol=VECTOR)]


def _code_values(indexed: DataFrame, code: str) -> int:
    return indexed.schema[code].metadata["ml_attr"]["num_vals"]


def ordinal_stages(train: DataFrame, columns: Sequence[str], learned: Learned) -> tuple[list, list[str]]:
    """Most-frequent fill, then the place among the sorted training values, -1 if unseen."""
    if not columns:
        return [], []
    stage = encoder(learned.counts, columns, learned.modes)
    sizes = {c: stage.facts[c]["size"] for c in columns if stage.facts[c]["size"]}
    return [stage, _sql({f"k_{c}": f"IF(`i_{c}` >= {n}, -1D, `i_{c}`)" for c, n in sizes.items()})] if sizes else [], [f"k_{c}" for c in sizes]


def target_mean_stages(train: DataFrame, spec: TableSpec, learned: Learned) -> tuple[list, list[str]]:
    """Numbers with nulls marked, categories as smoothed target means with ``missing`` as a value of its own, of any vocabulary."""
    marks = {f"n_{c}": f"coalesce(CAST(`{c}` AS DOUBLE), {v.number_sql(0.0)})" for c in spec.numeric_features}
    marks |= {f"m_{c}": f"CAST(`{c}` IS NULL AS DOUBLE)" for c in learned.missing}
    stages: list = [_sql(marks)] if marks else []
    if not spec.categorical:
        return stages, list(marks)
    stages.append(TargetEncoder.fitted(train, spec.categorical, dict.fromkeys(spec.categorical, FILLED_CATEGORY), spec.target))
    return stages, [*marks, *[f"t_{c}" for c in spec.categorical]]


def training_rows(
    preparation: PipelineModel, train: DataFrame, id: str, target: str, place: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """The training rows through the preparation; target means come from the rows before each only.

    Stages that move rows, by looking values up in tables or writing them, come first. ``place`` then moves the narrow rows, and the
    other stages widen them where they lie.
    """
    stages = list(preparation.stages)
    if any(isinstance(stage, SparseAssembler) for stage in stages):  # writes the rows and needs all stages before it
        first, last = stages, []
    else:
        first = [stage for stage in stages if isinstance(stage, TableEncoder)]
        last = [stage for stage in stages if not isinstance(stage, TableEncoder)]
    for stage in first:
        train = stage.ordered(train, id, target) if isinstance(stage, TargetEncoder) else stage.transform(train)
    train = place(train)
    for stage in last:
        train = stage.transform(train)
    return train


def fit_preparation(train: DataFrame, spec: TableSpec, kind: str, learned: Learned | None = None) -> PipelineModel:
    """``linear``, ``spline``, ``tree`` or ``native`` preparation ending in one ``features`` vector."""
    learned = learned or learn(train, spec)
    if kind == "native":
        stages, names = target_mean_stages(train, spec, learned)
    else:
        scaled = kind in ("linear", "spline")
        stages, names = numeric_stages(train, spec.numeric_features, learned, scale=scaled, splines=kind == "spline")
        if scaled:
            more, widths = one_hot_stages(train, spec.categorical, learned)
            return PipelineModel([*stages, *more, *assembled(train, stages + more, names, widths)])
        more, more_names = ordinal_stages(train, spec.categorical, learned)
        stages, names = stages + more, names + more_names
    return PipelineModel([*stages, VectorAssembler(inputCols=names, outputCol=VECTOR)])


def spline_columns(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """The frame plus ``<column>_b0`` .. ``_b4``, the spline basis of one column."""
    kept, (stages, names) = df.columns, _spline_stages({column: (low, high)})
    for stage in stages:
        df = stage.transform(df)
    return df.select(*kept, *[F.col(n).alias(f"{column}_b{j}") for j, n in enumerate(names)])
