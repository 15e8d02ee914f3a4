"""Strict typing, validation, quarantine and earliest-record deduplication."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.functions import values as v
from propensity.session import materialize
from propensity.spec import HOUR, ROW_NUMBER, WEEKDAY, DataContractError, TableSpec


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where ``broken`` holds; ``column`` supplies the samples of the error."""

    name: str
    column: str
    broken: Column
    message: str


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    absent = [c for c in names if c not in df.columns]
    if absent:
        raise KeyError(f"missing required columns: {absent}")


def needed_columns(spec: TableSpec, require_target: bool) -> list[str]:
    return [spec.id, spec.time, *spec.categorical, *spec.numeric, *([spec.target] if require_target else [])]


def _numeric_columns(spec: TableSpec, require_target: bool) -> list[str]:
    return [*spec.numeric, *([spec.target] if require_target else [])]


def malformed_rules(spec: TableSpec, require_target: bool = True) -> list[Rule]:
    """Texts that are neither blank nor a number / a time. To be applied to the raw text frame."""
    rules = [
        Rule(f"malformed:{c}", c, _malformed(c, spec), f"{c} has malformed numbers")
        for c in _numeric_columns(spec, require_target)
    ]
    return [*rules, Rule(f"malformed:{spec.time}", spec.time, _malformed(spec.time, spec), f"{spec.time} has malformed times")]


def coerce(raw: DataFrame, spec: TableSpec, require_target: bool = True) -> DataFrame:
    """Typed columns from text; malformed cells become null, so run :func:`check` first.

    Blank rules differ: numbers and ids are missing when whitespace-only, categories only when empty.
    """
    require_columns(raw, needed_columns(spec, require_target))
    typed = {c: v.parsed_number(F.col(c)) for c in _numeric_columns(spec, require_target)}
    typed[spec.time] = v.parsed_time(F.col(spec.time))
    typed |= {c: v.empty_to_null(F.col(c)) for c in spec.categorical}
    typed[spec.id] = v.blank_to_null(F.col(spec.id))
    return raw.withColumns(typed)


def contract_rules(spec: TableSpec, require_target: bool = True) -> list[Rule]:
    """Validation rules in the order in which they are reported. To be applied to the typed frame."""
    rules = [
        Rule("id_missing", spec.id, F.col(spec.id).isNull(), f"{spec.id} contains missing values"),
        Rule("time_missing", spec.time, F.col(spec.time).isNull(), f"{spec.time} contains invalid timestamps"),
    ]
    if require_target:
        good = F.coalesce(F.col(spec.target).isin(0, 1), F.lit(False))
        rules.append(Rule("target_invalid", spec.target, ~good, f"{spec.target} must be binary 0/1"))
    for c in spec.binary:
        off = F.coalesce(~v.nan_to_null(F.col(c).cast("double")).isin(0.0, 1.0), F.lit(False))
        rules.append(Rule(f"binary:{c}", c, off, f"{c} contains values outside 0/1"))
    for c, (low, high) in spec.ranges.items():
        off = F.coalesce(~v.nan_to_null(F.col(c).cast("double")).between(float(low), float(high)), F.lit(False))
        rules.append(Rule(f"range:{c}", c, off, f"{c} has values outside [{low}, {high}]"))
    return rules


def count_broken(df: DataFrame, rules: Iterable[Rule], *extra: Column) -> DataFrame:
    """One row: for every rule, how many rows break it. One pass, no shuffle beyond partial counts."""
    return df.agg(*[F.count_if(rule.broken).alias(rule.name) for rule in rules], *extra)


def _judged(raw: DataFrame, spec: TableSpec, require_target: bool) -> tuple[DataFrame, list[Rule]]:
    """The typed frame plus flag columns for malformed text, and all rules stated on that frame."""
    text_rules = malformed_rules(spec, require_target)
    flagged = raw.withColumns({f"_bad{i}": r.broken for i, r in enumerate(text_rules)})
    typed = coerce(flagged, spec, require_target)
    rules = [Rule(r.name, r.column, F.col(f"_bad{i}"), r.message) for i, r in enumerate(text_rules)]
    return typed, rules + contract_rules(spec, require_target)


def violation_counts(raw: DataFrame, spec: TableSpec, require_target: bool = True) -> DataFrame:
    """(rule, rows) of all malformed and contract rules for a raw text frame, in one scan."""
    typed, rules = _judged(raw, spec, require_target)
    return _long(count_broken(typed, rules), "rule", "rows")


def _long(one_row: DataFrame, key: str, value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias(key), F.col(f"`{c}`").alias(value)) for c in one_row.columns])
    return one_row.select(F.inline(pairs))


def _samples(df: DataFrame, rule: Rule, how_many: int) -> list:
    return [r[0] for r in df.where(rule.broken).select(rule.column).limit(how_many).collect()]


def check(df: DataFrame, spec: TableSpec, require_target: bool = True, text: bool = True) -> int:
    """Raise on the first broken rule, in a fixed order; returns the row count. One pass when all is well.

    ``text=False`` is for a frame whose columns are typed already.
    """
    require_columns(df, needed_columns(spec, require_target))
    typed, rules = _judged(df, spec, require_target) if text else (df, contract_rules(spec, require_target))
    extra = [F.count("*").alias("_rows")]
    if require_target:
        extra += [F.min(spec.target).alias("_low"), F.max(spec.target).alias("_high")]
    counts = count_broken(typed, rules, *extra).first()
    for rule in rules:
        if counts[rule.name]:
            # Samples are looked up only once a rule is known to be broken; malformed cells as raw text.
            text_rule = text and rule.name.startswith("malformed:")
            source = df.where(_malformed(rule.column, spec)) if text_rule else typed.where(rule.broken)
            sample = _first_values(source, rule.column, distinct=rule.name == "target_invalid")
            raise DataContractError(f"{rule.message}: {counts[rule.name]} rows; sample={sample}")
        if rule.name == "target_invalid" and counts["_low"] == counts["_high"]:
            raise DataContractError(f"{spec.target} must contain both classes")
    return counts["_rows"]


def _first_values(df: DataFrame, column: str, distinct: bool) -> list:
    """The first three values, or the first five distinct ones, in row order where rows are numbered."""
    numbered = ROW_NUMBER in df.columns
    if distinct:
        at = F.min(ROW_NUMBER) if numbered else F.lit(0)
        shown = df.groupBy(column).agg(F.count("*").alias("_n"), at.alias("_at")).orderBy("_at").limit(5)
    else:
        shown = df.orderBy(ROW_NUMBER).limit(3) if numbered else df.limit(3)
    return [r[0] for r in shown.select(column).collect()]


def _malformed(column: str, spec: TableSpec) -> Column:
    return (v.malformed_time if column == spec.time else v.malformed_number)(F.col(column))


def quarantine(raw: DataFrame, spec: TableSpec, require_target: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split a raw text frame into typed good rows and raw bad rows with their broken rules.

    Every row is judged once and written with its verdict; both frames read that. The class check on the
    whole table stays with :func:`check`.
    """
    require_columns(raw, needed_columns(spec, require_target))
    names = raw.columns
    typed, rules = _judged(raw.withColumn("_raw", F.struct(*names)), spec, require_target)
    found = F.array_compact(F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules]))
    listed = typed.withColumn("_reasons", found)
    raw_if_bad = F.when(F.size("_reasons") > 0, F.col("_raw")).alias("_raw")
    judged = materialize(listed.select(*names, "_reasons", raw_if_bad))
    good = judged.where(F.size("_reasons") == 0).select(*names)
    return good, judged.where(F.size("_reasons") > 0).select("_raw.*", F.col("_reasons").alias("reasons"))


def keep_earliest(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Earliest row per id, ties by the spec's tie-break columns (the file row number by default).

    Keeping only rank 1 lets Spark reduce every map partition to one row per id before the shuffle
    (WindowGroupLimit), so an id that holds a large share of the rows stays cheap.
    """
    order = [spec.time, *[c for c in spec.tie_break if c in df.columns]]
    first = Window.partitionBy(spec.id).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def derive_time_parts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Hour of day and weekday (Monday = 0) as doubles."""
    return df.withColumns(
        {HOUR: F.hour(spec.time).cast("double"), WEEKDAY: F.weekday(spec.time).cast("double")}
    )


@dataclass(frozen=True)
class Prepared:
    frame: DataFrame
    rows_in: int

    def duplicates_removed(self) -> int:
        return self.rows_in - self.frame.count()


def prepare(raw: DataFrame, spec: TableSpec, require_target: bool = True, text: bool = True) -> Prepared:
    """Type, validate, deduplicate and derive; ``text=False`` for a frame whose columns are typed already."""
    rows = check(raw, spec, require_target, text)
    typed = coerce(raw, spec, require_target) if text else raw
    if require_target:
        typed = typed.withColumn(spec.target, F.col(spec.target).cast("int"))
    frame = keep_earliest(typed, spec)
    return Prepared(derive_time_parts(frame, spec) if spec.derive_time_parts else frame, rows)


def select_features(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*spec.features)
