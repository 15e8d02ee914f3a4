"""Data-quality measures, all as small frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.functions import values as v
from propensity.operators.order import deciles, quantiles
from propensity.session import materialize
from propensity.spec import TableSpec

# Texts that often stand for "no value".
SENTINELS = ("-999", "999999", "N/A", "unknown")


def per_column(df: DataFrame, aggregates: Mapping[str, object], key: str = "column", value: str = "rows") -> DataFrame:
    """One aggregate per column in a single pass, returned as (column, value) rows."""
    if not aggregates:
        return df.sparkSession.createDataFrame([], f"{key} string, {value} long")
    one_row = df.agg(*[a.alias(c) for c, a in aggregates.items()])
    return one_row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias(key), F.col(f"`{c}`").alias(value)) for c in aggregates]))
    )


def missing_counts(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null or exactly empty cells per raw column (whitespace counts as a value here)."""
    blank = {c: F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")) for c in columns}
    return per_column(raw, blank, value="missing")


def duplicate_counts(raw: DataFrame, spec: TableSpec, columns: Sequence[str]) -> DataFrame:
    """Exact duplicate rows and duplicate ids beyond the first; null ids equal each other."""

    def extra(keys: Sequence[str], name: str) -> DataFrame:
        beyond_first = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")
        counts = raw.groupBy(*keys).agg(F.count("*").alias("_n"))
        return counts.agg(beyond_first).select(F.lit(name).alias("measure"), "duplicates")

    return extra(columns, "duplicate_rows").unionByName(extra([spec.id], "duplicate_ids"))


def near_duplicate_records(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, groups, rows) for every one of ``columns``: groups of rows that agree in all the others but not in it, and their rows.

    A row's key without a column is the exclusive or of the other columns' digests, so all keys come from one pass. Rows that differ in one column agree
    in the whole first or the whole second half of the columns: only rows whose half occurs again get their keys without each column of
    the other half. Groups are counted with the smallest and largest digest of the column left out, which maps sum up before the
    shuffle; no group is held together and no pairs are formed, whatever its size. Digests have 128 bits. Nulls equal each other and nothing else.
    """
    halves = columns[: len(columns) // 2], columns[len(columns) // 2 :]
    digests = {c: [F.xxhash64(F.lit(seed), F.lit(i), F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for seed in (1, 2)] for i, c in enumerate(columns)}

    def both(names: Sequence[str], less: str | None = None) -> list:
        parts = [digests[c] for c in names if c != less]
        return [reduce(lambda a, b: a.bitwiseXOR(b), p) for p in zip(*parts)] if parts else [F.lit(0).cast("long")] * 2

    sides = []
    for kept, other in (halves, halves[::-1]):
        left_out = [F.struct(F.lit(columns.index(c)).alias("at"), *[h.alias(f"o{j}") for j, h in enumerate(both(other, c))], *[h.alias(f"v{j}") for j, h in enumerate(digests[c])]) for c in other]
        if left_out:
            sides.append(F.struct(F.lit(len(sides)).alias("side"), *[h.alias(f"h{j}") for j, h in enumerate(both(kept))], F.array(*left_out).alias("left_out")))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "at int, column string")
    keyed = df.select(F.explode(F.array(*sides)).alias("x")).select("x.*")
    half = ["side", "h0", "h1"]
    again = keyed.groupBy(*half).agg(F.count("*").alias("n")).where("n > 1").select(*half)
    keys = keyed.join(again, half, "left_semi").select(*half, F.explode("left_out").alias("x")).select(*half, "x.*")
    least, most = F.min(F.struct("v0", "v1")), F.max(F.struct("v0", "v1"))
    groups = keys.groupBy(*half, "at", "o0", "o1").agg(F.count("*").alias("rows"), least.alias("least"), most.alias("most")).where("least <> most")
    counts = groups.groupBy("at").agg(F.count("*").alias("groups"), F.sum("rows").alias("rows"))
    return names.join(counts, "at", "left").select("column", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("groups", "rows")])


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, rows) for every distinct value, nulls included."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, rows long")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(cells)).groupBy("column", "value").agg(F.count("*").alias("rows"))


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column."""
    return value_counts(df, columns).groupBy("column").agg(F.count("value").alias("distinct_values"))


def rare_categories(df: DataFrame, columns: Sequence[str], floor: int = 20, share: float = 0.001) -> DataFrame:
    """Values seen fewer than ``max(floor, int(share * rows))`` times, commonest first; a null shows as ``nan``."""
    counts = value_counts(df, columns)
    limit = F.greatest(F.lit(floor), F.floor(F.sum("rows") * F.lit(share)))
    minimum = counts.groupBy("column").agg(limit.alias("minimum"))
    return (
        counts.join(F.broadcast(minimum), "column")  # one row per column
        .where("rows < minimum")
        .select("column", F.coalesce("value", F.lit("nan")).alias("value"), "rows")
        .orderBy("column", F.desc("rows"), "value")
    )


def outlier_counts(df: DataFrame, columns: Sequence[str], reach: float = 3.0) -> DataFrame:
    """Values strictly outside the quartiles by more than ``reach`` interquartile ranges."""
    quartiles = quantiles(df, columns, [0.25, 0.75])
    outside = {}
    for c in columns:
        low, high = quartiles[c]
        if low is None:
            outside[c] = F.lit(0).cast("long") * F.count("*")
            continue
        span = high - low
        value = F.col(c).cast("double")
        outside[c] = F.count_if((value < low - reach * span) | (value > high + reach * span))
    return per_column(df, outside, value="outliers")


def monthly_rate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows and conversion rate per calendar month."""
    month = F.date_format(spec.time, "yyyy-MM").alias("month")
    return df.groupBy(month).agg(
        F.count(spec.target).alias("rows"), F.avg(F.col(spec.target).cast("double")).alias("rate")
    )


def decile_rate(df: DataFrame, column: str, target: str) -> DataFrame:
    """Conversion rate per decile bin ``(a, b]`` of a numeric column; repeated edges are merged."""
    edges = deciles(df, [column]).get(column, [])  # none for a column without values, which then has no rows
    bucket = v.right_closed_bin(column, edges) + 1
    return (
        df.select(F.col(column).cast("double").alias(column), target)
        .where(F.col(column).isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("rows"), F.avg(F.col(target).cast("double")).alias("rate"))
    )


def conflicting_targets(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Ids whose rows disagree on the target."""
    low, high = F.min(spec.target), F.max(spec.target)
    return df.groupBy(spec.id).agg(F.count("*").alias("rows"), low.alias("low"), high.alias("high")).where(
        "low < high"
    )


def sentinel_counts(raw: DataFrame, columns: Sequence[str], sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """How often each stand-in text occurs over all columns."""
    text = [F.trim(F.col(c).cast("string")) for c in columns]
    hits = {s: F.sum(sum((F.coalesce((t == s).cast("long"), F.lit(0)) for t in text), F.lit(0))) for s in sentinels}
    return per_column(raw, hits, key="sentinel", value="cells")


def near_constant(df: DataFrame, columns: Sequence[str], share: float = 0.995) -> DataFrame:
    """Columns whose most common value (nulls included) covers at least ``share`` of the rows."""
    counts = value_counts(df, columns).groupBy("column").agg(F.max("rows").alias("top"), F.sum("rows").alias("all"))
    return counts.select("column", (F.col("top") / F.col("all")).alias("top_share")).where(F.col("top_share") >= share)


def prevalence_before_after(raw: DataFrame, clean: DataFrame, spec: TableSpec) -> DataFrame:
    """Target prevalence in the raw table and after deduplication."""
    rate = F.avg(F.col(spec.target).cast("double")).alias("prevalence")
    before = raw.agg(rate).select(F.lit("raw").alias("stage"), "prevalence")
    return before.unionByName(clean.agg(rate).select(F.lit("deduplicated").alias("stage"), "prevalence"))


def id_pattern(df: DataFrame, id_column: str, pattern: str) -> DataFrame:
    """Share of ids that match a pattern, and whether their numbers run without a gap."""
    number = F.regexp_extract(F.col(id_column).cast("string"), r"(\d+)$", 1).try_cast("long")
    span = F.max("number") - F.min("number") + 1
    return (
        df.select(F.col(id_column).cast("string").alias("id"), number.alias("number"))
        .groupBy("id", "number")
        .agg(F.count("*").alias("n"))
        .agg(
            (F.sum(F.when(F.col("id").rlike(pattern), F.col("n")).otherwise(0)) / F.sum("n")).alias("pattern_share"),
            F.coalesce((span == F.count("*")) & (F.count("number") == F.count("*")), F.lit(False)).alias("sequential"),
            F.sum(F.col("n") - 1).alias("repeated_ids"),
        )
    )


def effect_screen(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Strength of each feature alone: standardised mean difference, or Cramér's V for categories."""
    if not spec.numeric_features:
        return _cramers_v(df, spec)
    y = F.col(spec.target) == 1
    aggregates = []
    for c in spec.numeric_features:
        x = F.col(c).cast("double")
        for side, rows in (("1", y), ("0", ~y)):
            aggregates += [
                F.avg(F.when(rows, x)).alias(f"m{side}:{c}"),
                F.var_pop(F.when(rows, x)).alias(f"v{side}:{c}"),
            ]
    moments = df.agg(*aggregates)
    scale = {c: F.sqrt((F.col(f"`v1:{c}`") + F.col(f"`v0:{c}`")) / 2) for c in spec.numeric_features}
    gap = {c: F.abs(F.col(f"`m1:{c}`") - F.col(f"`m0:{c}`")) for c in spec.numeric_features}
    numeric = moments.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), v.ratio(gap[c], scale[c]).alias("effect"))
                    for c in spec.numeric_features
                ]
            )
        )
    )
    return numeric.unionByName(_cramers_v(df, spec)) if spec.categorical else numeric


def _cramers_v(df: DataFrame, spec: TableSpec) -> DataFrame:
    """V of category against the 0/1 target; for a two-column table V² is the chi-square over n."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), v.known_category(F.col(c)).alias("value")) for c in spec.categorical]
    )
    counts = (
        df.select(F.col(spec.target).cast("double").alias("y"), F.inline(cells))
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"), F.sum("y").alias("pos"))
    )
    totals = counts.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum("pos").alias("positives"))
    rate = F.col("positives") / F.col("rows")
    # Σ (observed − expected)² / expected over both target classes of a category.
    term = (F.col("pos") - F.col("n") * rate) * (F.col("pos") - F.col("n") * rate) / F.col("n")
    joined = counts.join(F.broadcast(totals), "feature")  # one row per feature
    spread = joined.groupBy("feature").agg(
        F.sum(term).alias("spread"), F.first(rate).alias("rate"), F.first("rows").alias("rows")
    )
    chi = v.ratio(F.col("spread"), F.col("rate") * (1 - F.col("rate")) * F.col("rows"))
    return spread.select("feature", F.sqrt(chi).alias("effect"))


def observed_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def quality_report(raw: DataFrame, clean: DataFrame, spec: TableSpec) -> DataFrame:
    """All fields of the quality report as (metric, column, value) rows with text values."""
    columns = [c for c in spec.columns if c in raw.columns]

    def rows(df: DataFrame, metric: str, column: str | None, value: str) -> DataFrame:
        name = F.col(column) if column else F.lit(None).cast("string")
        return df.select(F.lit(metric).alias("metric"), name.alias("column"), F.col(value).cast("string").alias("value"))

    raw_facts = raw.agg(F.count("*").alias("rows_raw"))
    facts = clean.agg(
        F.count("*").alias("rows_clean"),
        F.lit(len(columns)).alias("columns"),
        F.avg(F.col(spec.target).cast("double")).alias("target_prevalence"),
        F.min(spec.time).alias("date_min"),
        F.max(spec.time).alias("date_max"),
    )
    duplicates = duplicate_counts(raw, spec, columns)
    parts = [
        *[rows(raw_facts, m, None, m) for m in raw_facts.columns],
        *[rows(facts, m, None, m) for m in facts.columns],
        duplicates.select(
            F.col("measure").alias("metric"),
            F.lit(None).cast("string").alias("column"),
            F.col("duplicates").cast("string").alias("value"),
        ),
        rows(missing_counts(raw, columns), "missing_counts", "column", "missing"),
        rows(cardinality(clean, spec.categorical), "cardinality", "column", "distinct_values"),
        rows(rare_categories(clean, spec.categorical), "rare_categories", "column", "value"),
        rows(outlier_counts(clean, spec.numeric), "outliers", "column", "outliers"),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def quality_findings(raw: DataFrame, clean: DataFrame, spec: TableSpec, pattern: str = r"^\S+$") -> DataFrame:
    """(metric, column, value as text): conflicting targets, effects, stand-in texts, near-constant columns, id pattern, records that
    differ in one column only, prevalence before and after cleaning, and observed types."""
    columns = [c for c in spec.columns if c in raw.columns]
    nothing = F.lit(None).cast("string")

    def rows(df: DataFrame, metric: str, column, value) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), column.alias("column"), value.cast("string").alias("value"))

    ids = id_pattern(raw, spec.id, pattern)
    near = materialize(near_duplicate_records(raw, columns))
    # raw rows may hold text; those without a valid target don't count
    target = v.parsed_number(F.col(spec.target).cast("string"))
    read = raw.select(F.when(target.isin(0, 1), target).alias(spec.target))
    parts = [
        rows(conflicting_targets(clean, spec).agg(F.count("*").alias("n")), "conflicting_targets", nothing, F.col("n")),
        rows(effect_screen(clean, spec), "effect", F.col("feature"), F.col("effect")),
        rows(sentinel_counts(raw, columns), "sentinels", F.col("sentinel"), F.col("cells")),
        rows(near_constant(clean, list(spec.features)), "near_constant", F.col("column"), F.col("top_share")),
        *[rows(ids, f"id_{c}", F.lit(spec.id), F.col(c)) for c in ids.columns],
        *[rows(near, f"near_duplicate_{c}", F.col("column"), F.col(c)) for c in ("groups", "rows")],
        rows(prevalence_before_after(read, clean, spec), "prevalence", F.col("stage"), F.col("prevalence")),
        rows(observed_types(clean), "observed_type", F.col("column"), F.col("type")),
    ]
    return reduce(DataFrame.unionByName, parts)


def top_values(counts: DataFrame) -> DataFrame:
    """Most common non-null value of each column of a :func:`value_counts` frame; ties go to the smallest.

    Keeping rank 1 only, every map partition sends one row a column.
    """
    best = Window.partitionBy("column").orderBy(F.desc("rows"), "value")
    nth = counts.where("value is not null").withColumn("_nth", F.row_number().over(best))
    return nth.where("_nth = 1").drop("_nth")
