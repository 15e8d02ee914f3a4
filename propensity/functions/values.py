"""Expressions: the three blank rules, strict parsing, finite values, bins and the spline basis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_CATEGORY = "__MISSING__"

# Blank text and accepted time texts.
BLANK = r"(?U)^\s*$"
TIME = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
NO_TIME = ("", "nat", "nan")


def blank_to_null(text: Column) -> Column:
    """Empty or whitespace-only text is missing (numbers and ids)."""
    return F.when(~text.rlike(BLANK), text)


def empty_to_null(text: Column) -> Column:
    """Only the empty text is missing (categories keep their whitespace)."""
    return F.nullif(text, F.lit(""))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def parsed_number(text: Column) -> Column:
    """Number in the text, null for blank, ``nan`` and malformed text."""
    return nan_to_null(_cast_number(text))


def malformed_number(text: Column) -> Column:
    # The blank pattern is only tried on texts that are no number.
    return F.when(text.isNull() | _cast_number(text).isNotNull(), F.lit(False)).otherwise(~text.rlike(BLANK))


def _cast_number(text: Column) -> Column:
    """Decimal number, ``inf``, ``infinity`` or ``nan`` of any case; Spark's cast alone also takes ``1d``, ``5f``, ``0x1p3``."""
    last = F.lower(F.right(F.rtrim(text), F.lit(1)))
    suffixed = last.isin("d", "f") & ~F.lower(F.rtrim(text)).endswith("inf")
    return F.when(~suffixed & ~F.contains(F.lower(text), F.lit("x")), text.try_cast("double"))


def parsed_time(text: Column) -> Column:
    """Time in the text, read as UTC unless it names a zone; null for empty and malformed text."""
    return F.when(text.rlike(TIME), text.try_cast("timestamp"))


def malformed_time(text: Column) -> Column:
    return F.coalesce(~F.lower(text).isin(*NO_TIME) & parsed_time(text).isNull(), F.lit(False))


def finite(value: Column) -> Column:
    """The value if it is a finite number, else null."""
    return F.when(F.abs(value) < float("inf"), value)


def known_category(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(MISSING_CATEGORY))


def left_closed_bin(column: str, edges: Sequence[float]) -> Column:
    """0-based bin of ``[a, b)`` intervals, the last one closed; the outer edges count as infinite."""
    return _first_match(column, [("<", e) for e in edges[1:-1]])


def right_closed_bin(column: str, edges: Sequence[float]) -> Column:
    """0-based bin of ``(a, b]`` intervals, the lowest edge included."""
    return _first_match(column, [("<=", e) for e in edges[1:-1]])


def _first_match(column: str, tests: Sequence[tuple[str, float]]) -> Column:
    """Number of the first test a double column passes. A CASE chain stops early and stays in generated code."""
    chain = " ".join(f"WHEN `{column}` {sign} {number_sql(x)} THEN {i}" for i, (sign, x) in enumerate(tests))
    return F.expr(f"CASE WHEN `{column}` IS NULL THEN CAST(NULL AS INT) {chain} ELSE {len(tests)} END")


def capacity(rows: Column, fraction: float) -> Column:
    """How many rows a fraction of the table comes to, rounded up in double arithmetic."""
    return F.ceil(rows.cast("double") * F.lit(float(fraction)))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 where the denominator is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.when(bottom != 0, bottom))


# --- SQL text, for transformers that are saved with a model --------------------------------------


def number_sql(x: float) -> str:
    """A double literal that keeps every bit."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def text_sql(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Weights of the five shifted cubes that make up one cubic B-spline.
CUBE_WEIGHTS = ("1D / 6D", "-4D / 6D", "1D", "-4D / 6D", "1D / 6D")


def spline_place(column: str, low: float, high: float, pieces: int = 3) -> str:
    """Place on equal knots 0..pieces; values outside the range go to its border, a single point to 0."""
    step = (high - low) / pieces
    clamped = f"least(greatest(`{column}`, {number_sql(low)}), {number_sql(high)})"
    return f"({clamped} - {number_sql(low)}) / {number_sql(step)}" if step else f"`{column}` * 0D"


def spline_cubes(place: str, pieces: int = 3) -> list[str]:
    """``max(place - m, 0) ** 3`` for the knots m = -3 .. pieces - 1 that lie below some place."""
    return [f"power(greatest(`{place}` - {m}D, 0D), 3D)" for m in range(-3, pieces)]


def spline_basis(cubes: Sequence[str]) -> list[str]:
    """Cubic B-spline basis from the names of the cubes, the last function left out."""
    return [
        " + ".join(f"({w}) * `{cube}`" for w, cube in zip(CUBE_WEIGHTS, cubes[j:]))
        for j in range(len(cubes) - 1)
    ]
