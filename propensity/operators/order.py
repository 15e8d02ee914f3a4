"""Exact global order without a single task: ranks, running totals and order statistics.

Rows are range-partitioned on the full sort key, so a value shared by a third of the rows is still cut
into many slices by the next key. Only one number per slice (and group) is combined across slices.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.session import materialize

SLICE = "_slice"
POSITION = "_position"

# A slice number sits above bit 33 of Spark's increasing id, the row's place in the slice below it.
_PLACE_MASK = (1 << 33) - 1


def _in_slices(df: DataFrame, keys: Sequence[Column], slices: int | None) -> DataFrame:
    return df.repartitionByRange(slices, *keys) if slices else df.repartitionByRange(*keys)


def placed_in_slices(df: DataFrame, keys: Sequence[Column], slices: int | None = None) -> DataFrame:
    """Sort globally: slice number plus 1-based place inside the slice."""
    return (
        _in_slices(df, keys, slices)
        .sortWithinPartitions(*keys)
        .withColumns(
            {
                SLICE: F.spark_partition_id(),
                POSITION: F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_MASK)) + 1,
            }
        )
    )


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    rank: str = "rank",
    total: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """1..n along ``order`` (inside each ``by`` group), optionally with n itself as a column.

    ``order`` must be total for a repeatable result. One range shuffle; the placed rows are written once,
    because offsets from one run must not meet slices of another.
    """
    placed = materialize(placed_in_slices(df, [F.col(c) for c in by] + list(order), slices))
    # At most one row per slice plus one per group.
    pieces = placed.groupBy(SLICE, *by).agg(F.min(POSITION).alias("_first"), F.count("*").alias("_rows"))
    ahead = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = pieces.select(
        SLICE,
        *by,
        (F.coalesce(F.sum("_rows").over(ahead), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_rows").over(whole).alias("_total"),
    )
    ranked = placed.join(offsets, [SLICE, *by])  # as many rows as slices and groups; the join is Spark's choice
    extra = [F.col("_total").alias(total)] if total else []
    return ranked.select(*df.columns, (F.col(POSITION) + F.col("_shift")).cast("long").alias(rank), *extra)


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Inclusive running sums along ``order`` (inside each ``by`` group).

    ``sums`` maps the new column to the summed one, a whole number or a double. ``order`` should be unique inside a group: group by
    the ordering value first, which also takes ties out of the shuffle. One range shuffle; a task adds up its sorted rows as they come,
    and what the slices before it hold is added after.
    """
    sliced = _in_slices(df, [F.col(c) for c in by] + list(order), slices).sortWithinPartitions(*by, *order)
    marks = [F.xxhash64(F.lit(seed), *by).alias(f"_group{seed}") for seed in (1, 2)]
    kinds = {name: "double" if isinstance(df.schema[c].dataType, T.FractionalType) else "long" for name, c in sums.items()}
    inside = [F.col(c).cast(kinds[name]).alias(f"_in_{name}") for name, c in sums.items()]
    placed = sliced.select("*", F.spark_partition_id().alias(SLICE), *marks, *inside)
    local = materialize(placed.mapInArrow(_added_up([f"_in_{name}" for name in sums]), placed.schema).drop("_group1", "_group2"))
    pieces = local.groupBy(SLICE, *by).agg(*[F.sum(column).alias(f"_all_{name}") for name, column in sums.items()])
    ahead = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        F.col(SLICE).alias("_at"),
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
        *[F.coalesce(F.sum(f"_all_{name}").over(ahead), F.lit(0)).alias(f"_off_{name}") for name in sums],
    )
    # null groups are groups, too
    same = [F.col(SLICE) == F.col("_at"), *[F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]]
    return local.join(offsets, same).select(
        *df.columns, *[(F.col(f"_in_{name}") + F.col(f"_off_{name}")).alias(name) for name in sums]
    )


def _added_up(columns: Sequence[str]):
    """Running sums of ``columns`` over a partition's rows as they come, from nothing where the group changes; nulls add nothing."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (batch.column(c).to_numpy() for c in ("_group1", "_group2"))
            new = np.ones(len(one), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            new[0] = (one[0], two[0]) != last
            start = np.maximum.accumulate(np.where(new, np.arange(len(one)), -1))  # -1: the group goes on from the batch before
            arrays = list(batch.columns)
            for c in columns:
                at = batch.schema.get_field_index(c)
                sums = np.cumsum(batch.column(at).fill_null(0).to_numpy(zero_copy_only=False))
                before = np.concatenate([[0], sums])[np.maximum(start, 0)].astype(sums.dtype)
                sums = sums - before + np.where(start < 0, carried.get(c, 0), 0).astype(sums.dtype)
                arrays[at], carried[c] = pa.array(sums, batch.column(at).type), sums[-1]
            last = one[-1], two[-1]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return add


# --- selection of places ------------------------------------------------------------------------

BITS = 10  # of a key that one scan settles
VALUES = 1_000  # rows of an interval whose keys are counted one by one
_LONGEST = (1 << 63) - 1
_MANTISSA = 1 << 52


def ordered_bits(value: Column) -> Column:
    """A double as a whole number of the same order: its sign, exponent and fraction bits. NaN is the largest, both zeros are one."""
    power = _power(value)
    return _bits(value, power, _part(value, power))


def _power(value: Column) -> Column:
    """The exponent that the logarithm suggests; it may be off by one."""
    return F.greatest(F.least(F.floor(F.log2(F.abs(value))).cast("double"), F.lit(1023.0)), F.lit(-1022.0))


def _part(value: Column, power: Column) -> Column:
    """What the power leaves, exactly, as powers of two are exact: at least 1 and below 2, or half or twice that."""
    return F.abs(value) / F.pow(F.lit(2.0), power)


def _bits(value: Column, power: Column, part: Column) -> Column:
    size = F.abs(value)
    fraction = F.when(part >= 2, part / 2).when(part < 1, 2 * part - 2).otherwise(part - 1)  # with the exponent put right
    normal = (power + 1023).cast("long") * _MANTISSA + (fraction * float(_MANTISSA)).cast("long")
    small = (size / F.lit(5e-324)).cast("long")
    bits = F.when(size == math.inf, F.lit(2047 * _MANTISSA)).when(size >= 2.2250738585072014e-308, normal).otherwise(small)
    return F.when(F.isnan(value), F.lit(_LONGEST)).when(value < 0, -bits).otherwise(bits)


def double_of(bits: int) -> float:
    """The double with these :func:`ordered_bits`."""
    if bits == _LONGEST:
        return math.nan
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(bits)))[0], -1.0 if bits < 0 else 1.0)


def text_keys(text: Column, width: int) -> list[Column]:
    """Whole numbers that order texts of up to ``width`` bytes like their bytes: seven bytes each, with how many there are."""
    data = F.encode(text, "UTF-8")
    keys = []
    for at in range(0, max(width, 1), 7):
        part = F.substring(data, at + 1, 7)
        bits = F.conv(F.rpad(F.hex(part), 14, "0"), 16, 10).cast("long")
        keys.append(F.shiftleft(bits, 3) + F.octet_length(part))
    return keys


@dataclass(frozen=True)
class Search:
    """Places (from 0) sought among the rows that meet ``where``, ordered by ``keys`` one after the other; keys are whole numbers
    without null, within ``ends``."""

    where: Column | None
    keys: tuple[Column, ...]
    ends: tuple[tuple[int, int], ...]
    rows: int
    places: tuple[int, ...]


@dataclass(frozen=True)
class _Part:
    """Rows of a search whose first keys are ``settled`` and whose next one lies from ``low`` to ``high``."""

    search: int
    settled: tuple[int, ...]
    low: int
    high: int
    rows: int
    below: int
    sums: tuple[int, ...]  # of all rows below
    places: tuple[int, ...]


def select_places(df: DataFrame, searches: Sequence[Search], sums: Sequence[Column] = ()) -> list[dict[int, tuple]]:
    """For each search ``{place: (keys at the place, sums over the rows before it)}``, without ordering any rows.

    Each scan counts the rows of the open parts by the next ``BITS`` bits of their key. The place's bin, from its smallest to its largest
    key, is the next part, so a key of 64 bits takes 7 scans at most whatever the values are. What moves are counters, at most 2^BITS for each part
    and task. A place at the start of a bin is not followed further if only sums are asked for.
    """
    found: list[dict[int, tuple]] = [{} for _ in searches]
    parts = [_Part(i, (), *s.ends[0], s.rows, 0, (0,) * len(sums), s.places) for i, s in enumerate(searches) if s.places]
    parts = _open(parts, searches, found)
    while parts:
        parts = _open(_scanned(df, searches, parts, sums, found), searches, found)
    return found


def _open(parts: list[_Part], searches: Sequence[Search], found: list[dict]) -> list[_Part]:
    """Parts with one key go on with the next key; after the last one their places are found."""
    rest = []
    for p in parts:
        while p is not None and p.low == p.high:
            settled, ends = (*p.settled, p.low), searches[p.search].ends
            if len(settled) == len(ends):
                found[p.search].update({place: (settled, p.sums) for place in p.places})
                p = None
            else:
                p = replace(p, settled=settled, low=ends[len(settled)][0], high=ends[len(settled)][1])
        if p is not None:
            rest.append(p)
    return rest


def _scanned(df: DataFrame, searches: Sequence[Search], parts: list[_Part], sums: Sequence[Column], found: list[dict]) -> list[_Part]:
    """One scan: the parts of the next one."""
    cells = []
    for i, p in enumerate(parts):
        s, depth = searches[p.search], len(p.settled)
        key, inside = s.keys[depth], s.where
        for k, at in zip(s.keys, p.settled):
            inside = k == at if inside is None else inside & (k == at)
        if p.rows < s.rows or inside is None:
            between = key.between(p.low, p.high)
            inside = between if inside is None else inside & between
        shift = 0 if p.rows <= VALUES else max(0, ((p.high >> 1) - (p.low >> 1)).bit_length() + 1 - BITS)
        cells.append(F.when(inside, F.struct(F.lit(i).alias("i"), F.shiftright(key, shift).alias("bin"), key.alias("key"))))
    added = [x.cast("long").alias(f"s{j}") for j, x in enumerate(sums)]
    hits = df.select(F.explode(F.array(*cells)).alias("x"), *added).where("x IS NOT NULL").select("x.*", *[f"s{j}" for j in range(len(sums))])
    totals = [F.coalesce(F.sum(f"s{j}"), F.lit(0)).alias(f"s{j}") for j in range(len(sums))]
    counted = hits.groupBy("i", "bin").agg(F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"), *totals)
    bins: dict[int, list] = {}
    for r in counted.collect():  # 2^BITS rows for each part at most, or VALUES
        bins.setdefault(r["i"], []).append((r["low"], r["high"], r["rows"], tuple(r[f"s{j}"] for j in range(len(sums)))))
    following = []
    for i, p in enumerate(parts):
        below, so_far = p.below, p.sums
        for low, high, rows, here in sorted(bins.get(i, [])):
            mine = tuple(x for x in p.places if below <= x < below + rows)
            if sums and below in mine:  # nothing of the bin stands before its first place
                found[p.search][below] = ((*p.settled, low), so_far)
                mine = tuple(x for x in mine if x != below)
            if mine:
                following.append(_Part(p.search, p.settled, low, high, rows, below, so_far, mine))
            below, so_far = below + rows, tuple(a + b for a, b in zip(so_far, here, strict=True))
        if below != p.below + p.rows:
            raise RuntimeError("the rows changed between two scans; materialize the frame first")
    return following


# --- order statistics ---------------------------------------------------------------------------


def order_statistics(df: DataFrame, wanted: Mapping[str, Iterable[tuple[float, str]]]) -> dict:
    """Exact values at given shares of the sorted non-null values, for many columns at once.

    ``wanted`` maps a column to ``(share, how)`` pairs; ``how`` is ``linear`` (interpolated) or ``nearest``
    (place ``(n-1)*share`` rounded half to even). Returns ``{column: {(share, how): value}}``; None if a
    column has no value.

    Values become whole numbers of the same order: doubles their bits, whole numbers themselves, decimals of up to 18 digits their digits. Places
    are found by :func:`select_places`, all columns in the same scans. Other columns count as doubles.

    NaN counts as null. ``nearest`` gives whole numbers and decimals exactly, of any size; ``linear`` gives the nearest double.
    """
    wanted = {c: list(dict.fromkeys(pairs)) for c, pairs in wanted.items()}
    if not wanted:
        return {}
    kinds = {c: _kind(df.schema[c].dataType) for c in wanted}
    columns = {f"k{i}": c for i, c in enumerate(wanted)}
    keyed = _keyed(df, columns, kinds)
    if is_computed(df):
        keyed = materialize(keyed)
    facts = keyed.agg(*[F.struct(F.count(k).alias("n"), F.min(k).alias("low"), F.max(k).alias("high")).alias(k) for k in columns]).first()
    searches, sizes = [], {}
    for k, c in columns.items():
        n = sizes[c] = facts[k]["n"]
        places = tuple(sorted({p for share, how in wanted[c] for p in _places(n, share, how)})) if n else ()
        searches.append(Search(None, (F.col(k),), ((facts[k]["low"], facts[k]["high"]),), n, places))
    found = select_places(keyed, searches)
    result = {}
    for places, (c, pairs) in zip(found, wanted.items(), strict=True):
        values = {p: _value_of(keys[0], kinds[c]) for p, (keys, _) in places.items()}
        result[c] = {pair: _value(values, sizes[c], *pair) if sizes[c] else None for pair in pairs}
    return result


def _kind(data_type: T.DataType) -> int | None:
    """The decimal digits behind the point of an exact type; None for a double."""
    if isinstance(data_type, T.IntegralType):
        return 0
    if isinstance(data_type, T.DecimalType) and data_type.precision <= 18:
        return data_type.scale
    return None


def _keyed(df: DataFrame, columns: Mapping[str, str], kinds: Mapping[str, int | None]) -> DataFrame:
    """The keys of all columns, in three steps so that no expression repeats another."""
    doubles = [k for k, c in columns.items() if kinds[c] is None]
    values = df.select(*[_value_for_key(F.col(f"`{c}`"), kinds[c]).alias(k) for k, c in columns.items()])
    powers = values.select("*", *[_power(F.col(k)).alias(f"{k}_power") for k in doubles])
    parts = powers.select("*", *[_part(F.col(k), F.col(f"{k}_power")).alias(f"{k}_part") for k in doubles])
    bits = {k: F.when(F.col(k).isNotNull(), _bits(F.col(k), F.col(f"{k}_power"), F.col(f"{k}_part"))) for k in doubles}
    return parts.select(*[bits.get(k, F.col(k)).alias(k) for k in columns])


def _value_for_key(value: Column, kind: int | None) -> Column:
    if kind is None:
        return F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return (value.cast(f"decimal(38,{kind})") * F.lit(10**kind)).cast("long") if kind else value.cast("long")


def _value_of(key: int, kind: int | None) -> float | int | Decimal:
    if kind is None:
        return double_of(key)
    return Decimal(key).scaleb(-kind) if kind else key


_COMPUTED = re.compile(r"^\W*(Join|Aggregate|Window|Generate|Sort|Repartition|RebalancePartitions|MapIn|FlatMap|Deduplicate|Distinct)", re.MULTILINE)


def is_computed(df: DataFrame) -> bool:
    """Whether each scan would join, group or sort anew; a plain table is read again instead of written."""
    return bool(_COMPUTED.search(df._jdf.queryExecution().optimizedPlan().toString()))


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of many columns; nulls are left out."""
    result = order_statistics(df, {c: [(share, "linear") for share in shares] for c in columns})
    return {c: [result[c][(share, "linear")] for share in shares] for c in columns}


def deciles(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Distinct edges of the eleven decile points of each column that has a value."""
    shares = [k * 0.1 for k in range(10)] + [1.0]
    return {c: sorted(set(v)) for c, v in quantiles(df, columns, shares).items() if v[0] is not None}


def _places(n: int, share: float, how: str) -> list[int]:
    at = (n - 1) * share
    return [round(at)] if how == "nearest" else [math.floor(at), math.ceil(at)]


def _value(found: Mapping[int, float | int | Decimal], n: int, share: float, how: str) -> float | int | Decimal:
    at = (n - 1) * share
    if how == "nearest":
        return found[round(at)]
    low, high, part = found[math.floor(at)], found[math.ceil(at)], at - math.floor(at)
    if not all(isinstance(x, float) or float(x) == x for x in (low, high)):  # no doubles: interpolated exactly, rounded once
        return float(Fraction(low) + (Fraction(high) - Fraction(low)) * Fraction(part))
    low, high = float(low), float(high)
    gap = high - low
    return low + gap * part if part < 0.5 else high - gap * (1 - part)
