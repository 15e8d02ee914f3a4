from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensity.operators.order import (
    Search,
    deciles,
    double_of,
    global_rank,
    order_statistics,
    ordered_bits,
    quantiles,
    running_totals,
    select_places,
    text_keys,
)


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows share one score."""
    frame = spark.range(20_000).select(
        "id",
        F.when(F.rand(1) < 0.34, 0.5).otherwise(F.rand(2)).alias("score"),
        (F.col("id") % 3).alias("model"),
        F.when(F.col("id") % 5 > 0, F.round(F.randn(3), 2)).alias("gaps"),
    )
    return frame.cache()


@pytest.mark.parametrize("slices", [None, 1, 7])
def test_rank_equals_a_sort(values, slices):
    got = global_rank(values, [F.desc("score"), F.asc("id")], total="n", slices=slices).toPandas()
    wanted = values.toPandas().sort_values(["score", "id"], ascending=[False, True])
    assert got.sort_values("rank")["id"].tolist() == wanted["id"].tolist()
    assert sorted(got["rank"]) == list(range(1, 20_001))
    assert (got["n"] == 20_000).all()


def test_rank_inside_groups(values):
    got = global_rank(values, [F.desc("score"), F.asc("id")], by=["model"], total="n", slices=5).toPandas()
    wanted = values.toPandas().sort_values(["score", "id"], ascending=[False, True])
    wanted["rank"] = wanted.groupby("model").cumcount() + 1
    merged = got.merge(wanted, on="id")
    assert (merged["rank_x"] == merged["rank_y"]).all()
    assert got.groupby("model")["n"].first().tolist() == wanted.groupby("model").size().tolist()


def test_a_hot_score_is_spread_over_slices(values):
    from propensity.operators.order import SLICE, placed_in_slices

    placed = placed_in_slices(values, [F.desc("score"), F.asc("id")], 8)
    sizes = [r["count"] for r in placed.groupBy(SLICE).count().collect()]
    assert len(sizes) == 8
    assert max(sizes) < 20_000 / 4


@pytest.mark.parametrize("slices", [None, 6])
@pytest.mark.parametrize("by", [[], ["model"]])
def test_running_totals(values, slices, by):
    grouped = values.groupBy(*by, "score").agg(F.count("*").alias("n"))
    got = running_totals(grouped, [F.desc("score")], {"total": "n"}, by=by, slices=slices).toPandas()
    wanted = got.sort_values("score", ascending=False)
    sums = wanted.groupby(by)["n"].cumsum() if by else wanted["n"].cumsum()
    assert (sums == wanted["total"]).all()


@pytest.mark.parametrize("rows", [1, 2, 3, 150, 999, 20_000])
def test_quantiles_match_numpy_to_the_bit(values, rows):
    part = values.where(F.col("id") < rows)
    shares = list(np.linspace(0, 1, 11))
    got, frame = quantiles(part, ["score", "gaps"], shares), part.toPandas()
    for c in ("score", "gaps"):
        known = frame[c].dropna()
        assert got[c] == (list(np.quantile(known, shares)) if len(known) else [None] * 11)


@pytest.mark.parametrize("bits, limit", [(1, 1), (2, 7), (8, 1), (8, 10**9)])
def test_places_need_any_number_of_scans(values, monkeypatch, bits, limit):
    from propensity.operators import order

    monkeypatch.setattr(order, "BITS", bits)
    monkeypatch.setattr(order, "VALUES", limit)
    part = values.where("id < 3000")
    got = quantiles(part, ["score"], [0.25, 0.5, 1.0])
    assert got["score"] == list(np.quantile(part.toPandas()["score"], [0.25, 0.5, 1.0]))


@pytest.fixture
def scans(monkeypatch):
    from propensity.operators import order

    counted, scanned = [], order._scanned
    monkeypatch.setattr(order, "_scanned", lambda *a: counted.append(1) or scanned(*a))
    return counted


@pytest.mark.parametrize("spread", ["log-uniform", "lognormal", "uniform", "whole"])
def test_the_number_of_scans_does_not_follow_the_spread(spark, scans, spread):
    rng = np.random.default_rng(4)
    many = {
        "log-uniform": rng.choice([-1, 1], 20_000) * 10.0 ** rng.uniform(-320, 308, 20_000),
        "lognormal": rng.lognormal(0, 10, 20_000),
        "uniform": rng.random(20_000),
        "whole": rng.integers(-(1 << 63), (1 << 63) - 1, 20_000),
    }[spread]
    frame = spark.createDataFrame(pd.DataFrame({"x": many}))
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = order_statistics(frame, {"x": [(s, "nearest") for s in shares]})["x"]
    assert list(found.values()) == [np.sort(many)[round(19_999 * s)] for s in shares]
    assert len(scans) <= 7


def test_bits_have_the_order_of_doubles(spark):
    rng = np.random.default_rng(1)
    edges = [2.0**e for e in range(-1074, 1024)]
    x = np.array([0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, np.finfo(float).max, np.inf, *edges, *np.nextafter(edges, 0), *np.nextafter(edges, np.inf)])
    x = np.concatenate([x, -x, rng.integers(0, 2047 << 52, 20_000).view(np.float64)])
    rows = spark.createDataFrame(pd.DataFrame({"x": x})).select("x", ordered_bits(F.col("x")).alias("bits")).toPandas()
    magnitude = np.abs(rows["x"].to_numpy()).view(np.int64)
    assert (rows["bits"] == np.where(rows["x"] < 0, -magnitude, magnitude)).all()
    assert [double_of(b) for b in rows["bits"]] == rows["x"].tolist()
    assert spark.range(1).select(ordered_bits(F.lit(float("nan")))).first()[0] == (1 << 63) - 1


def test_text_keys_have_the_order_of_bytes(spark):
    texts = ["", "a", "a\x00", "ab", "abcdefg", "abcdefgh", "abcdefg\x00", "Z", "é", "𝒳", "abcdefghijklmno", "z" * 14, "z" * 15]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", F.array(*text_keys(F.col("t"), 16)).alias("k")).collect()
    assert [r.t for r in sorted(rows, key=lambda r: r.k)] == sorted(texts, key=lambda t: t.encode())


def test_places_by_several_keys_with_sums(spark):
    frame = spark.range(3000).select((F.col("id") % 3).alias("a"), F.expr("(id * 7919) % 1000 - 500").alias("b"), (F.col("id") % 2).alias("y"))
    wanted = sorted(((r.a, r.b, r.y) for r in frame.collect()), key=lambda r: r[:2])
    places = (0, 1, 999, 1000, 1500, 2999)
    keys = (F.col("a"), F.col("b"))
    search = Search(None, keys, ((0, 2), (-600, 600)), 3000, places)
    (found,) = select_places(frame, [search], [F.col("y")])
    assert {p: found[p][1][0] for p in places} == {p: sum(r[2] for r in wanted[:p]) for p in places}
    (found,) = select_places(frame, [search])
    assert {p: found[p][0] for p in places} == {p: wanted[p][:2] for p in places}
    part = Search(F.col("y") == 1, keys, ((0, 2), (-600, 600)), 1500, (7,))
    assert select_places(frame, [part])[0][7][0] == [r[:2] for r in wanted if r[2]][7]


def test_nan_infinities_and_wide_ranges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1.0, -inf, 1e308, 7.0), (2.0, 0.0, -1e308, 7.0), (nan, inf, 1e-300, 7.0), (None, inf, 0.0, 7.0), (nan, nan, 5.0, 7.0)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    wanted = {c: [(k / 4, "nearest") for k in range(5)] for c in "abcd"}
    found = {c: list(x.values()) for c, x in order_statistics(frame, wanted).items()}
    assert found["a"] == [1.0, 1.0, 1.0, 2.0, 2.0]  # places 0, 0.25, 0.5, 0.75, 1 round half to even
    assert found["b"] == [-inf, 0.0, inf, inf, inf]
    assert found["c"] == [-1e308, 0.0, 1e-300, 5.0, 1e308]
    assert found["d"] == [7.0] * 5
    assert order_statistics(frame.where("a = 9"), {"a": [(0.5, "linear")]}) == {"a": {(0.5, "linear"): None}}
    assert order_statistics(frame.where("isnan(a)").select("a"), {"a": [(1.0, "linear")]}) == {"a": {(1.0, "linear"): None}}


def test_whole_numbers_and_decimals_of_any_size(spark):
    big = (1 << 53) + 1
    frame = spark.createDataFrame([(big, Decimal("90071992547409.93")), (5, Decimal("0.10")), (-big, None)], "x long, d decimal(18,2)")
    found = order_statistics(frame, {"x": [(1.0, "nearest"), (0.0, "nearest"), (0.75, "linear")], "d": [(1.0, "nearest"), (0.5, "linear")]})
    assert list(found["x"].values()) == [big, -big, (big + 5) / 2]
    assert found["d"] == {(1.0, "nearest"): Decimal("90071992547409.93"), (0.5, "linear"): 45035996273705.015}
    assert quantiles(frame.where("x = 5"), ["x", "d"], [0.5]) == {"x": [5.0], "d": [0.1]}


def test_nearest_rounds_half_to_even(spark):
    frame = spark.range(6).select(F.col("id").cast("double").alias("x"))
    found = order_statistics(frame, {"x": [(0.5, "nearest"), (0.7, "nearest"), (0.3, "nearest")]})["x"]
    assert found == {(0.5, "nearest"): 2.0, (0.7, "nearest"): 4.0, (0.3, "nearest"): 2.0}  # places 2.5, 3.5, 1.5


def test_deciles_merge_repeated_edges(spark):
    frame = spark.range(100).select((F.col("id") % 3 == 0).cast("double").alias("flag"), F.lit(7.0).alias("one"))
    assert deciles(frame, ["flag", "one"]) == {"flag": [0.0, 1.0], "one": [7.0]}
