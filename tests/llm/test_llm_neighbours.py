from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from propensity.llm import neighbours
from propensity.llm.neighbours import nearest_neighbours, op6_neighbours

SF = "/root/testdata/sf0.1"


def brute(ids, v, queries, k):
    out = {}
    for q in queries:
        s = v @ v[ids == q][0]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), s[i]) for i in order]
    return out


def test_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    ids, v = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), float)
    wanted = brute(ids, v, ids[ids % 20 == 0], 20)
    got = {}
    for r in op6_neighbours(spark, SF).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(wanted)
    hits = 0
    for q, rows in got.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        exact = {i: s for i, s in zip(ids, v @ v[ids == q][0], strict=True)}
        assert all(abs(exact[r.vec_id] - r.score) < 1e-12 and r.vec_id != q for r in rows)
        hits += len({r.vec_id for r in rows} & {i for i, _ in wanted[q]})
    assert hits / (20 * len(wanted)) >= 0.9


def test_blocks_and_lengths(spark, monkeypatch):
    """Several blocks of entries and queries, vectors of very different length; small blocks are reranked whole."""
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(600, 8)) * rng.lognormal(size=(600, 1))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0, 5).collect()
    wanted = brute(np.arange(600), v, range(0, 600, 20), 5)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted((q, n, i) for q, f in wanted.items() for n, (i, _) in enumerate(f, 1))


def test_copies_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(0, 120, 2)] + [(1, [0.5, 0.5]), (3, [2.0, 0.0]), (1000, [0.0, 1.0]), (1000, [0.0, 1.0])]
    rows += [(20 * 40, None), (20 * 41, [0.0, 0.0]), (20 * 42, [1.0, None]), (20 * 43, [nan, 1.0]), (20 * 44, [inf, 1.0]), (20 * 45, [1.0, 2.0, 3.0]), (20 * 46, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, id int")
    got = {}
    for r in sorted(nearest_neighbours(df, F.col("id") % 20 == 0).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {0, 20, 40, 60, 80, 100, 1000}
    for q in (0, 20, 100):
        assert got[q] == [(3, 2.0)] + [(i, 1.0) for i in range(0, 120, 2) if i != q][:19]
    assert got[1000][0] == (1, 0.5) and got[1000][1:] == [(i, 0.0) for i in [0, 2, 3, *range(4, 120, 2)][:19]]


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (20, [2.0])], "vec_id long, embedding array<double>")
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest_neighbours(df, F.lit(True)).collect()) == [(0, 1, 20, 2.0), (20, 1, 0, 2.0)]
    assert nearest_neighbours(df.limit(0), F.lit(True)).count() == 0
    assert nearest_neighbours(df.limit(1), F.lit(True)).count() == 0
    assert nearest_neighbours(df, F.lit(False)).count() == 0
