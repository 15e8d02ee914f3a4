from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from propensity.llm import quality, toxicity
from propensity.llm.fitting import sigmoid
from propensity.llm.words import grams, slices, words_of

SF = "/root/testdata/sf0.1"


def test_words_match_a_pattern():
    import re

    texts = ["Aé b-C", None, "", "𐐷x 1", "ß" * 3, "A" * 50 + " " + "b"]
    ((a, b, data, offsets),) = list(slices(pa.array(texts)))
    w = words_of(data, offsets)
    wanted = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for t in texts]
    assert (a, b) == (0, 6)
    assert [w.phrase(w.first[i], w.first[i + 1]).split() for i in range(6)] == wanted
    assert len(set(w.hashes.tolist())) == len({x for ws in wanted for x in ws})
    h, text, place = grams(w, 2, whole=True)
    assert list(zip(text.tolist(), place.tolist(), strict=True)) == [(0, 0), (0, 1), (3, 0), (4, 0), (5, 0)]


def test_slices_cover_every_row_of_a_sliced_array():
    texts = pa.array([str(i) * (i % 7) for i in range(100)]).slice(10, 80)
    seen = [data[offsets[k] : offsets[k + 1]].tobytes().decode() for a, b, data, offsets in slices(texts, 16) for k in range(b - a)]
    assert seen == texts.to_pylist()


def test_thresholds_are_ordered_and_the_likelihood_is_stationary():
    rng = np.random.default_rng(0)
    n, x = 1500, rng.normal(size=1500)
    grade = np.clip(np.digitize(x + rng.logistic(size=n) * 0.3, [-0.5, 0.5]), 0, 2)
    rows, columns = np.arange(n), np.full(n, 7)
    w, cuts = quality.cumulative_link(rows, columns, x, grade, 3, steps=600, decay=0.0)
    assert cuts[0] < cuts[1] and np.count_nonzero(w) == 1

    def loss(weight, c):
        tail = np.concatenate([np.ones((n, 1)), sigmoid(weight * x[:, None] - c), np.zeros((n, 1))], axis=1)
        return -np.log(tail[np.arange(n), grade] - tail[np.arange(n), grade + 1]).mean()

    best = loss(w[7], cuts)
    assert all(loss(w[7] + d, cuts + e) > best - 1e-4 for d in (-0.2, 0, 0.2) for e in (np.array([0.1, 0]), np.array([0, -0.1])))


def test_one_grade_or_no_rows_give_no_weights():
    none = np.zeros(0, np.int64)
    w, cuts = quality.cumulative_link(none, none, none.astype(float), none, 3)
    assert not w.any() and cuts[0] < cuts[1]
    w, _ = quality.cumulative_link(np.arange(4), np.zeros(4, int), np.ones(4), np.full(4, 2), 3)
    assert not w.any()


def test_non_negative_risk_finds_the_positive_feature():
    rng = np.random.default_rng(1)
    n = 4000
    toxic = rng.random(n) < 0.2
    positive = toxic & (rng.random(n) < 0.5)
    rows = np.concatenate([np.flatnonzero(toxic), np.arange(n)])
    columns = np.concatenate([np.zeros(toxic.sum(), int), rng.integers(1, 20, n)])
    w, b = toxicity.non_negative_pu(rows, columns, positive, 0.12)
    f = np.bincount(rows, weights=w[columns], minlength=n) + b
    assert w[0] == max(w) and sigmoid(f)[toxic].min() > sigmoid(f)[~toxic].max()
    assert not toxicity.non_negative_pu(rows, columns, np.zeros(n, bool), 0.1)[0].any()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_held_out_documents(spark, labels):
    got = quality.op10_quality(spark, SF).join(labels, "doc_id").where("held_out").toPandas()
    assert got.keep[got.quality == 1].mean() > 0.99
    assert (~got.keep[got.quality == 0]).mean() > 0.95
    assert ((got.expected_grade - got.p_good - got.p_clean).abs() < 1e-9).all() and (got.p_good >= got.p_clean).all()


def test_toxicity_on_held_out_documents(spark, labels):
    got = toxicity.op3_toxicity(spark, SF).join(labels, "doc_id").where("held_out").toPandas()
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    assert got.toxic[got.predicted == 1].mean() > 0.85
    assert got.predicted[got.toxic == 1].mean() > 0.75


def test_held_out_labels_do_not_matter(spark):
    docs = spark.createDataFrame([(i, "bad word" if i % 2 else f"good text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    changed = labels.withColumn("toxic", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (toxicity.fit_toxicity(docs, x.where(~quality.held_out(F.col("doc_id")))) for x in (labels, changed))
    assert one == other


def test_nulls_repeats_empty_tables_and_foreign_columns(spark):
    rows = [(1, "good fine text", 0, None), (1, "good fine text", 0, None), (2, None, 1, 0), (None, "", None, 1), (3, "x " * 30000, 0, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, score int, tails int")
    ratings = spark.createDataFrame([(1, 2), (1, 2), (1, 0), (2, None), (None, 1), (3, 1), (9, 1)], "doc_id long, grade int")
    got = quality.grade_documents(d, quality.fit_quality(d, ratings, 3))
    assert got.columns == ["doc_id", "text", "score", "expected_grade", "tails"] and got.count() == 5
    assert got.where("expected_grade IS NULL OR size(tails) <> 2").count() == 0
    empty = d.limit(0)
    assert quality.grade_documents(empty, quality.fit_quality(empty, ratings.limit(0), 3)).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    scored = toxicity.toxicity(d, toxicity.fit_toxicity(d, labels))
    assert scored.count() == 5 and scored.where("score IS NULL").count() == 0 and scored.columns == ["doc_id", "text", "tails", "score"]
    assert toxicity.toxicity(empty, toxicity.fit_toxicity(empty, labels.limit(0))).count() == 0
