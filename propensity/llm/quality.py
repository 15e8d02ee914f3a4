"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0 < 1 < ... < K-1 share one weight vector over hashed text features; ordered thresholds t_1 < ... < t_(K-1) give
P(grade >= j) = sigmoid(w.x - t_j). The expected grade is the sum of these tails, and one tail selects documents.

Features are hashed shares of a document's blank-separated tokens: the token itself, its shape (upper, lower, digit and
every other sign, equal neighbours merged), and whether it repeats the token before. All come from the whole text, in numpy on
Arrow batches. The model is fitted in one task on at most about ``fit_rows`` rated rows (drawn by a hash of the id, so the
draw does not depend on partitions or row order); scoring is one pass over all rows with the weights broadcast (2^16 numbers).

Defined cases: null and empty texts have no features and get the score of the thresholds alone; ratings without a grade or
an id are not learned from; different ratings of an id are each learned from once, with one of its texts; rows with null ids are scored; repeated rows get
one result each; a table without any rated row, or with one grade only, gives a model without weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.fitting import featurised, fit_in_task, held_out, packed, sample_share, sigmoid, sparse, unpacked
from propensity.llm.words import FOLD, runs, slices, span_hashes

DIMENSIONS = 1 << 16
FIT_ROWS = 10_000
SLICE = 1 << 20  # bytes of text scored together
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x30:0x3A], table[0x41:0x5B], table[0x61:0x7B], table[0x80:] = 1, 2, 3, 3
    return table


_CLASS = _classes()


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of hashed token, shape and repeat shares; a family's values are roots of shares."""
    starts, ends = runs(~_BLANK[data], offsets)
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(float)
    token = span_hashes(np.where(FOLD[data] > 0, FOLD[data], data), starts, ends)
    kinds = _CLASS[data]
    kept = np.ones(len(data), bool)
    kept[1:] = kinds[1:] != kinds[:-1]
    kept[starts] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    shape = span_hashes(kinds[kept], place[starts], place[ends])
    again = np.zeros(len(token), bool)
    again[1:] = (token[1:] == token[:-1]) & (text[1:] == text[:-1])
    half = np.uint64(DIMENSIONS // 2)
    column = np.concatenate([token % half, half + np.uint64(2) + shape % (half - np.uint64(2)), half + again.astype(np.uint64)])
    key, n = np.unique((np.tile(text, 3).astype(np.uint64) << np.uint64(32)) | column, return_counts=True)
    rows = (key >> np.uint64(32)).astype(np.int64)
    return rows, (key & np.uint64(0xFFFFFFFF)).astype(np.int64), np.sqrt(n / counts[rows])


def cumulative_link(rows, columns, values, grade: np.ndarray, grades: int, steps: int = 150, rate: float = 0.1, decay: float = 2e-5):
    """(weights, thresholds) that maximise the likelihood of the grades; thresholds are kept in order by positive gaps."""
    n = len(grade)
    weights, share = np.zeros(DIMENSIONS), np.bincount(grade, minlength=grades) / max(n, 1)
    tails = np.clip(np.cumsum(share[::-1])[::-1][1:], 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(-np.log(tails / (1 - tails)) + 1e-3 * np.arange(grades - 1))
    theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])  # first threshold, logs of the gaps
    if n == 0 or (share > 0).sum() < 2:
        return weights, start
    often = np.bincount(columns, minlength=DIMENSIONS) >= max(3, 0.002 * n)
    use = often[columns]
    rows, columns, values = rows[use], columns[use], values[use]
    moments = [np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), np.zeros(grades - 1), np.zeros(grades - 1)]
    who = np.arange(n)
    for t in range(1, steps + 1):
        cuts = np.concatenate([theta[:1], theta[0] + np.cumsum(np.exp(theta[1:]))])
        f = np.bincount(rows, weights=weights[columns] * values, minlength=n)
        above = np.ones((n, grades + 1))
        above[:, 1:-1] = sigmoid(f[:, None] - cuts)
        above[:, -1] = 0
        p = np.maximum(above[who, grade] - above[who, grade + 1], 1e-9)
        slope = above * (1 - above)
        upper, lower = slope[who, grade] / p / n, slope[who, grade + 1] / p / n
        by_row = -(upper - lower)
        by_cut = np.bincount(grade, weights=upper, minlength=grades)[1:] - np.bincount(grade + 1, weights=lower, minlength=grades + 1)[1:-1]
        by_theta = np.concatenate([[by_cut.sum()], np.exp(theta[1:]) * np.cumsum(by_cut[::-1])[::-1][1:]])
        by_weight = np.bincount(columns, weights=by_row[rows] * values, minlength=DIMENSIONS) + decay * weights
        for x, g, i in ((weights, by_weight, 0), (theta, by_theta, 2)):
            moments[i] = 0.9 * moments[i] + 0.1 * g
            moments[i + 1] = 0.99 * moments[i + 1] + 0.01 * g * g
            x -= rate * (moments[i] / (1 - 0.9**t)) / (np.sqrt(moments[i + 1] / (1 - 0.99**t)) + 1e-8)
    return weights, np.concatenate([theta[:1], theta[0] + np.cumsum(np.exp(theta[1:]))])


def fit_quality(docs: DataFrame, ratings: DataFrame, grades: int, doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> str:
    """The model fitted on ``ratings`` (doc_id, grade int from 0) and the texts of those documents."""
    rated = sample_share(ratings.select(F.col(doc_id).alias("key"), F.col("grade").cast("int").alias("grade")).dropna().distinct(), fit_rows, F.col("key"))
    # about fit_rows ratings, so they are sent to the texts instead of moving the texts
    texts = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text")).join(F.broadcast(rated), "key").dropDuplicates(["key", "grade"]).select("grade", "text")

    def fit(table: pa.Table) -> str:
        w, cuts = cumulative_link(*sparse(table), table["grade"].to_numpy().astype(np.int64), grades)
        return packed(weights=w, cuts=cuts)

    return fit_in_task(featurised(texts, features, ["grade"]), fit)


def grade_documents(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` (columns kept) with ``expected_grade`` and ``tails``, tails[j] = P(grade >= j + 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = unpacked(shared.value)
        weights, cuts = parts["weights"], parts["cuts"]
        for batch in batches:
            tails = [np.zeros((0, len(cuts)))]
            for a, b, data, offsets in slices(batch.column(text), SLICE):
                rows, columns, values = features(data, offsets)
                f = np.bincount(rows, weights=weights[columns] * values, minlength=b - a)
                tails.append(sigmoid(f[:, None] - cuts))
            tails = np.concatenate(tails)
            ends = pa.array(np.arange(len(tails) + 1, dtype=np.int32) * len(cuts))
            more = [pa.array(tails.sum(1)), pa.ListArray.from_arrays(ends, pa.array(tails.ravel()))]
            yield pa.record_batch([*batch.columns, *more], names=[*batch.schema.names, "expected_grade", "tails"])

    kept = docs.drop("expected_grade", "tails")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(score, f"{kinds}, expected_grade double, tails array<double>")


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from the 0/1 labels: 0 low quality, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    return labels.where(~held_out(F.col("doc_id"))).select("doc_id", grade.alias("grade"))


def selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with expected_grade, tails and ``keep``: P(grade >= 1), good text, is at least one half."""
    return grade_documents(docs, fit_quality(docs, graded(labels), 3)).withColumn("keep", F.element_at("tails", 1) >= 0.5)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return selected(docs, labels).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "expected_grade",
        F.element_at("tails", 1).alias("p_good"),
        F.element_at("tails", 2).alias("p_clean"),
        "keep",
    )
