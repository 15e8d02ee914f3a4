"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts P and unlabelled texts U train a logistic model on hashed words. With the class prior pi, the risk
    pi * E_P[l(f)] + max(0, E_U[l(-f)] - pi * E_P[l(-f)])
estimates the error on toxic and clean text without one confirmed clean example; when the bracket, the part of the clean
texts, falls below zero, the step goes back along it, which keeps the fit from learning U by heart.

A feature is the presence of a word (2^18 hashes of lower-cased words of the whole text) that is in ``MIN_SHARE`` and ``MIN_TEXTS`` of P
or of U and whose shares in P and U are four standard errors apart. The prior is counted over all learnable
labels. The fit itself takes one task and bounded samples drawn by a hash of the id (``POSITIVES`` confirmed, ``UNLABELLED`` other
texts, one row an id, each distinct text once); scoring is one pass over every whole text with the weights broadcast (2^18 numbers).

Defined cases: a null or empty text has no word and gets the score of the intercept; labels that are null or have no id are
not learned; several labels of an id count each; repeated rows are scored one by one; without a confirmed text all weights are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.fitting import featurised, fit_in_task, held_out, packed, sample_share, sigmoid, sparse, unpacked
from propensity.llm.words import mixed, slices, words_of

DIMENSIONS = 1 << 18
POSITIVES = 4_000
UNLABELLED = 16_000
MIN_SHARE = 0.02
MIN_TEXTS = 10
STANDARD_ERRORS = 4.0
CUT = 0.7


def present(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, 1.0) for every distinct hashed word of a text, or only for the ``wanted`` features (a mask)."""
    w = words_of(data, offsets)
    column = (w.hashes % np.uint64(DIMENSIONS)).astype(np.int64)
    text = np.repeat(np.arange(len(w.counts)), w.counts)
    if wanted is not None:
        use = wanted[column]
        text, column = text[use], column[use]
    key = np.unique(text * DIMENSIONS + column)
    return key // DIMENSIONS, key % DIMENSIONS, np.ones(len(key))


def telling(rows: np.ndarray, columns: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Mask of the features whose share among confirmed texts differs from the unlabelled share beyond chance."""
    p, u = max(positive.sum(), 1), max((~positive).sum(), 1)
    of_p = np.bincount(columns[positive[rows]], minlength=DIMENSIONS) / p
    of_u = np.bincount(columns[~positive[rows]], minlength=DIMENSIONS) / u
    error = np.sqrt((of_u + 1 / u) * (1 / p + 1 / u))
    common = (np.maximum(of_p, of_u) >= MIN_SHARE) & (np.maximum(of_p * p, of_u * u) >= MIN_TEXTS)
    return (np.abs(of_p - of_u) >= STANDARD_ERRORS * error) & common


def non_negative_pu(rows, columns, positive: np.ndarray, prior: float, steps: int = 300, rate: float = 0.1, decay: float = 1e-5):
    """(weights, intercept) of the least non-negative risk; ``positive`` marks confirmed rows, the others are unlabelled."""
    n, weights, intercept = len(positive), np.zeros(DIMENSIONS), float(np.log(prior / (1 - prior)))
    of_p, of_u = positive / max(positive.sum(), 1), ~positive / max((~positive).sum(), 1)
    if not positive.any() or positive.all():
        return weights, intercept
    m, v, mb, vb = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0.0
    for t in range(1, steps + 1):
        f = np.bincount(rows, weights=weights[columns], minlength=n) + intercept
        s, loss = sigmoid(f), np.logaddexp(0, f)  # loss is that of calling the row toxic when it is not
        clean_risk = (of_u * loss).sum() - prior * (of_p * loss).sum()
        clean_slope = of_u * s - prior * of_p * s
        slope = clean_slope - prior * of_p * (1 - s) if clean_risk >= 0 else -clean_slope
        g, gb = np.bincount(columns, weights=slope[rows], minlength=DIMENSIONS) + decay * weights, slope.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        weights -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        intercept -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return weights, intercept


def fit_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> str:
    """The model learned from ``labels`` (doc_id, toxic; only toxic = 1 is used as a label) and unlabelled ``docs``."""
    known = labels.select(F.col(doc_id).alias("key"), F.col("toxic").cast("int").alias("toxic")).dropna()
    share = known.agg(F.avg("toxic").alias("prior")).first().prior
    prior = float(min(max(share or 0.0, 1e-3), 0.999))
    texts = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
    confirmed = sample_share(known.where("toxic = 1").select("key").distinct(), POSITIVES, F.col("key"))
    # about POSITIVES ids, so they are sent to the texts instead of moving the texts
    rows = texts.join(F.broadcast(confirmed), "key").dropDuplicates(["key"]).select(F.lit(1).alias("confirmed"), "text")
    others = sample_share(texts, UNLABELLED, F.col("key")).dropDuplicates(["key"]).select(F.lit(0).alias("confirmed"), "text")

    def fit(table: pa.Table) -> str:
        r, c, _ = sparse(table)
        confirmed = table["confirmed"].to_numpy() == 1
        r, c, confirmed = distinct_texts(r, c, confirmed)
        use = telling(r, c, confirmed)
        kept = use[c]
        weights, intercept = non_negative_pu(r[kept], c[kept], confirmed, prior)
        return packed(weights=weights, intercept=[intercept])

    return fit_in_task(featurised(rows.unionByName(others), present, ["confirmed"]), fit)


def distinct_texts(rows: np.ndarray, columns: np.ndarray, confirmed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct set of words once among the confirmed rows and once among the others."""
    digest = np.zeros(len(confirmed), np.uint64)
    np.add.at(digest, rows, mixed(columns.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(digest * np.uint64(2) + confirmed, return_index=True)
    keep = np.zeros(len(confirmed), bool)
    keep[first] = True
    place = np.cumsum(keep) - 1
    use = keep[rows]
    return place[rows[use]], columns[use], confirmed[keep]


def toxicity(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` (columns kept) with ``score``, the estimated probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = unpacked(shared.value)
        weights, wanted = parts["weights"], parts["weights"] != 0
        for batch in batches:
            scores = [np.zeros(0)]
            for a, b, data, offsets in slices(batch.column(text)):
                rows, columns, _ = present(data, offsets, wanted)
                scores.append(sigmoid(np.bincount(rows, weights=weights[columns], minlength=b - a) + parts["intercept"]))
            yield pa.record_batch([*batch.columns, pa.array(np.concatenate(scores))], names=[*batch.schema.names, "score"])

    kept = docs.drop("score")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(judge, f"{kinds}, score double")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels.where(~held_out(F.col("doc_id"))))
    return toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted")
    )
