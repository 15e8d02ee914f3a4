"""Importance resampling towards a target distribution, with a cutoff found by a bracketed quantile sketch.

Words (A-Z lower-cased) and their runs of up to ``NGRAMS`` words are features, hashed by CRC-32 to ``BUCKETS`` buckets. With S features in the
corpus, s of them in a bucket, and T and t for the target texts, a bucket gains floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))), and a document weighs the
floored mean of its features' gains. A Gumbel draw from a hash of its id makes the highest scores a weighted sample without
replacement, so selection is one cutoff.

1. One numpy scan counts the buckets of corpus and target; a task sends one row for each bucket it has seen.
2. The gains are one array of ``BUCKETS`` numbers (bounded by that parameter), with which a second scan scores whole texts. Scores are
   written once.
3. A quantile sketch over the scores names a bracket around the cutoff. The rows above and in it are counted exactly: if the cutoff's place is not in
   the bracket, it is widened and counted again. Only the bracket's rows are sorted, over many tasks, to find the last row drawn.
4. The drawn rows are ranked over range partitions.

Defined cases: a null or empty text has no features, weight 0 and is too short to be drawn; a null id draws as the empty id and is the last of equal
scores; repeated rows are drawn one by one, equal scores and ids in the order of weight, features and a hash of the text; very long texts are counted whole,
one at a time; an empty table gives no rows; without target texts every gain compares with an even distribution; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.words import Words, slices, words_of
from propensity.operators.order import global_rank
from propensity.session import materialize

NGRAMS = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
ACCURACY = 10_000  # of the sketch: a place is off by a ten-thousandth of the rows at most
_TABLE = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
_LONG = 32  # bytes of a feature up to which all features of a slice are hashed together


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of data[start:end] for every span: byte by byte for all spans together, long ones on their own."""
    out, lengths = np.full(len(starts), 0xFFFFFFFF, np.uint32), ends - starts
    order = np.argsort(-np.minimum(lengths, _LONG + 1), kind="stable")
    live = order[int(np.count_nonzero(lengths > _LONG)) :]
    behind = np.searchsorted(-lengths[live], -np.arange(_LONG + 1), side="left")  # spans longer than k
    for k in range(_LONG):
        now = live[: behind[k]]
        if not len(now):
            break
        c = out[now]
        out[now] = _TABLE[(c ^ data[starts[now] + k]) & 255] ^ (c >> 8)
    out ^= 0xFFFFFFFF
    for i in np.flatnonzero(lengths > _LONG).tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return out


def features(words: Words, ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The text and the bucket of every run of 1 to ``ngrams`` words; a run's words are joined by one blank."""
    n, doc = len(words.starts), np.repeat(np.arange(len(words.counts)), words.counts)
    docs, found = [], []
    if ngrams > 1:  # the words of all texts, each with one blank behind it
        lengths = words.ends - words.starts
        ends = np.cumsum(lengths + 1)
        starts = ends - lengths - 1
        joined = np.full(int(ends[-1]) if n else 0, 0x20, np.uint8)
        edges = np.zeros(len(joined) + 1, np.int8)
        edges[starts] += 1
        edges[ends - 1] -= 1
        joined[np.cumsum(edges[:-1], dtype=np.int8).astype(bool)] = words.folded[words.folded != 0]
        data, ends = joined, ends - 1
    else:
        data, starts, ends = words.folded, words.starts, words.ends
    for size in range(1, ngrams + 1):
        at = np.arange(max(n - size + 1, 0))
        at = at[doc[at] == doc[at + size - 1]]
        docs.append(doc[at])
        found.append((crc32_of(data, starts[at], ends[at + size - 1]) % np.uint32(buckets)).astype(np.int64))
    return np.concatenate(docs), np.concatenate(found)


def bucket_counts(texts: DataFrame, text: str, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has some."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                total += np.bincount(features(words_of(data, offsets), ngrams, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    counted = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str, target_text: str, ngrams: int, buckets: int) -> np.ndarray:
    """The gain of every bucket, in thousandths."""
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    sides = bucket_counts(docs, text, ngrams, buckets).withColumnRenamed("n", "s"), bucket_counts(target, target_text, ngrams, buckets).withColumnRenamed("n", "t")
    counts = every.join(sides[0], "bucket", "left").join(sides[1], "bucket", "left").na.fill(0).orderBy("bucket").collect()  # one row for each bucket
    s, t = (np.array([r[c] for r in counts], np.float64) for c in ("s", "t"))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, doc_id: str, text: str, ngrams: int = NGRAMS) -> DataFrame:
    """(id, n_words, n_features, weight, tie): one row for each document."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                words = words_of(data, offsets)
                doc, bucket = features(words, ngrams, len(gain))
                n = np.bincount(doc, minlength=b - a)
                order = np.argsort(doc, kind="stable") if ngrams > 1 else slice(None)
                sums = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
                ends = np.cumsum(n)
                weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
                rest = [pa.array(x, pa.int64()) for x in (words.counts, n, weight)]
                yield pa.record_batch([batch.column(0).slice(a, b - a), *rest, batch.column(2).slice(a, b - a)], names=["id", "n_words", "n_features", "weight", "tie"])

    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("tie"))
    return picked.mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long, tie long")


def drawn_score(weight: Column, doc_id: Column, seed: int = SEED) -> Column:
    """The weight plus a Gumbel draw in thousandths from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def bracket(scores: DataFrame, n: int, place: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """(low, high, above): scores between which the ``place``-th highest of ``n`` lies, and how many are above ``high``."""
    slack = 1 / accuracy
    while True:
        middle = 1 - (place - 0.5) / n
        shares = [max(0.0, middle - slack), min(1.0, middle + slack)]
        low, high = scores.agg(F.percentile_approx("score", shares, accuracy)).first()[0]
        if slack >= 1:  # the bracket is everything
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        above, inside = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < place <= above + inside:
            return low, high, above
        slack *= 4


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, n_words, n_features, weight, score, rank), rank null where it is not drawn.

    Drawn are ``percent`` in a hundred (rounded down) of the documents with ``least_words`` words or more.
    """
    gains = bucket_gains(docs, target, text, target_text, ngrams, buckets)
    rows = weighted(docs, gains, doc_id, text, ngrams)
    scored = materialize(rows.withColumn("score", drawn_score(F.col("weight"), F.col("id"), seed)))
    eligible = scored.where(F.col("n_words") >= least_words)
    n = eligible.count()
    wanted = percent * n // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("weight"), F.asc("n_features"), F.asc_nulls_first("tie")]
    if not wanted:
        return scored.select(F.col("id").alias(doc_id), "n_words", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    low, high, above = bracket(eligible.select("score"), n, wanted, accuracy)
    inside = eligible.where(F.col("score").between(low, high))
    ordered = global_rank(inside, order)
    taken, left = ordered.where(F.col("rank") <= wanted - above), ordered.where(F.col("rank") > wanted - above)
    drawn = global_rank(eligible.where(F.col("score") > high).union(taken.drop("rank")), order)
    others = scored.where((F.col("n_words") < least_words) | (F.col("score") < low)).withColumn("rank", F.lit(None).cast("long"))
    left = left.withColumn("rank", F.lit(None).cast("long"))
    return drawn.union(left).union(others).select(F.col("id").alias(doc_id), "n_words", "n_features", "weight", "score", "rank")


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BYTES = "list_transform(range(0, (strlen(word))::BIGINT), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)"
_BITS = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"

OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT r, unnest(w) AS word FROM d),
bw AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
vocabulary AS (SELECT DISTINCT word FROM (SELECT word FROM dw UNION ALL SELECT word FROM bw)),
crc AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295, {_BYTES}), lambda c, b: {_BITS}), 4294967295) % 10000 AS bucket
    FROM vocabulary
),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN crc USING (word) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)
        / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000))))::BIGINT AS gain
    FROM (SELECT range AS bucket FROM range(10000)) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
),
weights AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM dw JOIN crc USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
    SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM d LEFT JOIN weights USING (r)
),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
