"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of consecutive words, a window into short shingles. A document holds a window only if
it holds every shingle of it, so for full containment the necessary prefix of a window, its shingles ordered by
rarity in the corpus, is the one rarest shingle. Documents meet windows on that shingle alone; a meeting survives when
the window fits in the document at that place (length and position), and counts when the words are equal.

1. One scan over the documents marks the places of benchmark shingles. The scan knows them by a bit map of a fixed size
   (4 MB), whatever the benchmark's size; false marks drop out in the join. A mark carries the words around it, so texts
   are never read or moved again.
2. Marks per shingle give its frequency over the whole corpus, and with it each window's rarest shingle.
3. Marks join prefixes on the shingle; the words of the window are compared.

Defined cases: a null or empty text has no words and no hits; an item without words has no windows; repeated rows, also
with one id, are judged one by one; null ids stay null; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.bitmaps import bit_map, probed
from propensity.llm.words import grams, slices, words_of
from propensity.session import materialize

WINDOW = 10
SHINGLE = 5


def item_windows(items: DataFrame, item_id: str, text: str, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item, phrase, size, grams): each item's windows, the words joined by blanks, with their shingles in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                w = words_of(data, offsets)
                hashes = {s: _by_place(w, s) for s in range(1, shingle + 1)}
                rows = []
                for i, n in enumerate(w.counts.tolist()):
                    size, at = min(window, n), int(w.first[i])
                    s = min(shingle, size)
                    for p in range(n - size + 1 if n else 0):
                        g = hashes[s][at + p : at + p + size - s + 1].view(np.int64)
                        rows.append((a + i, w.phrase(at + p, at + p + size), size, g.tolist()))
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                        pa.array([r[1] for r in rows], pa.string()),
                        pa.array([r[2] for r in rows], pa.int32()),
                        pa.array([r[3] for r in rows], pa.list_(pa.int64())),
                    ],
                    names=["item", "phrase", "size", "grams"],
                )

    kind = items.schema[item_id].dataType.simpleString()
    picked = items.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    return picked.mapInArrow(cut, f"item {kind}, phrase string, size int, grams array<bigint>")


def _by_place(words, size: int) -> np.ndarray:
    """The gram that starts at each word, 0 where the text ends before."""
    out = np.zeros(len(words.hashes), np.uint64)
    h, text, place = grams(words, size)
    out[words.first[text] + place] = h
    return out


def marked(docs: DataFrame, doc_id: str, text: str, bits, sizes: list[int], window: int) -> DataFrame:
    """(uid, id, n_words, marks): for every document the places of words that start a shingle in the bit map."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(2)):
                w = words_of(data, offsets)
                at, doc, size, gram = [], [], [], []
                for s in sizes:
                    h, text_of, place = grams(w, s)
                    hit = probed(bits.value, h)
                    at.append(place[hit])
                    doc.append(text_of[hit])
                    size.append(np.full(len(hit), s))
                    gram.append(h[hit].view(np.int64))
                at, doc, size, gram = (np.concatenate(x) for x in (at, doc, size, gram))
                order = np.argsort(doc, kind="stable")
                at, doc, size, gram = at[order], doc[order], size[order], gram[order]
                first = w.first[doc]
                low = np.maximum(first, first + at - (window - size))
                high = np.minimum(w.first[doc + 1], first + at + window)
                around = [w.phrase(x, y) for x, y in zip(low.tolist(), high.tolist(), strict=True)]
                marks = pa.StructArray.from_arrays(
                    [pa.array(at, pa.int64()), pa.array(gram, pa.int64()), pa.array(first + at - low, pa.int32()), pa.array(around, pa.string())],
                    names=["at", "h", "left", "around"],
                )
                ends = np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(w.counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), marks),
                    ],
                    names=["uid", "id", "n_words", "marks"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    shape = f"uid long, id {kind}, n_words long, marks array<struct<at:long,h:long,left:int,around:string>>"
    return picked.mapInArrow(scan, shape)


def rarest_shingles(windows: DataFrame, marks: DataFrame) -> DataFrame:
    """(phrase, size, off, h): the necessary prefix of every distinct window, its rarest shingle and the place in it."""
    often = marks.groupBy("h").agg(F.count("*").alias("often"))
    each = windows.select("phrase", "size", "grams").distinct().select("phrase", "size", F.posexplode("grams").alias("off", "h"))
    # a window with a shingle that no document has is met by none: the inner join keeps only shingles that occur
    return (
        each.join(often, "h")
        .groupBy("phrase", "size")
        .agg(F.min(F.struct("often", "off", "h")).alias("rarest"))
        .select("phrase", "size", "rarest.off", "rarest.h")
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, n_words, n_hit, spans, items).

    ``spans`` are the word ranges [start, end) of item windows that the document holds, ``n_hit`` the words inside any of
    them, ``items`` the ids (as text, sorted) of the items with such a window.
    """
    spark = docs.sparkSession
    windows = materialize(item_windows(items, item_id, item_text, window, shingle))
    sizes = [r.size for r in windows.select(F.least("size", F.lit(shingle)).alias("size")).distinct().collect()]
    bits = spark.sparkContext.broadcast(bit_map(windows.select(F.explode("grams").alias("h"))))
    scanned = materialize(marked(docs, doc_id, text, bits, sorted(sizes) or [shingle], window))
    marks = scanned.where(F.size("marks") > 0).select("uid", "n_words", F.explode("marks").alias("m")).select("uid", "n_words", "m.*")
    start = F.col("at") - F.col("off")
    fits = (F.col("left") >= F.col("off")) & (start + F.col("size") <= F.col("n_words"))
    held = F.array_join(F.slice(F.split("around", " "), F.col("left") - F.col("off") + 1, F.col("size")), " ")
    hits = materialize(
        marks.join(rarest_shingles(windows, marks), "h")
        .where(fits)
        .where(held == F.col("phrase"))
        .select("uid", "phrase", start.alias("start"), (start + F.col("size")).alias("end"))
    )
    spans = hits.groupBy("uid").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    found = (
        hits.select("uid", "phrase")
        .distinct()
        .join(windows.select("phrase", F.col("item").cast("string").alias("item")).distinct(), "phrase")
        .groupBy("uid")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, x: F.struct(
            (acc.n + F.greatest(F.lit(0), x.end - F.greatest(x.start, acc.to))).alias("n"), F.greatest(acc.to, x.end).alias("to")
        ),
        lambda acc: acc.n,
    )
    none = F.array().cast("array<string>")
    return (
        scanned.select("uid", "id", "n_words")
        .join(spans, "uid", "left")
        .join(found, "uid", "left")
        .select(
            F.col("id").alias(doc_id),
            "n_words",
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
            "spans",
            F.coalesce("items", none).alias("items"),
        )
    )


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, size, array_to_string(w[p : p + size - 1], ' ') AS phrase
    FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)
),
dw AS (
    SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS phrase
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)
),
hits AS (SELECT doc_id, item_id, p, bw.size FROM dw JOIN bw ON dw.phrase = bw.phrase AND dw.size = bw.size),
places AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + size)) AS pos FROM (SELECT DISTINCT doc_id, p, size FROM hits)) GROUP BY doc_id
),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
"""
