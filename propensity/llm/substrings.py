"""Substring deduplication over difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document, a word a run of characters other than blank and U+0009 to U+000D. A word goes when a
window over it starts somewhere else too, in whatever document; windows are judged on the texts as given.

Windows are not hashed at every place. A difference cover of a period (0, 1, 3, 9 modulo 13) holds, for any two places, a common
shift below the period that takes both to cover places. So of two equal windows, anchors of ``WINDOW - 12`` words at cover places agree
at the same shift: anchors are hashed at 4 of 13 places only, and no repeated window is without a repeated anchor.

1. Documents are written once as chunks of some ``CHUNK_BYTES`` of text, compressed. A chunk is the unit of all later steps and bounds their
   memory; a longer text is a chunk of its own.
2. Each chunk sends the distinct hashes of its anchors, 5 bytes each, to buckets by their upper bits. A bucket answers with one bit for each:
   does another chunk have it? What repeats inside a chunk the chunk knows. So a passage that a third of all documents hold is sent once by a chunk.
3. A repeated anchor is extended by up to 12 words to the left and right: the windows that hold it are the candidates, 12 bytes of hash each, and
   buckets answer in the same way whether a window starts in another chunk too.
4. Each chunk takes out the words that repeated windows cover.

No pairs of documents are formed, whatever many share a passage, and no row is dropped. The number of buckets follows from the counted words, so that a
bucket holds about ``BUCKET_KEYS`` keys; both sizes are parameters, to be raised together on large executors (at 100 TB to 128 MB
and 32 million keys, as blocks of a chunk and a bucket get short otherwise). 40 bits within a bucket decide which windows are looked at, 96 bits which are
equal: for 10^13 windows less than one false match in a thousand runs.

Defined cases: a null or empty text has no words, keeps the empty text and removes nothing; a document of fewer than ``WINDOW`` words loses nothing;
repeated rows, also with one id, repeat each other's windows; null ids stay null; very long texts are handled whole, one at a time; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.words import SLICE_BYTES, mixed, runs, slices, span_hashes
from propensity.session import materialize

WINDOW = 35
#: Perfect difference sets, the period first.
COVERS = ((13, (0, 1, 3, 9)), (7, (0, 1, 3)), (3, (0, 1)), (1, (0,)))
CHUNK_BYTES = 8 << 20
BUCKET_KEYS = 4_000_000
_ANCHOR_BYTES, _WINDOW_BYTES = 5, 12
_OTHER = np.uint64(0x5851F42D4C957F2D)


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of at least half a window."""
    return next((p, c) for p, c in COVERS if window - p + 1 >= (window + 1) // 2)


def chunked(docs: DataFrame, doc_id: str, text: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, n_words, texts): consecutive documents as one compressed Arrow stream of (id, text)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, words = TaskContext.get().partitionId() << 32, [], 0, 0

        def packed() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for part in held:
                    out.write_batch(part)
            row = [pa.array([number], pa.int64()), pa.array([words], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
            return pa.record_batch(row, names=["chunk", "n_words", "texts"])

        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1), chunk_bytes):
                if held and size + len(data) > chunk_bytes:
                    yield packed()
                    number, held, size, words = number + 1, [], 0, 0
                held.append(batch.slice(a, b - a))
                size += len(data)
                words += len(runs(_inside(data), offsets)[0])
        if held:
            yield packed()

    picked = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(pack, "chunk long, n_words long, texts binary")


def _inside(data: np.ndarray) -> np.ndarray:
    return ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The words' hashes, some ``SLICE_BYTES`` of text at a time, as eight bytes are needed for each byte."""
    out, a = np.zeros(len(starts), np.uint64), 0
    while a < len(starts):
        base = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, base + SLICE_BYTES)))
        out[a:b] = span_hashes(data[base : ends[b - 1]], starts[a:b] - base, ends[a:b] - base)
        a = b
    return out


@dataclass
class Chunk:
    """The words of a chunk's documents: byte places, hashes, and for document i the words first[i]:first[i + 1]."""

    ids: pa.Array
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @classmethod
    def read(cls, texts: bytes) -> Chunk:
        table = pa.ipc.open_stream(texts).read_all().combine_chunks()
        ((_, _, data, offsets),) = slices(table["text"].combine_chunks(), 1 << 62)
        starts, ends = runs(_inside(data), offsets)
        return cls(table["id"].combine_chunks(), data, offsets, starts, ends, _word_hashes(data, starts, ends), np.searchsorted(starts, offsets))

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Words at cover places that start an anchor, and the anchors' hashes."""
        period, cover = cover_for(window)
        length, counts = window - period + 1, np.diff(self.first)
        place = np.arange(len(self.hashes)) - np.repeat(self.first[:-1], counts)
        covered = np.isin(np.arange(period), cover)
        at = np.flatnonzero(covered[place % period] & (place + length <= np.repeat(counts, counts)))
        return at, span_hashes(self.hashes, at, at + length)

    def candidates(self, window: int, anchors: np.ndarray) -> np.ndarray:
        """Words that start a window which holds one of ``anchors`` whole."""
        period, _ = cover_for(window)
        n = len(self.hashes)
        near = np.zeros(n + 1, np.int32)
        np.add.at(near, np.maximum(anchors - period + 1, 0), 1)
        np.add.at(near, anchors + 1, -1)
        last = np.repeat(self.first[1:], np.diff(self.first))  # the document's end, for each word
        at = np.arange(n)
        holds = (np.cumsum(near[:-1]) > 0) & (at + window <= last)
        # an anchor near a document's start is not held by windows of the document before: those end in front of it
        return np.flatnonzero(holds)

    def windows(self, window: int, at: np.ndarray) -> np.ndarray:
        """The two hashes of the windows that start at words ``at``, as rows (upper 64 bits, lower 32 bits)."""
        out = np.zeros(len(at), [("h", np.uint64), ("more", np.uint32)])
        out["h"] = span_hashes(self.hashes, at, at + window)
        out["more"] = span_hashes(mixed(self.hashes ^ _OTHER), at, at + window) >> np.uint64(32)
        return out


class Keys:
    """The distinct keys of a chunk in the order in which buckets are asked, and who of ``keys`` stands behind each."""

    def __init__(self, keys: np.ndarray):
        order = np.argsort(keys, kind="stable") if keys.dtype == np.uint64 else np.lexsort((keys["more"], keys["h"]))
        ordered = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        self.distinct = ordered[new]
        self._group = np.zeros(len(keys), np.int64)
        self._group[order] = np.cumsum(new) - 1
        self._often = np.bincount(self._group, minlength=len(self.distinct)) > 1

    def bounds(self, buckets: int) -> np.ndarray:
        h = self.distinct if self.distinct.dtype == np.uint64 else self.distinct["h"]
        bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))

    def asked(self, chunk: int, buckets: int) -> pa.RecordBatch:
        """(bucket, chunk, keys): the bytes of the keys of each bucket that has some."""
        if self.distinct.dtype == np.uint64:
            raw, width = self.distinct.view(np.uint8).reshape(-1, 8)[:, :_ANCHOR_BYTES], _ANCHOR_BYTES
        else:
            raw, width = self.distinct.view(np.uint8).reshape(-1, 12), _WINDOW_BYTES
        raw, ends = np.ascontiguousarray(raw).reshape(-1), self.bounds(buckets)
        some = np.flatnonzero(np.diff(ends))
        parts = [raw[ends[b] * width : ends[b + 1] * width].tobytes() for b in some.tolist()]
        return pa.record_batch([pa.array(some, pa.int32()), pa.array([chunk] * len(some), pa.int64()), pa.array(parts, pa.binary())], names=["bucket", "chunk", "keys"])

    def repeated(self, answers: pa.Table, buckets: int) -> np.ndarray:
        """For each key given, whether it occurs again, here or in another chunk."""
        again, ends = self._often.copy(), self.bounds(buckets)
        for b, bits in zip(answers["bucket"].to_pylist(), answers["bits"], strict=True):
            part = np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), count=int(ends[b + 1] - ends[b]))
            again[ends[b] : ends[b + 1]] |= part.astype(bool)
        return again[self._group]


ASKED = "bucket int, chunk long, keys binary"


def answered(asked: DataFrame, buckets: int, width: int) -> DataFrame:
    """(chunk, bucket, bits): for each key of a block one bit, set if another chunk has it."""

    def answer(table: pa.Table) -> pa.Table:
        blocks = [x.as_buffer() for x in table["keys"]]
        sizes = [len(x) // width for x in blocks]
        raw = np.frombuffer(b"".join(blocks), np.uint8).reshape(-1, width)
        low = np.zeros((len(raw), 8), np.uint8)
        low[:, : min(width, 8)] = raw[:, :8]
        low = low.view(np.uint64).reshape(-1)
        if width > 8:
            high = np.zeros((len(raw), 4), np.uint8)
            high[:, : width - 8] = raw[:, 8:]
            keys = (low, high.view(np.uint32).reshape(-1))
            order = np.lexsort((keys[1], keys[0]))
        else:
            keys, order = (low,), np.argsort(low, kind="stable")
        same = np.ones(max(len(raw) - 1, 0), bool)
        for k in keys:
            k = k[order]
            same &= k[1:] == k[:-1]
        again = np.zeros(len(raw), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        cuts = np.cumsum([0, *sizes])
        bits = [np.packbits(again[a:b]).tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return pa.table([table["chunk"], table["bucket"], pa.array(bits, pa.binary())], names=["chunk", "bucket", "bits"])

    return asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, bits binary")


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_keys: int = BUCKET_KEYS,
) -> DataFrame:
    """One row for each row of ``docs``: (doc_id, n_words, n_removed, removed, kept).

    ``removed`` are the word ranges [start, end) that repeated windows cover, ``kept`` the other words joined by one blank.
    """
    chunks = materialize(chunked(docs, doc_id, text, chunk_bytes))
    period, cover = cover_for(window)
    n_words = chunks.agg(F.sum("n_words")).first()[0] or 0
    first = max(1, -(-n_words * len(cover) // (period * bucket_keys)))
    second = max(1, -(-n_words // bucket_keys))

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, texts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield Keys(Chunk.read(texts.as_buffer()).anchors(window)[1]).asked(chunk, first)

    def candidates(chunk: Chunk, answers: pa.Table) -> np.ndarray:
        at, hashes = chunk.anchors(window)
        return chunk.candidates(window, at[Keys(hashes).repeated(answers, first)])

    def ask_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk.read(left["texts"][0].as_buffer())
        at = candidates(chunk, right)
        return pa.Table.from_batches([Keys(chunk.windows(window, at)).asked(left["chunk"][0].as_py(), second)])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk.read(left["texts"][0].as_buffer())
        one, two = (right.filter(pa.compute.equal(right["turn"], pa.scalar(t, pa.int32()))) for t in (1, 2))
        at = candidates(chunk, one)
        return _kept(chunk, at[Keys(chunk.windows(window, at)).repeated(two, second)], window)

    texts = chunks.select("chunk", "texts")
    anchors = materialize(answered(texts.mapInArrow(ask_anchors, ASKED), first, _ANCHOR_BYTES))
    asked = texts.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(ask_windows, ASKED)
    both = anchors.withColumn("turn", F.lit(1)).union(answered(asked, second, _WINDOW_BYTES).withColumn("turn", F.lit(2)))
    kind = docs.schema[doc_id].dataType.simpleString()
    shape = f"id {kind}, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string"
    done = texts.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(finish, shape)
    return done.withColumnRenamed("id", doc_id)


def _kept(chunk: Chunk, repeated: np.ndarray, window: int) -> pa.Table:
    """Result rows of a chunk in which the windows that start at words ``repeated`` go."""
    n, first = len(chunk.hashes), chunk.first
    depth = np.zeros(n + 1, np.int32)
    depth[repeated] += 1
    np.add.at(depth, repeated + window, -1)
    gone = np.cumsum(depth[:-1]) > 0
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    counts = np.concatenate([[0], np.cumsum(gone)])
    # ranges end where a word stays and at the end of a document
    opens, closes = gone.copy(), gone.copy()
    if n:
        inner = (doc[1:] == doc[:-1]) & gone[1:] & gone[:-1]
        opens[1:] &= ~inner
        closes[:-1] &= ~inner
    opens, closes = np.flatnonzero(opens), np.flatnonzero(closes)
    spans = pa.StructArray.from_arrays([pa.array(opens - first[doc[opens]], pa.int64()), pa.array(closes + 1 - first[doc[opens]], pa.int64())], names=["start", "end"])
    # a kept word takes the blank in front of it along, except the first of its document
    at = np.flatnonzero(~gone)
    from_, to = chunk.starts[at].copy(), chunk.ends[at]
    if len(at):
        from_[1:] -= doc[at][1:] == doc[at][:-1]
    edges = np.zeros(len(chunk.data) + 1, np.int8)
    edges[from_] += 1
    edges[to] -= 1
    letters = np.where(_inside(chunk.data), chunk.data, np.uint8(0x20))[np.cumsum(edges[:-1], dtype=np.int8).astype(bool)]
    sizes = np.concatenate([[0], np.cumsum(to - from_)])[np.searchsorted(at, first)]
    kept = pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(letters.tobytes()))
    return pa.table(
        [
            chunk.ids,
            pa.array(np.diff(first), pa.int64()),
            pa.array(np.diff(counts[first]), pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.searchsorted(opens, first).astype(np.int32)), spans),
            kept.cast(pa.string()) if len(letters) < 1 << 31 else kept,
        ],
        names=["id", "n_words", "n_removed", "removed", "kept"],
    )


def op13_substrings(spark, sf_dir: str) -> DataFrame:
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT r, p, array_to_string(w[p : p + 34], ' ') AS phrase FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
often AS (SELECT phrase FROM places GROUP BY phrase HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS place FROM places JOIN often USING (phrase)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
    FROM words ANTI JOIN gone USING (r, place) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
