"""MinHash near-duplicates by Order MinHash, verified by banded alignment.

Two texts are near-duplicates when a word alignment needs at most a fifth of the longer text's words as edits
(similarity 1 - edits / longer length of ``SIMILARITY`` or more). Classes are the connected components of these links.

A sketch is the ``PICKS`` shingles with the smallest hashes, kept in text order; shingles carry the number of their occurrence, so
repeats count. ``SKETCHES`` sketches with independent hashes make a text's signature; two texts share a sketch about as often as both
picks lie in what an alignment keeps, in one order. Shingles have three words, in texts of up to ``SHORT`` words two (texts that can be
similar to some of both sorts have both signatures), as an edit costs a short text a large part of its shingles. Up to ``ONE_EDIT`` words
similar texts are one edit apart, so they share their first or last half: these halves are keys too, and no such pair is lost. Above that the
sketches are a chance: the README has the measured share of pairs that meet, by length and edits.

1. One numpy pass makes signatures. Texts with equal words are one entry from there on, so thousands of copies cost one.
2. Texts that share a sketch form a bucket. Each text is first aligned with one centre of each of its buckets; large groups of near
   copies fall into one component after a number of checks that grows with their size, not its square.
3. In the buckets that still hold several components, all texts of different components are compared in bounded blocks inside tasks, by
   length and by counts of hashed words: an edit changes these by two at most, so no similar pair is lost, and nothing is emitted
   for the pairs that differ in more, such as texts that only share a passage. The others are aligned on the spot.
4. Alignment is banded, on words coded as single characters (2^20 codes), first in a narrow band, then in the widest one that the
   similarity allows: Spark's Levenshtein distance for centres, a numpy one for many pairs at once inside buckets.

Defined cases: null and empty texts have no words and are copies of one another; a text of fewer words than a shingle is one shingle; repeated
rows are copies, also with one id; null ids are in classes, but a class is named by its smallest id (null if all are).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.bitmaps import bit_map, probed
from propensity.llm.components import components
from propensity.llm.words import Words, grams, mixed, slices, words_of
from propensity.session import materialize, release, small_batches

SHINGLE = 3
SHORT_SHINGLE = 2
SHORT = 100
ONE_EDIT = 9
SKETCHES = 64
BANDS = 2 * SKETCHES + 4  # keys of a text: sketches of either shingle size, halves
PICKS = 2  # written out in order_sketches
SIMILARITY = 0.8
BAG = 1024
BLOCK = 512
SLICE = 1 << 19  # bytes of text signed at once: some 20 times as much is held for them
CELLS = 1 << 21  # of one banded alignment of several texts
_rng = np.random.default_rng(20240801)
_FLIP = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)
_TIMES = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def labelled_shingles(words: Words, size: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of (shingle, number of its occurrence in the text), in text order, and the texts they are of: the ``chosen`` ones."""
    h, text, _ = grams(words, size, whole=True)
    keep = chosen[text]
    h, text = h[keep], text[keep]
    order = np.lexsort((h, text))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    run = np.flatnonzero(new)
    occurrence = np.empty(len(h), np.uint64)
    occurrence[order] = (np.arange(len(h)) - run[np.cumsum(new) - 1]).astype(np.uint64)
    return mixed(h + occurrence * _SECOND), text


def order_sketches(words: Words, size: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(``chosen`` texts that have words, their signatures): one row of ``SKETCHES`` numbers each."""
    h, text = labelled_shingles(words, size, chosen)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros((0, SKETCHES), np.uint64)
    new = np.ones(len(text), bool)
    new[1:] = text[1:] != text[:-1]
    starts = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    out = np.empty((len(starts), SKETCHES), np.uint64)
    for j in range(SKETCHES):
        v = (h ^ _FLIP[j]) * _TIMES[j]
        first = np.minimum.reduceat(v, starts)
        at = np.flatnonzero(v == first[of])  # hashes within a text are distinct, so one place a text
        v[at] = _LAST
        second = np.minimum.reduceat(v, starts)
        behind = np.empty(len(starts), np.int64)
        hit = np.flatnonzero(v == second[of])
        behind[of[hit]] = hit
        ordered = at <= behind
        a, b = np.where(ordered, first, second), np.where(ordered, second, first)
        out[:, j] = mixed(a + mixed(b + np.uint64(j)) * _SECOND)
    return text[starts], out


def halves(words: Words, longer: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """(texts, keys): the first or ``last`` words that two texts share if the longer has ``longer`` words and one edit parts them."""
    size = longer // 2
    text = np.flatnonzero((words.counts == longer) | (words.counts == longer - 1))
    start = words.first[text] + (words.counts[text] - size if last else 0)
    key = np.full(len(text), 2 * longer + last, np.uint64)
    for j in range(size):
        key = mixed(key) + words.hashes[start + j]
    return text, mixed(key)


def keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have words, their keys): one row of ``BANDS`` numbers each, 0 where a text has no key."""
    n = words.counts
    out = np.zeros((len(n), BANDS), np.uint64)
    for at, size, chosen in ((0, SHINGLE, n > SHORT), (SKETCHES, SHORT_SHINGLE, n <= SHORT / SIMILARITY)):
        text, sketch = order_sketches(words, size, chosen)
        out[text, at : at + SKETCHES] = mixed(sketch + np.uint64(size))
    for longer in range(round(1 / (1 - SIMILARITY)), ONE_EDIT + 1):
        for last in (False, True):
            text, key = halves(words, longer, last)
            out[text, 2 * SKETCHES + 2 * (longer % 2) + last] = key
    has = np.flatnonzero(n)
    out = out[has]
    out[out != 0] |= np.uint64(1 << 32)  # the upper half of a key is not 0 either
    return has, out.view(np.int64)


def coded(words: Words) -> pa.Array:
    """Each text as a string with one character for each word, U+10000 to U+10FFFF by the word's hash."""
    code = (words.hashes >> np.uint64(44)).astype(np.uint32) + np.uint32(0x10000)
    utf8 = np.empty((len(code), 4), np.uint8)
    utf8[:, 0] = 0xF0 | (code >> 18)
    for k, shift in ((1, 12), (2, 6), (3, 0)):
        utf8[:, k] = 0x80 | ((code >> shift) & 0x3F)
    offsets = (words.first * 4).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(utf8)]).cast(pa.string())


def digests(words: Words, offsets: np.ndarray) -> list[bytes]:
    """A SHA-256 digest of each text's sequence of words."""
    keep = words.folded != 0
    keep[words.ends[words.ends < len(keep)]] = True  # one zero after each word
    upto = np.concatenate([[0], np.cumsum(keep)])[offsets]
    data = words.folded[keep].tobytes()
    return [hashlib.sha256(data[a:b].strip(b"\0")).digest() for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]


def bags(words: Words) -> np.ndarray:
    """Each text's counts of words in ``BAG`` hash classes, up to 255."""
    n = len(words.first) - 1
    text = np.repeat(np.arange(n), words.counts)
    counts = np.bincount(text * BAG + (words.hashes & np.uint64(BAG - 1)).astype(np.int64), minlength=n * BAG)
    return np.minimum(counts, 255).astype(np.uint8).reshape(n, BAG)


def _binary(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _bags_of(column: pa.ChunkedArray) -> np.ndarray:
    column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    if not len(column):
        return np.zeros((0, BAG), np.int16)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, BAG).astype(np.int16)


def _allowed(n: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """The most edits between texts of n and m words, in thousandths."""
    return np.maximum(n, m) * round((1 - SIMILARITY) * 1000)


def _apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Fewest edits, in thousandths, that the bags allow: an edit takes one word away at most and adds one at most."""
    more = one - other
    return (np.abs(more).sum(1, dtype=np.int64) + np.abs(more.sum(1, dtype=np.int64))) * 500  # the larger of both sums


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(uid, id, n, digest, sketches, bag, code) of every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(2), SLICE):
                w = words_of(data, offsets)
                who, sketch = keys(w)
                has = np.zeros(b - a, np.int64)
                has[who] = BANDS
                ends = np.concatenate([[0], np.cumsum(has)]).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(w.counts, pa.int32()),
                        pa.array(digests(w, offsets), pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(sketch.ravel())),
                        _binary(bags(w)),
                        coded(w),
                    ],
                    names=["uid", "id", "n", "digest", "sketches", "bag", "code"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return picked.mapInArrow(make, f"uid long, id {kind}, n int, digest binary, sketches array<bigint>, bag binary, code string")


def aligned(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose word alignment is similar enough, written."""
    # lengths and bags are compared before codes are moved
    pairs = materialize(pairs)
    near = materialize(_with_both(pairs, signed, "bag", "binary").mapInArrow(_alike, "a long, b long"))
    most = f"CAST(floor(greatest(n_a, n_b) * {round((1 - SIMILARITY) * 1000)} / 1000) AS INT)"
    within = f"""CASE WHEN abs(n_a - n_b) > {most} THEN false
        WHEN levenshtein(code_a, code_b, least(24, {most})) >= 0 THEN true
        WHEN {most} <= 24 THEN false
        WHEN levenshtein(code_a, code_b, least(200, {most})) >= 0 THEN true
        WHEN {most} <= 200 THEN false
        ELSE levenshtein(code_a, code_b, {most}) >= 0 END"""
    links = materialize(_with_both(near, signed, "code", "string").where(F.expr(within)).select("a", "b"))
    release(pairs, near)
    return links


def _with_both(pairs: DataFrame, signed: DataFrame, column: str, kind: str) -> DataFrame:
    """``pairs`` with n and ``column`` of both rows. Few rows without a pair are moved: a bit map of fixed size names the others."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("uid")).select(F.xxhash64("uid").alias("h")).distinct()
    bits = signed.sparkSession.sparkContext.broadcast(bit_map(wanted))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = probed(bits.value, batch.column("h").to_numpy().view(np.uint64))
            yield batch.select(["uid", "n", column]).take(pa.array(at))

    rows = signed.select("uid", "n", column, F.xxhash64("uid").alias("h")).mapInArrow(keep, f"uid long, n int, {column} {kind}")
    left, right = (rows.select(F.col("uid").alias(x), F.col("n").alias(f"n_{x}"), F.col(column).alias(f"{column}_{x}")) for x in "ab")
    return pairs.join(left, "a").join(right, "b")


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose lengths and bags allow the similarity."""
    for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
        t = pa.Table.from_batches([batch])
        n, m = t["n_a"].to_numpy().astype(np.int64), t["n_b"].to_numpy().astype(np.int64)
        apart = _apart(_bags_of(t["bag_a"]), _bags_of(t["bag_b"]))
        keep = (np.abs(n - m) * 1000 <= _allowed(n, m)) & (apart <= _allowed(n, m))
        yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))


def edits_within(one: np.ndarray, others: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Whether each of ``others`` is at most ``most`` edits from ``one``: one banded alignment for all of them at once."""
    apart = np.abs(np.array([len(o) for o in others]) - len(one))
    widest = int(most.max(initial=0))
    ok, done = np.zeros(len(others), bool), -1
    for width in [widest] if widest <= 64 else [24, min(200, widest), widest]:
        # what a narrower band has not decided
        left = np.flatnonzero((apart <= np.minimum(most, width)) & ~ok & (most > done))
        for at in range(0, len(left), max(1, CELLS // (2 * width + 1))):
            part = left[at : at + max(1, CELLS // (2 * width + 1))]
            ok[part] = _banded(one, [others[i] for i in part.tolist()], width) <= most[part]
        done = width
    return ok


def _banded(one: np.ndarray, others: list[np.ndarray], width: int) -> np.ndarray:
    """Edits between ``one`` and each of ``others``, exact up to ``width``, on the diagonals from -width to width."""
    far, n = 1 << 20, len(one)
    sizes = np.array([len(o) for o in others])
    text = np.zeros((len(others), max(n, int(sizes.max())) + 2 * width + 2), np.uint32)  # no code is 0
    for k, o in enumerate(others):
        text[k, width + 1 : width + 1 + len(o)] = o
    diagonal = np.arange(-width, width + 1, dtype=np.int32)
    cost = np.broadcast_to(np.where(diagonal >= 0, diagonal, far), (len(others), len(diagonal))).astype(np.int32)
    for i in range(n):
        step = cost + (text[:, i + 1 : i + 2 + 2 * width] != one[i])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(step - diagonal, axis=1) + diagonal
    return cost[np.arange(len(others)), sizes - n + width]


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, s, t): links between rows of one group that have different components.

    A pair is looked at in the group of the first sketch that it shares, and in no other; components that a link has joined
    count as one in the rest of the group.
    """
    kept: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if kept is not None:
            table = pa.concat_tables([kept, table])
        if not table.num_rows:
            continue
        mark = [table[c].to_numpy() for c in ("key", "s", "t")]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.logical_or.reduce([m[1:] != m[:-1] for m in mark])
        edges = np.flatnonzero(new)
        kept = table.slice(int(edges[-1]))  # the last group may go on in the next batch
        yield _links(table, edges)
    if kept is not None:
        yield _links(kept, np.array([0, kept.num_rows]))


def _links(table: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
    uid, n, comp, band, own, s, t = (table[c].to_numpy() for c in ("uid", "n", "comp", "band", "own", "s", "t"))
    n, comp = n.astype(np.int64), comp.copy()
    sketch = np.asarray(pa.concat_arrays(table["sketch"].chunks).flatten()).reshape(-1, BANDS)
    bag = _bags_of(table["bag"])
    coarse = bag.reshape(len(bag), -1, 4).sum(2, dtype=np.int16)  # a cheaper bound, looked at first
    text = pa.concat_arrays(table["code"].chunks).cast(pa.large_binary())
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    code = np.frombuffer(text.buffers()[2], np.uint8)[ends[0] : ends[-1]].copy().view(np.uint32)  # four bytes a word
    ends = (ends - ends[0]) // 4
    left, right = [], []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        across = s[a] != t[a]
        for i in range(a, b):
            if across and own[i] != s[a]:
                continue
            others = a + np.flatnonzero(own[a:b] == t[a]) if across else np.arange(i + 1, b)
            allowed = _allowed(n[others], n[i])
            fits = (comp[others] != comp[i]) & (np.abs(n[others] - n[i]) * 1000 <= allowed)
            others, allowed = others[fits], allowed[fits]
            if len(others):
                before = np.flatnonzero(sketch[i, : band[i]])
                fits = ~(sketch[others[:, None], before] == sketch[i, before]).any(1)
                others, allowed = others[fits], allowed[fits]
            for level in (coarse, bag):
                if len(others):
                    fits = _apart(level[others], level[i]) <= allowed
                    others, allowed = others[fits], allowed[fits]
            if len(others):
                words = [code[ends[k] : ends[k + 1]] for k in others.tolist()]
                others = others[edits_within(code[ends[i] : ends[i + 1]], words, allowed // 1000)]
                for k in others[np.unique(comp[others], return_index=True)[1]].tolist():
                    left.append(uid[i])
                    right.append(uid[k])
                    comp[a:b][comp[a:b] == comp[k]] = comp[i]
    pair = np.array([left, right], np.int64).reshape(2, -1)
    return pa.record_batch([pa.array(pair.min(0)), pa.array(pair.max(0))], names=["a", "b"])


def near_links(signed: DataFrame, firsts: DataFrame) -> DataFrame:
    """Links (a, b) between different texts, the rows ``firsts`` (uid) of ``signed``, whose components are the classes."""
    sketches = materialize(signed.select("uid", "sketches").join(firsts, "uid", "left_semi"))
    posts = sketches.select("uid", F.posexplode("sketches").alias("band", "key")).where("key <> 0")
    buckets = posts.groupBy("key").agg(F.min("uid").alias("centre"), F.count("*").alias("size")).where("size > 1")
    members = materialize(posts.join(buckets, "key"))
    release(sketches)
    rays = members.where("uid <> centre").select(F.col("centre").alias("a"), F.col("uid").alias("b")).distinct()
    links = aligned(rays, signed)
    return links.union(_within_buckets(members, components(links), signed))


def _within_buckets(members: DataFrame, roots: DataFrame, signed: DataFrame) -> DataFrame:
    """Links between different components that share a bucket."""
    known = roots.withColumnRenamed("node", "uid")
    placed = materialize(members.join(known, "uid", "left").withColumn("comp", F.coalesce("root", "uid")).drop("root"))
    release(members)
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
    rows = (
        placed.join(mixed, "key", "left_semi")
        .join(signed.select("uid", "n", "bag", "code", F.transform("sketches", lambda x: F.shiftright(x, 32).cast("int")).alias("sketch")), "uid")
        .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", F.least("own", "other").alias("s"), F.greatest("own", "other").alias("t"), "own", "uid", "n", "comp", "band", "sketch", "bag", "code")
    )
    dealt = rows.repartition("key", "s", "t").sortWithinPartitions("key", "s", "t", "uid")
    links = materialize(dealt.mapInArrow(_similar, "a long, b long").distinct())
    release(placed)
    return links


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (doc_id, class_id, class_size, first).

    ``class_id`` is the smallest id of the class, ``first`` marks one row of each class, one with that id.
    """
    small_batches(docs.sparkSession)
    signed = materialize(signatures(docs, doc_id, text))
    copies = signed.groupBy("digest").agg(F.min("uid").alias("of"))
    roots = components(near_links(signed, copies.select(F.col("of").alias("uid")))).select(F.col("node").alias("of"), "root")
    classes = copies.join(roots, "of", "left").select("digest", F.coalesce("root", "of").alias("class"))
    rows = materialize(signed.select("uid", "id", "digest").join(classes, "digest").select("uid", "id", "class"))
    release(signed)
    named = rows.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("m"), F.count("*").alias("class_size"))
    return rows.join(named, "class").select(
        F.col("id").alias(doc_id), F.col("m.id").alias("class_id"), "class_size", (F.col("uid") == F.col("m.uid")).alias("first")
    )


def op8_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
