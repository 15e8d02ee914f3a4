"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token pieces of at most ``capacity`` tokens; pieces go into as few sequences as possible.

* Full pieces are sequences of their own. The others are dealt by a hash into blocks of about ``BLOCK`` pieces, one row of
  arrays each, so a task holds a bounded problem however many pieces share a length or a document.
* A block is evolved on several islands, each a small population of packings (genes are whole bins). Crossover takes
  well-filled bins of one parent, injects them into the other, removes the bins that now hold a piece twice, and best-fits the
  displaced pieces. Between epochs the elite of each island migrates to the next island of its block.
* Sequences with little waste are kept. The pieces of the others, of all blocks, are dealt into fewer blocks and
  evolved again, until one block is left or nothing is gained, so blocks leave no seams.

Defined cases: a null or empty text is the end token alone; repeated rows are packed one by one (by their own row number);
null ids stay null; an empty table gives no pieces; ties between pieces of one length go by row number.
"""

from __future__ import annotations

import os
import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.words import runs, slices, span_hashes
from propensity.session import materialize

CAPACITY = 2048
BLOCK = 2048
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4
WASTE = 8  # free tokens up to which a sequence is kept as it is
SLICE = 1 << 20  # bytes of text whose distinct words are looked up together
MEMO = 250_000  # words of one generation of the memory for their ids
ASKED = 4096  # words given to the tokenizer at once: it returns much more than their ids

_recent: dict[bytes, bytes] = {}
_older: dict[bytes, bytes] = {}
_tokenizers: dict[str, object] = {}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LETTER = np.isin(np.arange(256), range(0x61, 0x7B))
_SIGN = np.isin(np.arange(256), [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        for x in (_recent, _older, _tokenizers):
            x.clear()
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def _word_ids(words: list[bytes], path: str) -> list[bytes]:
    """The ids of each word, of which a process remembers the last one or two generations of ``MEMO`` words."""
    global _recent, _older
    tokenizer = _tokenizer(path)
    if len(_recent) > MEMO:
        _recent, _older = {}, _recent
    unknown = []
    for w in words:
        if w not in _recent:
            if (known := _older.get(w)) is None:
                unknown.append(w)
            else:
                _recent[w] = known
    for at in range(0, len(unknown), ASKED):
        asked = unknown[at : at + ASKED]
        encoded = tokenizer.encode_batch_fast([w.decode() for w in asked], add_special_tokens=False)
        _recent.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(asked, encoded, strict=True))
    return [_recent[w] for w in words]


def token_ids(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, where each text's begin).

    The tokenizer puts ASCII letters in lower case and never joins across a blank or a line break, nor from an ASCII letter to an ASCII
    sign behind it, so a text's ids are those of the words between them. Each distinct word of a slice is looked up once, and a word before a
    comma is the same as without one. Where a special token may stand, case is kept and no sign is cut off, as these are only recognised as written.
    """
    cuts = np.zeros(0, np.int64)
    if b"<|" not in data.tobytes():
        data = _LOWER[data]
        cuts = np.flatnonzero(_LETTER[data[:-1]] & _SIGN[data[1:]]) + 1
    starts, ends = runs((data != 0x20) & (data != 0x0A), np.concatenate([offsets, cuts]))
    _, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    text = data.tobytes()
    words = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    found = _word_ids(words, path)
    ids = np.frombuffer(b"".join(found), "<u4")
    n = np.fromiter(map(len, found), np.int64, len(found)) // 4
    begin = np.cumsum(n) - n
    each = n[which]
    upto = np.concatenate([[0], np.cumsum(each)])
    at = np.repeat(begin[which] - upto[:-1], each) + np.arange(upto[-1])
    return ids[at], upto[np.searchsorted(starts, offsets)]


def token_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY, end: int = 0, with_ids: bool = False
) -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32[, ids]): the pieces of every row's token ids and the end token.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer or tokenizer_path()
        step, last = 4 * capacity, end.to_bytes(4, "little")
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for a, b, data, offsets in slices(batch.column(2), SLICE):
                found, begin = token_ids(data, offsets, path)
                for row in range(a, b):
                    tokens = found[begin[row - a] : begin[row - a + 1]].tobytes() + last
                    for k, at in enumerate(range(0, len(tokens), step)):
                        part = tokens[at : at + step]
                        rows.append(row)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(part)
            take = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.record_batch(columns + [pa.array(ids, pa.binary())] * with_ids, names=[f.split(" ")[0] for f in shape])

    kind = docs.schema[doc_id].dataType.simpleString()
    shape = ["uid long", f"id {kind}", "piece int", "start long", "length long", "ids_crc32 long"] + ["ids binary"] * with_ids
    picked = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return picked.mapInArrow(cut, ", ".join(shape)).withColumnRenamed("id", doc_id)


class Packing:
    """A packing of one block: bins as lists of pieces, and the free room of each."""

    def __init__(self, lengths: list[int], capacity: int, bins: list[list[int]] | None = None):
        self.lengths, self.capacity, self.bins = lengths, capacity, bins or []
        self.room = [capacity - sum(lengths[i] for i in b) for b in self.bins]

    def best_fit(self, pieces: list[int]) -> Packing:
        """Put each piece into the bin that it fills best, or into a new one."""
        lengths, bins, room = self.lengths, self.bins, self.room
        free = sorted((r, b) for b, r in enumerate(room) if r)
        for i in pieces:
            size = lengths[i]
            at = bisect_left(free, (size, -1))
            if at < len(free):
                r, b = free.pop(at)
                bins[b].append(i)
            else:
                b, r = len(bins), self.capacity
                bins.append([i])
                room.append(r)
            room[b] = r - size
            if room[b]:
                insort(free, (room[b], b))
        return self

    def fitness(self) -> float:
        """Fewer bins first; among equals the one whose room is gathered in few bins."""
        return -len(self.bins) + sum((r / self.capacity) ** 2 for r in self.room) / (len(self.room) + 1)

    def numbers(self) -> list[int]:
        out = [0] * len(self.lengths)
        for b, pieces in enumerate(self.bins):
            for i in pieces:
                out[i] = b
        return out


def from_numbers(lengths: list[int], capacity: int, numbers: list[int]) -> Packing:
    bins: list[list[int]] = [[] for _ in range(max(numbers, default=-1) + 1)]
    for i, b in enumerate(numbers):
        bins[b].append(i)
    return Packing(lengths, capacity, bins)


def longest_first(lengths: list[int], pieces) -> list[int]:
    return sorted(pieces, key=lambda i: (-lengths[i], i))


def crossover(mother: Packing, father: Packing, draw: random.Random) -> Packing:
    """The father's well-filled bins put into the mother's packing; pieces they displace are fitted anew."""
    full = [b for b, r in enumerate(father.room) if r <= WASTE]
    count = max(1, len(full) // 2)
    chosen = draw.sample(full, count) if full else [min(range(len(father.bins)), key=father.room.__getitem__)]
    injected = [father.bins[b] for b in chosen]
    taken = {i for b in injected for i in b}
    kept, displaced = [list(b) for b in injected], []
    for b, room in zip(mother.bins, mother.room, strict=True):
        if not taken.isdisjoint(b):
            displaced += [i for i in b if i not in taken]
        elif room > WASTE and draw.random() < 0.5:  # mutation: some bins with waste are opened as well
            displaced += b
        else:
            kept.append(list(b))
    return Packing(mother.lengths, mother.capacity, kept).best_fit(longest_first(mother.lengths, displaced))


def evolve(lengths: list[int], capacity: int, elites: list[list[int]], seed: int) -> list[int]:
    """One epoch of one island: bin numbers of its best packing. ``elites`` are the packings that start it, own and migrated."""
    draw = random.Random(seed)
    population = [from_numbers(lengths, capacity, e) for e in elites]
    least = -(-sum(lengths) // capacity)
    while len(population) < POPULATION:
        order = longest_first(lengths, range(len(lengths)))
        if population:  # the others of the first population: nearly longest first
            order = sorted(order, key=lambda i: -lengths[i] * draw.uniform(0.8, 1))
        population.append(Packing(lengths, capacity).best_fit(order))
    population.sort(key=Packing.fitness, reverse=True)
    for _ in range(GENERATIONS):
        if len(population[0].bins) <= least:
            break
        children = [crossover(*draw.sample(population, 2), draw) for _ in range(POPULATION // 2)]
        population = sorted(population + children, key=Packing.fitness, reverse=True)[:POPULATION]
    return population[0].numbers()


def _epoch(rows: DataFrame, capacity: int, round_: int, epoch: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r in batch.select(["block", "island", "lengths", "elites"]).to_pylist():
                found.append(evolve(r["lengths"], capacity, r["elites"], hash((round_, epoch, r["block"], r["island"]))))
            best = [pa.array(found, pa.list_(pa.int32())), pa.array([max(x, default=-1) + 1 for x in found], pa.int32())]
            yield pa.record_batch([*(batch.column(c) for c in ("block", "island", "keys", "lengths")), *best], names=["block", "island", "keys", "lengths", "best", "n_bins"])

    shape = "block long, island int, keys array<struct<uid:bigint,piece:int>>, lengths array<int>, best array<int>, n_bins int"
    return rows.mapInArrow(run, shape)


def packed_blocks(pieces: DataFrame, n: int, capacity: int, round_: int) -> DataFrame:
    """(uid, piece, block, bin, offset, room) after all epochs, for ``n`` pieces shorter than the capacity."""
    blocks = max(1, round(n / BLOCK))
    item = F.struct((-F.col("length").cast("int")).alias("order"), "uid", "piece")
    rows = (
        pieces.withColumn("block", F.pmod(F.xxhash64("uid", "piece", F.lit(round_)), F.lit(blocks)))
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select(
            "block",
            F.transform("items", lambda x: F.struct(x.uid.alias("uid"), x.piece.alias("piece"))).alias("keys"),
            F.transform("items", lambda x: -x.order).alias("lengths"),
        )
    )
    islands = rows.withColumn("island", F.explode(F.array([F.lit(i) for i in range(ISLANDS)])))
    # one row a block and island: few rows with much work each, so they are spread over all tasks
    islands = islands.withColumn("elites", F.array().cast("array<array<int>>")).repartition(min(2 * blocks, 4096), "block", "island")
    for epoch in range(EPOCHS):
        evolved = materialize(_epoch(islands, capacity, round_, epoch))
        if epoch + 1 < EPOCHS:
            islands = (
                evolved.withColumn("to", F.explode(F.array("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)))))
                .groupBy("block", F.col("to").alias("island"))
                .agg(F.first("keys").alias("keys"), F.first("lengths").alias("lengths"), F.collect_list("best").alias("elites"))
            )
    best = evolved.groupBy("block").agg(F.min_by(F.struct("keys", "lengths", "best"), F.struct("n_bins", "island")).alias("b"))
    return best.select("block", "b.*").mapInArrow(lambda batches: _placed(batches, capacity), "uid long, piece int, block long, bin int, offset long, room int")


def _placed(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            keys, lengths, numbers = (batch.column(c)[i].values for c in ("keys", "lengths", "best"))
            lengths, numbers = lengths.to_pylist(), numbers.to_pylist()
            filled = [0] * (max(numbers) + 1)
            offset = []
            for size, b in zip(lengths, numbers, strict=True):
                offset.append(filled[b])
                filled[b] += size
            yield pa.record_batch(
                [
                    keys.field("uid"),
                    keys.field("piece"),
                    pa.array([batch.column("block")[i].as_py()] * len(lengths), pa.int64()),
                    pa.array(numbers, pa.int32()),
                    pa.array(offset, pa.int64()),
                    pa.array([capacity - filled[b] for b in numbers], pa.int32()),
                ],
                names=["uid", "piece", "block", "bin", "offset", "room"],
            )


def best_fit_packing(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (uid, piece, length and more) with ``sequence_id`` and ``offset``."""
    pieces = materialize(pieces)
    keys = ["uid", "piece"]
    number = F.col("block") * (1 << 16) + F.col("bin")
    done = []
    rest, round_ = pieces.where(F.col("length") < capacity).select(*keys, "length"), 1
    n = rest.count()
    while n:
        placed = materialize(packed_blocks(rest, n, capacity, round_))
        last = n <= 1.5 * BLOCK
        wasted = F.col("room") > WASTE
        left = 0 if last else placed.where(wasted).count()
        again = not last and left < 0.7 * n
        kept = placed.where(~wasted) if again else placed
        done.append(kept.select(*keys, F.lit(round_).cast("long").alias("round"), number.alias("number"), "offset"))
        if not again:
            break
        rest = rest.join(placed.where(wasted).select(*keys), keys)
        n, round_ = left, round_ + 1
    base = 1 << 56
    full = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    if not done:
        return full
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    found = found.select(*keys, (F.col("round") * base + F.col("number")).alias("sequence_id"), "offset")
    return full.unionByName(pieces.where(F.col("length") < capacity).join(found, keys))


def write_sequences(packed: DataFrame, path: str) -> None:
    """Packed pieces with their ``ids`` as one row a sequence: the bytes of at most ``capacity`` token ids in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x.ids)
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x))
    packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens")).write.parquet(path)


def packed_documents(docs: DataFrame) -> DataFrame:
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return best_fit_packing(token_pieces(docs.select("doc_id", "text"))).select(*columns)


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
