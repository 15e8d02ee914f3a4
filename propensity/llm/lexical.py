"""Ranked lexical search over document FP-trees.

Each item's best documents by an integer score over the item's terms: every term weighs by its rarity, a document's occurrences count with
saturation, less in long documents. Terms are words with A-Z lower-cased.

1. Items are dealt by a hash to blocks of some ``ITEM_TERMS`` terms, so what a block shares with the tasks is bounded. One numpy scan
   restricts every document to the block's terms: (id, words, terms, occurrences), written once; texts are not moved. Tasks count the document
   frequencies from these vectors.
2. A task reads vectors and grows FP-trees of up to ``TREE_DOCS`` documents: a vector's terms stand in the order of falling document frequency, so
   documents with the same frequent terms share a path, and copies all of it. Nodes of fewer than ``LEAF`` documents are not split.
   A node knows, for its subtree, each term's largest number of occurrences and the smallest length measure m.
3. Each item goes depth-first through the tree, children with larger bounds first. The node's maxima and its minimum in place of a document's own
   numbers bound all scores below it, as the score rises with occurrences and falls with m. A subtree whose bound is under the item's k-th best score is left out; else
   the node's own documents are scored. The k-th best scores carry over from tree to tree of a task.
4. A task sends its k best for each item, and the best of all tasks are ranked.

The result is exact: only subtrees that cannot reach the k best are left out, equal scores are kept for the id to decide. No shuffle but that of the k best; a copied
text costs one path in a tree however often it occurs.

Defined cases: a null or empty text has no terms, neither as document (it is not counted in N) nor as item (no results); repeated rows are ranked one by one, also
with one id; equal scores go to the smaller id, a null id last; repeated item rows give results each; very long texts are counted whole, one at a time; other columns
are ignored; without documents or items there are no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.words import slices, words_of
from propensity.session import materialize

K = 10
ITEM_TERMS = 16_384
TREE_DOCS = 8_192
TREE_TERMS = 2_000_000  # terms of all documents of a tree, which bounds the memory for long documents
LEAF = 16


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What occurrences count, from 0 to 1,000,000: it rises with ``tf`` and falls with ``m``."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def measures(words: np.ndarray, n: int, length: int) -> np.ndarray:
    """The length measure m of documents with ``words`` terms, of ``n`` documents with ``length`` terms in all."""
    if len(words) and int(words.max()) * 90 * n >= 1 << 63:
        return np.array([10 + 90 * x * n // length for x in words.tolist()], np.int64)
    return 10 + 90 * words * n // length


@dataclass
class FpTree:
    """Documents with their terms in the order of rank, laid out by the node that holds them.

    Node 0 is the root. A node's own documents (in no child) are own[node]:own[node + 1], a document's terms first[d]:first[d + 1].
    """

    ids: list
    first: np.ndarray
    terms: np.ndarray
    worth: np.ndarray
    own: np.ndarray
    children: list[list[int]]
    most: np.ndarray  # (node, term): occurrences
    least: np.ndarray  # node: m

    @classmethod
    def grow(cls, ids: list, first: np.ndarray, terms: np.ndarray, tf: np.ndarray, m: np.ndarray, n_terms: int, leaf: int = LEAF) -> FpTree:
        """From documents whose ``terms`` (by rank, each once) ascend; document d has first[d]:first[d + 1]."""
        big = terms.astype(">u4")
        keys = [big[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        shared = _shared(first, terms, np.array(order, np.int64))
        low, high, parent = _nodes(shared.tolist(), len(order), leaf)
        owner = np.zeros(len(order), np.int64)
        for node, (a, b) in enumerate(zip(low, high, strict=True)):  # parents come before their children
            owner[a:b] = node
        # documents in the order of their nodes
        by_node = np.argsort(owner, kind="stable")
        docs = np.array(order, np.int64)[by_node]
        owner = owner[by_node]
        sizes = np.diff(first)[docs]
        new_first = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(first[docs] - new_first[:-1], sizes) + np.arange(new_first[-1])
        terms, tf, m = terms[at], tf[at], m[docs]
        most = np.zeros((len(low), n_terms), np.int64)
        np.maximum.at(most, (np.repeat(owner, sizes), terms), tf)
        least = np.full(len(low), np.iinfo(np.int64).max // 16)
        np.minimum.at(least, owner, m)
        children: list[list[int]] = [[] for _ in low]
        for node in range(len(low) - 1, 0, -1):
            np.maximum(most[parent[node]], most[node], out=most[parent[node]])
            least[parent[node]] = min(least[parent[node]], least[node])
            children[parent[node]].append(node)
        worth = saturated(tf, np.repeat(m, sizes))
        return cls([ids[d] for d in docs.tolist()], new_first, terms, worth, np.searchsorted(owner, np.arange(len(low) + 1)), children, most, least)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, best: list[tuple]) -> int:
        """Enter documents into ``best``, a heap of the k best as (score, id behind all others first); returns how many were scored."""
        bound = (saturated(self.most[:, terms], self.least[:, None]) * weights).sum(axis=1).tolist()
        weight = np.zeros(self.most.shape[1], np.int64)
        weight[terms] = weights
        scored, stack = 0, [0]
        while stack:
            node = stack.pop()
            if bound[node] <= 0 or len(best) == k and bound[node] < best[0][0]:
                continue
            a, b = int(self.own[node]), int(self.own[node + 1])
            if a < b:
                scored += b - a
                x, y = self.first[a], self.first[b]
                scores = np.add.reduceat(weight[self.terms[x:y]] * self.worth[x:y], self.first[a:b] - x)
                floor = best[0][0] if len(best) == k else 1
                for d in np.flatnonzero(scores >= floor).tolist():
                    entry = (int(scores[d]), _Behind(self.ids[a + d]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            stack += sorted(self.children[node], key=bound.__getitem__)
        return scored


class _Behind:
    """An id in the opposite order, null the least."""

    __slots__ = ("id",)

    def __init__(self, id_):
        self.id = id_

    def __lt__(self, other: _Behind) -> bool:
        if self.id is None or other.id is None:
            return self.id is None and other.id is not None
        return self.id > other.id

    def __eq__(self, other) -> bool:
        return self.id == other.id


def _shared(first: np.ndarray, terms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many first terms each document shares with the one before it in ``order``; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    sizes = np.diff(first)
    a, b = order[:-1], order[1:]
    n = np.minimum(sizes[a], sizes[b])
    ends = np.cumsum(n)
    place = np.arange(ends[-1]) - np.repeat(ends - n, n)
    same = terms[np.repeat(first[a], n) + place] == terms[np.repeat(first[b], n) + place]
    apart = np.where(same, np.iinfo(np.int64).max, place)
    out[1:] = n  # documents have a term at least, so no part of reduceat is empty
    out[1:] = np.minimum(out[1:], np.minimum.reduceat(apart, ends - n))
    return out


def _nodes(shared: list[int], n: int, leaf: int) -> tuple[list[int], list[int], list[int]]:
    """(low, high, parent) of the branching nodes over documents low:high in order, those with ``leaf`` documents or more, parents first."""
    found, stack = [], [(-1, 0)]  # (depth, low) of open nodes; the root is open at depth -1
    for i in range(1, n + 1):
        depth, low = (shared[i] if i < n else -1), i - 1
        while stack[-1][0] > depth:
            top, low = stack.pop()
            if i - low >= leaf:
                found.append((low, i, top))
        if depth > stack[-1][0]:
            stack.append((depth, low))
    found = sorted({(a, b): d for a, b, d in found if (a, b) != (0, n)}.items(), key=lambda x: (x[0][0], -x[0][1]))
    low, high, parent, path = [0], [n], [0], [0]
    for (a, b), _ in found:
        while high[path[-1]] < b or low[path[-1]] > a:
            path.pop()
        parent.append(path[-1])
        path.append(len(low))
        low.append(a)
        high.append(b)
    return low, high, parent


# --- items, vectors and trees as Spark jobs --------------------------------------------------------


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, terms): the distinct term hashes of each item that has some."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                w = words_of(data, offsets)
                lists = [np.unique(w.hashes[w.first[i] : w.first[i + 1]]).view(np.int64) for i in range(b - a)]
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(lists, pa.list_(pa.int64()))], names=["item", "terms"])

    kind = items.schema[item_id].dataType.simpleString()
    cutted = items.select(F.col(item_id).alias("item"), F.col(text).cast("string").alias("text")).mapInArrow(cut, f"item {kind}, terms array<bigint>")
    return cutted.where(F.size("terms") > 0)


def restricted(docs: DataFrame, doc_id: str, text: str, vocabulary: np.ndarray) -> DataFrame:
    """(id, n, terms, tf): for each document its words and, of the sorted ``vocabulary``, the places of its terms with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                w = words_of(data, offsets)
                place = np.minimum(np.searchsorted(known, w.hashes), len(known) - 1)
                hit = np.flatnonzero(known[place] == w.hashes)
                doc = np.repeat(np.arange(b - a), w.counts)[hit]
                both, tf = np.unique(doc * len(known) + place[hit], return_counts=True)
                ends = pa.array(np.searchsorted(both // len(known), np.arange(b - a + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (both % len(known), tf)]
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(w.counts, pa.int64()), *lists], names=["id", "n", "terms", "tf"])

    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(scan, f"id {kind}, n long, terms array<int>, tf array<int>")


def frequencies(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["term", "df"])

    df = np.zeros(n_terms, np.int64)
    counted = vectors.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in counted.toLocalIterator():  # a row for each term of a block of items
        df[r.term] = r.df
    return df


def best_of_tasks(vectors: DataFrame, vocabulary: np.ndarray, items: list[np.ndarray], n: int, length: int, k: int, tree_docs: int, leaf: int) -> DataFrame:
    """(at, id, score): the k best documents of each task for the item at place ``at`` of ``items``."""
    df = frequencies(vectors, len(vocabulary))
    weight = np.floor(1000 * np.log((2.0 * n + 2) / (2.0 * df + 1))).astype(np.int64)
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
    asked = []
    for terms in items:
        places = np.searchsorted(vocabulary, terms)
        places = places[(df[places] > 0) & (weight[places] > 0)]
        asked.append((rank[places], weight[places]))
    shared = vectors.sparkSession.sparkContext.broadcast((rank, asked))
    id_type = vectors.schema["id"].dataType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, wanted = shared.value
        best: list[list] = [[] for _ in wanted]
        kind = None
        for ids, words, first, terms, tf in _documents(batches, tree_docs):
            kind = ids.type
            by_rank = ranks[terms]
            order = np.lexsort((by_rank, np.repeat(np.arange(len(words)), np.diff(first))))
            m = measures(words, n, length)
            tree = FpTree.grow(ids.to_pylist(), first, by_rank[order], tf[order], m, len(ranks), leaf)
            for (t, w), heap in zip(wanted, best, strict=True):
                if len(t):
                    tree.search(t, w, k, heap)
        rows = [(at, entry[1].id, entry[0]) for at, heap in enumerate(best) for entry in heap]
        if rows:
            at, found, scores = zip(*rows, strict=True)
            yield pa.record_batch([pa.array(at, pa.int32()), pa.array(found, kind), pa.array(scores, pa.int64())], names=["at", "id", "score"])

    return vectors.where(F.size("terms") > 0).mapInArrow(search, f"at int, id {id_type.simpleString()}, score long")


def _documents(batches: Iterator[pa.RecordBatch], tree_docs: int):
    """(ids, words, first, terms, tf) of up to ``tree_docs`` documents at a time."""
    held, docs, terms = [], 0, 0

    def taken():
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table["terms"].combine_chunks()
        first = lists.offsets.to_numpy().astype(np.int64)
        flat = [table[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "tf")]
        return table["id"].combine_chunks(), table["n"].to_numpy(), first - first[0], *flat

    for batch in batches:
        sizes = np.diff(batch.column(2).offsets.to_numpy())
        a = 0
        while a < batch.num_rows:
            room = int(np.searchsorted(np.cumsum(sizes[a:]), TREE_TERMS - terms, side="right"))
            b = min(batch.num_rows, a + min(tree_docs - docs, room))
            if b == a and not held:
                b = a + 1  # a document of very many terms is a tree of its own
            if b > a:
                held.append(batch.slice(a, b - a))
                docs, terms, a = docs + b - a, terms + int(sizes[a:b].sum()), b
            if a < batch.num_rows:
                yield taken()
                held, docs, terms = [], 0, 0
    if held:
        yield taken()


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_terms: int = ITEM_TERMS,
    tree_docs: int = TREE_DOCS,
    leaf: int = LEAF,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 of every row of ``items``, best first."""
    spark = docs.sparkSession
    asked = materialize(item_terms(items, item_id, item_text).withColumn("row", F.monotonically_increasing_id()))
    all_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-all_terms // block_terms)
    kinds = items.schema[item_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()
    found = spark.createDataFrame([], f"row long, id {kinds[1]}, score long")
    total = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).select("row", "terms").orderBy("row").collect()  # some ITEM_TERMS terms
        if not rows:
            continue
        terms = [np.array(r.terms, np.int64).view(np.uint64) for r in rows]
        vocabulary = np.unique(np.concatenate(terms))
        vectors = materialize(restricted(docs, doc_id, text, vocabulary))
        if total is None:
            total = vectors.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("length")).first()
        if not total.n:
            break
        best = best_of_tasks(vectors, vocabulary, terms, total.n, total.length, k, tree_docs, leaf)
        places = spark.createDataFrame([(at, r.row) for at, r in enumerate(rows)], "at int, row long")
        found = found.union(best.join(places, "at").select("row", "id", "score"))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("row", "item"), "row").select(F.col("item").alias(item_id), "rank", F.col("id").alias(doc_id), "score")


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
totals AS (SELECT (count(*) FILTER (len(w) > 0))::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
items AS (SELECT DISTINCT i, item_id, term FROM (SELECT i, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark))),
often AS (
    SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d)
    WHERE term IN (SELECT term FROM items) GROUP BY r, term
),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM often, totals GROUP BY term, n_docs
),
lengths AS (SELECT r, doc_id, (10 + (90 * len(w)::BIGINT * n_docs) // n_terms)::BIGINT AS m FROM d, totals),
scores AS (
    SELECT i, item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM items JOIN often USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY i, item_id, doc_id, r
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10
"""
