"""Approximate nearest neighbours with a permutation index.

A vector is represented by its ``NEAREST`` nearest of ``PIVOTS`` pivots, in order. Each pivot's inverted file lists the vectors that name
it and at which rank. A query adds up, over the files of its own pivots, how far the ranks lie apart (the footrule distance of the two
orders, where an unnamed pivot counts as rank NEAREST), and the vectors with the least distance are reranked by the
exact inner product in double precision.

Inner products are turned into angles by one more component, sqrt(M^2 - |v|^2) for the largest norm M of all vectors, so long
vectors are found too. Equal vectors are one entry of the index and are listed again at the end, so a vector that a third of all rows share costs
one entry. The index is split by a hash into blocks of bounded size, each with its own inverted files; blocks of queries visit every block,
and the best of each are merged. A block reranks the same share of its entries at every size (``RERANK``), at least ``LEAST``.

The pivots are a bounded sample (``PIVOTS`` distinct vectors with the smallest hashes); every vector is indexed.

Defined cases: vectors that are null, zero, hold a null or a non-finite component, or differ from the usual dimension (the
commonest, the larger of two) take no part, neither as query nor as candidate; null ids neither; rows with one id and one vector are one
row; with fewer candidates than asked for all are returned; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.session import materialize

PIVOTS = 256
NEAREST = 64
RERANK = 0.2
LEAST = 512
BLOCK = 8192
QUERY_BLOCK = 1024


def valid_vectors(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v): distinct rows with a usable vector as doubles."""
    v = F.col("v")
    rows = table.select(F.col(vec_id).alias("id"), F.col(embedding).cast("array<double>").alias("v")).dropna()
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["size"] if sizes else 0)).distinct()


def _matrix(column: pa.ChunkedArray, width: int, kind=np.float64) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), dtype=kind).reshape(-1, width)


def _orders(lifted: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The ``nearest`` nearest pivots of each row, nearest first, ties to the smaller pivot."""
    return np.argsort(-(lifted @ pivots.T), axis=1, kind="stable")[:, :nearest].astype(np.int16)


def indexed(classes: DataFrame, pivots: np.ndarray, largest: float) -> DataFrame:
    """``classes`` (id, v) with ``as_entry`` and ``as_query``: its pivots in order, as an entry and as a query."""
    shared = classes.sparkSession.sparkContext.broadcast((_lifted(pivots, largest), largest))

    def order(batches):
        p, top = shared.value
        nearest = min(NEAREST, len(p))
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(pa.chunked_array([batch.column("v")]), p.shape[1] - 1)
            flat = np.concatenate([v, np.zeros((len(v), 1))], axis=1)
            ends = pa.array(np.arange(len(v) + 1, dtype=np.int32) * nearest)
            lists = [pa.ListArray.from_arrays(ends, pa.array(_orders(x, p, nearest).ravel())) for x in (_lifted(v, top), flat)]
            yield pa.record_batch([*batch.columns, *lists], names=["id", "v", "as_entry", "as_query"])

    return classes.mapInArrow(order, f"id {classes.schema['id'].dataType.simpleString()}, v array<double>, as_entry array<smallint>, as_query array<smallint>")


def _lifted(v: np.ndarray, largest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(largest**2 - (v**2).sum(1), 0))
    return np.concatenate([v, rest[:, None]], axis=1)


def search_block(queries: np.ndarray, asked: np.ndarray, entries: np.ndarray, orders: np.ndarray, ids: np.ndarray, pivots: int, k: int):
    """For each query the places of its k best entries of a block and their inner products."""
    n, nearest = orders.shape
    place = np.argsort(orders.ravel(), kind="stable")  # the inverted files, one after the other
    ends = np.searchsorted(orders.ravel()[place], np.arange(pivots + 1))
    owner, rank = (place // nearest).astype(np.int32), (place % nearest).astype(np.int32)
    take = min(n, max(LEAST, math.ceil(RERANK * n)))
    for q, named in zip(queries, asked, strict=True):
        footrule = np.zeros(n, np.int32)  # less the constant for entries that share no pivot
        for r, p in enumerate(named.tolist()):
            ranks = rank[ends[p] : ends[p + 1]]
            footrule[owner[ends[p] : ends[p + 1]]] += np.abs(ranks - r) + ranks + (r - 2 * nearest)
        near = np.argpartition(footrule, take - 1)[:take] if take < n else np.arange(n)
        score = entries[near] @ q
        best = np.lexsort((ids[near], -score))[:k]
        yield near[best], score[best]


def candidates(index: DataFrame, queries: DataFrame, n: int, n_queries: int, width: int, pivots: int, k: int) -> DataFrame:
    """(query, id, score): the k best of every block for every query class."""
    blocks, query_blocks = max(1, math.ceil(n / BLOCK)), max(1, math.ceil(n_queries / QUERY_BLOCK))

    def numbers(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    entries = index.select("id", "v", "as_entry", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("b"), numbers(query_blocks).alias("qb"))
    asked = queries.select(F.col("id").alias("query"), F.col("v").alias("wanted"), "as_query", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qb"), numbers(blocks).alias("b"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        query, found, scores = [], [], []
        if left.num_rows and right.num_rows:
            ids = left["id"].to_numpy()
            nearest = min(NEAREST, pivots)
            entries = _matrix(left["v"], width)
            results = search_block(
                _matrix(right["wanted"], width), _matrix(right["as_query"], nearest, np.int64), entries, _matrix(left["as_entry"], nearest, np.int16), ids, pivots, k
            )
            vectors = _matrix(right["wanted"], width)
            for i, (q, (places, _)) in enumerate(zip(right["query"].to_pylist(), results, strict=True)):
                query += [q] * len(places)
                found += ids[places].tolist()
                scores += [math.fsum(x) for x in (entries[places] * vectors[i]).tolist()]
        return pa.table({"query": pa.array(query, pa.int64()), "id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.float64())})

    return entries.groupBy("b", "qb").cogroup(asked.groupBy("b", "qb")).applyInArrow(search, "query long, id long, score double")


def nearest_neighbours(table: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for which ``is_query`` (of column id) holds."""
    spark = table.sparkSession
    rows = materialize(valid_vectors(table, vec_id, embedding).withColumn("id", F.col("id").cast("long")))
    # equal vectors are one class, named by its smallest id; at most k + 1 of its rows can be among the k nearest
    classes = rows.groupBy("v").agg(F.min("id").alias("id")).select("id", "v")
    classes = materialize(classes)
    member = materialize(rows.join(classes.select(F.col("id").alias("of"), "v"), "v").select("id", "of"))
    facts = classes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm")).first()
    shape = "query_id long, rank int, vec_id long, score double"
    if not facts.n:
        return spark.createDataFrame([], shape)
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("v").collect()
    pivots = np.array([r.v for r in sample])
    index = materialize(indexed(classes, pivots, math.sqrt(facts.norm)))
    asking = member.where(is_query).select("id", "of")
    wanted = asking.select(F.col("of").alias("id")).distinct()
    n_queries = wanted.count()
    found = candidates(index, wanted.join(index, "id"), facts.n, n_queries, facts.width, len(pivots), k + 1)
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1).drop("place")
    first = Window.partitionBy("of").orderBy("id")
    listed = member.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1).select("of", F.col("id").alias("vec_id"))
    by_class = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    spread = best.withColumnRenamed("id", "of").join(listed, "of").withColumn("place", F.row_number().over(by_class)).where(F.col("place") <= k + 1)
    lists = spread.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    own = asking.select(F.col("id").alias("query_id"), F.col("of").alias("query")).join(lists, "query")
    kept = F.slice(F.filter("found", lambda x: x.vec_id != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(kept).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score"
    )


def op6_neighbours(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest_neighbours(table, F.col("id") % 20 == 0)
