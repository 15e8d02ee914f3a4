"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: slot (offset + j * skip) mod size for
j = 0, 1, ..., with offset and skip from the md5 of its name. Shards take turns and claim their first slot that is still free, until the table is
full, so shares differ by one slot at most, and taking a shard away moves little else. The table has a fixed number of
rows (``SIZE``), so it is broadcast, and placing a row is one hash and one lookup: no shuffle, no Python.

Defined cases: a null key is placed like the empty text; equal keys go to the same shard; repeated rows stay; columns
called like the added ones are replaced; an empty table stays empty. Without shards or with a size that is no prime above the
number of shards the table is refused.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 4099
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str] | tuple[str, ...], size: int = SIZE) -> list[int]:
    """The number of the shard that owns each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if size <= len(shards) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime above the number of shards")
    offset = [_number("offset " + s) % size for s in shards]
    skip = [_number("skip " + s) % (size - 1) + 1 for s in shards]
    table, asked = [-1] * size, [0] * len(shards)
    for claim in range(size):
        i = claim % len(shards)
        while table[slot := (offset[i] + asked[i] * skip[i]) % size] >= 0:
            asked[i] += 1
        table[slot] = i
    return table


def table_frame(spark: SparkSession, shards: list[str] | tuple[str, ...], size: int = SIZE) -> DataFrame:
    """(slot, shard) with one row for each slot."""
    owners = ",".join(map(str, lookup_table(shards, size)))
    names = F.split(F.lit("\n".join(shards)), "\n")
    slots = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
    return slots.select("slot", F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))


def slot_of(key: Column, size: int = SIZE) -> Column:
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long") % size).cast("int")


def placed(df: DataFrame, key: str, shards: list[str] | tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard``."""
    table = table_frame(df.sparkSession, shards, size)
    return df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), size)).join(F.broadcast(table), "slot")


def write_shards(df: DataFrame, key: str, path: str, shards: list[str] | tuple[str, ...] = SHARDS, size: int = SIZE) -> None:
    """One folder of Parquet files for each shard; rows are spread over tasks by slot, so no shard waits for one task."""
    placed(df, key, shards, size).repartition("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return placed(docs, "doc_id").select("doc_id", "slot", "shard")


def _hash_sql(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


OP7_SQL = f"""
WITH RECURSIVE s AS (
    SELECT list({_hash_sql("'offset ' || name")} % {SIZE} ORDER BY i) AS offs, list({_hash_sql("'skip ' || name")} % {SIZE - 1} + 1 ORDER BY i) AS skips,
        list(name ORDER BY i) AS names
    FROM (SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS name FROM range({len(SHARDS)}) r(i))
),
claims(step, shard, slot, free) AS (
    SELECT -1::BIGINT, NULL::BIGINT, NULL::BIGINT, list_transform(range({SIZE}), lambda x: true)
    UNION ALL
    SELECT step + 1, i, pick, list_transform(free, lambda x, k: x AND k <> pick + 1)
    FROM (
        SELECT step, free, (step + 1) % {len(SHARDS)} AS i,
            list_filter(
                list_transform(range({SIZE}), lambda j: (offs[(step + 1) % {len(SHARDS)} + 1] + j * skips[(step + 1) % {len(SHARDS)} + 1]) % {SIZE}),
                lambda p: free[p + 1]
            )[1] AS pick
        FROM claims, s WHERE step < {SIZE - 1}
    )
)
SELECT doc_id, slot::INTEGER AS slot, names[shard + 1] AS shard
FROM (SELECT doc_id, {_hash_sql("coalesce(doc_id::VARCHAR, '')")} % {SIZE} AS slot FROM documents)
JOIN (SELECT slot, shard FROM claims WHERE step >= 0) USING (slot), s
"""
