from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from propensity.llm.sharding import SHARDS, SIZE, lookup_table, placed, write_shards


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain_fill(names, size):
    """Turn by turn over whole preference lists."""
    wishes = {n: [(number("offset " + n) + j * (number("skip " + n) % (size - 1) + 1)) % size for j in range(size)] for n in names}
    table = {}
    while len(table) < size:
        for i, n in enumerate(names):
            if len(table) < size:
                table[next(s for s in wishes[n] if s not in table)] = i
    return [table[s] for s in range(size)]


def test_table_equals_the_plain_fill():
    names = [f"n{i}" for i in range(5)]
    assert lookup_table(names, 101) == plain_fill(names, 101)


def test_shares_are_even_and_little_moves_without_a_shard():
    table = lookup_table(SHARDS)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = lookup_table(SHARDS[:-1])
    moved = sum(SHARDS[a] != SHARDS[b] for a, b in zip(table, fewer, strict=True))
    assert moved < 0.15 * SIZE


def test_bad_tables():
    for names, size in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b"], 2)):
        with pytest.raises(ValueError):
            lookup_table(names, size)


def test_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (5, None)], "doc_id long, shard string")
    rows = placed(df, "doc_id").collect()
    assert len(rows) == 4 and all(r.slot == number("" if r.doc_id is None else str(r.doc_id)) % SIZE for r in rows)
    assert all(r.shard == SHARDS[lookup_table(SHARDS)[r.slot]] for r in rows)
    assert placed(df.limit(0), "doc_id").count() == 0
    write_shards(df, "doc_id", str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4
    plan = placed(df, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
