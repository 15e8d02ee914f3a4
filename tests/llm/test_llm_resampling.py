from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import oracle
import pytest

from propensity.llm.resampling import OP12_SQL, bracket, crc32_of, op12_resampling, resampled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, ngrams, buckets):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, ngrams + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, percent, ngrams, buckets, least):
    found = [features(t, ngrams, buckets) for _, t in docs]
    s, t = Counter(b for _, f in found for b in f), Counter(b for x in target for b in features(x, ngrams, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for (doc_id, _), (n_words, f) in zip(docs, found):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    drawn = {id(r): i for i, r in enumerate(fit[: percent * len(fit) // 100], 1)}
    return sorted(((*r, drawn.get(id(r))) for r in rows), key=repr)


@pytest.mark.parametrize("ngrams,percent,accuracy", [(1, 10, 10_000), (2, 50, 10_000), (3, 100, 10_000), (1, 35, 2)])
def test_equal_to_brute_force(spark, ngrams, percent, accuracy):
    rng = random.Random(ngrams)
    words = ["a", "B", "öl", "𝒳y", "Rot", "grün", "w" * 40, "zwei"]
    docs = [(i, rng.choice([" ", "-", "\n"]).join(rng.choice(words) + str(rng.randrange(3)) for _ in range(rng.randrange(60)))) for i in range(300)]
    docs += [(900, None), (901, ""), (None, "a b c " * 10), (902, "tail " * 100_000), (7, docs[7][1]), (7, docs[7][1]), (None, "a b c " * 10)]
    target = ["a B öl " * 20, "Rot", None, ""]
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, score string, rank int")
    b = spark.createDataFrame([(t,) for t in target], "text string")
    got = [tuple(r) for r in resampled(d, b, percent, ngrams=ngrams, buckets=50, accuracy=accuracy).collect()]
    assert sorted(got, key=repr) == brute(docs, target, percent, ngrams, 50, 20)


def test_nothing_to_draw_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "a few words"), (2, "w " * 30)], "doc_id long, text string")
    b = spark.createDataFrame([], "text string")
    assert [r.rank for r in resampled(d, b).collect()] == [None, None]
    assert sorted((r.doc_id, r.rank or 0) for r in resampled(d, b, percent=100).collect()) == [(1, 0), (2, 1)]
    assert resampled(d.limit(0), b).collect() == []


def test_bracket_holds_the_place_and_widens(spark):
    scores = spark.range(5000).selectExpr("cast(case when id < 2000 then 7 else id end as long) AS score")
    for accuracy in (10_000, 3):
        for place in (1, 2, 1500, 3000, 3001, 4999, 5000):
            low, high, above = bracket(scores, 5000, place, accuracy)
            at = 5000 - place if place <= 3000 else 7
            assert low <= at <= high and above == scores.where(f"score > {high}").count() < place


def test_crc32_of_spans():
    rng = random.Random(3)
    data = np.frombuffer(rng.randbytes(3000), np.uint8)
    starts = np.array([rng.randrange(2800) for _ in range(400)])
    ends = starts + np.array([rng.choice([0, 1, 5, 31, 32, 33, 150]) for _ in starts])
    assert crc32_of(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


def test_query_equals_its_sql(spark):
    assert oracle.difference(op12_resampling(spark, "/root/testdata/sf0.001"), oracle.connect("/root/testdata/sf0.001"), OP12_SQL) is None
