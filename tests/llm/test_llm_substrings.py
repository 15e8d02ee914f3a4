from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from propensity.llm.substrings import COVERS, Chunk, cover_for, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    often = Counter(tuple(w[p : p + window]) for w in words for p in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {q for p in range(len(w) - window + 1) if often[tuple(w[p : p + window])] > 1 for q in range(p, p + window)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def found(spark, texts, **sizes):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, chunk string, kept int")
    rows = without_repeats(docs, **sizes).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        w = WORD.findall(t or "")
        cut = {i for a, b in r.removed for i in range(a, b)}
        assert len(cut) == r.n_removed and " ".join(x for i, x in enumerate(w) if i not in cut) == r.kept
    return [(r.n_words, r.n_removed, r.kept) for r in rows]


@pytest.mark.parametrize("period,cover", COVERS)
def test_every_difference_is_covered(period, cover):
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_anchors_leave_half_a_window():
    assert [cover_for(w)[0] for w in (35, 25, 20, 13, 5, 1)] == [13, 13, 7, 7, 3, 1]


@pytest.mark.parametrize("window", [1, 3, 6, 14, 35])
@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 500, "bucket_keys": 50}])
def test_equal_to_brute_force(spark, window, sizes):
    rng = random.Random(window)
    pool = [" ".join(rng.choice(["a", "B", "öl", "𝒳", "c.", "d e", "f"]) + str(rng.randrange(40)) for _ in range(n)) for n in (34, 35, 36, 47, 60, 90)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(pool) if rng.random() < 0.5 else " ".join(str(rng.random()) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(5))]
        texts.append(rng.choice([" ", "\n", "\t  ", "\x0b"]).join(parts))
    texts += [None, "", " \n", "one", *[pool[4]] * 20, "tail " * 40, pool[2] + " " + pool[2]]
    assert found(spark, texts, window=window, **sizes) == brute(texts, window)


def test_a_shared_passage_of_exactly_a_window_at_every_shift(spark):
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(35))
    texts = [" ".join([*(str(rng.random()) for _ in range(i)), passage, *(str(rng.random()) for _ in range(i % 3))]) for i in range(30)]
    rows = found(spark, texts, chunk_bytes=2000)
    assert [n for _, n, _ in rows] == [35] * 30
    almost = [t.replace("p34", f"q{i}") for i, t in enumerate(texts)]  # 34 equal words are no window
    assert {n for _, n, _ in found(spark, almost, chunk_bytes=2000)} == {0}


def test_a_very_long_text_and_one_word_again_and_again(spark):
    long = " ".join(f"w{i}" for i in range(300_000))
    rows = found(spark, [long, "x " * 200_000, long[:400_000] + "!", "y" * 1_000_000], chunk_bytes=1 << 20)
    n = len((long[:400_000] + "!").split())
    assert [r[:2] for r in rows] == [(300_000, n - 1), (200_000, 200_000), (n, n - 1), (1, 0)]


def test_repeated_ids_nulls_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text + " end"), (None, None)], "doc_id long, text string")
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in without_repeats(docs).collect()]
    assert sorted(rows, key=repr) == sorted([(1, 40, 40, ""), (1, 40, 40, ""), (None, 41, 40, "end"), (None, 0, 0, "")], key=repr)
    assert without_repeats(docs.limit(0)).collect() == []


def test_query_equals_its_sql(spark):
    import oracle

    from propensity.llm.substrings import OP13_SQL, op13_substrings

    assert oracle.difference(op13_substrings(spark, "/root/testdata/sf0.001"), oracle.connect("/root/testdata/sf0.001"), OP13_SQL) is None


def test_windows_hold_their_anchor():
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    batch = pa.record_batch([pa.array([1, 2]), pa.array([" ".join(map(str, range(50))), " ".join(map(str, range(100)))])], names=["id", "text"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    chunk = Chunk.read(sink.getvalue())
    at, _ = chunk.anchors(35)
    for a in at.tolist():
        first, last = (0, 50) if a < 50 else (50, 150)
        wanted = [p for p in range(max(first, a - 12), a + 1) if p + 35 <= last]
        assert chunk.candidates(35, np.array([a])).tolist() == wanted
