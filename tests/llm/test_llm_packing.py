from __future__ import annotations

import struct
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from propensity.llm.packing import Packing, best_fit_packing, crossover, evolve, packed_documents, token_pieces, tokenizer_path, write_sequences

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "\n\n a", "Á b́", "it's  <|endoftext|>x <|startoftext|> y", "tab\tand nbsp \x1c\x85z", "Σας ΣΑΣ", "a\ńb", "日本語 text", "x" * 9000, "1 22 333 " * 2500]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, texts, tokenizer):
    """Every document's pieces are its ids; sequences hold at most 2048 tokens without gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = whole(tokenizer, texts[doc_id])
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 2048)))
        for r in pieces:
            part = ids[r.start : r.start + r.length]
            assert r.start == 2048 * r.piece and r.length == len(part) == min(2048, len(ids) - r.start)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_sequence)


def test_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packed_documents(docs).collect()
    count = check(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    assert count <= -(-sum(r.length for r in rows) // 2048) + 1


def test_odd_texts_equal_the_tokenizer(spark, tokenizer):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").withColumn("piece", F.lit("x"))
    check(packed_documents(docs).collect(), dict(enumerate(ODD)), tokenizer)


def test_repeats_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 3 + [(None, "a b c")], "doc_id long, text string")
    rows = packed_documents(docs).collect()
    assert len(rows) == 4 and len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packed_documents(docs.limit(0)).count() == 0


def test_many_equal_lengths_that_do_not_fit_together(spark):
    pieces = spark.range(9000).selectExpr("id AS uid", "0 AS piece", "CAST(CASE WHEN id % 3 = 0 THEN 1100 ELSE 900 END AS LONG) AS length")
    packed = best_fit_packing(pieces)
    assert packed.count() == 9000
    totals = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    # 3000 pairs of 1100 and 900, and 3000 pieces of 900 in pairs
    assert totals.where("n > 2048 OR n <> end").count() == 0 and totals.count() <= 4520


def test_evolution_keeps_every_piece_and_never_gets_worse():
    import random

    draw = random.Random(5)
    lengths = [draw.randint(20, 1500) for _ in range(300)]
    first = Packing(lengths, 2048).best_fit(sorted(range(300), key=lambda i: -lengths[i]))
    numbers = evolve(lengths, 2048, [first.numbers()], 3)
    assert max(numbers) + 1 <= len(first.bins)
    other = Packing(lengths, 2048).best_fit(list(range(300)))
    child = crossover(first, other, draw)
    assert sorted(i for b in child.bins for i in b) == list(range(300)) and min(child.room) >= 0


def test_written_sequences_are_the_ids(spark, tokenizer, tmp_path):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "d " * 3000)], "doc_id long, text string")
    packed = best_fit_packing(token_pieces(docs, with_ids=True))
    write_sequences(packed, str(tmp_path / "s"))
    out = spark.read.parquet(str(tmp_path / "s")).collect()
    assert sum(r.n_tokens for r in out) == sum(len(whole(tokenizer, t)) for t in ("alpha beta", "gamma", "d " * 3000))
    assert all(len(r.ids) == 4 * r.n_tokens <= 8192 for r in out)


def test_signs_behind_letters_are_cut_off(tokenizer, monkeypatch):
    import numpy as np

    from propensity.llm import packing

    asked = set()
    lookup = packing._word_ids
    monkeypatch.setattr(packing, "_word_ids", lambda words, path: (asked.update(words), lookup(words, path))[1])
    texts = ["Alpha alpha, alpha. alpha; (alpha) alpha!!! alpha", "it's they'll a's'd o''s x--'s it'S", "a.Σ aΣ. Σa.Σ b<≮ c≠ d-́ e≯", "a_b^c`d{e|f}g~h@i[j", "a1.b2,c 3d,e", "é,à á,b"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    ids, begin = packing.token_ids(np.frombuffer(data, np.uint8), offsets, tokenizer_path())
    for i, t in enumerate(texts):
        assert ids[begin[i] : begin[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert b"alpha" in asked and b"," in asked and b"!!!" in asked and b"alpha," not in asked
