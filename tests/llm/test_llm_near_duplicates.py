from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.llm import near_duplicates as nd
from propensity.llm.components import components

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def within(a, b):
    """Whether a plain alignment needs at most a fifth of the longer text's words as edits."""
    most = max(len(a), len(b)) // 5
    if abs(len(a) - len(b)) > most:
        return False
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        if min(row) > most:
            return False
        before = row
    return before[-1] <= most


def brute_classes(docs):
    """Smallest id of each component over all pairs that share a shingle of three words."""
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_words, holders = {}, {}
    for i, text in docs:
        by_words.setdefault(tuple(words(text)), []).append(i)
    for w, ids in by_words.items():
        for i in ids:
            root[find(i)] = find(ids[0])
        for k in range(max(1, len(w) - 2)):
            holders.setdefault(w[k : k + 3], set()).add(w)
    pairs = {(a, b) for group in holders.values() if 1 < len(group) < 40 for a in group for b in group if a < b}
    for a, b in pairs:
        if find(by_words[a][0]) != find(by_words[b][0]) and max(len(a), len(b)) < 700 and within(a, b):
            root[find(by_words[a][0])] = find(by_words[b][0])
    smallest = {}
    for i in root:
        smallest[find(i)] = min(i, smallest.get(find(i), i))
    return {i: smallest[find(i)] for i in root}


def test_documents_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = {i for i, t in docs if len(words(t)) < 700}
    got = {r.doc_id: r.class_id for r in nd.op8_near_duplicates(spark, SF).collect()}
    wanted = brute_classes(docs)
    assert len(got) == len(docs)
    assert {i: c for i, c in got.items() if i in short} == {i: c for i, c in wanted.items() if i in short}


def mutated(base, edits, draw):
    w = list(base)
    for _ in range(edits):
        k = draw.randrange(len(w))
        kind = draw.randrange(3)
        w[k : k + (kind < 2)] = [] if kind == 0 else [f"n{draw.randrange(10**6)}"]
    return w


def test_a_large_group_and_a_shared_passage(spark, monkeypatch):
    """Near copies in hundreds fall into one class, texts that share a passage do not; small blocks take every path."""
    monkeypatch.setattr(nd, "BLOCK", 16)
    draw = random.Random(7)
    base = [f"b{draw.randrange(5000)}" for _ in range(120)]
    passage = [f"p{i}" for i in range(55)]
    rows = [(i, " ".join(mutated(base, 5, draw))) for i in range(150)]
    rows += [(1000 + i, " ".join([f"w{draw.randrange(10**6)}" for _ in range(45)] + passage)) for i in range(150)]
    twin = [f"t{i}" for i in range(100)]
    rows += [(5000, " ".join(twin)), (5001, " ".join(mutated(twin, 15, draw))), (5002, " ".join(reversed(twin)))]
    got = {r.doc_id: (r.class_id, r.class_size) for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(150)} == {(0, 150)}
    assert all(got[1000 + i] == (1000 + i, 1) for i in range(150))
    assert got[5000] == got[5001] == (5000, 2) and got[5002] == (5002, 1)


def test_links_across_components_of_a_bucket(spark, monkeypatch):
    """Without the round with centres, the comparison inside buckets finds the same classes."""
    draw = random.Random(11)
    rows = []
    for g in range(12):
        base = [f"g{g}x{draw.randrange(10**6)}" for _ in range(90)]
        rows += [(10 * g + k, " ".join(mutated(base, 6, draw))) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = nd.aligned
    monkeypatch.setattr(nd, "aligned", lambda pairs, signed: whole(pairs, signed).limit(0))
    monkeypatch.setattr(nd, "BLOCK", 3)
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(docs).collect()}
    assert got == {10 * g + k: 10 * g for g in range(12) for k in range(4)}


def test_nulls_short_texts_repeats_and_empty_tables(spark):
    rows = [(1, None), (2, ""), (3, "...!"), (4, "a b"), (5, "A, b."), (6, "a c"), (7, "one two three four five six seven eight nine ten"), (8, "one two three four five six seven eight nine zehn"),
            (9, "x"), (9, "x"), (None, "x"), (None, "alone here"), (10, "wort " * 20000), (11, "wort " * 20000 + "ende"), (12, "wort " * 3)]
    df = spark.createDataFrame([(*r, 1, "u") for r in rows], "doc_id long, text string, n int, uid string")
    got = nd.near_duplicates(df).collect()
    assert len(got) == len(rows)
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    assert {k: sorted(v, key=repr) for k, v in classes.items()} == {
        1: [1, 2, 3], 4: [4, 5], 6: [6], 7: [7, 8], 9: [9, 9, None], None: [None], 10: [10, 11], 12: [12],
    }
    assert sum(r.first for r in got) == 8 and all(r.doc_id == r.class_id for r in got if r.first)
    assert nd.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("links", [[], [(1, 2), (2, 1), (3, 3)], [(i, i + 1) for i in range(0, 40)] + [(100, 90), (95, 90)], [(50, i) for i in range(60)]])
def test_components(spark, links):
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}
    for a, b in links:
        if a != b:
            root.setdefault(a, a)
            root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root


def test_alignment_bound_is_exact(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(n))) for i, n in enumerate((50, 40, 39))]
    signed = nd.signatures(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").withColumn("uid", F.col("id"))
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a long, b long")
    assert sorted(map(tuple, nd.aligned(pairs, signed).collect())) == [(0, 1), (1, 2)]


def test_many_alignments_at_once_equal_a_plain_one():
    draw = random.Random(3)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for n in (1, 3, 40, 300):
        one = [draw.randrange(1, 60) for _ in range(n)]
        others = [mutated_codes(one, e, draw) for e in (0, 0, 1, 2, 3, 5, 8, 30, 70, 100)] + [[7], one * 2, one[::-1]]
        most = [max(len(one), len(o)) // 5 for o in others]
        got = nd.edits_within(np.array(one, np.uint32), [np.array(o, np.uint32) for o in others], np.array(most))
        assert got.tolist() == [plain(one, o) <= m for o, m in zip(others, most, strict=True)]


def mutated_codes(base, edits, draw):
    w = list(base)
    for _ in range(edits):
        k = draw.randrange(len(w)) if w else 0
        kind = draw.randrange(3)
        w[k : k + (kind < 2)] = [] if kind == 0 and len(w) > 1 else [draw.randrange(100, 999)]
    return w


def replaced(base, edits, draw):
    w = list(base)
    for k in draw.sample(range(len(w)), edits):
        w[k] = f"n{draw.randrange(10**6)}"
    return w


def test_one_edit_anywhere_in_a_short_text_is_found(spark):
    rows, wanted = [], {}
    for n in range(5, 10):
        for k in range(n):
            base = [f"s{n}x{k}x{i}" for i in range(n)]
            for edited in (base, [*base[:k], "new", *base[k + 1 :]], base[:k] + base[k + 1 :]):
                wanted[len(rows)] = 3 * (len(rows) // 3)
                rows.append((len(rows), " ".join(edited)))
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # a text of four words is one edit from its base of five
    assert got == wanted


@pytest.mark.parametrize("n", [5, 8, 10, 12, 15, 20, 30, 50, 99, 100, 101, 110, 125, 126, 150, 300])
def test_pairs_at_the_similarity_share_a_key(n):
    draw = random.Random(n)
    pairs = []
    for _ in range(300):
        base = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        pairs += [" ".join(base).encode(), " ".join(replaced(base, n // 5, draw)).encode()]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pairs])])
    _, key = nd.keys(nd.words_of(np.frombuffer(b"".join(pairs), np.uint8), offsets))
    met = ((key[::2] == key[1::2]) & (key[::2] != 0)).any(1)
    assert met.mean() >= (1 if n <= nd.ONE_EDIT else 0.98)


def test_bags_bound_texts_that_lose_words_at_one_end_and_gain_them_at_the_other():
    """Words only in one text are edits of their own, so the larger of both sums counts, not their mean."""
    one, other = (np.bincount(range(a, b), minlength=nd.BAG).astype(np.int16) for a, b in ((0, 100), (25, 110)))
    assert nd._apart(one[None], other[None]).tolist() == nd._apart(other[None], one).tolist() == [25_000]


def test_batches_for_python_are_bounded_in_bytes(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.createDataFrame([(i, f"{i} " * 4000) for i in range(2)], "doc_id long, text string")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "67108864")
        nd.near_duplicates(docs)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(4 << 20)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "100000b")
        nd.near_duplicates(docs)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "100000b"
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)


def test_a_bit_map_of_many_partitions_is_one_job(spark):
    from propensity.llm.bitmaps import bit_map, probed

    seen = spark.sparkContext.statusTracker()
    group = "bits-of-many-partitions"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.sparkContext.setJobGroup(group, group)
        hashes = np.arange(2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bits = bit_map(spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h long"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(probed(bits, hashes)) == 2000 and len(seen.getJobIdsForGroup(group)) <= 2
