from __future__ import annotations

import re

from propensity.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            v = words(item_text)
            size = min(10, len(v))
            for p in range(len(v) - size + 1 if v else 0):
                for q in range(len(w) - size + 1):
                    if w[q : q + size] == v[p : p + size]:
                        hit |= set(range(q, q + size))
                        found |= {str(item)} if item is not None else set()
        out.append((doc_id, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=repr)


def test_windows_short_items_nulls_repeats_and_foreign_columns(spark):
    long = " ".join(f"w{i}" for i in range(14))
    items = [(1, long), (2, "Öl, und Wasser"), (10, "a a a a a a a a a a a"), (3, ""), (4, None), (None, "xx yy zz qq"), (5, long)]
    docs = [
        (1, f"intro {long} outro"),
        (2, "ÖL und wasser! Öl UND WASSER"),  # only A-Z are folded
        (2, "öl"),
        (3, "A a-a a a a a a a a a a a"),
        (4, " ".join(f"w{i}" for i in range(9))),
        (5, None),
        (None, "XX yy; zz\nqq"),
        (6, ""),
        (7, "𝒳y 𐐷 " + "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 " * 3),
        (7, "𝒳y 𐐷 " + "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 " * 3),
        (8, "tail " * 5000 + long),
    ]
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, items string, uid int")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, phrase string")
    got = [(r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in decontaminate(d, b).collect()]
    assert sorted(got, key=repr) == brute(docs, items)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate(d, b).collect()] == [0]
    assert decontaminate(d.limit(0), d.select("doc_id", "text"), item_id="doc_id").count() == 0
