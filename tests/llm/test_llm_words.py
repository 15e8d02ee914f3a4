from __future__ import annotations

import pyarrow as pa

from propensity.llm import quality, words
from propensity.llm.words import slices


def test_memory_is_given_back_behind_the_last_row(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(1)

    monkeypatch.setattr(words.pa, "system_memory_pool", Pool)
    column = pa.array(["abc", None, "defg", "h"])
    parts = []
    for a, b, data, offsets in slices(column, 4):
        assert not released
        parts += [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(b - a)]
    assert parts == [b"abc", b"", b"defg", b"h"] and released == [1]


def test_documents_are_scored_in_slices_of_a_megabyte(spark, monkeypatch):
    assert quality.SLICE <= 1 << 20
    docs = spark.createDataFrame([(i, f"Word{i % 7} other, {i} " * 20) for i in range(50)], "doc_id long, text string")
    rated = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, grade int")
    model = quality.fit_quality(docs, rated, 2)
    whole = {r.doc_id: r.expected_grade for r in quality.grade_documents(docs, model).collect()}
    monkeypatch.setattr(quality, "SLICE", 300)
    assert {r.doc_id: r.expected_grade for r in quality.grade_documents(docs, model).collect()} == whole
