from __future__ import annotations

import re

import oracle
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from propensity.llm.decontaminate import decontaminate
from propensity.llm.near_duplicates import near_duplicates
from propensity.llm.queries import ORACLES, QUERIES
from propensity.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert oracle.difference(QUERIES[name](spark, SF), oracle.connect(SF), ORACLES[name]) is None


def test_thirteen_operators_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = [docs]
    for _, stage in pipeline.STAGES[:-1]:
        kept.append(materialize(stage(spark, kept[-1], SF)))
        assert kept[-1].columns == columns
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert [len(i) for i in ids] == [k.count() for k in kept] and all(b <= a for a, b in zip(ids, ids[1:]))
    good = {i for i, q in labels.items() if q == 1}
    assert len(good & ids[1]) >= 0.97 * len(good) and len(ids[1]) < len(ids[0])
    classes = near_duplicates(kept[1]).collect()
    assert {c.class_id for c in classes} == ids[2]
    hit = {r.doc_id for r in decontaminate(kept[2], spark.read.parquet(f"{SF}/benchmark.parquet")).where("n_hit > 0").collect()}
    assert ids[3] == ids[2] - hit and ids[4] == ids[3]
    before, after = ({r.doc_id: r for r in k.collect()} for k in kept[3:])
    for i, r in after.items():
        assert not re.search("[0-9a-f]{16,}", r.text) and r.n_chars == len(r.text)
        assert r.text == before[i].text or "[REDACTED]" in r.text
    packed = pipeline.packing(spark, kept[4], SF)
    assert {r.doc_id for r in packed.collect()} == ids[4]


def test_nulls_repeats_and_empty_input(spark):
    rows = [(1, "a fine text of words", "en", None, 20), (1, "a fine text of words", "en", "s", 20), (None, None, None, None, None), (2, "other words stand here", None, "s", 22)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for data, left in ((docs, 3), (docs.limit(0), 0)):
        out = data
        for _, stage in pipeline.STAGES[1:-1]:
            out = materialize(stage(spark, out, SF))
        assert out.count() == left
        assert pipeline.packing(spark, out, SF).count() == left
    assert pipeline.quality(spark, docs, SF).columns == docs.columns


def test_extra_columns_keep_their_values(spark):
    names = ["spans", "clean", "keep", "tails", "expected_grade", "row_number", "whole", "a.b"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    more = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, more, SF)
        assert out.columns == more.columns, name
        assert all(r[n] == f"{n} {r.doc_id}" for r in out.collect() for n in names), name


def test_the_secrets_stage_has_one_python_node(spark):
    docs = spark.createDataFrame([(1, "password=abcdefghijkl1234", 25)], "doc_id long, text string, n_chars long")
    out = pipeline.secrets(spark, docs, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    assert out.collect() == [(1, "[REDACTED]", 10)]
