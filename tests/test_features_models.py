from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from propensity.leads import LEADS
from propensity.operators import features, models
from propensity.operators.clean import prepare
from propensity.operators.vocabulary import TableEncoder, TargetEncoder, vocabulary_table
from propensity.sources.reports import ModelBundle
from propensity.spec import TableSpec

SMALL = {"numTrees": 5, "maxDepth": 4}, {"maxIter": 5}


def quick(name):
    tree, boost = SMALL
    changes = tree if "forest" in name else boost if "boosting" in name or "gbt" in name else {}
    return models.candidate(name, **changes)


@pytest.fixture(scope="module")
def parts(raw_frame):
    clean = prepare(raw_frame, LEADS).frame
    number = F.col("source_row_number")
    held_out = clean.where(number > 45).withColumns(
        {
            "channel": F.when(number == 46, "brand_new_channel").otherwise(F.col("channel")),
            "city": F.when(number != 47, F.col("city")),
            "price": F.when(number != 48, F.col("price")),
        }
    )
    return clean.where(number <= 45).cache(), held_out.cache()


@pytest.mark.parametrize("name", [c.name for c in models.candidates()])
def test_unseen_and_missing_values_still_score(spark, parts, name, tmp_path):
    train, held_out = parts
    fitted = models.fit(train, LEADS, quick(name))
    scores = {r["lead_id"]: r["score"] for r in models.predict(fitted, held_out).select("lead_id", "score").collect()}
    assert len(scores) == 15
    assert all(np.isfinite(s) and 0 <= s <= 1 for s in scores.values())
    bundle = ModelBundle(fitted, "v1", LEADS.features, "hash", 0.2, 0.1)
    bundle.save(spark, str(tmp_path))
    loaded = ModelBundle.load(spark, str(tmp_path))
    assert (loaded.model_features, loaded.operating_threshold) == (LEADS.features, 0.2)
    again = {r["lead_id"]: r["score"] for r in models.predict(loaded.model, held_out).collect()}
    assert again == pytest.approx(scores, abs=1e-12)


def test_candidate_list():
    names = [c.name for c in models.candidates(1)]
    assert len(names) == len(set(names)) == 9 and names[0] == "dummy_prior"


def frame_of(spark, rows=400, seed=3):
    rng = np.random.default_rng(seed)
    x, z = rng.normal(size=rows), rng.normal(size=rows)
    group = np.where(rng.random(rows) < 0.05, "rare", np.where(rng.random(rows) < 0.5, "a", "b"))
    y = (rng.random(rows) < 1 / (1 + np.exp(-(x - 0.5 * z + (group == "a"))))).astype(int)
    data = [
        (i, None if i % 17 == 0 else float(a), float(b), str(g), int(t))
        for i, (a, b, g, t) in enumerate(zip(x, z, group, y))
    ]
    return spark.createDataFrame(data, "id long, x double, z double, g string, y int")


G_SPEC = TableSpec(id="id", time="", target="", numeric=(), categorical=("g",), derive_time_parts=False)
SPEC = TableSpec(id="id", time="", target="y", numeric=("x", "z"), categorical=("g",), derive_time_parts=False)


def test_logistic_regression_solves_the_penalised_problem(spark):
    frame = frame_of(spark)
    fitted = models.fit(frame, SPEC, models.candidate("logistic_regression"))
    data = fitted.transform(frame).select("features", "y", "probability").collect()
    X, y = np.array([r["features"].toArray() for r in data]), np.array([r["y"] for r in data], float)
    design = np.column_stack([np.ones(len(y)), X])
    penalty = np.diag([0.0] + [1.0] * X.shape[1])  # C = 0.5: loss sum * 0.5 + w'w / 2
    beta = np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = 0.5 * design.T @ (p - y) + penalty @ beta
        hessian = 0.5 * design.T @ (design * (p * (1 - p))[:, None]) + penalty
        beta -= np.linalg.solve(hessian, gradient)
    wanted = 1 / (1 + np.exp(-design @ beta))
    np.testing.assert_allclose([r["probability"][1] for r in data], wanted, atol=1e-4)


def test_linear_preparation(spark):
    frame = frame_of(spark)
    prepared = features.fit_preparation(frame, SPEC, "linear").transform(frame).orderBy("id").collect()
    X, pdf = np.array([r["features"].toArray() for r in prepared]), frame.orderBy("id").toPandas()
    x, mark = pdf["x"].fillna(pdf["x"].median()), pdf["x"].isna().astype(float)
    for j, column in enumerate((x, pdf["z"], mark)):
        np.testing.assert_allclose(X[:, j], (column - column.mean()) / column.std(ddof=0), atol=1e-9)
    assert X.shape[1] == 3 + 3  # a, b and either the pooled or the own column of the rare value
    np.testing.assert_array_equal(X[:, 3], pdf["g"] == "a")
    np.testing.assert_array_equal(X[:, 4], pdf["g"] == "b")


@pytest.mark.parametrize("rare", [19, 20])
def test_infrequent_categories_are_pooled(spark, rare):
    values = ["a"] * 30 + ["b"] * 25 + ["c"] * rare
    frame = spark.createDataFrame([(i, g) for i, g in enumerate(values)], "id long, g string")
    out = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "new"), (4, None)], "id long, g string")
    got = {r["id"]: r["features"].toArray().tolist() for r in features.fit_preparation(frame, G_SPEC, "linear").transform(out).collect()}
    other = [0.0, 0.0, 1.0] if rare < 20 else [0.0, 0.0, 0.0]
    assert got == {0: [1, 0, 0], 1: [0, 1, 0], 2: [0, 0, 1], 3: other, 4: [1, 0, 0]}


def test_unseen_value_is_all_zero_without_a_pool(spark):
    frame = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(60)], "id long, g string")
    out = spark.createDataFrame([(0, "zzz")], "id long, g string")
    assert features.fit_preparation(frame, G_SPEC, "linear").transform(out).first()["features"].toArray().tolist() == [0.0, 0.0]


@pytest.mark.parametrize("most", [8 << 20, 0])
def test_encoding_by_broadcast_and_by_shuffle_agree(spark, most, tmp_path):
    values = [None] * 40 + ["hot"] * 300 + ["", "\u00001", "b", "b"] + [f"v{i:03d}" for i in range(200)]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "id long, `g x` string").withColumnRenamed("g x", "g")
    counts = features.filled_counts(features.category_counts(frame, ["g"]), {"g": "hot"})
    stage = TableEncoder.of(vocabulary_table(counts), ["g"], {"g": "hot"}, most)
    words = sorted({x for x in values if x is not None})
    assert stage.facts["g"]["size"] == len(words)
    PipelineModel([stage]).save(f"{tmp_path}/m")
    asked = frame.union(spark.createDataFrame([(9000, "new")], "id long, g string"))
    for s in (stage, PipelineModel.load(f"{tmp_path}/m").stages[0]):
        got = {r.id: r.i_g for r in s.transform(asked).collect()}
        assert got == {i: float(words.index("hot" if x is None else x)) for i, x in enumerate(values)} | {9000: float(len(words))}


def test_sparse_vectors_equal_the_named_ones(spark, monkeypatch, tmp_path):
    frame = frame_of(spark)
    named = features.fit_preparation(frame, SPEC, "linear").transform(frame)
    monkeypatch.setattr(features, "ONE_HOT_WIDTH", 0)
    fitted = models.fit(frame, SPEC, models.candidate("logistic_regression"))
    sparse = fitted.transform(frame)
    one, two = ({r.id: r.features.toArray().tolist() for r in f.select("id", "features").collect()} for f in (named, sparse))
    assert one == two
    ModelBundle(fitted, "v1", ("x",), "hash", 0.2, 0.1).save(spark, str(tmp_path))
    loaded = ModelBundle.load(spark, str(tmp_path)).model
    scores = [{r.id: r.score for r in models.predict(m, frame).collect()} for m in (fitted, loaded)]
    assert scores[0] == scores[1] and len(scores[0]) == 400


def test_two_million_categories(spark):
    """No list of categories in the driver, no name for each place of the vector."""
    frame = spark.range(2_000_000, numPartitions=8).select(
        "id", F.concat(F.lit("c"), F.col("id").cast("string")).alias("g"), (F.col("id") % 2).cast("int").alias("y")
    )
    spec = TableSpec(id="id", time="", target="y", numeric=(), categorical=("g",), derive_time_parts=False)
    learned = features.learn(frame, spec)
    stages, widths = features.one_hot_stages(frame, ["g"], learned, min_frequency=1)
    assert widths == {"i_g": 2_000_000}
    few = frame.where("id % 400000 = 7").union(spark.createDataFrame([(-1, "unseen", 0)], "id long, g string, y int"))
    out = PipelineModel([*stages, *features.assembled(frame, stages, [], widths)]).transform(few)
    places = {r.id: (r.features.size, r.features.indices.tolist()) for r in out.collect()}
    order = np.argsort(np.array([f"c{i}" for i in range(2_000_000)]), kind="stable")
    place = np.empty(2_000_000, np.int64)
    place[order] = np.arange(2_000_000)
    assert places == {i: (2_000_000, [int(place[i])]) for i in range(7, 2_000_000, 400_000)} | {-1: (2_000_000, [])}


def cox_de_boor(x, knots, degree, i):
    if degree == 0:
        return float(knots[i] <= x < knots[i + 1])
    left = (x - knots[i]) / (knots[i + degree] - knots[i]) * cox_de_boor(x, knots, degree - 1, i)
    right = (knots[i + degree + 1] - x) / (knots[i + degree + 1] - knots[i + 1])
    return left + right * cox_de_boor(x, knots, degree - 1, i + 1)


def test_spline_basis(spark):
    low, high, step = 2.0, 11.0, 3.0
    knots = [low + step * k for k in range(-3, 7)]
    points = [2.0, 2.5, 4.9, 5.0, 7.3, 10.999]
    frame = spark.createDataFrame([(p,) for p in [*points, 11.0, -50.0, 99.0]], "x double")
    rows = {r["x"]: [r[f"x_b{j}"] for j in range(5)] for r in features.spline_columns(frame, "x", low, high).collect()}
    for p in points:
        np.testing.assert_allclose(rows[p], [cox_de_boor(p, knots, 3, j) for j in range(5)], atol=1e-12)
    assert rows[-50.0] == rows[2.0] and rows[99.0] == rows[11.0]
    np.testing.assert_allclose(rows[11.0], [0, 0, 0, 1 / 6, 4 / 6], atol=1e-12)


def test_modes_prefer_the_smallest_on_a_tie(spark):
    frame = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "g string, h string")
    assert features.modes(frame, ["g", "h"]) == {"g": "a", "h": None}


def test_column_without_any_value_is_left_out(spark):
    frame = frame_of(spark, 80).withColumn("x", F.lit(None).cast("double"))
    fitted = models.fit(frame, SPEC, models.candidate("logistic_regression"))
    assert models.predict(fitted, frame).where("score is null").count() == 0


def test_seeded_fits_repeat(spark):
    frame = frame_of(spark).cache()
    model = models.candidate("random_forest", numTrees=5, maxDepth=4)
    one, two = (models.predict(models.fit(frame, SPEC, model), frame).orderBy("id").collect() for _ in range(2))
    assert one == two


def test_learners_beat_the_prior(spark):
    frame = frame_of(spark, 800)
    chosen = [quick(n) for n in ("dummy_prior", "logistic_regression", "spline_logistic_regression", "gradient_boosting")]
    _, comparison, _ = models.compare(frame, frame, SPEC, chosen)
    rows = {r["model"]: r for r in comparison.collect()}
    assert [rows[c.name]["position"] for c in chosen] == [1, 2, 3, 4]
    for name in ("logistic_regression", "spline_logistic_regression", "gradient_boosting"):
        assert rows[name]["log_loss"] < rows["dummy_prior"]["log_loss"]
        assert rows[name]["roc_auc"] > 0.6
    assert rows["dummy_prior"]["roc_auc"] == 0.5


def test_early_stopped_boosting_keeps_its_rounds(spark):
    frame = frame_of(spark, 600)
    fitted = models.fit(frame, SPEC, models.candidate("hist_gradient_boosting", maxIter=25))
    assert 10 <= fitted.stages[-1].getNumTrees <= 25
    assert models.predict(fitted, frame).select("score").distinct().count() > 12


def test_models_do_not_depend_on_partitions(spark):
    frame = frame_of(spark, 500).cache()
    model = models.candidate("gradient_boosting", maxIter=6)
    one, two = (models.predict(models.fit(f, SPEC, model), frame).orderBy("id").collect() for f in (frame.repartition(2), frame.repartition(7)))
    assert one == two


def test_partitions_of_a_sensible_size():
    assert [models.partitions_for(n) for n in (0, 1, 20_000, 20_001, 10**6, 10**8, 10**11)] == [1, 1, 1, 2, 8, 100, 100_000]


def test_ordered_target_means_do_not_see_their_own_row(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, None if x < 0.1 else "hot" if x < 0.6 else f"v{int(x * 40)}", int(y < 0.3)) for i, (x, y) in enumerate(rng.random((400, 2)))]
    frame = spark.createDataFrame(rows, "id long, g string, y int").repartition(5)
    stage = TargetEncoder.fitted(frame, ["g"], {"g": "missing"}, "y", seed=9)
    prior = float(np.mean([r[2] for r in rows]))
    seen, wanted = {}, {}
    for i, g, y in sorted(rows, key=lambda r: hashlib.sha256(f"9:{r[0]}".encode()).hexdigest()):
        n, pos = seen.get(g, (0, 0))
        wanted[i] = (pos + prior) / (n + 1)
        seen[g] = (n + 1, pos + y)
    got = {r.id: r.t_g for r in stage.ordered(frame, "id", "y").collect()}
    assert got == pytest.approx(wanted, abs=1e-12)
    PipelineModel([stage]).save(f"{tmp_path}/m")
    later = spark.createDataFrame([(1, "hot"), (2, None), (3, "new")], "id long, g string")
    for s in (stage, PipelineModel.load(f"{tmp_path}/m").stages[0]):
        codes = {r.id: r.t_g for r in s.transform(later).collect()}
        assert codes == pytest.approx({i: (seen[g][1] + prior) / (seen[g][0] + 1) if g in seen else prior for i, g in ((1, "hot"), (2, None), (3, "new"))})


@pytest.mark.parametrize("kind", ["linear", "spline", "tree", "native"])
def test_training_rows_are_placed_before_they_widen(spark, kind):
    frame = frame_of(spark, 300)
    preparation = features.fit_preparation(frame, SPEC, kind)
    moved = []
    place = lambda rows: (moved.append(rows), models.placed_by_id(rows.withColumn(models.PLACE, F.col("id").cast("string")), 3))[1]
    rows = features.training_rows(preparation, frame, "id", "y", place).select("id", features.VECTOR)
    assert len(moved) == 1 and features.VECTOR not in moved[0].columns
    assert not [c for c in moved[0].columns if c[:2] in ("n_", "m_", "u_", "q0", "b0", "z_", "o_")]
    plain = features.training_rows(preparation, frame, "id", "y").select("id", features.VECTOR)
    assert {r.id: r.features for r in rows.collect()} == {r.id: r.features for r in plain.collect()}


def test_linear_models_read_bounded_partitions(spark, monkeypatch):
    monkeypatch.setattr(models, "VECTORS_PER_TASK", 60)
    parts = []
    placed = models.placed_by_id
    monkeypatch.setattr(models, "placed_by_id", lambda rows, n: (parts.append(n), placed(rows, n))[1])
    frame = frame_of(spark, 300)
    few = models.predict(models.fit(frame, SPEC, models.candidate("spline_logistic_regression")), frame)
    models.fit(frame, SPEC, quick("gradient_boosting"))
    assert parts == [5, 1]
    monkeypatch.setattr(models, "VECTORS_PER_TASK", 100_000)
    one = models.predict(models.fit(frame, SPEC, models.candidate("spline_logistic_regression")), frame)
    assert {r.id: r.score for r in few.collect()} == pytest.approx({r.id: r.score for r in one.collect()}, abs=1e-6)
