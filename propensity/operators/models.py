"""Candidate models as Spark ML pipelines: fit, predict, compare."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.operators import boosting, trees
from propensity.operators.features import VECTOR, fit_preparation, learn, training_rows
from propensity.operators.metrics import capacity_table, check_scored, probability_metrics
from propensity.session import materialize
from propensity.spec import TableSpec

LABEL = "_label"
SCORE = "score"
HOLDOUT = "_holdout"
PLACE = "_place"
ROWS_PER_TASK, LEAST_TASKS, LEAST_ROWS = 1_000_000, 8, 20_000
# Every step of a linear model reads whole vectors of doubles again.
VECTORS_PER_TASK = 100_000
# Candidates fitted side by side, and the training rows up to which that is done.
AT_ONCE, ROWS_AT_ONCE = 6, 2_000_000


@dataclass(frozen=True)
class Candidate:
    """A model family: which preparation it takes and how its estimator is set."""

    name: str
    preparation: str
    settings: dict

    def estimator(self, rows: int) -> Estimator | None:
        options = dict(self.settings)
        kind = options.pop("kind")
        common = {"featuresCol": VECTOR, "labelCol": LABEL}
        if kind != "logistic":
            return None
        # L2 strength C on the summed loss equals 1 / (C * rows) on Spark's averaged loss.
        strength = 1.0 / (options.pop("C") * rows)
        return LogisticRegression(regParam=strength, elasticNetParam=0.0, standardization=False, **common, **options)

    def tree_settings(self) -> trees.Settings:
        """Settings of forests and boosted trees, under Spark ML's names in ``settings``."""
        s = self.settings
        forest = s["kind"] == "forest"
        return trees.Settings(
            trees=s["numTrees"] if forest else s["maxIter"],
            depth=s["maxDepth"],
            least=s.get("minInstancesPerNode", 1),
            share=float(s.get("featureSubsetStrategy", 1)),
            rate=None if forest and s.get("bootstrap", True) else s.get("subsamplingRate", 1.0),
            step=s.get("stepSize", 0.1),
            seed=s["seed"],
        )


def candidates(seed: int = 42, forest_depth: int = 12, bins: int = 255) -> list[Candidate]:
    """Settings of the nine candidates, in order of preference on equal precision.

    Depth is unbounded in single-machine forests; ``forest_depth`` bounds the nodes of a tree.
    ``bins`` split candidates per number, as many as the histogram learners take.
    """
    common = {"seed": seed, "maxBins": bins}
    boosted = {"kind": "boosted", **common}
    forest = {"kind": "forest", "numTrees": 300, "minInstancesPerNode": 20, "featureSubsetStrategy": "0.8", **common}
    forest["maxDepth"] = forest_depth
    return [
        Candidate("dummy_prior", "linear", {"kind": "prior"}),
        Candidate("logistic_regression", "linear", {"kind": "logistic", "C": 0.5, "maxIter": 1000}),
        Candidate("spline_logistic_regression", "spline", {"kind": "logistic", "C": 0.5, "maxIter": 1000}),
        Candidate("randomized_forest", "linear", {**forest, "bootstrap": False}),
        Candidate("random_forest", "tree", forest),
        Candidate(
            "gradient_boosting",
            "tree",
            {**boosted, "maxIter": 150, "maxDepth": 2, "stepSize": 0.04, "minInstancesPerNode": 40, "subsamplingRate": 0.8},
        ),
        Candidate(
            "hist_gradient_boosting",
            "tree",
            {"kind": "histogram", "maxIter": 180, "learning_rate": 0.06, "max_leaf_nodes": 15, "min_samples_leaf": 40, "l2": 1.0, "early_stop": True},
        ),
        Candidate("gbt_categorical_depth_4", "native", {**boosted, "maxIter": 300, "maxDepth": 4, "stepSize": 0.04}),
        Candidate(
            "gbt_onehot_depth_4",
            "linear",
            {
                **boosted,
                "maxIter": 300,
                "maxDepth": 4,
                "stepSize": 0.04,
                "minInstancesPerNode": 20,
                "subsamplingRate": 0.8,
                "featureSubsetStrategy": "0.8",
            },
        ),
    ]


def candidate(name: str, seed: int = 42, **changes) -> Candidate:
    """One candidate by name, with some settings changed."""
    found = next(c for c in candidates(seed) if c.name == name)
    return Candidate(found.name, found.preparation, {**found.settings, **changes})


def fit(train: DataFrame, spec: TableSpec, model: Candidate, preparation: PipelineModel | None = None) -> PipelineModel:
    """Fit preparation and estimator on the training rows; the result maps a clean frame to ``score``."""
    labels = train.agg(F.count("*").alias("n"), F.avg(F.col(spec.target).cast("double")).alias("rate")).first()
    if model.settings["kind"] == "prior":
        return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST('{labels['rate']!r}' AS DOUBLE) AS {SCORE} FROM __THIS__")])
    preparation = preparation or fit_preparation(train, spec, model.preparation)
    holdout = F.pmod(F.xxhash64(F.col(spec.id).cast("string")), F.lit(100)) < 15
    marked = train.withColumns({LABEL: F.col(spec.target).cast("double"), HOLDOUT: holdout, PLACE: F.col(spec.id).cast("string")})
    estimator = model.estimator(labels["n"])
    # Trees draw rows by partition: a row's partition and place follow from its id and the number of rows alone. Rows are placed before their
    # numbers become a vector, of which a spline preparation makes several times their bytes.
    parts = partitions_for(labels["n"], VECTORS_PER_TASK if model.settings["kind"] == "logistic" else ROWS_PER_TASK)
    placed = lambda rows: placed_by_id(rows, parts)
    prepared = training_rows(preparation, marked, spec.id, spec.target, placed).select(VECTOR, LABEL, HOLDOUT)
    prepared.persist()  # read by every pass; a lost block is recomputed
    try:
        if model.settings["kind"] == "histogram":
            options = {k: x for k, x in model.settings.items() if k != "kind"}
            settings = boosting.Settings(max_iter=options.pop("maxIter"), **options)
            fitted = boosting.fit_histogram_boosting(prepared, VECTOR, LABEL, HOLDOUT, settings)
        elif (kind := model.settings["kind"]) in ("forest", "boosted"):
            learner = trees.fit_forest if kind == "forest" else trees.fit_boosting
            fitted = learner(prepared, VECTOR, LABEL, labels["n"], model.settings["maxBins"], model.tree_settings())
        else:
            fitted = estimator.fit(prepared)
    finally:
        prepared.unpersist()
    return PipelineModel([*preparation.stages, fitted])


def placed_by_id(prepared: DataFrame, parts: int) -> DataFrame:
    """The rows in partitions that depend on their ids and number only, so a model does not depend on the cluster."""
    slot = F.pmod(F.xxhash64(PLACE), F.lit(parts)).cast("int")
    # one range for each slot number: the bounds are the numbers themselves, not a sample of the rows
    return prepared.repartitionById(parts, slot).sortWithinPartitions(PLACE).drop(PLACE)


def partitions_for(rows: int, most: int = ROWS_PER_TASK) -> int:
    """Every tree level passes over all partitions, so they hold up to ``most`` rows; at least ``LEAST_TASKS`` work on a large table."""
    return max(1, min(LEAST_TASKS, -(-rows // LEAST_ROWS)), -(-rows // most))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The frame's own columns plus ``score``, the probability of target 1."""
    scored = model.transform(df)
    if SCORE not in scored.columns:
        scored = scored.withColumn(SCORE, vector_to_array("probability")[1])
    return scored.select(*df.columns, SCORE)


def compare(
    train: DataFrame,
    validation: DataFrame,
    spec: TableSpec,
    models: Iterable[Candidate],
    fraction: float = 0.1,
) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """Fit every candidate and measure all of them on the validation rows.

    Returns the fitted models, the comparison (one row a model) and the long scored frame
    (model, id, label, score) from which all metrics are taken together. Preparations, and what they learn from single columns, are shared.
    """
    preparations: dict[str, PipelineModel] = {}
    learned = None
    models = list(models)
    for model in models:
        if model.settings["kind"] != "prior" and model.preparation not in preparations:
            learned = learned or learn(train, spec)
            preparations[model.preparation] = fit_preparation(train, spec, model.preparation, learned)
    # boosting is a chain of small steps that leaves most cores idle, so other models are fitted beside it while tables are small
    at_once = AT_ONCE if len(models) > 1 and train.count() <= ROWS_AT_ONCE else 1
    with ThreadPoolExecutor(at_once) as pool:
        chains_first = sorted(models, key=lambda m: m.settings["kind"] not in ("boosted", "histogram"))
        running = {m.name: pool.submit(fit, train, spec, m, preparations.get(m.preparation)) for m in chains_first}
        fitted = {m.name: running[m.name].result() for m in models}
    scored = [_scored(predict(fitted[m.name], validation), spec, m.name) for m in models]
    long = materialize(reduce(DataFrame.unionByName, scored))
    return fitted, comparison(long, [m.name for m in models], fraction), long


def _scored(predicted: DataFrame, spec: TableSpec, name: str) -> DataFrame:
    return predicted.select(
        F.lit(name).alias("model"),
        F.col(spec.id).cast("string").alias("id"),
        F.col(spec.target).cast("int").alias("label"),
        F.col(SCORE).alias("score"),
    )


def comparison(scored: DataFrame, names: list[str], fraction: float = 0.1) -> DataFrame:
    """One row a model: the probability metrics and precision, recall and lift at capacity."""
    check_scored(scored, ["model"])
    whole = probability_metrics(scored, by=["model"])
    top = capacity_table(scored, [fraction], by=["model"]).drop("level", "fraction", "k")
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("model")).alias("position")
    return whole.join(top, "model").select("model", position, *whole.columns[1:], *top.columns[1:])
