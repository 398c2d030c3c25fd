"""Supervised models on Spark ML: specifications, balanced weights, scoring, importances."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.operators import metrics as M
from flowsieve.operators.preparation import Preparation, fit_preparation
from flowsieve.operators.reports import top_k
from flowsieve.session import scratch_path, written
from flowsieve.sources.schema import BASE_NUMERIC, CATEGORICAL, GRAPH_NUMERIC

SEED = 42


def class_weights(df: DataFrame, label: str = "is_laundering") -> DataFrame:
    """Balanced weights n / (2 n_c): one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("classes"))
    share = totals.select(F.col("all") / F.col("classes")).scalar()
    return counts.select(label, "n", (share / F.col("n")).alias("weight"))


def weighted_like(df: DataFrame, train: DataFrame, label: str = "is_laundering", column: str = "weight") -> DataFrame:
    """``df`` plus the balanced class weights of ``train``; two numbers pass through the driver."""
    value = F.lit(1.0)
    for r in class_weights(train, label).collect():
        value = F.when(F.col(label) == F.lit(r[label]), F.lit(r["weight"])).otherwise(value)
    return df.withColumn(column, value)


def weighted(df: DataFrame, label: str = "is_laundering", column: str = "weight") -> DataFrame:
    """``df`` plus the balanced weight of its rows."""
    return weighted_like(df, df, label, column)


@dataclass(frozen=True)
class Spec:
    """A named model: ``build(rows, params)`` returns an estimator, ``numeric`` its numeric features."""

    name: str
    build: Callable
    params: dict = field(default_factory=dict)
    numeric: tuple = tuple(BASE_NUMERIC)
    categorical: tuple = tuple(CATEGORICAL)
    balanced: bool = True

    def estimator(self, rows: int, **overrides):
        return self.build(rows, {**self.params, **overrides}).setLabelCol("is_laundering").setWeightCol("weight")


def _logistic(rows, p):
    # The penalty of the summed loss with strength 1/C, per unit of weight (balanced weights sum to the rows).
    return LogisticRegression(maxIter=p.get("max_iter", 1000), regParam=1.0 / (p.get("C", 1.0) * rows), standardization=False)


def _tree(rows, p):
    return DecisionTreeClassifier(
        maxDepth=p.get("max_depth", 9), minInstancesPerNode=p.get("min_samples_leaf", 1), maxBins=64, seed=SEED
    )


def _svm(rows, p):
    return LinearSVC(maxIter=p.get("max_iter", 100), regParam=1.0 / (p.get("C", 0.5) * rows), standardization=False)


def _forest(rows, p):
    return RandomForestClassifier(
        numTrees=p.get("n_estimators", 140), maxDepth=p.get("max_depth", 16),
        minInstancesPerNode=p.get("min_samples_leaf", 5), maxBins=64, seed=SEED,
    )


#: Leaf budgets of the boosting grid stand for tree depths here; there is no L2 term to set.
LEAVES_TO_DEPTH = {15: 4, 31: 5, 63: 6}


def _boosting(rows, p):
    return GBTClassifier(
        maxIter=p.get("max_iter", 120), stepSize=p.get("learning_rate", 0.08),
        maxDepth=LEAVES_TO_DEPTH[p.get("max_leaf_nodes", 31)], maxBins=64, minInstancesPerNode=20,
        subsamplingRate=p.get("subsample", 1.0), seed=SEED,
    )


LOGISTIC = Spec("Logistic Regression", _logistic)
TREE = Spec("Decision Tree", _tree, {"max_depth": 9})
SVM = Spec("Linear SVM", _svm, {"C": 0.5})
FOREST = Spec("Random Forest Base Features", _forest)
FOREST_GRAPH = Spec("Random Forest + Graph Features", _forest, numeric=tuple(BASE_NUMERIC + GRAPH_NUMERIC))
BOOSTING = Spec("Gradient Boosting Base Features", _boosting)
BOOSTING_GRAPH = Spec("Gradient Boosting + Graph Features", _boosting, numeric=tuple(BASE_NUMERIC + GRAPH_NUMERIC))
ALL_SPECS = [LOGISTIC, TREE, SVM, FOREST_GRAPH, FOREST, BOOSTING, BOOSTING_GRAPH]


def score_vectors(model, vectors: DataFrame, column: str = "score") -> DataFrame:
    """``vectors`` without the vector, plus the class-1 probability (or the decision value without one)."""
    out = model.transform(vectors.drop(column))
    source = "probability" if "probability" in out.columns else "rawPrediction"
    keep = [c for c in vectors.columns if c not in ("features", column)]
    return out.select(*keep, vector_to_array(source)[1].alias(column))


@dataclass
class Fitted:
    spec: Spec
    preparation: Preparation
    model: object
    features: list[str]

    def score(self, df: DataFrame, column: str = "score") -> DataFrame:
        """``df`` plus its score."""
        return score_vectors(self.model, self.preparation.transform(df, self.features), column)

    def importances(self, k: int = 20) -> DataFrame:
        """The ``k`` most important encoded features of a tree model."""
        values = self.model.featureImportances.toArray()
        rows = [(n, float(v)) for n, v in zip(self.features, values, strict=True)]
        table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
        return top_k(table, "importance", k, "feature")


def without_summary(model):
    """The model saved to the shared folder and loaded again.

    A freshly fitted model keeps its training summary, which holds the session; scoring would ship both to the tasks.
    """
    path = scratch_path(SparkSession.active(), "model")
    model.write().save(path)
    return type(model).load(path)


def fit_vectors(spec: Spec, vectors: DataFrame, overrides: dict | None = None):
    """Fit on a written table of ``is_laundering``, ``weight`` and ``features``."""
    rows = vectors.count()
    if not spec.balanced:
        vectors = vectors.withColumn("weight", F.lit(1.0))
    return without_summary(spec.estimator(rows, **(overrides or {})).fit(vectors))


def fit_model(
    spec: Spec, train: DataFrame, overrides: dict | None = None, only: list[str] | None = None,
    preparation: Preparation | None = None,
) -> Fitted:
    """Fit preparation and model on ``train``; the vectors are written once, the solver re-reads them."""
    preparation = preparation or fit_preparation(train, list(spec.numeric), list(spec.categorical))
    names = only or preparation.names()
    vectors = preparation.transform(weighted(train), names).select("is_laundering", "weight", "features")
    return Fitted(spec, preparation, fit_vectors(spec, written(vectors, "vectors"), overrides), names)


def evaluate_models(specs: list[Spec], rows: DataFrame, overrides: dict[str, dict] | None = None) -> tuple[DataFrame, dict]:
    """Metrics by model and split, and the fitted models.

    ``rows`` carry ``split`` in fit / validation / test. Models are fitted on fit, the threshold is the best
    F1 on validation, and train (fit + validation), test and full are evaluated from one scored table.
    Models with the same features share one preparation and one written table of vectors.
    """
    prepared, fitted, scored = {}, {}, None
    rows = weighted_like(rows, rows.filter(F.col("split") == "fit"))
    for spec in specs:
        features = (spec.numeric, spec.categorical)
        if features not in prepared:
            preparation = fit_preparation(rows.filter(F.col("split") == "fit"), list(spec.numeric), list(spec.categorical))
            vectors = preparation.transform(rows).select("split", "is_laundering", "weight", "features")
            prepared[features] = preparation, written(vectors, "vectors")
        preparation, vectors = prepared[features]
        model = fit_vectors(spec, vectors.filter(F.col("split") == "fit"), (overrides or {}).get(spec.name))
        fitted[spec.name] = Fitted(spec, preparation, model, preparation.names())
        part = score_vectors(model, vectors).select(F.lit(spec.name).alias("model"), "split", "is_laundering", "score")
        scored = part if scored is None else scored.unionByName(part)
    scored = written(scored, "scored")
    best = M.best_f1_threshold(scored.filter(F.col("split") == "validation"), ["model"])
    thresholds = written(best.withColumnRenamed("f1", "validation_f1"), "thresholds")
    named = F.when(F.col("split") == "test", F.array(F.lit("test"), F.lit("full"))).otherwise(
        F.array(F.lit("train"), F.lit("full"))
    )
    every = scored.withColumn("split", F.explode(named))
    table = M.metrics_table(every, thresholds, ["model", "split"])
    return table.join(F.broadcast(thresholds.select("model", "validation_f1")), "model"), fitted
