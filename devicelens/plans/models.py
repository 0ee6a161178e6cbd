"""Defect classifiers on feature columns: fitting, scoring, evaluation, importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devicelens.operators.profile import binary_metrics

# Size and seed of the forest.
TREES, SEED = 100, 42


def _fit(df: DataFrame, classifier, label: str, columns: Sequence[str]) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")
    # The fit reads its input several times (classes, split points, rows).
    data = df.select(*columns, F.col(label).cast("double").alias(label)).persist()
    try:
        return Pipeline(stages=[assembler, classifier.setLabelCol(label)]).fit(data)
    finally:
        data.unpersist()


def train_rf(df: DataFrame, label: str, columns: Sequence[str], trees: int = TREES, seed: int = SEED, max_depth: int = 5) -> PipelineModel:
    """Random forest; all trees grow together, level by level, in passes over the data."""
    return _fit(df, RandomForestClassifier(numTrees=trees, seed=seed, maxDepth=max_depth), label, columns)


def train_lr(df: DataFrame, label: str, columns: Sequence[str], ridge: float = 1e-4, max_iter: int = 100) -> PipelineModel:
    return _fit(df, LogisticRegression(regParam=ridge, maxIter=max_iter), label, columns)


def train_perceptron(df: DataFrame, label: str, columns: Sequence[str], hidden: Sequence[int] = (64, 32), seed: int = SEED) -> PipelineModel:
    """The built-in network (sigmoid units, full-batch solver); see :mod:`devicelens.plans.mlp` for the other."""
    layers = [len(columns), *hidden, 2]
    return _fit(df, MultilayerPerceptronClassifier(layers=layers, seed=seed), label, columns)


def score(df: DataFrame, model: PipelineModel, out: str = "predictions") -> DataFrame:
    """All columns of the frame and the predicted class."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("prediction").alias(out))


def evaluate(model: PipelineModel, test: DataFrame, label: str) -> DataFrame:
    """Recall, F1, precision and predicted positives on held-out rows, one row."""
    return binary_metrics(score(test, model, "_p").select("_p", label), "_p", label)


def importances(spark: SparkSession, model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    """Importance per feature, the largest first. One row per feature of the model."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(columns, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")
