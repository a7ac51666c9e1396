"""Features, labels and the decision-tree pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CATEGORIES = 4


def assemble(df: DataFrame, inputs: Sequence[str], keep_invalid: bool = False) -> DataFrame:
    """Number columns as one vector ``features``. A null in them is an error unless kept as NaN."""
    handling = "keep" if keep_invalid else "error"
    return VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid=handling).transform(df)


def tree_pipeline(
    train: DataFrame, label: str = "label", unseen: str = "error", **tree_options
) -> PipelineModel:
    """Label index, category detection, decision tree and label text, fitted on ``train``.

    ``unseen`` says what a category outside the training rows does: ``error``,
    ``keep`` or ``skip``.
    """
    # Three fits read the rows; those that do not fit into memory stay on disk.
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    labels = StringIndexer(inputCol=label, outputCol="indexed_label", handleInvalid=unseen).fit(train)
    categories = VectorIndexer(
        inputCol="features", outputCol="indexed_features", maxCategories=MAX_CATEGORIES, handleInvalid=unseen
    )
    tree = DecisionTreeClassifier(labelCol="indexed_label", featuresCol="indexed_features", **tree_options)
    names = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels.labels)
    model = Pipeline(stages=[labels, categories, tree, names]).fit(train)
    train.unpersist()
    return model


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with ``predicted_label`` and the columns behind it."""
    return model.transform(df)


def scores(predicted: DataFrame) -> dict[str, float]:
    """Weighted F1, which is the evaluator's default, and accuracy, each by its name.

    The predictions are counted once; the evaluator weighs the counts.
    """
    counts = predicted.groupBy("indexed_label", "prediction").agg(F.count("*").cast("double").alias("n"))
    counts = counts.persist()
    evaluator = MulticlassClassificationEvaluator(
        labelCol="indexed_label", predictionCol="prediction", weightCol="n"
    )
    found = {name: evaluator.evaluate(counts, {evaluator.metricName: name}) for name in ("f1", "accuracy")}
    counts.unpersist()
    return found


def tree_text(model: PipelineModel) -> str:
    """The learned tree as text."""
    return model.stages[-2].toDebugString
