"""Credibility classifier: train, score, evaluate."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from pressgauge.operators.joins import lookup

SCORING_BATCH = 20


def train(
    docs: DataFrame,
    *,
    tokens: str = "tokens",
    label: str = "label",
    vector: str | None = None,
    buckets: int = 1 << 12,
    iterations: int = 20,
) -> PipelineModel:
    """Logistic regression over hashed term counts and, if given, a document vector column.

    The optimiser passes over ``docs`` once per iteration: hand in a stored table.
    """
    stages = [HashingTF(inputCol=tokens, outputCol="_terms", numFeatures=buckets)]
    features = "_terms"
    frame = docs
    if vector is not None:
        frame = with_vector(docs, vector)
        stages.append(VectorAssembler(inputCols=["_terms", "_vector"], outputCol="_features"))
        features = "_features"
    stages.append(LogisticRegression(featuresCol=features, labelCol=label, maxIter=iterations, regParam=0.01))
    return Pipeline(stages=stages).fit(frame)


def with_vector(docs: DataFrame, vector: str) -> DataFrame:
    """Documents with the ML vector the pipeline reads."""
    return docs.withColumn("_vector", array_to_vector(F.col(vector).cast("array<double>")))


def verdict(prediction: Column) -> Column:
    """Class 1 is ``Fake``, class 0 ``True``."""
    return F.when(prediction == 1, F.lit("Fake")).otherwise(F.lit("True"))


def predict(model: PipelineModel, docs: DataFrame, keep: Sequence[str], vector: str | None = None) -> DataFrame:
    """Kept columns, ``prediction``, ``probability`` of class 1 and ``label_text``; also for streams."""
    frame = docs if vector is None else with_vector(docs, vector)
    scored = model.transform(frame)
    return scored.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        F.get(vector_to_array("probability"), F.lit(1)).alias("probability"),
        verdict(F.col("prediction")).alias("label_text"),
    )


def predict_linear(
    terms: DataFrame, weights: DataFrame, ids: Sequence[str], *, intercept: float = 0.0, docs: DataFrame | None = None, small: bool | None = None
) -> DataFrame:
    """Verdicts of a linear model given as a table ``weights(token, weight)`` over ``terms`` (ids, ``token``, ``n``).

    Kept are the ids, ``prediction``, ``probability`` and ``label_text`` as of :func:`predict`. Documents of
    ``docs`` without any known term get the intercept. Weights are added as decimals, so the sum does not depend on
    the order of rows.
    """
    known = lookup(terms, weights.select("token", "weight"), "token", small=small, salt=F.xxhash64(*ids))
    part = (F.col("weight").cast("decimal(18,9)") * F.col("n").cast("decimal(12,0)")).cast("decimal(38,9)")
    sums = known.groupBy(*ids).agg(F.sum(part).alias("_z"))
    rows = sums if docs is None else docs.select(*ids).join(sums, list(ids), "left")
    p = 1 / (1 + F.exp(-(F.coalesce(F.col("_z").cast("double"), F.lit(0.0)) + F.lit(float(intercept)))))
    scored = rows.select(*ids, p.alias("probability")).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    return scored.select(*ids, "prediction", "probability", verdict(F.col("prediction")).alias("label_text"))


def predict_external(
    docs: DataFrame,
    load_model: Callable[[], Callable[[np.ndarray], np.ndarray]],
    features: str,
    *,
    batch: int = SCORING_BATCH,
    out: str = "prediction",
) -> DataFrame:
    """Predictions of a user's own model on an array column; loaded once per worker, fed in batches."""

    @F.pandas_udf("int")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for values in series:
            parts = [
                np.asarray(model(np.stack(values.iloc[i:i + batch].to_numpy()))).astype("int32")
                for i in range(0, len(values), batch)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0, dtype="int32"))

    return docs.withColumn(out, run(F.col(features)))


def accuracy_and_loss(scored: DataFrame, label: str, prediction: Column, probability: Column, clamp: float = 1e-15) -> DataFrame:
    """One row: documents, correct ones, accuracy, mean cross-entropy."""
    p = F.greatest(F.least(probability, F.lit(1 - clamp)), F.lit(clamp))
    y = F.col(label)
    right = (prediction == y).cast("int")
    return scored.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(right).alias("n_correct"),
        F.avg(right.cast("double")).alias("accuracy"),
        (-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("loss"),
    )


def evaluate(scored: DataFrame, label: str = "label", metric: str = "f1") -> float:
    """A Spark ML metric of scored documents."""
    frame = scored.select(F.col(label).cast("double").alias(label), F.col("prediction").cast("double").alias("prediction"))
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric).evaluate(frame)
