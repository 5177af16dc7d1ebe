"""Scores and features of image vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import labels, texts, vectors
from scorewatch.schemas import IMAGE_FEATURES, PREDICTIONS, conform


class BatchModel(Protocol):
    """What ``batch_score_pandas`` calls: scores for one batch of inputs, vectors or file paths."""

    def predict(self, batch: pd.Series) -> np.ndarray: ...


class LogisticModel:
    """A linear scorer of vectors; a batch is one matrix product."""

    def __init__(self, weights: Sequence[float], bias: float):
        self.weights = np.asarray(weights, dtype="float64")
        self.bias = float(bias)

    def predict(self, batch: pd.Series) -> np.ndarray:
        matrix = np.stack(batch.to_numpy()).astype("float64")
        return 1.0 / (1.0 + np.exp(-(matrix @ self.weights + self.bias)))


def with_predictions(scored: DataFrame, score: str = "prediction_probability") -> DataFrame:
    """Label and confidence of a score column."""
    return scored.withColumn("predicted_label", labels.score_to_label(F.col(score))).withColumn(
        "confidence_score", labels.confidence(F.col(score))
    )


def batch_score(vectors_df: DataFrame, weights: Sequence[float], bias: float) -> DataFrame:
    """Score every vector inside the JVM; rows without a vector are dropped."""
    probability = vectors.logistic_score(F.col("feature_vector"), weights, bias)
    scored = vectors_df.filter(F.col("feature_vector").isNotNull()).select(
        "image_id", probability.alias("prediction_probability")
    )
    return with_predictions(scored)


def batch_score_pandas(
    rows: DataFrame, load_model: Callable[[], BatchModel], input_col: str = "feature_vector"
) -> DataFrame:
    """Score with any Python model, one Arrow batch at a time.

    ``load_model`` runs once per partition, so weights are read once and not per row. ``input_col``
    holds what the model takes: a vector, or the path of a file it opens itself. Rows without an
    input are dropped.
    """

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for batch in batches:
            if len(batch):
                yield pd.DataFrame(
                    {"image_id": batch["image_id"], "prediction_probability": model.predict(batch[input_col])}
                )

    inputs = rows.filter(F.col(input_col).isNotNull()).select("image_id", input_col)
    return with_predictions(inputs.mapInPandas(score, "image_id string, prediction_probability double"))


def scale_vectors(vectors_df: DataFrame, divisor: float = 255.0) -> DataFrame:
    """Pixel values scaled by a constant; rows without a vector are dropped."""
    return vectors_df.filter(F.col("feature_vector").isNotNull()).withColumn(
        "feature_vector", vectors.scale(F.col("feature_vector"), divisor)
    )


def vector_stats(vectors_df: DataFrame) -> DataFrame:
    """Mean and population standard deviation of every vector."""
    return vectors_df.select(
        "image_id",
        vectors.mean(F.col("feature_vector")).alias("mean_pixel_value"),
        vectors.std(F.col("feature_vector")).alias("std_pixel_value"),
    )


def image_features(vectors_df: DataFrame, model_name: str, extracted_at: Column) -> DataFrame:
    """The feature table: vector, model, mean, deviation, time."""
    return conform(
        vectors_df.select(
            "image_id",
            vectors.as_doubles(F.col("feature_vector")).alias("feature_vector"),
            F.lit(model_name).alias("feature_extraction_model"),
            vectors.mean(F.col("feature_vector")).alias("mean_pixel_value"),
            vectors.std(F.col("feature_vector")).alias("std_pixel_value"),
            extracted_at.alias("extracted_at"),
        ),
        IMAGE_FEATURES,
    )


def prediction_log(
    scored: DataFrame, images: DataFrame, model_name: str, model_version: str, predicted_at: Column
) -> DataFrame:
    """Prediction table rows for scored images with their known class."""
    truth = images.select("image_id", labels.encode_label(F.col("category")).alias("true_label"))
    return conform(
        scored.join(truth, "image_id", "left").select(
            texts.derived_id(K.PREDICTION_ID_PREFIX, F.col("image_id"), F.lit(model_name), F.lit(model_version), predicted_at).alias(
                "prediction_id"
            ),
            "image_id",
            "predicted_label",
            "prediction_probability",
            "confidence_score",
            "true_label",
            (F.col("predicted_label") == F.col("true_label")).alias("is_correct"),
            F.lit(model_name).alias("model_name"),
            F.lit(model_version).alias("model_version"),
            predicted_at.alias("predicted_at"),
            F.to_date(predicted_at).alias("prediction_date"),
        ),
        PREDICTIONS,
    )


def retrain_set(feedback_latest: DataFrame, predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Training rows from reviews: vector and reviewed label of each reviewed image.

    Takes one review per prediction; an image predicted several times takes its newest review. The
    reviews are reduced per image before they meet the wide vectors.
    """
    reviewed = feedback_latest.select("prediction_id", "ground_truth", "timestamp", "feedback_id").join(
        predictions.select("prediction_id", "image_id"), "prediction_id"
    )
    newest = F.max(F.struct("timestamp", "feedback_id", "ground_truth")).alias("newest")
    per_image = reviewed.groupBy("image_id").agg(newest, F.count("*").alias("reviews"))
    return per_image.join(features.select("image_id", "feature_vector"), "image_id").select(
        "image_id", labels.encode_label(F.col("newest.ground_truth")).alias("label"), "reviews", "feature_vector"
    )
