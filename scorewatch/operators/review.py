"""The review queue and the feedback made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import labels, texts, times
from scorewatch.operators import joins
from scorewatch.schemas import FEEDBACK, conform


def pending_feedback(predictions: DataFrame, feedback: DataFrame, newest: int | None = 10) -> DataFrame:
    """Predictions nobody has reviewed, newest first; all of them when ``newest`` is None."""
    waiting = joins.unreviewed(predictions, feedback).select(
        "prediction_id",
        "image_id",
        labels.decode_label(F.col("predicted_label")).alias("ai_prediction"),
        labels.decode_label(F.col("true_label")).alias("actual_diagnosis"),
        "prediction_probability",
        "predicted_at",
    )
    return waiting if newest is None else _newest(waiting, newest)


def _newest(waiting: DataFrame, rows: int) -> DataFrame:
    return waiting.orderBy(F.desc("predicted_at"), "prediction_id").limit(rows)


def _queue(predictions: DataFrame, feedback: DataFrame, images: DataFrame, newest: int) -> DataFrame:
    waiting = joins.unreviewed(predictions, feedback).select(
        "prediction_id",
        "image_id",
        labels.decode_label(F.col("predicted_label")).alias("ai_prediction"),
        "prediction_probability",
        "model_name",
        "predicted_at",
    )
    paths = images.select("image_id", F.col("file_path").alias("image_path"))
    found = joins.lookup_rows(_newest(waiting, newest), paths, "image_id")
    return found.orderBy(F.desc("predicted_at"), "prediction_id", "image_path").limit(newest)


def review_queue(predictions: DataFrame, feedback: DataFrame, images: DataFrame, newest: int = 50) -> DataFrame:
    """The newest unreviewed predictions with the path of their image.

    The top rows are taken before the lookup, so image metadata is not shuffled.
    """
    return _queue(predictions, feedback, images, newest).select(
        "prediction_id", "image_id", "ai_prediction", "prediction_probability", "model_name", "predicted_at", "image_path"
    )


def review_queue_filtered(
    predictions: DataFrame,
    feedback: DataFrame,
    images: DataFrame,
    from_date: str | None = None,
    to_date: str | None = None,
    model_name: str | None = None,
    min_confidence: float | None = None,
    max_confidence: float | None = None,
    newest: int = 50,
) -> DataFrame:
    """The queue by date, model and confidence. The filters run before the anti join."""
    wanted = F.lit(True)
    if from_date is not None:
        wanted = wanted & (F.col("prediction_date") >= F.lit(from_date).cast("date"))
    if to_date is not None:
        wanted = wanted & (F.col("prediction_date") <= F.lit(to_date).cast("date"))
    if model_name is not None:
        wanted = wanted & (F.col("model_name") == model_name)
    if min_confidence is not None:
        wanted = wanted & (F.col("confidence_score") >= min_confidence)
    if max_confidence is not None:
        wanted = wanted & (F.col("confidence_score") <= max_confidence)
    return review_queue(predictions.filter(wanted), feedback, images, newest)


def queue_display(queue: DataFrame) -> DataFrame:
    """Queue rows as a reviewer sees them."""
    return queue.select(
        "prediction_id",
        texts.preview(F.col("prediction_id")).alias("id_preview"),
        "ai_prediction",
        F.round("prediction_probability", 3).alias("prediction_probability"),
        times.display_time(F.col("predicted_at")).alias("predicted_at"),
        texts.image_link(F.col("image_id")).alias("image_link"),
        F.lit(None).cast("string").alias("radiologist_assessment"),
    )


def classify_assessments(assessed: DataFrame) -> DataFrame:
    """Outcome of rows with ``ai_prediction`` and ``radiologist_assessment``.

    Rows without an assessment, and pairs of unknown class names, are left out.
    """
    result = labels.outcome(F.col("ai_prediction"), F.col("radiologist_assessment"))
    return (
        assessed.filter(F.col("radiologist_assessment").isNotNull() & (F.col("radiologist_assessment") != ""))
        .withColumn("feedback_type", result)
        .filter(F.col("feedback_type") != K.UNKNOWN_OUTCOME)
    )


def feedback_rows(
    assessed: DataFrame,
    reviewer: str,
    at: Column,
    source: str = "review_app",
    notes: str = "",
) -> DataFrame:
    """Feedback table rows for assessed predictions (``feedback_type`` is present).

    Ids are a hash of prediction, reviewer, truth and time: a retried write of one review gives the same
    row and can be merged away, and going back to an earlier truth is a review of its own.
    """
    truth = F.col("radiologist_assessment")
    return conform(
        assessed.select(
            texts.derived_id(K.FEEDBACK_ID_PREFIX, F.col("prediction_id"), F.lit(reviewer), truth, at).alias("feedback_id"),
            "prediction_id",
            at.alias("timestamp"),
            truth.alias("ground_truth"),
            "feedback_type",
            F.lit(reviewer).alias("radiologist_id"),
            F.lit(K.CONFIRMED).alias("confidence"),
            F.lit(source).alias("feedback_source"),
            F.lit(notes).alias("notes"),
        ),
        FEEDBACK,
    )


def batch_feedback(
    predictions: DataFrame,
    feedback: DataFrame,
    reviewer: str,
    at: Column,
    min_confidence: float | None = None,
) -> DataFrame:
    """Feedback for every waiting prediction from its known truth, optionally only sure ones."""
    if min_confidence is not None:
        predictions = predictions.filter(F.col("confidence_score") >= min_confidence)
    waiting = pending_feedback(predictions, feedback, newest=None)
    assessed = waiting.withColumn("radiologist_assessment", F.col("actual_diagnosis")).withColumn(
        "feedback_type", labels.outcome(F.col("ai_prediction"), F.col("actual_diagnosis"))
    )
    return feedback_rows(assessed, reviewer, at, source="batch", notes="from known label")


def review_progress(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """One row: assessed of all, and agreeing of assessed, by the latest review."""
    needed = feedback.select("prediction_id", "timestamp", "feedback_id", "ground_truth")
    assessment = latest_feedback(needed).select("prediction_id", "ground_truth")
    sheet = predictions.select(
        "prediction_id", labels.decode_label(F.col("predicted_label")).alias("ai_prediction")
    ).join(assessment, "prediction_id", "left")
    return sheet.agg(
        F.count("ground_truth").alias("assessed"),
        F.count("*").alias("total"),
        F.count_if(F.col("ai_prediction") == F.col("ground_truth")).alias("matches"),
    ).withColumns(
        {
            "assessed_text": F.concat_ws("/", F.col("assessed").cast("string"), F.col("total").cast("string")),
            "matches_text": F.concat_ws("/", F.col("matches").cast("string"), F.col("assessed").cast("string")),
        }
    )


def latest_feedback(feedback: DataFrame) -> DataFrame:
    """One review per prediction: the newest, then the highest id.

    A maximum of rows instead of a ranking: it combines on the map side, so a prediction with very
    many reviews is never ranked in one task. A maximum over texts sorts each task's rows, and all given
    columns are moved, so callers select what they need first.
    """
    rest = [c for c in feedback.columns if c not in ("prediction_id", "timestamp", "feedback_id")]
    newest = F.max(F.struct("timestamp", "feedback_id", *rest)).alias("newest")
    return feedback.groupBy("prediction_id").agg(newest).select("prediction_id", "newest.*").select(*feedback.columns)
