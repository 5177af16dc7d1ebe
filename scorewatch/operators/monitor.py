"""Trends, drift and health of each model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import numeric, times
from scorewatch.operators import joins


def daily_by_model(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Reviews and hits per model and prediction day: the small frame every trend is made of."""
    reviewed = predictions.select("prediction_id", "model_name", "predicted_at").join(
        joins.review_tallies(feedback), "prediction_id"
    )
    return reviewed.groupBy("model_name", times.day_number(F.col("predicted_at")).alias("day_number")).agg(
        F.sum("reviews").alias("reviews"), F.sum("hits").alias("hits")
    )


def _day(daily: DataFrame) -> DataFrame:
    return daily.withColumn("day", F.date_from_unix_date("day_number").cast("timestamp")).drop("day_number")


def accuracy_trend(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Accuracy per model and day with its change from the day before that has reviews."""
    daily = daily_by_model(predictions, feedback).withColumn(
        "accuracy_pct", numeric.percent(F.col("hits"), F.col("reviews"))
    )
    order = Window.partitionBy("model_name").orderBy("day_number")
    change = F.round(F.col("accuracy_pct") - F.lag("accuracy_pct").over(order), 2)
    return _day(daily.withColumn("change_pct", change)).select(
        "model_name", "day", "reviews", "accuracy_pct", "change_pct"
    )


def rolling_accuracy(predictions: DataFrame, feedback: DataFrame, days: int = 7) -> DataFrame:
    """Accuracy over the trailing days: sums over the frame first, then the quotient."""
    daily = daily_by_model(predictions, feedback)
    frame = Window.partitionBy("model_name").orderBy("day_number").rangeBetween(-(days - 1), 0)
    rolled = daily.withColumn("reviews_in_window", F.sum("reviews").over(frame)).withColumn(
        "hits_in_window", F.sum("hits").over(frame)
    )
    return _day(rolled).select(
        "model_name",
        "day",
        "reviews_in_window",
        numeric.percent(F.col("hits_in_window"), F.col("reviews_in_window")).alias("rolling_accuracy_pct"),
    )


def drift_alert(
    predictions: DataFrame,
    feedback: DataFrame,
    baseline_days: int = 7,
    window_days: int = 7,
    max_drop: float = 0.05,
) -> DataFrame:
    """Accuracy of the first days against the last days per model; alert when it fell too far.

    The two windows are counted from each model's own first and last day with reviews.
    """
    daily = daily_by_model(predictions, feedback)
    of_model = Window.partitionBy("model_name")  # one row per day
    in_baseline = F.col("day_number") < F.col("first_day") + baseline_days
    in_window = F.col("day_number") > F.col("last_day") - window_days
    part = lambda inside, value: F.sum(F.when(inside, F.col(value)).otherwise(0))
    return (
        daily.withColumn("first_day", F.min("day_number").over(of_model))
        .withColumn("last_day", F.max("day_number").over(of_model))
        .groupBy("model_name")
        .agg(
            numeric.ratio(part(in_baseline, "hits"), part(in_baseline, "reviews")).alias("baseline_accuracy"),
            numeric.ratio(part(in_window, "hits"), part(in_window, "reviews")).alias("recent_accuracy"),
        )
        .select(
            "model_name",
            F.round("baseline_accuracy", 6).alias("baseline_accuracy"),
            F.round("recent_accuracy", 6).alias("recent_accuracy"),
            F.round(F.col("baseline_accuracy") - F.col("recent_accuracy"), 6).alias("accuracy_drop"),
            F.coalesce(F.col("baseline_accuracy") - F.col("recent_accuracy") > max_drop, F.lit(False)).alias("alert"),
        )
    )


def health_flags(
    predictions: DataFrame,
    feedback: DataFrame,
    min_precision: float = K.TARGET_PRECISION,
    min_recall: float = K.TARGET_RECALL,
    min_f1: float = K.TARGET_F1,
    max_error_rate: float = 0.10,
    min_confidence_when_right: float = 0.70,
    max_confidence_when_wrong: float = 0.80,
) -> DataFrame:
    """Targets met and red flags raised per model.

    Error rates are the shares of false negatives and false positives among all four outcomes. The
    confidence flags compare the mean confidence of right and of wrong predictions.
    """
    reviewed = predictions.select("prediction_id", "model_name", "confidence_score").join(
        joins.review_tallies(feedback), "prediction_id"
    )
    confidence = F.col("confidence_score")
    mean_over = lambda weight: F.sum(confidence * F.col(weight)) / F.nullif(
        F.sum(weight).cast("double"), F.lit(0.0)
    )
    counts = reviewed.groupBy("model_name").agg(
        *[F.sum(name).alias(name) for name in joins.OUTCOME_COUNTS],
        mean_over("hits").alias("confidence_right"),
        mean_over("misses").alias("confidence_wrong"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    known = tp + fp + tn + fn
    precision, recall = numeric.ratio(tp, tp + fp), numeric.ratio(tp, tp + fn)
    flag = lambda c: F.coalesce(c, F.lit(False))
    return counts.select(
        "model_name",
        F.round(precision, 4).alias("precision"),
        F.round(recall, 4).alias("recall"),
        F.round(numeric.f1(precision, recall), 4).alias("f1_score"),
        flag(precision > min_precision).alias("precision_ok"),
        flag(recall > min_recall).alias("recall_ok"),
        flag(numeric.f1(precision, recall) > min_f1).alias("f1_ok"),
        flag(numeric.ratio(fn, known) > max_error_rate).alias("many_false_negatives"),
        flag(numeric.ratio(fp, known) > max_error_rate).alias("many_false_positives"),
        flag(F.col("confidence_right") < min_confidence_when_right).alias("unsure_when_right"),
        flag(F.col("confidence_wrong") > max_confidence_when_wrong).alias("sure_when_wrong"),
    )


def late_rows(predictions: DataFrame, feedback: DataFrame, allowed_hours: int = 48) -> DataFrame:
    """Reviews that came later than allowed after their prediction, with their delay.

    These are the rows a stream with that watermark drops; the batch report keeps them.
    """
    delay = F.unix_timestamp("timestamp") - F.unix_timestamp("predicted_at")
    reviewed = joins.with_feedback(
        predictions.select("prediction_id", "predicted_at"), feedback.select("prediction_id", "feedback_id", "timestamp")
    )
    return reviewed.withColumn("delay_hours", F.round(delay / 3600.0, 4)).filter(
        delay > allowed_hours * 3600
    ).select("feedback_id", "prediction_id", "predicted_at", "timestamp", "delay_hours")


def late_summary(predictions: DataFrame, feedback: DataFrame, allowed_hours: int = 48) -> DataFrame:
    """Late reviews per prediction day."""
    return (
        late_rows(predictions, feedback, allowed_hours)
        .groupBy(times.day(F.col("predicted_at")).alias("day"))
        .agg(F.count("*").alias("late_reviews"), F.max("delay_hours").alias("longest_delay_hours"))
    )
