"""Monitoring reports over predictions and feedback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import labels, numeric, texts, times
from scorewatch.operators import joins


def _rates(digits: int = 4) -> dict[str, Column]:
    """Unrounded rates of the four outcome counts; NULL where a denominator is 0."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    precision, recall = numeric.ratio(tp, tp + fp), numeric.ratio(tp, tp + fn)
    return {
        "precision": F.round(precision, digits),
        "recall": F.round(recall, digits),
        "specificity": F.round(numeric.ratio(tn, tn + fp), digits),
        "f1_score": F.round(numeric.f1(precision, recall), digits),
    }


def model_metrics(
    predictions: DataFrame,
    feedback: DataFrame,
    by: Sequence[str] = ("model_name", "model_version"),
) -> DataFrame:
    """Review counts, precision, recall, specificity, F1 and accuracy per model.

    ``accuracy`` divides by the distinct reviews, unknown outcomes included. The distinct count
    shuffles on (model, feedback id), so few models still use all executors.
    """
    reviewed = joins.with_feedback(
        predictions.select("prediction_id", *by), feedback.select("prediction_id", "feedback_id", "feedback_type")
    )
    counts = reviewed.groupBy(*by).agg(
        F.count_distinct("feedback_id").alias("total_feedback"), *joins.outcome_tallies()
    )
    correct = F.col("true_positives") + F.col("true_negatives")
    return counts.select(
        *by,
        "total_feedback",
        *joins.OUTCOME_COUNTS,
        *[rate.alias(name) for name, rate in _rates().items()],
        F.round(numeric.ratio(correct, F.col("total_feedback")), 4).alias("accuracy"),
    ).orderBy(F.desc("f1_score"), *by)


def model_metrics_basic(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """The report without specificity and F1, best accuracy first."""
    return (
        model_metrics(predictions, feedback)
        .drop("specificity", "f1_score")
        .orderBy(F.desc("accuracy"), "model_name", "model_version")
    )


def outcome_counts(feedback: DataFrame) -> DataFrame:
    return feedback.groupBy("feedback_type").agg(F.count("*").alias("count"))


def _share(count: str, digits: int) -> Column:
    """Percentage of the total over an already aggregated frame (one row per group)."""
    return F.round(F.col(count) * 100.0 / F.sum(count).over(Window.partitionBy()).cast("double"), digits)


def outcome_distribution(feedback: DataFrame) -> DataFrame:
    """Outcome counts with their share, in report order."""
    return (
        outcome_counts(feedback)
        .withColumn("percentage", _share("count", 2))
        .withColumn("sort_order", labels.outcome_order(F.col("feedback_type")))
        .orderBy("sort_order", "feedback_type")
    )


def confusion_grid(feedback: DataFrame) -> DataFrame:
    """The 2x2 grid as two rows, from one scan."""
    counts = feedback.agg(*joins.outcome_tallies())
    return counts.select(
        F.expr(
            f"stack(2, 'Predicted {K.POSITIVE_CLASS}', true_positives, false_positives,"
            f" 'Predicted {K.NEGATIVE_CLASS}', false_negatives, true_negatives)"
            " AS (predicted_label, actual_pneumonia, actual_normal)"
        )
    )


def _by_correctness(scored: DataFrame) -> DataFrame:
    """One row per prediction and correctness with its number of reviews."""
    pairs = F.array(
        F.struct(F.lit(K.CORRECT).alias("outcome"), F.col("hits").alias("weight")),
        F.struct(F.lit(K.INCORRECT).alias("outcome"), (F.col("reviews") - F.col("hits")).alias("weight")),
    )
    return (
        scored.withColumn("pair", F.explode(pairs))
        .select(*scored.columns, "pair.outcome", "pair.weight")
        .filter(F.col("weight") > 0)
    )


def _weighted_mean(value: str, weight: str) -> Column:
    """Mean of ``value`` over ``weight`` rows each, NULL values left out."""
    known = F.when(F.col(value).isNotNull(), F.col(weight))
    return F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(known).cast("double"), F.lit(0.0))


def confidence_by_outcome(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Mean, lowest and highest confidence of right and wrong predictions."""
    scored = predictions.select("prediction_id", "confidence_score").join(
        joins.review_tallies(feedback), "prediction_id"
    )
    return (
        _by_correctness(scored)
        .groupBy(F.col("outcome").alias("prediction_outcome"))
        .agg(
            F.round(_weighted_mean("confidence_score", "weight"), 4).alias("avg_confidence"),
            F.round(F.min("confidence_score"), 4).alias("min_confidence"),
            F.round(F.max("confidence_score"), 4).alias("max_confidence"),
            F.sum("weight").alias("count"),
        )
    )


def confidence_histogram(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Reviews per score (two digits) and correctness; ``confidence`` holds P(positive)."""
    scored = predictions.select("prediction_id", "prediction_probability").join(
        joins.review_tallies(feedback), "prediction_id"
    )
    return (
        _by_correctness(scored)
        .groupBy(F.round("prediction_probability", 2).alias("confidence"), F.col("outcome").alias("correctness"))
        .agg(F.sum("weight").alias("count"))
    )


def error_analysis(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """False positives against false negatives: how sure was the model."""
    errors = joins.outcome_tallies_per_prediction(feedback.filter(labels.is_miss(F.col("feedback_type"))))
    scored = errors.join(
        predictions.select("prediction_id", "prediction_probability", "confidence_score"), "prediction_id"
    )
    sure = F.sum(F.when(F.col("confidence_score") > K.HIGH_CONFIDENCE, F.col("reviews")).otherwise(0))
    return scored.groupBy("feedback_type").agg(
        F.sum("reviews").alias("count"),
        F.round(_weighted_mean("prediction_probability", "reviews"), 4).alias("avg_prediction_probability"),
        F.round(_weighted_mean("confidence_score", "reviews"), 4).alias("avg_confidence"),
        numeric.percent(sure, F.sum("reviews")).alias("high_confidence_errors_pct"),
    )


def _daily_counts(feedback: DataFrame) -> DataFrame:
    return feedback.groupBy(times.day(F.col("timestamp")).alias("date")).agg(
        F.count("*").alias("predictions"),
        numeric.tally(labels.is_hit(F.col("feedback_type"))).alias("hits"),
        *joins.outcome_tallies(),
    )


def daily_performance(feedback: DataFrame) -> DataFrame:
    """Reviews, accuracy (percent), precision and recall per review day."""
    rates = _rates()
    return (
        _daily_counts(feedback)
        .select(
            "date",
            "predictions",
            numeric.percent(F.col("hits"), F.col("predictions")).alias("accuracy_pct"),
            rates["precision"].alias("precision"),
            rates["recall"].alias("recall"),
        )
        .orderBy(F.desc("date"))
    )


def daily_performance_pct(feedback: DataFrame) -> DataFrame:
    """The daily report with every rate in percent."""
    tp = F.col("true_positives")
    precision = numeric.ratio(tp, tp + F.col("false_positives"))
    recall = numeric.ratio(tp, tp + F.col("false_negatives"))
    return (
        _daily_counts(feedback)
        .select(
            "date",
            "predictions",
            numeric.percent(F.col("hits"), F.col("predictions")).alias("accuracy_pct"),
            F.round(precision * 100, 2).alias("precision_pct"),
            F.round(recall * 100, 2).alias("recall_pct"),
        )
        .orderBy(F.desc("date"))
    )


def daily_accuracy(feedback: DataFrame) -> DataFrame:
    return daily_performance(feedback).select("date", "accuracy_pct")


def daily_error_rate(feedback: DataFrame) -> DataFrame:
    """Share of false positives and false negatives per review day."""
    return (
        feedback.groupBy(times.day(F.col("timestamp")).alias("date"))
        .agg(
            numeric.percent(numeric.tally(labels.is_miss(F.col("feedback_type"))), F.count("*")).alias(
                "error_rate_pct"
            ),
            F.count("*").alias("total_predictions"),
        )
        .orderBy(F.desc("date"))
    )


def reviewer_summary(feedback: DataFrame) -> DataFrame:
    """Reviews per reviewer by certainty, agreement with the model, first and last review."""
    certainty = F.col("confidence")
    return (
        feedback.groupBy("radiologist_id")
        .agg(
            F.count("*").alias("total_reviews"),
            numeric.tally(certainty == K.CONFIRMED).alias("confirmed_reviews"),
            numeric.tally(certainty == K.UNCERTAIN).alias("uncertain_reviews"),
            numeric.tally(certainty == K.NEEDS_REVIEW).alias("needs_review_count"),
            numeric.percent(numeric.tally(labels.is_hit(F.col("feedback_type"))), F.count("*")).alias(
                "ai_agreement_pct"
            ),
            F.min("timestamp").alias("first_review"),
            F.max("timestamp").alias("last_review"),
        )
        .orderBy(F.desc("total_reviews"), "radiologist_id")
    )


def reviewer_agreement(feedback: DataFrame) -> DataFrame:
    """Agreement per named reviewer, best first."""
    return (
        feedback.filter(F.col("radiologist_id").isNotNull())
        .groupBy(F.coalesce("radiologist_id", F.lit("Unknown")).alias("radiologist_id"))
        .agg(
            numeric.percent(numeric.tally(labels.is_hit(F.col("feedback_type"))), F.count("*")).alias("agreement_pct"),
            F.count("*").alias("total_reviews"),
            numeric.tally(labels.is_miss(F.col("feedback_type"))).alias("disagreements"),
        )
        .orderBy(F.desc("agreement_pct"), "radiologist_id")
    )


def _coverage(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """One row: distinct predictions, distinct reviews of them, distinct reviewed predictions."""
    known = predictions.select("prediction_id").distinct()
    matched = joins.salted_join(
        feedback.select("prediction_id", "feedback_id"), known, "prediction_id", spread_by="feedback_id", how="left_semi"
    )
    # One distinct count each: together they would send every row twice.
    reviewed = matched.agg(F.count_distinct("prediction_id")).scalar()
    total = known.agg(F.count("prediction_id")).scalar()
    return matched.agg(F.count_distinct("feedback_id").alias("reviews")).select(
        total.alias("total"), "reviews", reviewed.alias("reviewed")
    )


def feedback_coverage(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """How much of the predictions has been reviewed.

    The first four columns count reviews, so repeated reviews can push them past 100 percent and
    pending below zero; ``reviewed_predictions`` and ``reviewed_pct`` count predictions.
    """
    total, reviews, reviewed = F.col("total"), F.col("reviews"), F.col("reviewed")
    return _coverage(predictions, feedback).select(
        total.alias("total_predictions"),
        reviews.alias("predictions_with_feedback"),
        (total - reviews).alias("predictions_pending_feedback"),
        numeric.percent(reviews, total).alias("feedback_coverage_pct"),
        reviewed.alias("reviewed_predictions"),
        numeric.percent(reviewed, total).alias("reviewed_pct"),
    )


def _recent(log: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Requests of the last ``days`` days before the explicit date ``as_of``."""
    return log.filter(F.col("date") >= F.date_sub(as_of, days))


def feedback_coverage_recent(log: DataFrame, feedback: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Coverage of the requests of the last days, by request id."""
    requests = _recent(log, as_of, days).select(F.col("request_id").alias("prediction_id"))
    return _coverage(requests, feedback).select(
        F.col("total").alias("total_predictions"),
        F.col("reviews").alias("predictions_with_feedback"),
        numeric.percent(F.col("reviews"), F.col("total")).alias("coverage_pct"),
    )


def traffic_share(log: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Requests per served model and their share."""
    return (
        _recent(log, as_of, days)
        .groupBy("served_model_name")
        .agg(F.count("*").alias("total_predictions"))
        .withColumn("traffic_pct", _share("total_predictions", 1))
        .orderBy(F.desc("total_predictions"), "served_model_name")
    )


def _served_tallies(log: DataFrame, feedback: DataFrame, how: str, *columns: str) -> DataFrame:
    """Logged requests with the tallies of their reviews."""
    tallies = joins.review_tallies(feedback).withColumnRenamed("prediction_id", "request_id")
    return log.select("request_id", "served_model_name", *columns).join(tallies, "request_id", how)


def served_accuracy(log: DataFrame, feedback: DataFrame) -> DataFrame:
    """Accuracy per served model over all reviewed requests."""
    return (
        _served_tallies(log, feedback, "inner")
        .groupBy("served_model_name")
        .agg(
            F.sum("reviews").alias("total_predictions_with_feedback"),
            F.sum("hits").alias("correct_predictions"),
            numeric.percent(F.sum("hits"), F.sum("reviews")).alias("accuracy_pct"),
        )
        .orderBy(F.desc("accuracy_pct"), "served_model_name")
    )


def served_accuracy_recent(log: DataFrame, feedback: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Accuracy per served model over the requests of the last days."""
    return served_accuracy(_recent(log, as_of, days), feedback).withColumnsRenamed(
        {"total_predictions_with_feedback": "total_with_feedback", "correct_predictions": "correct"}
    )


def served_confusion_recent(log: DataFrame, feedback: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """The four outcome counts per served model over the requests of the last days."""
    return (
        _served_tallies(_recent(log, as_of, days), feedback, "inner")
        .groupBy("served_model_name")
        .agg(*[F.sum(name).alias(name) for name in joins.OUTCOME_COUNTS])
    )


def served_daily(log: DataFrame, feedback: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Requests, reviews and accuracy per day and served model.

    ``daily_accuracy`` counts requests without a review as wrong; ``daily_accuracy_reviewed`` leaves
    them out. A request counts once per review, and once without any.
    """
    rows = F.greatest(F.coalesce("reviews", F.lit(0)), F.lit(1))
    return (
        _served_tallies(_recent(log, as_of, days), feedback, "left", "timestamp")
        .groupBy(F.to_date("timestamp").alias("prediction_date"), "served_model_name")
        .agg(
            F.sum(rows).alias("predictions_count"),
            F.coalesce(F.sum("reviews"), F.lit(0)).alias("feedback_count"),
            numeric.percent(F.coalesce(F.sum("hits"), F.lit(0)), F.sum(rows)).alias("daily_accuracy"),
            numeric.percent(F.sum("hits"), F.sum("reviews")).alias("daily_accuracy_reviewed"),
        )
        .orderBy(F.desc("prediction_date"), "served_model_name")
    )


def confusion_by_model(
    predictions: DataFrame, feedback: DataFrame, payload: DataFrame, band_ms: int = K.ATTRIBUTION_BAND_MS
) -> DataFrame:
    """Outcome counts per model family, the model taken from the matching log entries.

    A review counts once per matching call. Reviews are summed per score, second and outcome and
    calls per score, time and family before they meet, so the sums multiply and no row is repeated.
    """
    point = ["prediction_probability", "predicted_ms"]
    reviews = (
        joins.outcome_tallies_per_prediction(feedback)
        .join(
            predictions.select(
                "prediction_id", "prediction_probability", times.epoch_ms(F.col("predicted_at")).alias("predicted_ms")
            ),
            "prediction_id",
        )
        .groupBy(*point, "feedback_type")
        .agg(F.sum("reviews").alias("reviews"))
    )
    calls = joins.call_points(payload, labels.model_family(F.col("logged_model")))
    near = joins.band_join(
        reviews, calls, "predicted_ms", "timestamp_ms", band_ms, equal=[("prediction_probability", "logged_score")]
    )
    return (
        near.groupBy(F.col("logged_model").alias("model_display_name"), "feedback_type")
        .agg(F.sum(F.col("reviews") * F.col("calls")).alias("count"))
        .withColumn("sort_order", labels.outcome_order(F.col("feedback_type")))
        .orderBy("sort_order", "model_display_name")
    )


def _reviews_per_image(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Reviews and hits per image; an image with many predictions is combined before the shuffle."""
    return (
        predictions.select("prediction_id", "image_id")
        .join(joins.review_tallies(feedback), "prediction_id")
        .groupBy("image_id")
        .agg(F.sum("reviews").alias("reviews"), F.sum("hits").alias("hits"))
    )


def errors_by_split(predictions: DataFrame, feedback: DataFrame, images: DataFrame) -> DataFrame:
    """Outcome counts per dataset split."""
    per_image = (
        joins.outcome_tallies_per_prediction(feedback)
        .join(predictions.select("prediction_id", "image_id"), "prediction_id")
        .groupBy("image_id", "feedback_type")
        .agg(F.sum("reviews").alias("reviews"))
    )
    return (
        per_image.join(images.select("image_id", "dataset_split"), "image_id")
        .groupBy("dataset_split", "feedback_type")
        .agg(F.sum("reviews").alias("count"))
        .orderBy("dataset_split", "feedback_type")
    )


def accuracy_by_size(predictions: DataFrame, feedback: DataFrame, images: DataFrame) -> DataFrame:
    """Accuracy per file size band."""
    return (
        _reviews_per_image(predictions, feedback)
        .join(images.select("image_id", "file_size_bytes"), "image_id")
        .groupBy(labels.size_band(F.col("file_size_bytes")).alias("size_category"))
        .agg(
            numeric.percent(F.sum("hits"), F.sum("reviews")).alias("accuracy_pct"),
            F.sum("reviews").alias("total_predictions"),
        )
        .orderBy("size_category")
    )


def false_positive_feed(
    predictions: DataFrame,
    feedback: DataFrame,
    payload: DataFrame,
    newest: int = 10,
    link_prefix: str = K.IMAGE_LINK_PREFIX,
) -> DataFrame:
    """The newest false positives with the model that served them and a link to the image."""
    alarms = feedback.filter(F.col("feedback_type") == K.FALSE_POSITIVE).select(
        "feedback_id", "prediction_id", "timestamp"
    )
    reviewed = joins.with_feedback(
        predictions.select("prediction_id", "image_id", "predicted_at", "prediction_probability"), alarms
    )
    # Every matched row is at least one entry of the feed, so the newest rows are enough; only they
    # are then repeated once per model and matching call.
    order = [F.desc("timestamp"), F.col("feedback_id")]
    newest_rows = joins.newest_matched(reviewed, payload, order, newest, spread_by="feedback_id")
    return (
        newest_rows.withColumn("call", F.explode(F.sequence(F.lit(1), F.least("matches", F.lit(newest)).cast("int"))))
        .orderBy(F.desc("timestamp"), "feedback_id", "logged_model", "call")
        .limit(newest)
        .select(
            "feedback_id",
            "image_id",
            "predicted_at",
            F.round("prediction_probability", 3).alias("ai_confidence"),
            labels.model_family(F.col("logged_model")).alias("model_name"),
            texts.image_link(F.col("image_id"), link_prefix).alias("app_link"),
        )
    )


def recent_predictions(predictions: DataFrame, newest: int = 20) -> DataFrame:
    """The newest predictions with readable labels."""
    return (
        predictions.orderBy(F.desc("predicted_at"), "prediction_id")
        .limit(newest)
        .select(
            "prediction_id",
            "image_id",
            labels.decode_label(F.col("predicted_label")).alias("predicted"),
            labels.decode_label(F.col("true_label")).alias("true_diagnosis"),
            F.round("prediction_probability", 3).alias("probability"),
            "is_correct",
            "model_name",
            "predicted_at",
        )
    )
