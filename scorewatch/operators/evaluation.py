"""Evaluation of a binary classifier from labels, predictions and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch.functions import numeric, texts
from scorewatch.operators.skew import salted_join
from scorewatch.schemas import MODEL_PERFORMANCE, conform

CLIP = 1e-7


def confusion_counts(label: Column, predicted: Column) -> list[Column]:
    """Aggregates: true and false positives and negatives of two 0/1 columns."""
    return [
        F.count_if((label == 1) & (predicted == 1)).alias("true_positives"),
        F.count_if((label == 0) & (predicted == 1)).alias("false_positives"),
        F.count_if((label == 0) & (predicted == 0)).alias("true_negatives"),
        F.count_if((label == 1) & (predicted == 0)).alias("false_negatives"),
    ]


def quality_metrics(zero_division: float | None = 0.0) -> list[Column]:
    """Accuracy, precision, recall and F1 of the four counts.

    A zero denominator gives ``zero_division``: 0.0 as in offline evaluation, None for NULL.
    """
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    fill = lambda c: c if zero_division is None else F.coalesce(c, F.lit(zero_division))
    precision, recall = fill(numeric.ratio(tp, tp + fp)), fill(numeric.ratio(tp, tp + fn))
    return [
        numeric.ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        fill(numeric.f1(precision, recall)).alias("f1_score"),
    ]


def binary_eval(
    pairs: DataFrame,
    label: str = "label",
    predicted: str = "predicted",
    by: Sequence[str] = (),
    zero_division: float | None = 0.0,
) -> DataFrame:
    """Counts and metrics, one row per group."""
    counts = pairs.groupBy(*by).agg(*confusion_counts(F.col(label), F.col(predicted)))
    return counts.select("*", *quality_metrics(zero_division))


def confusion_json() -> Column:
    """``[[TN,FP],[FN,TP]]`` of the four counts."""
    return F.to_json(
        F.array(
            F.array("true_negatives", "false_positives"),
            F.array("false_negatives", "true_positives"),
        )
    )


def auc(
    pairs: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    counts: Sequence[Column] = (),
) -> DataFrame:
    """Area under the ROC curve: share of (positive, negative) pairs ranked right, ties half.

    Exact and without a global sort in one task. Rows are first counted per distinct score, then
    the scores are cut into ranges of about equal size; inside a range a window counts the
    negatives below each score, and the negatives of the ranges before are added from one row per
    range. 0.5 when a group has only one class. ``counts`` are further named counts of the same
    rows; they ride along, so that a report needs one pass.
    """
    by = list(by)
    scored = F.col(score).isNotNull()
    per_score = pairs.groupBy(*by, score).agg(
        F.count_if(scored & (F.col(label) == 1)).cast("double").alias("pos"),
        F.count_if(scored & (F.col(label) == 0)).cast("double").alias("neg"),
        *counts,
    )
    named = [c for c in per_score.columns if c not in (*by, score, "pos", "neg")]
    summed = [F.sum(c).alias(c) for c in ("pos", "neg", *named)]
    ranges = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = per_score.repartitionByRange(ranges, *by, score).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy(*by, "_range").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0.0))
    per_range = (
        ranged.withColumn("wins", F.col("pos") * (below + F.col("neg") / 2.0))
        .groupBy(*by, "_range")
        .agg(*summed, F.sum("wins").alias("wins"))
    )
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifted = per_range.withColumn("neg_before", F.coalesce(F.sum("neg").over(before), F.lit(0.0)))
    wins = F.sum(F.col("wins") + F.col("pos") * F.col("neg_before"))
    return shifted.groupBy(*by).agg(
        F.sum("pos").cast("long").alias("positives"),
        F.sum("neg").cast("long").alias("negatives"),
        F.coalesce(wins / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0.0)), F.lit(0.5)).alias("auc"),
        *[F.sum(c).alias(c) for c in named],
    )


def auc_mllib(pairs: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The same area from Spark ML's evaluator, as a cross-check."""
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", metricName="areaUnderROC", numBins=0
    )
    value = evaluator.evaluate(
        pairs.select(F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score"))
    )
    return pairs.agg(F.count("*").alias("samples")).withColumn("auc", F.lit(float(value)))


def log_loss(pairs: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Mean binary cross-entropy and accuracy; scores are clipped away from 0 and 1."""
    p = F.least(F.greatest(F.col(score), F.lit(CLIP)), F.lit(1.0 - CLIP))
    y = F.col(label).cast("double")
    loss = -(y * F.log(p) + (1.0 - y) * F.log(1.0 - p))
    right = (F.col(score) > 0.5).cast("int") == F.col(label)
    return pairs.groupBy(*by).agg(
        F.count("*").alias("samples"),
        F.avg(loss).alias("log_loss"),
        numeric.ratio(F.count_if(right), F.count("*")).alias("accuracy"),
    )


def threshold_sweep(
    pairs: DataFrame, thresholds: Sequence[float], label: str = "label", score: str = "score"
) -> DataFrame:
    """Counts and metrics at every threshold, from one pass over the data.

    Rows are counted by how many thresholds their score exceeds; only those few counts are then
    compared with the thresholds.
    """
    steps = sorted({float(t) for t in thresholds})
    exceeded = sum(((F.col(score) > F.lit(t)).cast("int") for t in steps), F.lit(0))
    counts = (
        pairs.filter(F.col(score).isNotNull())
        .groupBy(exceeded.alias("exceeded"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    step_rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(steps)])
    above = F.col("exceeded") > F.col("step.i")
    return (
        counts.withColumn("step", F.explode(step_rows))
        .groupBy(F.col("step.threshold").alias("threshold"))
        .agg(
            sum_where(above, "pos").alias("true_positives"),
            sum_where(above, "neg").alias("false_positives"),
            sum_where(~above, "neg").alias("true_negatives"),
            sum_where(~above, "pos").alias("false_negatives"),
        )
        .select("*", *quality_metrics())
        .orderBy("threshold")
    )


def sum_where(condition: Column, value: str) -> Column:
    """Sum of ``value`` over the rows where the condition holds."""
    return F.sum(F.when(condition, F.col(value)).otherwise(0))


def evaluation_run(predictions: DataFrame, images: DataFrame, evaluated_at: Column) -> DataFrame:
    """One ``model_performance`` row per model, version and dataset split.

    Predictions are measured against their known label; predictions of unknown images are left out. All others
    are samples, those without a label too.
    """
    group = ["model_name", "model_version", "dataset_split"]
    known = salted_join(predictions, images.select("image_id", "dataset_split"), "image_id", spread_by="prediction_id")
    counts = [*confusion_counts(F.col("true_label"), F.col("predicted_label")), F.count("*").alias("samples")]
    run = auc(known, "true_label", "prediction_probability", by=group, counts=counts).select("*", *quality_metrics())
    return conform(
        run.select(
            texts.derived_id("eval-", *[F.col(c) for c in group], evaluated_at).alias("evaluation_id"),
            *group,
            "accuracy",
            "precision",
            "recall",
            "f1_score",
            F.col("auc").alias("auc_roc"),
            confusion_json().alias("confusion_matrix"),
            F.col("samples").alias("total_samples"),
            evaluated_at.alias("evaluated_at"),
            F.to_date(evaluated_at).alias("evaluation_date"),
        ),
        MODEL_PERFORMANCE,
    )
