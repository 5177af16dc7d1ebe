"""Champion against challenger: significance and decision."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import labels, numeric
from scorewatch.operators.review import latest_feedback


def reviewed_correctness(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """One row per reviewed prediction with a known outcome: model and 1 / 0 for right / wrong.

    Every prediction counts once, with its latest review.
    """
    verdict = labels.outcome_tristate(F.col("feedback_type")).cast("int").alias("correct")
    needed = feedback.select("prediction_id", "timestamp", "feedback_id", "feedback_type")
    latest = latest_feedback(needed).select("prediction_id", verdict).filter(F.col("correct").isNotNull())
    return predictions.select("prediction_id", "model_name").join(latest, "prediction_id").select("model_name", "correct")


def chi_square(predictions: DataFrame, feedback: DataFrame, champion: str, challenger: str) -> DataFrame:
    """Pearson test of the 2x2 table model x correct, without continuity correction; one row.

    n(ad - bc)^2 / ((a+b)(c+d)(a+c)(b+d)); NULL when a margin is 0, and then not significant.
    """
    verdicts = reviewed_correctness(
        predictions.filter(F.col("model_name").isin(champion, challenger)), feedback
    )
    cell = lambda model, value: F.count_if((F.col("model_name") == model) & (F.col("correct") == value))
    table = verdicts.agg(
        cell(champion, 1).alias("champion_correct"),
        cell(champion, 0).alias("champion_wrong"),
        cell(challenger, 1).alias("challenger_correct"),
        cell(challenger, 0).alias("challenger_wrong"),
    )
    a, b, c, d = (F.col(n).cast("double") for n in table.columns)
    statistic = (a + b + c + d) * F.pow(a * d - b * c, F.lit(2.0))
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    return (
        table.withColumn("champion", F.lit(champion))
        .withColumn("challenger", F.lit(challenger))
        .withColumn("champion_accuracy", numeric.ratio(a, a + b))
        .withColumn("challenger_accuracy", numeric.ratio(c, c + d))
        .withColumn("chi_square", statistic / F.nullif(margins, F.lit(0.0)))
        .withColumn("significant", F.coalesce(F.col("chi_square") > K.CHI_SQUARE_CRITICAL_5PCT, F.lit(False)))
    )


def upper_tail(x: Column) -> Column:
    """Upper tail of the chi-square distribution with one degree of freedom, as erfc(sqrt(x / 2)).

    Up to 12 it is one less a series of positive terms x^n / (1 * 3 * ... * (2n + 1)), beyond that a continued
    fraction, read from its inner end; both have more terms than a double can tell.
    """
    step = lambda s, n: F.struct(
        (s["term"] * x / (2 * n + 1)).alias("term"), (s["total"] + s["term"] * x / (2 * n + 1)).alias("total")
    )
    one = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(80)), one, step)["total"]
    near = 1 - F.sqrt(2 * x / math.pi) * F.exp(-x / 2) * series
    fraction = F.aggregate(F.sequence(F.lit(120), F.lit(1), F.lit(-1)), F.lit(1.0), lambda f, k: 1 + k / x / f)
    return F.when(x <= 12, near).otherwise(F.sqrt(2 / (math.pi * x)) * F.exp(-x / 2) / fraction)


def p_value(test: DataFrame) -> DataFrame:
    """Adds the p-value, NULL where there is no statistic."""
    return test.withColumn("p_value", upper_tail(F.col("chi_square")))


def chi_square_mllib(predictions: DataFrame, feedback: DataFrame, champion: str, challenger: str) -> DataFrame:
    """The same test from Spark ML, as a cross-check: statistic and p-value."""
    verdicts = reviewed_correctness(predictions.filter(F.col("model_name").isin(champion, challenger)), feedback)
    coded = verdicts.select(
        F.when(F.col("model_name") == challenger, 1.0).otherwise(0.0).alias("model"),
        F.col("correct").cast("double").alias("label"),
    )
    vectors = VectorAssembler(inputCols=["model"], outputCol="features").transform(coded)
    result = ChiSquareTest.test(vectors, "features", "label", True)
    return result.select(F.col("statistic").alias("chi_square"), F.col("pValue").alias("p_value"))


def decide(test: DataFrame, min_reviewed: int = K.MIN_REVIEWED_PER_MODEL) -> DataFrame:
    """PROMOTE, ROLLBACK or KEEP TESTING the challenger.

    Too few reviews of either model, or no significant difference, keep the test running.
    """
    champion_n = F.col("champion_correct") + F.col("champion_wrong")
    challenger_n = F.col("challenger_correct") + F.col("challenger_wrong")
    difference: Column = F.col("challenger_accuracy") - F.col("champion_accuracy")
    enough = (champion_n >= min_reviewed) & (challenger_n >= min_reviewed)
    decision = (
        F.when(~enough | ~F.col("significant"), K.KEEP_TESTING)
        .when(difference > 0, K.PROMOTE)
        .when(difference < 0, K.ROLLBACK)
        .otherwise(K.KEEP_TESTING)
    )
    return test.select(
        "champion",
        "challenger",
        champion_n.alias("champion_reviewed"),
        challenger_n.alias("challenger_reviewed"),
        F.round(difference, 6).alias("accuracy_difference"),
        F.round("chi_square", 6).alias("chi_square"),
        "significant",
        decision.alias("decision"),
    )
