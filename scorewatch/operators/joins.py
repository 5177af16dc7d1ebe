"""Joins of predictions, feedback, image metadata and request logs.

Reports that only count reviews do not join feedback rows: they first tally the feedback per
prediction. The tally combines on the map side, so a prediction with a third of all reviews
arrives as a few partial rows, and its shuffle by ``prediction_id`` is the one the join needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import labels, numeric, payloads, times
from scorewatch.operators.skew import salted_join

HITS = "hits"
MISSES = "misses"
REVIEWS = "reviews"
OUTCOME_COUNTS = {
    "true_positives": K.TRUE_POSITIVE,
    "false_positives": K.FALSE_POSITIVE,
    "true_negatives": K.TRUE_NEGATIVE,
    "false_negatives": K.FALSE_NEGATIVE,
}


def outcome_tallies(outcome_col: str = "feedback_type") -> list[Column]:
    """Aggregates: one count per named outcome."""
    return [numeric.tally(F.col(outcome_col) == value).alias(name) for name, value in OUTCOME_COUNTS.items()]


def review_tallies(feedback: DataFrame) -> DataFrame:
    """One row per reviewed prediction: reviews, hits, misses and the four outcome counts."""
    return feedback.groupBy("prediction_id").agg(
        F.count("*").alias(REVIEWS),
        numeric.tally(labels.is_hit(F.col("feedback_type"))).alias(HITS),
        numeric.tally(labels.is_miss(F.col("feedback_type"))).alias(MISSES),
        *outcome_tallies(),
    )


def outcome_tallies_per_prediction(feedback: DataFrame) -> DataFrame:
    """One row per prediction and outcome value, unlisted and NULL outcomes included."""
    return feedback.groupBy("prediction_id", "feedback_type").agg(F.count("*").alias(REVIEWS))


def with_feedback(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Every review with its prediction, one row per review; hot predictions are spread."""
    return salted_join(feedback, predictions, "prediction_id", spread_by="feedback_id")


def requests_with_feedback(log: DataFrame, feedback: DataFrame) -> DataFrame:
    """Every review with the logged request it belongs to.

    The inner form of a left join that keeps rows with a feedback id.
    """
    request = log.select(
        F.col("request_id").alias("prediction_id"),
        "served_model_name",
        "response",
        "date",
        F.col("timestamp").alias("prediction_time"),
    )
    joined = salted_join(
        feedback.withColumnRenamed("timestamp", "feedback_time"), request, "prediction_id", spread_by="feedback_id"
    )
    return joined.withColumnRenamed("prediction_id", "request_id")


def performance_live(log: DataFrame, feedback: DataFrame) -> DataFrame:
    """One row per review of a logged request: model, score, label, truth, outcome, times."""
    score = payloads.response_score(F.col("response"))
    return requests_with_feedback(log, feedback).select(
        "request_id",
        "served_model_name",
        score.alias("prediction_score"),
        F.when(score > K.DECISION_THRESHOLD, K.POSITIVE_CLASS).otherwise(K.NEGATIVE_CLASS).alias("predicted_label"),
        "ground_truth",
        "feedback_type",
        labels.outcome_tristate(F.col("feedback_type")).alias("is_correct"),
        "radiologist_id",
        "confidence",
        "prediction_time",
        "feedback_time",
        F.col("date").alias("prediction_date"),
        "feedback_id",
    )


def create_performance_view(log: DataFrame, feedback: DataFrame, name: str = "model_performance_live") -> DataFrame:
    """Register ``performance_live`` under a name for SQL users, and return it."""
    performance_live(log, feedback).createOrReplaceTempView(name)
    return log.sparkSession.table(name)


def predictions_with_feedback(log: DataFrame, feedback: DataFrame, newest: int = 10) -> DataFrame:
    """The newest reviewed requests."""
    live = performance_live(log, feedback)
    top = live.orderBy(F.desc("prediction_time"), "request_id", "feedback_id").limit(newest)
    return top.drop("prediction_date", "feedback_id")


def unreviewed(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Predictions without any review.

    A true anti join against distinct ids; a left join with an IS NULL filter would carry every
    review through the shuffle.
    """
    reviewed = feedback.select("prediction_id").distinct()
    return predictions.join(reviewed, "prediction_id", "left_anti")


def lookup_rows(top: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join of a limited result (``top`` ends in a ``limit``) with a table of any size.

    The table is cut to the few wanted keys with a broadcast semi join, so it is scanned but not shuffled.
    Both broadcasts are bounded by the limit. The limited rows are asked for twice; what stands before their
    limit is the same exchange and runs once.
    """
    wanted = F.broadcast(top.select(key).distinct())
    return top.join(table.join(wanted, key, "left_semi"), key, "left")


def score_log(payload: DataFrame) -> DataFrame:
    """Successful calls of the payload log: model, score, time.

    The score passes through a one-element array: otherwise the NULL check that a join adds would
    parse every response a second time.
    """
    return payload.filter(F.col("status_code") == 200).select(
        payloads.metadata_value(F.col("request_metadata"), "model_name").alias("logged_model"),
        F.explode(F.array(payloads.response_score(F.col("response")))).alias("logged_score"),
        F.col("timestamp_ms"),
    )


def _time_buckets(ms: Column, band_ms: int, width: int) -> Column:
    """Every bucket that the band around a time touches: 1 + 2 * band / width of them on average."""
    bucket = lambda at: F.floor(at / F.lit(width))
    return F.explode(F.sequence(bucket(ms - (band_ms - 1)), bucket(ms + (band_ms - 1))))


def band_join(
    left: DataFrame,
    right: DataFrame,
    left_ms: str,
    right_ms: str,
    band_ms: int,
    equal: list[tuple[str, str]],
    bucket_factor: int = 4,
) -> DataFrame:
    """Pairs with equal keys and ``abs(left_ms - right_ms) < band_ms``.

    Time is cut into buckets of ``bucket_factor`` bands. A left row lies in one bucket, a right row
    is repeated in each bucket its band touches, so this is an equi join on (keys, bucket) with the
    band as residual and no pair is met twice. Callers pass rows that are already counted per key
    and time, so one key with very many rows at one time is one row here.
    """
    width = band_ms * bucket_factor
    a = left.withColumn("_bucket", F.floor(F.col(left_ms) / F.lit(width)))
    b = right.withColumn("_right_bucket", _time_buckets(F.col(right_ms), band_ms, width))
    condition = (F.col("_bucket") == F.col("_right_bucket")) & (
        F.abs(F.col(left_ms) - F.col(right_ms)) < F.lit(band_ms)
    )
    for left_key, right_key in equal:
        condition = condition & (F.col(left_key) == F.col(right_key))
    return a.join(b, condition, "inner").drop("_bucket", "_right_bucket")


def call_points(payload: DataFrame, model: Column | None = None) -> DataFrame:
    """Successful calls counted per score, time and model."""
    name = F.col("logged_model") if model is None else model
    return (
        score_log(payload)
        .groupBy("logged_score", "timestamp_ms", name.alias("logged_model"))
        .agg(F.count("*").alias("calls"))
    )


POINT = ["prediction_probability", "predicted_ms"]


def at_points(rows: DataFrame) -> DataFrame:
    """Rows with the whole second of their prediction; with the score it makes the point that calls match."""
    return rows.withColumn("predicted_ms", times.epoch_ms(F.col("predicted_at")))


def calls_at_points(timed: DataFrame, payload: DataFrame, band_ms: int = K.ATTRIBUTION_BAND_MS) -> DataFrame:
    """Per point and model that served it: the calls in the band and the nearest one's distance."""
    near = band_join(
        timed.select(*POINT).distinct(),
        call_points(payload),
        "predicted_ms",
        "timestamp_ms",
        band_ms,
        equal=[("prediction_probability", "logged_score")],
    )
    return near.groupBy(*POINT, "logged_model").agg(
        F.sum("calls").alias("matches"),
        F.min(F.abs(F.col("timestamp_ms") - F.col("predicted_ms"))).alias("nearest_ms"),
    )


def matched_calls(
    rows: DataFrame, payload: DataFrame, band_ms: int = K.ATTRIBUTION_BAND_MS, spread_by: str | None = None
) -> DataFrame:
    """Rows with each model that served their score at their time.

    ``rows`` holds ``prediction_probability`` and ``predicted_at``. There is no shared id: a
    prediction belongs to the calls with its score less than ``band_ms`` away. Adds
    ``logged_model``, ``matches`` (calls in the band) and ``nearest_ms``. Prediction times count in
    whole seconds, so a call meets at most ``2 * band`` seconds of distinct times, however many
    rows share them; pairs of single rows are never formed. Scores are compared as numbers. With
    ``spread_by`` (an id of the rows) a score and second that many rows share is spread.
    """
    timed = at_points(rows)
    per_model = calls_at_points(timed, payload, band_ms)
    found = salted_join(timed, per_model, POINT, spread_by) if spread_by else timed.join(per_model, POINT)
    return found.drop("predicted_ms")


def newest_matched(
    rows: DataFrame, payload: DataFrame, order: list[Column], newest: int, spread_by: str, band_ms: int = K.ATTRIBUTION_BAND_MS
) -> DataFrame:
    """The first ``newest`` rows in an order that any call matches, with each model that served them.

    Points decide whether a row is matched; only the rows that remain after the limit are attributed. A point
    that many rows share is spread.
    """
    timed = at_points(rows)
    per_model = calls_at_points(timed, payload, band_ms)
    served = per_model.select(*POINT).distinct()
    top = salted_join(timed, served, POINT, spread_by, how="left_semi").orderBy(*order).limit(newest)
    return top.join(per_model, POINT).drop("predicted_ms")


def log_attribution(
    predictions: DataFrame, payload: DataFrame, band_ms: int = K.ATTRIBUTION_BAND_MS
) -> DataFrame:
    """Prediction and served model with the number of matching calls and the nearest one.

    Joining row by row would repeat a prediction ``matches`` times.
    """
    rows = predictions.select("prediction_id", "image_id", "predicted_at", "prediction_probability")
    return matched_calls(rows, payload, band_ms, spread_by="prediction_id").select(
        "prediction_id",
        "image_id",
        "predicted_at",
        "prediction_probability",
        F.col("logged_model").alias("model_name"),
        "matches",
        "nearest_ms",
    )


def nearest_in_band(
    points: DataFrame, calls: DataFrame, keys: list[str], band_ms: int, bucket_factor: int = 4
) -> DataFrame:
    """Calls around each point: how many in the band, and the nearest before and after.

    ``points`` has distinct (keys, ``at_ms``); ``calls`` has distinct (keys, ``at_ms``) with
    ``calls`` and ``tag``. Both are sorted together inside (keys, time bucket) and read off with
    running frames, so the work grows with the rows and not with the pairs. Points without a call
    in the band are left out.
    """
    width = band_ms * bucket_factor
    at = F.col("at_ms")
    asked = points.select(
        *keys, "at_ms", F.lit(0).cast("long").alias("calls"), F.lit(None).cast("string").alias("tag"),
        F.lit(True).alias("asked"), F.floor(at / F.lit(width)).alias("_bucket"),
    )
    known = calls.select(
        *keys, "at_ms", "calls", "tag", F.lit(False).alias("asked"),
        _time_buckets(at, band_ms, width).alias("_bucket"),
    )
    up = Window.partitionBy(*keys, "_bucket").orderBy(at)
    down = Window.partitionBy(*keys, "_bucket").orderBy(at.desc())
    first = Window.unboundedPreceding
    call = F.when(~F.col("asked"), F.struct("at_ms", "tag"))
    upto_band, before_band = (F.sum("calls").over(up.rangeBetween(first, end)) for end in (band_ms - 1, -band_ms))
    placed = (
        asked.unionByName(known)
        .select(
            *keys,
            "at_ms",
            "asked",
            (upto_band - F.coalesce(before_band, F.lit(0))).alias("calls_in_band"),
            F.last(call, ignorenulls=True).over(up.rangeBetween(first, 0)).alias("before"),
            F.last(call, ignorenulls=True).over(down.rangeBetween(first, 0)).alias("after"),
        )
        .filter(F.col("asked") & (F.col("calls_in_band") > 0))
    )
    distance = lambda side: F.when(
        F.abs(F.col(f"{side}.at_ms") - at) < band_ms,
        F.struct(
            F.abs(F.col(f"{side}.at_ms") - at).alias("nearest_ms"),
            F.col(f"{side}.at_ms").alias("call_ms"),
            F.col(f"{side}.tag").alias("tag"),
        ),
    )
    return placed.select(
        *keys, "at_ms", "calls_in_band", F.least(distance("before"), distance("after")).alias("nearest")
    )


def log_attribution_nearest(
    predictions: DataFrame, payload: DataFrame, band_ms: int = K.ATTRIBUTION_BAND_MS, precise: bool = True
) -> DataFrame:
    """At most one call per prediction: nearest in time, then earliest, then by model name.

    Prediction times count in milliseconds, or in whole seconds unless ``precise``.
    """
    timed = predictions.select(
        "prediction_id",
        "image_id",
        "prediction_probability",
        times.epoch_ms(F.col("predicted_at"), precise).alias("at_ms"),
    )
    calls = (
        score_log(payload)
        .groupBy(F.col("logged_score").alias("prediction_probability"), F.col("timestamp_ms").alias("at_ms"))
        .agg(F.count("*").alias("calls"), F.min("logged_model").alias("tag"))
    )
    point = ["prediction_probability", "at_ms"]
    found = nearest_in_band(timed.select(*point).distinct(), calls, ["prediction_probability"], band_ms)
    return salted_join(timed, found, point, spread_by="prediction_id").select(
        "prediction_id",
        "image_id",
        "prediction_probability",
        F.col("nearest.tag").alias("model_name"),
        F.col("nearest.call_ms").alias("timestamp_ms"),
        (F.col("nearest.call_ms") - F.col("at_ms")).alias("delta_ms"),
    )


def calls_near(predictions: DataFrame, payload: DataFrame, band_ms: int = K.ATTRIBUTION_BAND_MS) -> DataFrame:
    """How many successful calls fall within the band of each prediction, whatever their score.

    By time alone, without an equal key.
    """
    timed = predictions.select("prediction_id", times.epoch_ms(F.col("predicted_at")).alias("at_ms"))
    calls = (
        payload.filter(F.col("status_code") == 200)
        .groupBy(F.col("timestamp_ms").alias("at_ms"))
        .agg(F.count("*").alias("calls"), F.lit(None).cast("string").alias("tag"))
    )
    found = nearest_in_band(timed.select("at_ms").distinct(), calls, [], band_ms)
    return salted_join(timed, found, "at_ms", spread_by="prediction_id").select(
        "prediction_id", "calls_in_band", F.col("nearest.nearest_ms").alias("nearest_ms")
    )


def reviewer_disagreement(feedback: DataFrame) -> DataFrame:
    """Predictions whose reviews name different truths.

    Counts per prediction; the number of disagreeing pairs follows from them in closed form, so
    pairs of reviews are never formed.
    """
    per_truth = feedback.groupBy("prediction_id", "ground_truth").agg(
        F.count("*").alias("votes"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )
    votes = F.sum("votes")
    return (
        per_truth.groupBy("prediction_id")
        .agg(
            votes.alias("reviews"),
            F.count("*").alias("distinct_truths"),
            ((votes * votes - F.sum(F.col("votes") * F.col("votes"))) / 2).cast("long").alias("disagreeing_pairs"),
            F.min("first").alias("first_review"),
            F.max("last").alias("last_review"),
        )
        .filter(F.col("distinct_truths") > 1)
    )
