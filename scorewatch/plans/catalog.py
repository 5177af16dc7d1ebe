"""Every registered query: name -> (session, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import labels, payloads, texts, times
from scorewatch.operators import abtest, evaluation, ingest, joins, metrics, monitor, quality, review, sampling, scoring
from scorewatch.schemas import FEEDBACK, conform
from scorewatch.session import shared_folder
from scorewatch.sources import files, keyed, tables, testbed
from scorewatch.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries, shared with their SQL equivalents.
RUN_TIME = "2024-02-01 00:00:00"
SOURCE_TIME = "2024-01-30T12:00:00Z"
LOOKUP_IMAGE = "42"
SUMMARY_BATCH = "20240106_060000"
PRUNE_FROM, PRUNE_TO = "2024-01-10", "2024-01-16"
BATCH_REVIEWER = "DR_BATCH"
PER_CLASS = 50
QUOTAS = {K.NEGATIVE_CLASS: 3, K.POSITIVE_CLASS: 2}
THRESHOLDS = (0.1, 0.3, 0.5, 0.7, 0.9)
TRAFFIC = ((testbed.CHAMPION, 90), (testbed.CHALLENGER, 10))
VECTOR_SIZE = 64
BIAS = 0.1
WEIGHTS = [((i * 7) % 11 - 5) / 10.0 for i in range(VECTOR_SIZE)]

QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Result columns in zone-less types: UTC timestamps without zone, dates as ISO text."""
    changed = {
        name: F.col(f"`{name}`").cast("timestamp_ntz") if kind == "timestamp" else F.date_format(f"`{name}`", "yyyy-MM-dd")
        for name, kind in df.dtypes
        if kind in ("timestamp", "date")
    }
    return df.withColumns(changed) if changed else df


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # days and epochs are UTC
            return plain(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return register


def _run_time():
    return F.lit(RUN_TIME).cast("timestamp")


def _as_of(log: DataFrame):
    """Date of the newest request, in place of today's date."""
    return log.agg(F.max("date")).scalar()


# --- tables, loads and files -------------------------------------------------------------------


def _listing(spark, sf_dir):
    folder = shared_folder(spark, "files")
    records = testbed.images(spark, sf_dir).select("category", F.concat_ws(" ", "image_id", "file_path").alias("value"))
    records.write.partitionBy("category").option("maxRecordsPerFile", 500).text(folder)
    return files.list_images(spark, folder, _run_time(), suffix=".txt")


@query("file_listing")
def _file_listing(spark, sf_dir):
    """Customer records written as files of up to 500 records, one folder per class, then listed."""
    return _listing(spark, sf_dir)


@query("file_listing_totals")
def _file_listing_totals(spark, sf_dir):
    """Bytes per class of the same files, whose number depends on the run."""
    return _listing(spark, sf_dir).groupBy("category").agg(F.sum("file_size_bytes").alias("total_bytes"))


@query("conform_schema")
def _conform_schema(spark, sf_dir):
    raw = testbed.feedback(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("string"))
    return conform(raw.drop("notes").withColumn("extra", F.lit(1)), FEEDBACK)


@query("write_overwrite")
def _write_overwrite(spark, sf_dir):
    """A first load creates the table, a later one takes its place."""
    path = shared_folder(spark, "images")
    name = path.rpartition("/")[2].replace("-", "_")
    images = testbed.images(spark, sf_dir)
    tables.create_or_replace(images.limit(0), name, path)
    if tables.table_exists(spark, name):
        tables.create_or_replace(images, name, path)
    return spark.table(name)


@query("append_rows")
def _append_rows(spark, sf_dir):
    path = shared_folder(spark, "feedback")
    feedback = testbed.feedback(spark, sf_dir)
    second = F.col("feedback_id").startswith("fb2-")
    tables.overwrite(conform(feedback.filter(~second), FEEDBACK), path)
    tables.append(feedback.filter(second).withColumn("timestamp", F.col("timestamp").cast("string")), path, FEEDBACK)
    return spark.read.schema(FEEDBACK).parquet(path)


@query("upsert_by_key")
def _upsert_by_key(spark, sf_dir):
    stored, batch = testbed.image_reload(spark, sf_dir)
    root = shared_folder(spark, "images")
    for number, load in enumerate((stored, batch)):
        keyed.merge(ingest.unique_by_key(load, "image_id"), root, "image_id", number)
    return keyed.read(spark, root)


@query("migrate_log")
def _migrate_log(spark, sf_dir):
    return ingest.migrate_log(testbed.request_log(spark, sf_dir))


@query("freshness_gate")
def _freshness_gate(spark, sf_dir):
    return ingest.freshness_gate(testbed.images(spark, sf_dir), times.parse_source_time(F.lit(SOURCE_TIME)))


@query("incremental_slice")
def _incremental_slice(spark, sf_dir):
    since = ingest.high_water_mark(testbed.images(spark, sf_dir), "ingested_at")
    events = testbed.table(spark, sf_dir, "events")
    return ingest.incremental_slice(events, "ts", since).select("event_id", "ts", "event_type")


@query("batch_stamp")
def _batch_stamp(spark, sf_dir):
    images = testbed.images(spark, sf_dir).drop("ingested_at", "ingestion_batch_id")
    return ingest.stamp_batch(images, _run_time()).select("image_id", "ingested_at", "ingestion_batch_id")


@query("partition_prune")
def _partition_prune(spark, sf_dir):
    path = shared_folder(spark, "predictions")
    tables.write_by_date(testbed.predictions(spark, sf_dir), path, "prediction_date")
    rows = tables.read_dates(spark, path, "prediction_date", PRUNE_FROM, PRUNE_TO)
    return rows.select("prediction_id", "predicted_label", "prediction_probability", "prediction_date")


@query("change_feed")
def _change_feed(spark, sf_dir):
    return ingest.change_feed(*testbed.event_versions(spark, sf_dir), key="event_id")


@query("csv_roundtrip")
def _csv_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "export")
    tables.write_csv(testbed.feedback(spark, sf_dir), path)
    return tables.read_csv(spark, path, FEEDBACK)


@query("batch_count")
def _batch_count(spark, sf_dir):
    return ingest.batch_count(testbed.images(spark, sf_dir))


@query("count_by_category")
def _count_by_category(spark, sf_dir):
    return ingest.count_by_category(testbed.images(spark, sf_dir))


@query("ingest_summary")
def _ingest_summary(spark, sf_dir):
    """All batches; ``ingest_summary_batch`` reports one."""
    return ingest.ingest_summary(testbed.images(spark, sf_dir))


@query("ingest_summary_batch")
def _ingest_summary_batch(spark, sf_dir):
    return ingest.ingest_summary(testbed.images(spark, sf_dir), SUMMARY_BATCH)


@query("sample_rows")
def _sample_rows(spark, sf_dir):
    return ingest.sample_rows(testbed.images(spark, sf_dir), 10)


@query("lookup_by_id")
def _lookup_by_id(spark, sf_dir):
    return ingest.lookup_by_id(testbed.images(spark, sf_dir), LOOKUP_IMAGE)


# --- column functions --------------------------------------------------------------------------


@query("decode_label")
def _decode_label(spark, sf_dir):
    return testbed.predictions(spark, sf_dir).select(
        "prediction_id",
        labels.decode_label(F.col("predicted_label")).alias("predicted"),
        labels.decode_label(F.col("true_label")).alias("true_diagnosis"),
        labels.encode_label(labels.decode_label(F.col("true_label"))).alias("true_label"),
    )


@query("score_to_prediction")
def _score_to_prediction(spark, sf_dir):
    score = F.col("prediction_probability")
    return testbed.predictions(spark, sf_dir).select(
        "prediction_id",
        labels.score_to_label(score).alias("predicted_label"),
        labels.confidence(score).alias("confidence_score"),
        (labels.score_to_label(score) == F.col("true_label")).alias("is_correct"),
    )


def _assessed(spark, sf_dir):
    """Reviews as reviewer sheet rows; NULL and blank assessments come from the reviewer column."""
    predicted = testbed.predictions(spark, sf_dir).select(
        "prediction_id", labels.decode_label(F.col("predicted_label")).alias("ai_prediction")
    )
    assessment = F.when(F.col("radiologist_id") == "DR3", "").when(F.col("radiologist_id") == "DR5", "OTHER").otherwise(
        F.when(F.col("radiologist_id").isNotNull(), F.col("ground_truth"))
    )
    sheet = testbed.feedback(spark, sf_dir).select("feedback_id", "prediction_id", assessment.alias("radiologist_assessment"))
    return joins.with_feedback(predicted, sheet)


@query("classify_outcome")
def _classify_outcome(spark, sf_dir):
    result = labels.outcome(F.col("ai_prediction"), F.col("radiologist_assessment"))
    return _assessed(spark, sf_dir).withColumn("feedback_type", result)


@query("classify_outcome_strict")
def _classify_outcome_strict(spark, sf_dir):
    return review.classify_assessments(_assessed(spark, sf_dir))


@query("outcome_tristate")
def _outcome_tristate(spark, sf_dir):
    return testbed.feedback(spark, sf_dir).select(
        "feedback_id",
        labels.outcome_tristate(F.col("feedback_type")).alias("is_correct"),
        labels.correctness(F.col("feedback_type")).alias("correctness"),
    )


@query("model_family")
def _model_family(spark, sf_dir):
    log = testbed.payload_log(spark, sf_dir)
    name = payloads.metadata_value(F.col("request_metadata"), "model_name")
    return log.groupBy(name.alias("model_name"), labels.model_family(name).alias("family")).agg(F.count("*").alias("calls"))


@query("normalize_path")
def _normalize_path(spark, sf_dir):
    return ingest.normalize_paths(testbed.images(spark, sf_dir))


@query("image_labels")
def _image_labels(spark, sf_dir):
    return ingest.image_labels(testbed.images(spark, sf_dir))


@query("surrogate_ids")
def _surrogate_ids(spark, sf_dir):
    key = [F.col("prediction_id"), F.col("radiologist_id"), F.col("ground_truth")]
    return testbed.feedback(spark, sf_dir).select("feedback_id", texts.derived_id(K.FEEDBACK_ID_PREFIX, *key).alias("derived_id"))


@query("timestamp_formats")
def _timestamp_formats(spark, sf_dir):
    iso = F.date_format("predicted_at", K.SOURCE_TIME_FORMAT)
    return testbed.predictions(spark, sf_dir).select(
        "prediction_id",
        times.display_time(F.col("predicted_at")).alias("display_text"),
        iso.alias("iso_text"),
        times.parse_source_time(iso).alias("parsed_at"),
        times.epoch_ms(F.col("predicted_at")).alias("whole_second_ms"),
        times.from_epoch_ms(times.epoch_ms(F.col("predicted_at"), precise=True)).alias("from_ms"),
    )


@query("json_score")
def _json_score(spark, sf_dir):
    return testbed.request_log(spark, sf_dir).select(
        "request_id",
        payloads.response_score(F.col("response")).alias("score"),
        texts.version_suffix(F.col("served_model_name")).alias("version"),
    )


# --- joins -------------------------------------------------------------------------------------


def _tables(spark, sf_dir):
    return testbed.predictions(spark, sf_dir), testbed.feedback(spark, sf_dir)


@query("pending_feedback")
def _pending_feedback(spark, sf_dir):
    return review.pending_feedback(*_tables(spark, sf_dir))


@query("pending_all")
def _pending_all(spark, sf_dir):
    """The whole queue, without the display limit."""
    return review.pending_feedback(*_tables(spark, sf_dir), newest=None)


@query("predictions_with_feedback")
def _predictions_with_feedback(spark, sf_dir):
    return joins.predictions_with_feedback(testbed.request_log(spark, sf_dir), testbed.feedback(spark, sf_dir))


@query("performance_live")
def _performance_live(spark, sf_dir):
    return joins.create_performance_view(testbed.request_log(spark, sf_dir), testbed.feedback(spark, sf_dir))


@query("review_queue")
def _review_queue(spark, sf_dir):
    return review.review_queue(*_tables(spark, sf_dir), testbed.images(spark, sf_dir))


@query("review_queue_filtered")
def _review_queue_filtered(spark, sf_dir):
    return review.review_queue_filtered(
        *_tables(spark, sf_dir),
        testbed.images(spark, sf_dir),
        from_date=PRUNE_FROM,
        to_date=PRUNE_TO,
        model_name=testbed.CHAMPION,
        min_confidence=0.7,
    )


@query("review_queue_display")
def _review_queue_display(spark, sf_dir):
    return review.queue_display(review.review_queue(*_tables(spark, sf_dir), testbed.images(spark, sf_dir)))


@query("batch_feedback")
def _batch_feedback(spark, sf_dir):
    return review.batch_feedback(*_tables(spark, sf_dir), BATCH_REVIEWER, _run_time(), min_confidence=0.8)


@query("log_attribution")
def _log_attribution(spark, sf_dir):
    return joins.log_attribution(testbed.predictions(spark, sf_dir), testbed.payload_log(spark, sf_dir))


@query("log_attribution_nearest")
def _log_attribution_nearest(spark, sf_dir):
    return joins.log_attribution_nearest(testbed.predictions(spark, sf_dir), testbed.payload_log(spark, sf_dir))


@query("band_join_bucketed")
def _band_join_bucketed(spark, sf_dir):
    return joins.calls_near(testbed.predictions(spark, sf_dir), testbed.payload_log(spark, sf_dir), band_ms=60000)


@query("reviewer_disagreement")
def _reviewer_disagreement(spark, sf_dir):
    return joins.reviewer_disagreement(testbed.feedback(spark, sf_dir))


@query("latest_feedback")
def _latest_feedback(spark, sf_dir):
    return review.latest_feedback(testbed.feedback(spark, sf_dir))


@query("review_progress")
def _review_progress(spark, sf_dir):
    return review.review_progress(*_tables(spark, sf_dir))


@query("recent_predictions")
def _recent_predictions(spark, sf_dir):
    return metrics.recent_predictions(testbed.predictions(spark, sf_dir))


# --- reports -----------------------------------------------------------------------------------


@query("model_metrics")
def _model_metrics(spark, sf_dir):
    return metrics.model_metrics(*_tables(spark, sf_dir))


@query("model_metrics_basic")
def _model_metrics_basic(spark, sf_dir):
    return metrics.model_metrics_basic(*_tables(spark, sf_dir))


for _name, _report in {
    "outcome_distribution": metrics.outcome_distribution,
    "outcome_counts": metrics.outcome_counts,
    "confusion_grid": metrics.confusion_grid,
    "daily_performance": metrics.daily_performance,
    "daily_performance_pct": metrics.daily_performance_pct,
    "daily_accuracy": metrics.daily_accuracy,
    "daily_error_rate": metrics.daily_error_rate,
    "reviewer_summary": metrics.reviewer_summary,
    "reviewer_agreement": metrics.reviewer_agreement,
}.items():
    query(_name)(lambda spark, sf_dir, report=_report: report(testbed.feedback(spark, sf_dir)))

for _name, _report in {
    "confidence_by_outcome": metrics.confidence_by_outcome,
    "confidence_histogram": metrics.confidence_histogram,
    "error_analysis": metrics.error_analysis,
    "feedback_coverage": metrics.feedback_coverage,
    "accuracy_trend": monitor.accuracy_trend,
    "rolling_accuracy": monitor.rolling_accuracy,
    "drift_alert": monitor.drift_alert,
    "health_flags": monitor.health_flags,
    "late_rows": monitor.late_rows,
    "late_summary": monitor.late_summary,
}.items():
    query(_name)(lambda spark, sf_dir, report=_report: report(*_tables(spark, sf_dir)))


@query("errors_by_split")
def _errors_by_split(spark, sf_dir):
    return metrics.errors_by_split(*_tables(spark, sf_dir), testbed.images(spark, sf_dir))


@query("accuracy_by_size")
def _accuracy_by_size(spark, sf_dir):
    return metrics.accuracy_by_size(*_tables(spark, sf_dir), testbed.images(spark, sf_dir))


@query("confusion_by_model")
def _confusion_by_model(spark, sf_dir):
    return metrics.confusion_by_model(*_tables(spark, sf_dir), testbed.payload_log(spark, sf_dir))


@query("false_positive_feed")
def _false_positive_feed(spark, sf_dir):
    return metrics.false_positive_feed(*_tables(spark, sf_dir), testbed.payload_log(spark, sf_dir))


@query("traffic_share_7d")
def _traffic_share_7d(spark, sf_dir):
    log = testbed.request_log(spark, sf_dir)
    return metrics.traffic_share(log, _as_of(log))


for _name, _report in {
    "feedback_coverage_7d": metrics.feedback_coverage_recent,
    "served_accuracy_7d": metrics.served_accuracy_recent,
    "served_confusion_7d": metrics.served_confusion_recent,
    "served_daily": metrics.served_daily,
}.items():

    def _served(spark, sf_dir, report=_report):
        log = testbed.request_log(spark, sf_dir)
        return report(log, testbed.feedback(spark, sf_dir), _as_of(log))

    query(_name)(_served)


@query("served_accuracy")
def _served_accuracy(spark, sf_dir):
    return metrics.served_accuracy(testbed.request_log(spark, sf_dir), testbed.feedback(spark, sf_dir))


# --- evaluation --------------------------------------------------------------------------------


@query("binary_eval")
def _binary_eval(spark, sf_dir):
    by = ["model_name", "model_version"]
    return evaluation.binary_eval(testbed.predictions(spark, sf_dir), "true_label", "predicted_label", by=by)


@query("auc_exact")
def _auc_exact(spark, sf_dir):
    return evaluation.auc(testbed.evaluation_pairs(spark, sf_dir)).withColumn("auc", F.round("auc", 9))


@query("auc_by_model")
def _auc_by_model(spark, sf_dir):
    areas = evaluation.auc(testbed.predictions(spark, sf_dir), "true_label", "prediction_probability", by=["model_name"])
    return areas.withColumn("auc", F.round("auc", 9))


@query("auc_mllib")
def _auc_mllib(spark, sf_dir):
    return evaluation.auc_mllib(testbed.evaluation_pairs(spark, sf_dir))


@query("log_loss")
def _log_loss(spark, sf_dir):
    result = evaluation.log_loss(testbed.evaluation_pairs(spark, sf_dir))
    return result.withColumns({"log_loss": F.round("log_loss", 6), "accuracy": F.round("accuracy", 6)})


@query("threshold_sweep")
def _threshold_sweep(spark, sf_dir):
    return evaluation.threshold_sweep(testbed.scored_pairs(spark, sf_dir), THRESHOLDS)


@query("confusion_json")
def _confusion_json(spark, sf_dir):
    counts = evaluation.binary_eval(testbed.predictions(spark, sf_dir), "true_label", "predicted_label", by=["model_name"])
    return counts.select("model_name", evaluation.confusion_json().alias("confusion_matrix"))


@query("evaluation_run")
def _evaluation_run(spark, sf_dir):
    run = evaluation.evaluation_run(testbed.predictions(spark, sf_dir), testbed.images(spark, sf_dir), _run_time())
    return run.withColumn("auc_roc", F.round("auc_roc", 9))


@query("split_exact")
def _split_exact(spark, sf_dir):
    return sampling.exact_split(testbed.images(spark, sf_dir).select("image_id", "category"), "image_id")


@query("split_hash")
def _split_hash(spark, sf_dir):
    return sampling.hash_split(testbed.images(spark, sf_dir).select("image_id", "category"), "image_id")


@query("sample_per_class")
def _sample_per_class(spark, sf_dir):
    rows = testbed.images(spark, sf_dir).select("image_id", "category")
    return sampling.first_per_class(rows, "category", "image_id", PER_CLASS)


@query("stratified_quota")
def _stratified_quota(spark, sf_dir):
    rows = testbed.images(spark, sf_dir).select("image_id", "category")
    return sampling.first_per_class(rows, "category", "image_id", QUOTAS)


@query("ab_assign")
def _ab_assign(spark, sf_dir):
    return sampling.assign_variant(testbed.images(spark, sf_dir).select("image_id"), "image_id", TRAFFIC)


@query("batch_score")
def _batch_score(spark, sf_dir):
    return _rounded_scores(scoring.batch_score(testbed.vectors(spark, sf_dir), WEIGHTS, BIAS))


@query("batch_score_pandas")
def _batch_score_pandas(spark, sf_dir):
    load = lambda: scoring.LogisticModel(WEIGHTS, BIAS)
    return _rounded_scores(scoring.batch_score_pandas(testbed.vectors(spark, sf_dir), load))


def _rounded_scores(scored: DataFrame) -> DataFrame:
    return scored.withColumns(
        {
            "prediction_probability": F.round("prediction_probability", 6),
            "confidence_score": F.round("confidence_score", 6),
        }
    )


@query("prediction_log")
def _prediction_log(spark, sf_dir):
    scored = scoring.batch_score(testbed.vectors(spark, sf_dir), WEIGHTS, BIAS)
    log = scoring.prediction_log(scored, testbed.images(spark, sf_dir), "clf", "1", _run_time())
    return _rounded_scores(log)


@query("scale_vector")
def _scale_vector(spark, sf_dir):
    scaled = scoring.scale_vectors(testbed.vectors(spark, sf_dir))
    return scaled.select("image_id", F.posexplode("feature_vector").alias("position", "value")).withColumn(
        "value", F.round("value", 9)
    )


@query("vector_stats")
def _vector_stats(spark, sf_dir):
    stats = scoring.vector_stats(testbed.vectors(spark, sf_dir))
    return stats.withColumns(
        {"mean_pixel_value": F.round("mean_pixel_value", 6), "std_pixel_value": F.round("std_pixel_value", 6)}
    )


@query("image_features")
def _image_features(spark, sf_dir):
    features = scoring.image_features(testbed.vectors(spark, sf_dir), "embedding-64", _run_time())
    return features.select(
        "image_id",
        F.size("feature_vector").alias("vector_length"),
        "feature_extraction_model",
        F.round("mean_pixel_value", 6).alias("mean_pixel_value"),
        F.round("std_pixel_value", 6).alias("std_pixel_value"),
        "extracted_at",
    )


@query("retrain_set")
def _retrain_set(spark, sf_dir):
    predictions, feedback = _tables(spark, sf_dir)
    needed = feedback.select("prediction_id", "timestamp", "feedback_id", "ground_truth", "feedback_type")
    rows = scoring.retrain_set(review.latest_feedback(needed), predictions, testbed.vectors(spark, sf_dir))
    return rows.select("image_id", "label", "reviews", F.size("feature_vector").alias("vector_length"))


# --- quality, significance ---------------------------------------------------------------------


@query("silver_transform")
def _silver_transform(spark, sf_dir):
    return quality.silver_transform(testbed.images(spark, sf_dir), _run_time())


@query("quality_report")
def _quality_report(spark, sf_dir):
    return quality.quality_report(testbed.images(spark, sf_dir), *_tables(spark, sf_dir))


def _chi_square(spark, sf_dir):
    return abtest.chi_square(*_tables(spark, sf_dir), testbed.CHAMPION, testbed.CHALLENGER)


@query("ab_chi_square")
def _ab_chi_square(spark, sf_dir):
    digits = ("champion_accuracy", "challenger_accuracy", "chi_square")
    return _chi_square(spark, sf_dir).withColumns({c: F.round(c, 6) for c in digits})


@query("ab_p_value")
def _ab_p_value(spark, sf_dir):
    tested = abtest.p_value(_chi_square(spark, sf_dir)).select("champion", "challenger", "chi_square", "p_value")
    return tested.withColumns({c: F.round(c, 6) for c in ("chi_square", "p_value")})


@query("ab_decision")
def _ab_decision(spark, sf_dir):
    return abtest.decide(_chi_square(spark, sf_dir))


# --- streams -----------------------------------------------------------------------------------


def _feedback_stream(spark, sf_dir):
    return testbed.feedback_from(testbed.event_stream(spark, sf_dir))


def _partitions(spark):
    """State partitions for the small test tables: one wave of tasks."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _windows(spark, sf_dir, purpose, *shape):
    root = shared_folder(spark, purpose)
    windows = streams.outcome_windows(_feedback_stream(spark, sf_dir), *shape)
    streams.keep_windows(windows, f"{root}/rows", f"{root}/checkpoint", _partitions(spark))
    return streams.read_windows(spark, f"{root}/rows")


@query("stream_daily_error_rate")
def _stream_daily_error_rate(spark, sf_dir):
    return streams.error_rates(_windows(spark, sf_dir, "daily-errors", "1 day"))


@query("stream_sliding_accuracy")
def _stream_sliding_accuracy(spark, sf_dir):
    return streams.accuracies(_windows(spark, sf_dir, "sliding-accuracy", "7 days", "1 day"))


@query("stream_review_sessions")
def _stream_review_sessions(spark, sf_dir):
    closed = streams.materialize(streams.review_sessions(_feedback_stream(spark, sf_dir)), "sessions", _partitions(spark))
    return streams.with_open_sessions(closed, testbed.feedback(spark, sf_dir))


@query("stream_feedback_join")
def _stream_feedback_join(spark, sf_dir):
    """The most reviewed predictions so far are spread, however few their reviews, so that every run takes that way."""
    root = shared_folder(spark, "reviewed-keys")
    streams.watch_keys(_feedback_stream(spark, sf_dir), "prediction_id", f"{root}/sketches", f"{root}/checkpoint")
    hot = streams.hot_keys(spark, f"{root}/sketches", most=16, share=0.0)
    predictions = testbed.predictions_from(testbed.event_stream(spark, sf_dir))
    spread = streams.feedback_join(predictions, _feedback_stream(spark, sf_dir), hot=hot)
    joined = streams.settle_hot(streams.materialize(spread, "feedback-join", _partitions(spark)), hot)
    return streams.with_waiting(joined, testbed.predictions(spark, sf_dir))


@query("stream_late_split")
def _stream_late_split(spark, sf_dir):
    """Reviews arrive in the order of their predictions, eight days at a time; each arrival is one batch."""
    root = shared_folder(spark, "late-split")
    for part in range(testbed.ARRIVALS):
        testbed.feedback_arrival(spark, sf_dir, part).write.mode("append").parquet(f"{root}/arrived")
        arrived = spark.readStream.schema(FEEDBACK).parquet(f"{root}/arrived")
        streams.split_late(arrived, "timestamp", root, f"{root}/checkpoint")
    columns = ["feedback_id", "timestamp", "batch_id"]
    late = spark.read.parquet(f"{root}/late").select(*columns, "watermark").withColumn("late", F.lit(True))
    on_time = spark.read.parquet(f"{root}/on_time").select(*columns).withColumn("late", F.lit(False))
    return late.unionByName(on_time, allowMissingColumns=True).withColumn("batch_id", F.col("batch_id").cast("long"))


@query("stream_dedup")
def _stream_dedup(spark, sf_dir):
    root = shared_folder(spark, "dedup")
    keys = ["prediction_id", "ground_truth"]
    streams.deduplicate(_feedback_stream(spark, sf_dir), keys, f"{root}/rows", f"{root}/checkpoint")
    return keyed.read(spark, f"{root}/rows")


@query("stream_upsert")
def _stream_upsert(spark, sf_dir):
    root = shared_folder(spark, "loads")
    log = testbed.request_log_from(testbed.event_stream(spark, sf_dir))
    streams.load_batches(ingest.migrate_log(log), f"{root}/rows", "prediction_id", "predicted_at", f"{root}/checkpoint")
    return keyed.read(spark, f"{root}/rows")
