"""Monitored tables derived from the driver's test tables.

One rule set, written here as Spark SQL expressions and in ``scorewatch.plans.oracles`` as DuckDB
SQL. Every event is one scored request; three event types have been reviewed, one of them twice.
Rules use only integer arithmetic and comparisons, so both engines agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import times
from scorewatch.schemas import FEEDBACK, PAYLOAD_LOG, PREDICTIONS, RAW_IMAGES, REQUEST_LOG, conform

# Declared, so that opening a table reads no file footer.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}

CHAMPION = "clf-1"
CHALLENGER = "clf_alt-1"

_SCORE = """CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT) / 100.0D"""
_SERVED = f"CASE WHEN event_id % 2 = 0 THEN '{CHAMPION}' ELSE '{CHALLENGER}' END"
_PREDICTION_ID = f"concat('{K.PREDICTION_ID_PREFIX}', event_id)"
_PREDICTED = "CAST(score > 0.5D AS INT)"
# The model is wrong where the event value is low, about one time in seven.
_TRUTH = f"CASE WHEN value < 15.0D THEN 1 - {_PREDICTED} ELSE {_PREDICTED} END"
_RESPONSE = """concat('{"predictions":[[', score, ']]}')"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; zone-less timestamps become UTC timestamps."""
    return with_utc_timestamps(spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), name)


def with_utc_timestamps(df: DataFrame, name: str) -> DataFrame:
    columns = [c.split() for c in TABLES[name].split(", ")]
    return df.selectExpr(*[f"CAST({c} AS TIMESTAMP) AS {c}" if kind == "TIMESTAMP_NTZ" else c for c, kind in columns])


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    # A glob that matches just this name: the stream reader takes a file or a folder of files by it.
    files = spark.readStream.schema(TABLES["events"]).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    return with_utc_timestamps(files, "events")


def predictions_from(events: DataFrame) -> DataFrame:
    scored = events.selectExpr("event_id", "user_id", "value", "ts", f"{_SCORE} AS score")
    return conform(
        scored.selectExpr(
            f"{_PREDICTION_ID} AS prediction_id",
            "CAST(user_id AS STRING) AS image_id",
            f"{_PREDICTED} AS predicted_label",
            "score AS prediction_probability",
            "greatest(score, 1.0D - score) AS confidence_score",
            f"{_TRUTH} AS true_label",
            "NOT value < 15.0D AS is_correct",
            f"{_SERVED} AS model_name",
            "'1' AS model_version",
            "ts AS predicted_at",
            "to_date(ts) AS prediction_date",
        ),
        PREDICTIONS,
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_from(table(spark, sf_dir, "events"))


def feedback_from(events: DataFrame) -> DataFrame:
    """Reviews, hours after the prediction; the second review agrees with the model."""
    reviews = (
        events.where("event_type IN ('view', 'click', 'purchase')")
        .selectExpr(
            "event_id",
            "user_id",
            "value",
            "ts",
            f"{_SCORE} AS score",
            "explode(CASE event_type WHEN 'purchase' THEN array(1, 2) ELSE array(1) END) AS round",
        )
        .selectExpr(
            "event_id",
            "user_id",
            "ts",
            "round",
            f"{_PREDICTED} AS predicted",
            f"CASE round WHEN 1 THEN {_TRUTH} ELSE {_PREDICTED} END AS truth",
        )
    )
    return conform(
        reviews.selectExpr(
            "concat(CASE round WHEN 1 THEN 'fb-' ELSE 'fb2-' END, event_id) AS feedback_id",
            f"{_PREDICTION_ID} AS prediction_id",
            "ts + make_dt_interval(0, CAST(event_id % 72 + CASE round WHEN 2 THEN 5 ELSE 0 END AS INT)) AS timestamp",
            f"CASE truth WHEN 1 THEN '{K.POSITIVE_CLASS}' ELSE '{K.NEGATIVE_CLASS}' END AS ground_truth",
            f"""CASE WHEN event_id % 101 = 0 THEN NULL
                  WHEN predicted = 1 AND truth = 1 THEN '{K.TRUE_POSITIVE}'
                  WHEN predicted = 1 THEN '{K.FALSE_POSITIVE}'
                  WHEN truth = 0 THEN '{K.TRUE_NEGATIVE}' ELSE '{K.FALSE_NEGATIVE}' END AS feedback_type""",
            "CASE WHEN event_id % 97 <> 0 THEN concat('DR', (user_id + round - 1) % 8) END AS radiologist_id",
            f"""CASE event_id % 10 WHEN 0 THEN '{K.UNCERTAIN}' WHEN 1 THEN '{K.NEEDS_REVIEW}'
                  ELSE '{K.CONFIRMED}' END AS confidence""",
            "'review_app' AS feedback_source",
            "'' AS notes",
        ),
        FEEDBACK,
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback_from(table(spark, sf_dir, "events"))


#: Parts in which ``feedback_arrival`` hands over the reviews; the last one is open at its end.
ARRIVALS = 4


def feedback_arrival(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    """Reviews of the predictions of eight days; reviews of a part's last days are newer than the next part's first."""
    day = F.datediff("ts", F.lit("2024-01-01").cast("date"))
    number = F.least(F.floor(day / 8), F.lit(ARRIVALS - 1))
    return feedback_from(table(spark, sf_dir, "events").where(number == part))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw image metadata, one batch per nation."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS image_id",
        f"concat(c_custkey, '{K.IMAGE_SUFFIX}') AS filename",
        f"CASE c_custkey % 2 WHEN 1 THEN '{K.POSITIVE_CLASS}' ELSE '{K.NEGATIVE_CLASS}' END AS category",
        """CASE WHEN c_custkey % 20 < 14 THEN 'train' WHEN c_custkey % 20 < 17 THEN 'val' ELSE 'test' END
             AS dataset_split""",
        "floor(abs(c_acctbal)) * 9 AS file_size_bytes",
        "TIMESTAMP '2024-01-01 06:00:00' + make_dt_interval(c_nationkey) AS ingested_at",
    )
    return conform(
        rows.selectExpr(
            "*",
            f"concat('{K.STORAGE_PREFIX}/volumes/raw/', lower(category), '/', filename) AS file_path",
            f"date_format(ingested_at, '{K.BATCH_ID_FORMAT}') AS ingestion_batch_id",
        ),
        RAW_IMAGES,
    )


def payload_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log with the model name in a map; some rows are late by more than the band."""
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "ts", f"{_SCORE} AS score")
    return conform(
        rows.selectExpr(
            "map('model_name', CASE event_id % 2 WHEN 0 THEN 'clf_pytorch' ELSE 'clf_classifier' END) AS request_metadata",
            f"{_RESPONSE} AS response",
            "unix_timestamp(ts) * 1000 + event_id % 9 * 1000 AS timestamp_ms",
            "CASE event_id % 50 WHEN 0 THEN 500 ELSE 200 END AS status_code",
        ),
        PAYLOAD_LOG,
    )


def request_log_from(events: DataFrame) -> DataFrame:
    rows = events.selectExpr("event_id", "ts", f"{_SCORE} AS score")
    return conform(
        rows.selectExpr(
            f"{_PREDICTION_ID} AS request_id",
            f"{_SERVED} AS served_model_name",
            "ts AS timestamp",
            "unix_millis(ts) AS timestamp_ms",
            "to_date(ts) AS date",
            f"{_RESPONSE} AS response",
        ),
        REQUEST_LOG,
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_log_from(table(spark, sf_dir, "events"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors: image id, vector, class."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "CAST(vec_id AS STRING) AS image_id", "embedding AS feature_vector", "label AS vector_class"
    )


def evaluation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and scores of an offline evaluation: id, label, score."""
    return table(spark, sf_dir, "labels").selectExpr(
        "doc_id AS sample_id", "quality AS label", "doc_id % 100 / 100.0D AS score"
    )


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and scores of every logged prediction: id, label, score."""
    return predictions(spark, sf_dir).selectExpr(
        "prediction_id AS sample_id", "true_label AS label", "prediction_probability AS score"
    )


def event_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of one table: signups are new, errors are gone, clicks have another value."""
    events = table(spark, sf_dir, "events")
    old = events.where("event_type <> 'signup'").select("event_id", "event_type", "value")
    new = events.where("event_type <> 'error'").selectExpr(
        "event_id", "event_type", "CASE event_type WHEN 'click' THEN value + 1.0D ELSE value END AS value"
    )
    return old, new


def image_reload(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A stored table (train, test) and a later batch (val is new, test has changed)."""
    raw = images(spark, sf_dir)
    stored = raw.where("dataset_split <> 'val'")
    loaded_at = F.lit("2024-02-01 06:00:00").cast("timestamp")
    batch = (
        raw.where("dataset_split <> 'train'")
        .withColumn("file_size_bytes", F.col("file_size_bytes") + 1)
        .withColumn("ingested_at", loaded_at)
        .withColumn("ingestion_batch_id", times.batch_id(loaded_at))
    )
    return stored, batch
