"""SQL equivalents of the registered queries, for DuckDB over the same test tables.

``BASE`` states the derivation of the monitored tables once more, in SQL; every query is a SELECT
after it. Nothing is imported from the library, so a wrong value there shows.
"""

from __future__ import annotations

# Parameters of the registered queries.
_RUN_TIME = "2024-02-01 00:00:00"
_LOOKUP_IMAGE = "42"
_SUMMARY_BATCH = "20240106_060000"
_PRUNE_FROM, _PRUNE_TO = "2024-01-10", "2024-01-16"
_BATCH_REVIEWER = "DR_BATCH"
_PER_CLASS = 50
_THRESHOLDS = "0.1, 0.3, 0.5, 0.7, 0.9"

_HIT = "feedback_type IN ('true-positive', 'true-negative')"
_MISS = "feedback_type IN ('false-positive', 'false-negative')"


def _n(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


_TP, _FP = _n("feedback_type = 'true-positive'"), _n("feedback_type = 'false-positive'")
_TN, _FN = _n("feedback_type = 'true-negative'"), _n("feedback_type = 'false-negative'")


def _ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def _pct(a: str, b: str = "COUNT(*)", digits: int = 2) -> str:
    return f"ROUND(CAST({a} AS DOUBLE) * 100.0::DOUBLE / NULLIF(CAST({b} AS DOUBLE), 0), {digits})"


_PRECISION = _ratio(_TP, f"({_TP} + {_FP})")
_RECALL = _ratio(_TP, f"({_TP} + {_FN})")
_F1 = f"(2.0::DOUBLE * {_PRECISION} * {_RECALL} / NULLIF({_PRECISION} + {_RECALL}, 0))"
_COUNTS = f"""{_TP} AS true_positives, {_FP} AS false_positives, {_TN} AS true_negatives, {_FN} AS false_negatives"""
_ORDER = """CASE feedback_type WHEN 'true-positive' THEN 1 WHEN 'false-positive' THEN 2 WHEN 'false-negative' THEN 3
  WHEN 'true-negative' THEN 4 ELSE 5 END"""
_FAMILY = """CASE WHEN model_name LIKE '%pytorch%' THEN 'PyTorch' WHEN model_name LIKE '%classifier%' THEN 'Keras'
  ELSE model_name END"""
_SCORE = "CAST(response::JSON->>'$.predictions[0][0]' AS DOUBLE)"
_HASH = "CAST('0x' || substr(md5('{seed}:' || image_id), 1, 8) AS BIGINT)"
_SHUFFLE = "md5('42:' || image_id) || ':' || image_id"
_DECODE = "CASE WHEN {0} = 1 THEN 'PNEUMONIA' ELSE 'NORMAL' END"
_RUN = f"TIMESTAMP '{_RUN_TIME}'"
_LINEAR = """list_sum(list_transform(range(0, 64), lambda i: embedding[i + 1]::DOUBLE * (((i * 7) % 11 - 5) / 10.0::DOUBLE)))
  + 0.1::DOUBLE"""
_NEWEST = '(SELECT MAX("timestamp") FROM feedback)'

BASE = f"""
WITH scored AS (
  SELECT *, CAST(props::JSON->>'$.k' AS INTEGER) / 100.0::DOUBLE AS score FROM events
), labelled AS (
  SELECT *, CAST(score > 0.5 AS INTEGER) AS predicted,
    CASE WHEN value < 15.0 THEN 1 - CAST(score > 0.5 AS INTEGER) ELSE CAST(score > 0.5 AS INTEGER) END AS truth,
    CASE WHEN event_id % 2 = 0 THEN 'clf-1' ELSE 'clf_alt-1' END AS served
  FROM scored
), predictions AS (
  SELECT 'pred-' || event_id AS prediction_id, CAST(user_id AS VARCHAR) AS image_id,
    predicted AS predicted_label, score AS prediction_probability,
    GREATEST(score, 1.0::DOUBLE - score) AS confidence_score, CAST(truth AS INTEGER) AS true_label,
    predicted = truth AS is_correct, served AS model_name, '1' AS model_version,
    ts AS predicted_at, CAST(ts AS DATE) AS prediction_date
  FROM labelled
), reviews AS (
  SELECT *, 1 AS round, truth AS reviewed FROM labelled WHERE event_type IN ('view', 'click', 'purchase')
  UNION ALL
  SELECT *, 2 AS round, predicted AS reviewed FROM labelled WHERE event_type = 'purchase'
), feedback AS (
  SELECT CASE WHEN round = 1 THEN 'fb-' ELSE 'fb2-' END || event_id AS feedback_id,
    'pred-' || event_id AS prediction_id,
    ts + to_hours(CAST(event_id % 72 + CASE WHEN round = 2 THEN 5 ELSE 0 END AS INTEGER)) AS "timestamp",
    {_DECODE.format("reviewed")} AS ground_truth,
    CASE WHEN event_id % 101 = 0 THEN NULL
      WHEN predicted = 1 AND reviewed = 1 THEN 'true-positive'
      WHEN predicted = 1 AND reviewed = 0 THEN 'false-positive'
      WHEN predicted = 0 AND reviewed = 0 THEN 'true-negative' ELSE 'false-negative' END AS feedback_type,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'DR' || ((user_id + round - 1) % 8) END AS radiologist_id,
    CASE event_id % 10 WHEN 0 THEN 'uncertain' WHEN 1 THEN 'needs_review' ELSE 'confirmed' END AS confidence,
    'review_app' AS feedback_source, '' AS notes
  FROM reviews
), images AS (
  SELECT CAST(c_custkey AS VARCHAR) AS image_id, c_custkey || '.jpeg' AS filename,
    CASE WHEN c_custkey % 2 = 1 THEN 'PNEUMONIA' ELSE 'NORMAL' END AS category,
    CASE WHEN c_custkey % 20 < 14 THEN 'train' WHEN c_custkey % 20 < 17 THEN 'val' ELSE 'test' END AS dataset_split,
    'dbfs:/volumes/raw/' || CASE WHEN c_custkey % 2 = 1 THEN 'pneumonia' ELSE 'normal' END
      || '/' || c_custkey || '.jpeg' AS file_path,
    CAST(FLOOR(ABS(c_acctbal)) * 9 AS BIGINT) AS file_size_bytes,
    TIMESTAMP '2024-01-01 06:00:00' + to_days(c_nationkey) AS ingested_at,
    strftime(TIMESTAMP '2024-01-01 06:00:00' + to_days(c_nationkey), '%Y%m%d_%H%M%S') AS ingestion_batch_id
  FROM customer
), payload AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'clf_pytorch' ELSE 'clf_classifier' END AS model_name, score AS logged_score,
    CAST(FLOOR(epoch(ts)) AS BIGINT) * 1000 + event_id % 9 * 1000 AS timestamp_ms,
    CASE WHEN event_id % 50 = 0 THEN 500 ELSE 200 END AS status_code
  FROM scored
), request_log AS (
  SELECT 'pred-' || event_id AS request_id, served AS served_model_name, ts AS "timestamp",
    epoch_us(ts) // 1000 AS timestamp_ms, CAST(ts AS DATE) AS "date",
    '{{"predictions":[[' || score || ']]}}' AS response
  FROM labelled
), reviewed AS (
  SELECT p.*, f.feedback_id, f."timestamp", f.ground_truth, f.feedback_type, f.radiologist_id, f.confidence
  FROM predictions p JOIN feedback f ON p.prediction_id = f.prediction_id
), served AS (
  SELECT l.*, f.feedback_id, f."timestamp" AS feedback_time, f.ground_truth, f.feedback_type, f.radiologist_id, f.confidence
  FROM request_log l JOIN feedback f ON l.request_id = f.prediction_id
), latest AS (
  SELECT * FROM feedback QUALIFY ROW_NUMBER() OVER (PARTITION BY prediction_id ORDER BY "timestamp" DESC, feedback_id DESC) = 1
), attributed AS (
  SELECT p.*, l.model_name AS logged_model, l.timestamp_ms,
    CAST(FLOOR(epoch(p.predicted_at)) AS BIGINT) * 1000 AS predicted_ms
  FROM predictions p JOIN payload l ON p.prediction_probability = l.logged_score AND l.status_code = 200
    AND ABS(CAST(FLOOR(epoch(p.predicted_at)) AS BIGINT) * 1000 - l.timestamp_ms) < 5000
), recent AS (
  SELECT * FROM request_log WHERE "date" >= (SELECT MAX("date") FROM request_log) - 7
), daily AS (
  SELECT model_name, CAST(prediction_date AS TIMESTAMP) AS day, COUNT(*) AS reviews, {_n(_HIT)} AS hits
  FROM reviewed GROUP BY ALL
)
"""

_METRICS = f"""SELECT model_name, model_version, COUNT(DISTINCT feedback_id) AS total_feedback, {_COUNTS},
  ROUND({_PRECISION}, 4) AS "precision", ROUND({_RECALL}, 4) AS recall,
  ROUND({_ratio(_TN, f"({_TN} + {_FP})")}, 4) AS specificity, ROUND({_F1}, 4) AS f1_score,
  ROUND({_ratio(f"({_TP} + {_TN})", "COUNT(DISTINCT feedback_id)")}, 4) AS accuracy
FROM reviewed GROUP BY model_name, model_version"""

_EVAL_COUNTS = """COUNT(*) FILTER (true_label = 1 AND predicted_label = 1) AS true_positives,
  COUNT(*) FILTER (true_label = 0 AND predicted_label = 1) AS false_positives,
  COUNT(*) FILTER (true_label = 0 AND predicted_label = 0) AS true_negatives,
  COUNT(*) FILTER (true_label = 1 AND predicted_label = 0) AS false_negatives"""
_TPC, _FPC, _TNC, _FNC = "true_positives", "false_positives", "true_negatives", "false_negatives"
_EVAL_P = f"COALESCE({_ratio(_TPC, f'({_TPC} + {_FPC})')}, 0)"
_EVAL_R = f"COALESCE({_ratio(_TPC, f'({_TPC} + {_FNC})')}, 0)"
_EVAL_METRICS = f"""{_ratio(f'({_TPC} + {_TNC})', f'({_TPC} + {_TNC} + {_FPC} + {_FNC})')} AS accuracy,
  {_EVAL_P} AS "precision", {_EVAL_R} AS recall,
  COALESCE(2.0::DOUBLE * {_EVAL_P} * {_EVAL_R} / NULLIF({_EVAL_P} + {_EVAL_R}, 0), 0) AS f1_score"""
_JSON = f"'[[' || {_TNC} || ',' || {_FPC} || '],[' || {_FNC} || ',' || {_TPC} || ']]'"


def _auc(source: str, by: str = "") -> str:
    """Rank form with mid-ranks for ties."""
    comma, part, group = (f"{by}, ", f"PARTITION BY {by}", f"GROUP BY {by}") if by else ("", "", "")
    return f"""SELECT {comma}SUM(label)::BIGINT AS positives, (COUNT(*) - SUM(label))::BIGINT AS negatives,
  ROUND((SUM(CASE WHEN label = 1 THEN midrank ELSE 0 END) - SUM(label)::DOUBLE * (SUM(label) + 1) / 2)
    / (SUM(label)::DOUBLE * (COUNT(*) - SUM(label))), 9) AS auc
FROM (SELECT *, RANK() OVER ({part} ORDER BY score) + (COUNT(*) OVER (PARTITION BY {comma}score) - 1) / 2.0::DOUBLE AS midrank
  FROM ({source})) ranked {group}"""


_PAIRS = "SELECT doc_id AS sample_id, quality AS label, (doc_id % 100) / 100.0::DOUBLE AS score FROM labels"
_CLIPPED = "LEAST(GREATEST(score, 1e-7::DOUBLE), 1.0::DOUBLE - 1e-7::DOUBLE)"

_CHI = f"""SELECT *, 'clf-1' AS champion, 'clf_alt-1' AS challenger,
  champion_correct::DOUBLE / (champion_correct + champion_wrong) AS champion_accuracy,
  challenger_correct::DOUBLE / (challenger_correct + challenger_wrong) AS challenger_accuracy,
  (champion_correct + champion_wrong + challenger_correct + challenger_wrong)::DOUBLE
    * POWER(champion_correct::DOUBLE * challenger_wrong - champion_wrong::DOUBLE * challenger_correct, 2)
    / ((champion_correct + champion_wrong)::DOUBLE * (challenger_correct + challenger_wrong)
      * (champion_correct + challenger_correct) * (champion_wrong + challenger_wrong)) AS chi
FROM (SELECT
  COUNT(*) FILTER (p.model_name = 'clf-1' AND {_HIT}) AS champion_correct,
  COUNT(*) FILTER (p.model_name = 'clf-1' AND {_MISS}) AS champion_wrong,
  COUNT(*) FILTER (p.model_name = 'clf_alt-1' AND {_HIT}) AS challenger_correct,
  COUNT(*) FILTER (p.model_name = 'clf_alt-1' AND {_MISS}) AS challenger_wrong
  FROM predictions p JOIN latest f ON p.prediction_id = f.prediction_id)"""

_QUEUE = f"""SELECT p.prediction_id, p.image_id, {_DECODE.format("p.predicted_label")} AS ai_prediction,
  p.prediction_probability, p.model_name, p.predicted_at, i.file_path AS image_path
FROM predictions p LEFT JOIN feedback f ON p.prediction_id = f.prediction_id
  LEFT JOIN images i ON p.image_id = i.image_id
WHERE f.feedback_id IS NULL {{filter}} ORDER BY p.predicted_at DESC, p.prediction_id LIMIT 50"""

_PENDING = f"""SELECT p.prediction_id, p.image_id, {_DECODE.format("p.predicted_label")} AS ai_prediction,
  {_DECODE.format("p.true_label")} AS actual_diagnosis, p.prediction_probability, p.predicted_at
FROM predictions p LEFT JOIN feedback f ON p.prediction_id = f.prediction_id WHERE f.feedback_id IS NULL"""

_LIVE = f"""SELECT request_id, served_model_name, {_SCORE} AS prediction_score,
  CASE WHEN {_SCORE} > 0.5 THEN 'PNEUMONIA' ELSE 'NORMAL' END AS predicted_label, ground_truth, feedback_type,
  CASE WHEN {_HIT} THEN TRUE WHEN {_MISS} THEN FALSE END AS is_correct, radiologist_id, confidence,
  "timestamp" AS prediction_time, feedback_time"""

_FEEDBACK_COLUMNS = """feedback_id, prediction_id, "timestamp", ground_truth, feedback_type, radiologist_id, confidence,
  feedback_source, notes"""

_MIGRATED = f"""SELECT request_id AS prediction_id, CAST(NULL AS VARCHAR) AS image_id,
  CASE WHEN {_SCORE} > 0.5 THEN 1 ELSE 0 END AS predicted_label, {_SCORE} AS prediction_probability,
  {_SCORE} AS confidence_score, CAST(NULL AS INTEGER) AS true_label, CAST(NULL AS BOOLEAN) AS is_correct,
  served_model_name AS model_name, string_split(served_model_name, '-')[2] AS model_version,
  make_timestamp(timestamp_ms * 1000) AS predicted_at,
  strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS prediction_date FROM request_log"""

_SHEET = f"""SELECT f.feedback_id, f.prediction_id, {_DECODE.format("p.predicted_label")} AS ai_prediction,
  CASE WHEN radiologist_id = 'DR3' THEN '' WHEN radiologist_id = 'DR5' THEN 'OTHER'
    WHEN radiologist_id IS NULL THEN NULL ELSE ground_truth END AS radiologist_assessment
FROM feedback f JOIN predictions p ON f.prediction_id = p.prediction_id"""
_OUTCOME = """CASE WHEN ai_prediction = 'PNEUMONIA' AND radiologist_assessment = 'PNEUMONIA' THEN 'true-positive'
  WHEN ai_prediction = 'PNEUMONIA' AND radiologist_assessment = 'NORMAL' THEN 'false-positive'
  WHEN ai_prediction = 'NORMAL' AND radiologist_assessment = 'NORMAL' THEN 'true-negative'
  WHEN ai_prediction = 'NORMAL' AND radiologist_assessment = 'PNEUMONIA' THEN 'false-negative' ELSE 'unknown' END"""


def _rules(table: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (NOT COALESCE({rule}, FALSE)) AS failed, COUNT(*) AS total FROM {table}"
        for name, rule in rules.items()
    )


def _unique(table: str, key: str) -> str:
    return f"""SELECT '{table}.{key} unique' AS rule, COUNT(*) - COUNT(DISTINCT {key}) AS failed, COUNT(*) AS total
FROM {table}"""


def _orphans(table: str, parent: str, key: str) -> str:
    return f"""SELECT '{table}.{key} in {parent}' AS rule,
  COUNT(*) FILTER ({key} NOT IN (SELECT {key} FROM {parent})) AS failed, COUNT(*) AS total FROM {table}"""


_QUALITY = "\nUNION ALL ".join(
    [
        _rules(
            "images",
            {
                "images.image_id present": "image_id IS NOT NULL",
                "images.category known": "category IN ('PNEUMONIA', 'NORMAL')",
                "images.dataset_split known": "dataset_split IN ('train', 'val', 'test')",
                "images.file_size_bytes positive": "file_size_bytes > 0",
            },
        ),
        _rules(
            "predictions",
            {
                "predictions.prediction_probability in range": "prediction_probability BETWEEN 0 AND 1",
                "predictions.confidence_score in range": "confidence_score BETWEEN 0.5 AND 1",
                "predictions.predicted_label known": "predicted_label IN (0, 1)",
                "predictions.image_id present": "image_id IS NOT NULL",
            },
        ),
        _rules(
            "feedback",
            {
                "feedback.feedback_id present": "feedback_id IS NOT NULL",
                "feedback.prediction_id present": "prediction_id IS NOT NULL",
                "feedback.timestamp present": '"timestamp" IS NOT NULL',
                "feedback.ground_truth present": "ground_truth IS NOT NULL",
                "feedback.feedback_type known": f"{_HIT} OR {_MISS}",
                "feedback.confidence known": "confidence IN ('confirmed', 'uncertain', 'needs_review')",
                "feedback.radiologist_id present": "radiologist_id IS NOT NULL",
            },
        ),
        _unique("images", "image_id"),
        _unique("predictions", "prediction_id"),
        _unique("feedback", "feedback_id"),
        _orphans("predictions", "images", "image_id"),
        _orphans("feedback", "predictions", "prediction_id"),
    ]
)


def _daily(rates: str) -> str:
    return f"""SELECT DATE_TRUNC('day', "timestamp")::TIMESTAMP AS "date", {rates}
FROM feedback GROUP BY 1"""


def _first_per_class(limit: str) -> str:
    return f"""SELECT image_id, category FROM images
QUALIFY ROW_NUMBER() OVER (PARTITION BY category ORDER BY image_id) <= {limit}"""


def _per_request(columns: str, source: str = "served") -> str:
    return f"SELECT served_model_name, {columns} FROM {source} GROUP BY served_model_name"


_RECENT_SERVED = """(SELECT l.*, f.feedback_id, f.feedback_type FROM recent l JOIN feedback f ON l.request_id = f.prediction_id)"""
_AVG_PCT = f"ROUND(AVG(CASE WHEN {_HIT} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 2)"

SELECTS: dict[str, str] = {
    "conform_schema": """SELECT feedback_id, prediction_id, "timestamp", ground_truth, feedback_type, radiologist_id,
  confidence, feedback_source, CAST(NULL AS VARCHAR) AS notes FROM feedback""",
    "write_overwrite": "SELECT * FROM images",
    "append_rows": f"SELECT {_FEEDBACK_COLUMNS} FROM feedback",
    "csv_roundtrip": f"SELECT {_FEEDBACK_COLUMNS} FROM feedback",
    "file_listing_totals": """SELECT category, CAST(SUM(length(image_id || ' ' || file_path) + 1) AS BIGINT) AS total_bytes
FROM images GROUP BY category""",
    "upsert_by_key": """SELECT * FROM images WHERE dataset_split = 'train'
UNION ALL SELECT image_id, filename, category, dataset_split, file_path, file_size_bytes + 1,
  TIMESTAMP '2024-02-01 06:00:00', '20240201_060000' FROM images WHERE dataset_split <> 'train'""",
    "migrate_log": _MIGRATED,
    "stream_upsert": _MIGRATED,
    "freshness_gate": """SELECT TIMESTAMP '2024-01-30 12:00:00' AS source_updated_at, MAX(ingested_at) AS last_ingested,
  TIMESTAMP '2024-01-30 12:00:00' > MAX(ingested_at) AS should_run,
  CASE WHEN TIMESTAMP '2024-01-30 12:00:00' > MAX(ingested_at) THEN 'source is newer' ELSE 'up to date' END AS reason
FROM images""",
    "incremental_slice": """SELECT event_id, ts, event_type FROM events
WHERE ts > (SELECT MAX(ingested_at) FROM images)""",
    "batch_stamp": f"SELECT image_id, {_RUN} AS ingested_at, '20240201_000000' AS ingestion_batch_id FROM images",
    "partition_prune": f"""SELECT prediction_id, predicted_label, prediction_probability,
  strftime(prediction_date, '%Y-%m-%d') AS prediction_date
FROM predictions WHERE prediction_date BETWEEN DATE '{_PRUNE_FROM}' AND DATE '{_PRUNE_TO}'""",
    "change_feed": """SELECT 'insert' AS change_type, event_id, event_type, value FROM events WHERE event_type = 'signup'
UNION ALL SELECT 'delete', event_id, event_type, value FROM events WHERE event_type = 'error'
UNION ALL SELECT 'update_preimage', event_id, event_type, value FROM events WHERE event_type = 'click'
UNION ALL SELECT 'update_postimage', event_id, event_type, value + 1.0::DOUBLE FROM events WHERE event_type = 'click'""",
    "batch_count": "SELECT COUNT(*) AS total FROM images",
    "count_by_category": "SELECT category, COUNT(*) AS \"count\" FROM images GROUP BY category",
    "ingest_summary": """SELECT category, dataset_split, COUNT(*) AS image_count,
  CAST(SUM(file_size_bytes) AS BIGINT) AS total_size_bytes, AVG(file_size_bytes) AS avg_size_bytes,
  MIN(ingested_at) AS first_ingested, MAX(ingested_at) AS last_ingested FROM images GROUP BY ALL""",
    "ingest_summary_batch": f"""SELECT category, dataset_split, COUNT(*) AS image_count,
  CAST(SUM(file_size_bytes) AS BIGINT) AS total_size_bytes, AVG(file_size_bytes) AS avg_size_bytes,
  MIN(ingested_at) AS first_ingested, MAX(ingested_at) AS last_ingested FROM images
WHERE ingestion_batch_id = '{_SUMMARY_BATCH}' GROUP BY ALL""",
    "sample_rows": "SELECT * FROM images ORDER BY image_id LIMIT 10",
    "lookup_by_id": f"SELECT file_path, filename FROM images WHERE image_id = '{_LOOKUP_IMAGE}' LIMIT 1",
    "decode_label": f"""SELECT prediction_id, {_DECODE.format("predicted_label")} AS predicted,
  {_DECODE.format("true_label")} AS true_diagnosis, true_label FROM predictions""",
    "score_to_prediction": """SELECT prediction_id, CAST(prediction_probability > 0.5 AS INTEGER) AS predicted_label,
  CASE WHEN prediction_probability > 0.5 THEN prediction_probability ELSE 1.0::DOUBLE - prediction_probability END
    AS confidence_score, is_correct FROM predictions""",
    "classify_outcome": f"SELECT *, {_OUTCOME} AS feedback_type FROM ({_SHEET})",
    "classify_outcome_strict": f"""SELECT *, {_OUTCOME} AS feedback_type FROM ({_SHEET})
WHERE radiologist_assessment IN ('PNEUMONIA', 'NORMAL')""",
    "outcome_tristate": f"""SELECT feedback_id, CASE WHEN {_HIT} THEN TRUE WHEN {_MISS} THEN FALSE END AS is_correct,
  CASE WHEN {_HIT} THEN 'Correct' ELSE 'Incorrect' END AS correctness FROM feedback""",
    "model_family": f"SELECT model_name, {_FAMILY} AS family, COUNT(*) AS calls FROM payload GROUP BY model_name",
    "normalize_path": """SELECT image_id, regexp_replace(file_path, '^dbfs:', '') AS local_path,
  regexp_replace(filename, '\\.jpeg$', '') AS stem FROM images""",
    "image_labels": """SELECT image_id, category, CASE WHEN category = 'PNEUMONIA' THEN 1 ELSE 0 END AS label FROM images""",
    "surrogate_ids": """SELECT feedback_id, 'fb-' || substr(sha256(prediction_id || '|' || COALESCE(radiologist_id, '\\N')
  || '|' || ground_truth), 1, 32) AS derived_id FROM feedback""",
    "timestamp_formats": """SELECT prediction_id, strftime(predicted_at, '%Y-%m-%d %H:%M:%S') AS display_text,
  strftime(predicted_at, '%Y-%m-%dT%H:%M:%SZ') AS iso_text, DATE_TRUNC('second', predicted_at)::TIMESTAMP AS parsed_at,
  CAST(FLOOR(epoch(predicted_at)) AS BIGINT) * 1000 AS whole_second_ms,
  make_timestamp(epoch_us(predicted_at) // 1000 * 1000) AS from_ms FROM predictions""",
    "json_score": f"""SELECT request_id, {_SCORE} AS score, string_split(served_model_name, '-')[2] AS version
FROM request_log""",
    "pending_feedback": f"{_PENDING} ORDER BY p.predicted_at DESC, p.prediction_id LIMIT 10",
    "pending_all": _PENDING,
    "predictions_with_feedback": f"{_LIVE} FROM served ORDER BY prediction_time DESC, request_id, feedback_id LIMIT 10",
    "performance_live": f"""{_LIVE}, strftime("date", '%Y-%m-%d') AS prediction_date, feedback_id FROM served""",
    "review_queue": _QUEUE.format(filter=""),
    "review_queue_filtered": _QUEUE.format(
        filter=f"""AND p.prediction_date BETWEEN DATE '{_PRUNE_FROM}' AND DATE '{_PRUNE_TO}'
  AND p.model_name = 'clf-1' AND p.confidence_score >= 0.7"""
    ),
    "review_queue_display": f"""SELECT prediction_id, substr(prediction_id, 1, 16) AS id_preview, ai_prediction,
  ROUND(prediction_probability, 3) AS prediction_probability,
  strftime(predicted_at, '%Y-%m-%d %H:%M:%S') AS predicted_at, '?image=' || image_id AS image_link,
  CAST(NULL AS VARCHAR) AS radiologist_assessment FROM ({_QUEUE.format(filter="")})""",
    "batch_feedback": f"""SELECT 'fb-' || substr(sha256(prediction_id || '|{_BATCH_REVIEWER}|' || radiologist_assessment || '|{_RUN_TIME}'), 1, 32)
    AS feedback_id, prediction_id, {_RUN} AS "timestamp", radiologist_assessment AS ground_truth,
  {_OUTCOME} AS feedback_type, '{_BATCH_REVIEWER}' AS radiologist_id, 'confirmed' AS confidence,
  'batch' AS feedback_source, 'from known label' AS notes
FROM (SELECT p.prediction_id, {_DECODE.format("p.predicted_label")} AS ai_prediction,
  {_DECODE.format("p.true_label")} AS radiologist_assessment
  FROM predictions p LEFT JOIN feedback f ON p.prediction_id = f.prediction_id
  WHERE f.feedback_id IS NULL AND p.confidence_score >= 0.8)""",
    "log_attribution": """SELECT prediction_id, image_id, predicted_at, prediction_probability, logged_model AS model_name,
  COUNT(*) AS matches, MIN(ABS(timestamp_ms - predicted_ms)) AS nearest_ms FROM attributed GROUP BY ALL""",
    "log_attribution_nearest": """SELECT prediction_id, image_id, prediction_probability, model_name, timestamp_ms, delta_ms
FROM (SELECT p.prediction_id, p.image_id, p.prediction_probability, l.model_name, l.timestamp_ms,
    l.timestamp_ms - epoch_us(p.predicted_at) // 1000 AS delta_ms
  FROM predictions p JOIN payload l ON p.prediction_probability = l.logged_score AND l.status_code = 200
    AND ABS(epoch_us(p.predicted_at) // 1000 - l.timestamp_ms) < 5000)
QUALIFY ROW_NUMBER() OVER (PARTITION BY prediction_id ORDER BY ABS(delta_ms), timestamp_ms, model_name) = 1""",
    "band_join_bucketed": """SELECT prediction_id, COUNT(*) AS calls_in_band, MIN(ABS(timestamp_ms - predicted_ms)) AS nearest_ms
FROM (SELECT prediction_id, CAST(FLOOR(epoch(predicted_at)) AS BIGINT) * 1000 AS predicted_ms FROM predictions) p
JOIN payload l ON l.status_code = 200 AND l.timestamp_ms > predicted_ms - 60000 AND l.timestamp_ms < predicted_ms + 60000
GROUP BY prediction_id""",
    "reviewer_disagreement": """SELECT a.prediction_id, MAX(n.reviews) AS reviews, MAX(n.truths) AS distinct_truths,
  COUNT(*) AS disagreeing_pairs, MAX(n.first_review) AS first_review, MAX(n.last_review) AS last_review
FROM feedback a JOIN feedback b ON a.prediction_id = b.prediction_id AND a.feedback_id < b.feedback_id
  AND a.ground_truth <> b.ground_truth
JOIN (SELECT prediction_id, COUNT(*) AS reviews, COUNT(DISTINCT ground_truth) AS truths,
  MIN("timestamp") AS first_review, MAX("timestamp") AS last_review FROM feedback GROUP BY prediction_id) n
  ON n.prediction_id = a.prediction_id
GROUP BY a.prediction_id""",
    "latest_feedback": f"SELECT {_FEEDBACK_COLUMNS} FROM latest",
    "review_progress": f"""SELECT assessed, total, matches, assessed || '/' || total AS assessed_text,
  matches || '/' || assessed AS matches_text
FROM (SELECT COUNT(f.ground_truth) AS assessed, COUNT(*) AS total,
  COUNT(*) FILTER (f.ground_truth = {_DECODE.format("p.predicted_label")}) AS matches
  FROM predictions p LEFT JOIN latest f ON p.prediction_id = f.prediction_id)""",
    "recent_predictions": f"""SELECT prediction_id, image_id, {_DECODE.format("predicted_label")} AS predicted,
  {_DECODE.format("true_label")} AS true_diagnosis, ROUND(prediction_probability, 3) AS probability, is_correct,
  model_name, predicted_at FROM predictions ORDER BY predicted_at DESC, prediction_id LIMIT 20""",
    "model_metrics": _METRICS,
    "model_metrics_basic": f"SELECT * EXCLUDE (specificity, f1_score) FROM ({_METRICS})",
    "outcome_distribution": f"""SELECT feedback_type, COUNT(*) AS "count",
  ROUND(COUNT(*) * 100.0::DOUBLE / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 2) AS percentage, {_ORDER} AS sort_order
FROM feedback GROUP BY feedback_type""",
    "outcome_counts": "SELECT feedback_type, COUNT(*) AS \"count\" FROM feedback GROUP BY feedback_type",
    "confusion_grid": f"""SELECT 'Predicted PNEUMONIA' AS predicted_label, {_TP} AS actual_pneumonia, {_FP} AS actual_normal
FROM feedback UNION ALL SELECT 'Predicted NORMAL', {_FN}, {_TN} FROM feedback""",
    "confidence_by_outcome": f"""SELECT CASE WHEN {_HIT} THEN 'Correct' ELSE 'Incorrect' END AS prediction_outcome,
  ROUND(AVG(confidence_score), 4) AS avg_confidence, ROUND(MIN(confidence_score), 4) AS min_confidence,
  ROUND(MAX(confidence_score), 4) AS max_confidence, COUNT(*) AS "count" FROM reviewed GROUP BY 1""",
    "confidence_histogram": f"""SELECT ROUND(prediction_probability, 2) AS confidence,
  CASE WHEN {_HIT} THEN 'Correct' ELSE 'Incorrect' END AS correctness, COUNT(*) AS "count" FROM reviewed GROUP BY ALL""",
    "error_analysis": f"""SELECT feedback_type, COUNT(*) AS "count",
  ROUND(AVG(prediction_probability), 4) AS avg_prediction_probability, ROUND(AVG(confidence_score), 4) AS avg_confidence,
  {_pct(_n("confidence_score > 0.8"))} AS high_confidence_errors_pct
FROM reviewed WHERE {_MISS} GROUP BY feedback_type""",
    "daily_performance": _daily(
        f"COUNT(*) AS predictions, {_pct(_n(_HIT))} AS accuracy_pct, "
        f'ROUND({_PRECISION}, 4) AS "precision", ROUND({_RECALL}, 4) AS recall'
    ),
    "daily_performance_pct": _daily(
        f"COUNT(*) AS predictions, {_pct(_n(_HIT))} AS accuracy_pct, "
        f"ROUND({_PRECISION} * 100, 2) AS precision_pct, ROUND({_RECALL} * 100, 2) AS recall_pct"
    ),
    "daily_accuracy": _daily(f"{_pct(_n(_HIT))} AS accuracy_pct"),
    "daily_error_rate": _daily(f"{_pct(_n(_MISS))} AS error_rate_pct, COUNT(*) AS total_predictions"),
    "reviewer_summary": f"""SELECT radiologist_id, COUNT(*) AS total_reviews,
  {_n("confidence = 'confirmed'")} AS confirmed_reviews, {_n("confidence = 'uncertain'")} AS uncertain_reviews,
  {_n("confidence = 'needs_review'")} AS needs_review_count, {_pct(_n(_HIT))} AS ai_agreement_pct,
  MIN("timestamp") AS first_review, MAX("timestamp") AS last_review FROM feedback GROUP BY radiologist_id""",
    "reviewer_agreement": f"""SELECT COALESCE(radiologist_id, 'Unknown') AS radiologist_id, {_pct(_n(_HIT))} AS agreement_pct,
  COUNT(*) AS total_reviews, {_n(_MISS)} AS disagreements
FROM feedback WHERE radiologist_id IS NOT NULL GROUP BY radiologist_id""",
    "feedback_coverage": f"""SELECT COUNT(DISTINCT p.prediction_id) AS total_predictions,
  COUNT(DISTINCT f.feedback_id) AS predictions_with_feedback,
  COUNT(DISTINCT p.prediction_id) - COUNT(DISTINCT f.feedback_id) AS predictions_pending_feedback,
  {_pct("COUNT(DISTINCT f.feedback_id)", "COUNT(DISTINCT p.prediction_id)")} AS feedback_coverage_pct,
  COUNT(DISTINCT f.prediction_id) AS reviewed_predictions,
  {_pct("COUNT(DISTINCT f.prediction_id)", "COUNT(DISTINCT p.prediction_id)")} AS reviewed_pct
FROM predictions p LEFT JOIN feedback f ON p.prediction_id = f.prediction_id""",
    "feedback_coverage_7d": f"""SELECT COUNT(DISTINCT l.request_id) AS total_predictions,
  COUNT(DISTINCT f.feedback_id) AS predictions_with_feedback,
  {_pct("COUNT(DISTINCT f.feedback_id)", "COUNT(DISTINCT l.request_id)")} AS coverage_pct
FROM recent l LEFT JOIN feedback f ON l.request_id = f.prediction_id""",
    "errors_by_split": """SELECT i.dataset_split, r.feedback_type, COUNT(*) AS "count"
FROM reviewed r JOIN images i ON r.image_id = i.image_id GROUP BY ALL""",
    "accuracy_by_size": f"""SELECT CASE WHEN i.file_size_bytes < 30000 THEN 'Small (<30KB)'
    WHEN i.file_size_bytes < 60000 THEN 'Medium (30-60KB)' ELSE 'Large (>60KB)' END AS size_category,
  {_pct(_n(_HIT))} AS accuracy_pct, COUNT(*) AS total_predictions
FROM feedback f JOIN predictions p ON f.prediction_id = p.prediction_id JOIN images i ON p.image_id = i.image_id
GROUP BY 1""",
    "confusion_by_model": f"""SELECT {_FAMILY} AS model_display_name, feedback_type, COUNT(*) AS "count", {_ORDER} AS sort_order
FROM (SELECT a.logged_model AS model_name, f.feedback_type FROM attributed a
  JOIN feedback f ON a.prediction_id = f.prediction_id) GROUP BY ALL""",
    "false_positive_feed": f"""SELECT feedback_id, image_id, predicted_at, ROUND(prediction_probability, 3) AS ai_confidence,
  {_FAMILY} AS model_name, '?image=' || image_id AS app_link
FROM (SELECT f.feedback_id, f."timestamp", a.image_id, a.predicted_at, a.prediction_probability, a.timestamp_ms,
    a.logged_model AS model_name
  FROM attributed a JOIN feedback f ON a.prediction_id = f.prediction_id WHERE f.feedback_type = 'false-positive')
ORDER BY "timestamp" DESC, feedback_id, model_name LIMIT 10""",
    "traffic_share_7d": """SELECT served_model_name, COUNT(*) AS total_predictions,
  ROUND(COUNT(*) * 100.0::DOUBLE / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 1) AS traffic_pct
FROM recent GROUP BY served_model_name""",
    "served_accuracy_7d": _per_request(
        f"COUNT(*) AS total_with_feedback, {_n(_HIT)} AS correct, {_AVG_PCT} AS accuracy_pct", _RECENT_SERVED
    ),
    "served_confusion_7d": _per_request(_COUNTS, _RECENT_SERVED),
    "served_daily": f"""SELECT strftime(l."timestamp", '%Y-%m-%d') AS prediction_date, l.served_model_name,
  COUNT(*) AS predictions_count, COUNT(f.feedback_id) AS feedback_count, {_AVG_PCT} AS daily_accuracy,
  {_pct(_n(_HIT), "COUNT(f.feedback_id)")} AS daily_accuracy_reviewed
FROM recent l LEFT JOIN feedback f ON l.request_id = f.prediction_id GROUP BY 1, 2""",
    "served_accuracy": _per_request(
        f"COUNT(*) AS total_predictions_with_feedback, {_n(_HIT)} AS correct_predictions, {_AVG_PCT} AS accuracy_pct"
    ),
    "accuracy_trend": """SELECT model_name, day, reviews, accuracy_pct,
  ROUND(accuracy_pct - LAG(accuracy_pct) OVER (PARTITION BY model_name ORDER BY day), 2) AS change_pct
FROM (SELECT *, ROUND(hits * 100.0::DOUBLE / reviews, 2) AS accuracy_pct FROM daily)""",
    "rolling_accuracy": """SELECT model_name, day, CAST(SUM(reviews) OVER w AS BIGINT) AS reviews_in_window,
  ROUND(SUM(hits) OVER w * 100.0::DOUBLE / CAST(SUM(reviews) OVER w AS DOUBLE), 2) AS rolling_accuracy_pct
FROM daily WINDOW w AS (PARTITION BY model_name ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    "drift_alert": """SELECT model_name, ROUND(b, 6) AS baseline_accuracy, ROUND(r, 6) AS recent_accuracy,
  ROUND(b - r, 6) AS accuracy_drop, b - r > 0.05 AS alert
FROM (SELECT model_name,
  SUM(hits) FILTER (day < first_day + INTERVAL 7 DAYS)::DOUBLE / SUM(reviews) FILTER (day < first_day + INTERVAL 7 DAYS) AS b,
  SUM(hits) FILTER (day > last_day - INTERVAL 7 DAYS)::DOUBLE / SUM(reviews) FILTER (day > last_day - INTERVAL 7 DAYS) AS r
  FROM (SELECT *, MIN(day) OVER (PARTITION BY model_name) AS first_day,
    MAX(day) OVER (PARTITION BY model_name) AS last_day FROM daily)
  GROUP BY model_name)""",
    "health_flags": f"""SELECT model_name, ROUND({_PRECISION}, 4) AS "precision", ROUND({_RECALL}, 4) AS recall,
  ROUND({_F1}, 4) AS f1_score, {_PRECISION} > 0.85 AS precision_ok, {_RECALL} > 0.90 AS recall_ok, {_F1} > 0.87 AS f1_ok,
  {_FN}::DOUBLE / ({_TP} + {_FP} + {_TN} + {_FN}) > 0.10 AS many_false_negatives,
  {_FP}::DOUBLE / ({_TP} + {_FP} + {_TN} + {_FN}) > 0.10 AS many_false_positives,
  AVG(confidence_score) FILTER ({_HIT}) < 0.70 AS unsure_when_right,
  AVG(confidence_score) FILTER ({_MISS}) > 0.80 AS sure_when_wrong
FROM reviewed GROUP BY model_name""",
    "late_rows": """SELECT feedback_id, prediction_id, predicted_at, "timestamp",
  ROUND((FLOOR(epoch("timestamp")) - FLOOR(epoch(predicted_at))) / 3600.0::DOUBLE, 4) AS delay_hours
FROM reviewed WHERE FLOOR(epoch("timestamp")) - FLOOR(epoch(predicted_at)) > 48 * 3600""",
    "late_summary": """SELECT CAST(prediction_date AS TIMESTAMP) AS day, COUNT(*) AS late_reviews,
  MAX(ROUND((FLOOR(epoch("timestamp")) - FLOOR(epoch(predicted_at))) / 3600.0::DOUBLE, 4)) AS longest_delay_hours
FROM reviewed WHERE FLOOR(epoch("timestamp")) - FLOOR(epoch(predicted_at)) > 48 * 3600 GROUP BY 1""",
    "binary_eval": f"""SELECT *, {_EVAL_METRICS}
FROM (SELECT model_name, model_version, {_EVAL_COUNTS} FROM predictions GROUP BY ALL)""",
    "auc_exact": _auc(_PAIRS),
    "auc_by_model": _auc(
        "SELECT model_name, true_label AS label, prediction_probability AS score FROM predictions", "model_name"
    ),
    "log_loss": f"""SELECT COUNT(*) AS samples,
  ROUND(AVG(-(label * LN({_CLIPPED}) + (1 - label) * LN(1.0::DOUBLE - {_CLIPPED}))), 6) AS log_loss,
  ROUND(AVG(CASE WHEN CAST(score > 0.5 AS INTEGER) = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy
FROM ({_PAIRS})""",
    "threshold_sweep": f"""SELECT *, {_EVAL_METRICS} FROM (
  SELECT threshold, COUNT(*) FILTER (true_label = 1 AND prediction_probability > threshold) AS true_positives,
    COUNT(*) FILTER (true_label = 0 AND prediction_probability > threshold) AS false_positives,
    COUNT(*) FILTER (true_label = 0 AND prediction_probability <= threshold) AS true_negatives,
    COUNT(*) FILTER (true_label = 1 AND prediction_probability <= threshold) AS false_negatives
  FROM predictions, (SELECT UNNEST([{_THRESHOLDS}]::DOUBLE[]) AS threshold) GROUP BY threshold)""",
    "confusion_json": f"""SELECT model_name, {_JSON} AS confusion_matrix
FROM (SELECT model_name, {_EVAL_COUNTS} FROM predictions GROUP BY model_name)""",
    "evaluation_run": f"""SELECT 'eval-' || substr(sha256(c.model_name || '|' || c.model_version || '|' || c.dataset_split
    || '|{_RUN_TIME}'), 1, 32) AS evaluation_id, c.model_name, c.model_version, c.dataset_split,
  {_EVAL_METRICS}, a.auc AS auc_roc, {_JSON} AS confusion_matrix, total AS total_samples, {_RUN} AS evaluated_at,
  '{_RUN_TIME[:10]}' AS evaluation_date
FROM (SELECT model_name, model_version, dataset_split, COUNT(*) AS total, {_EVAL_COUNTS}
  FROM predictions p JOIN images i ON p.image_id = i.image_id GROUP BY ALL) c
JOIN ({_auc('''SELECT model_name, model_version, dataset_split, true_label AS label, prediction_probability AS score
    FROM predictions p JOIN images i ON p.image_id = i.image_id''', 'model_name, model_version, dataset_split')}) a
  ON c.model_name = a.model_name AND c.model_version = a.model_version AND c.dataset_split = a.dataset_split""",
    "split_exact": f"""SELECT image_id, category, CASE WHEN position < FLOOR(total * 0.7::DOUBLE) THEN 'train'
  WHEN position < FLOOR(total * 0.7::DOUBLE) + FLOOR(total * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split
FROM (SELECT image_id, category, ROW_NUMBER() OVER (ORDER BY {_SHUFFLE}) - 1 AS position, COUNT(*) OVER () AS total
  FROM images)""",
    "split_hash": f"""SELECT image_id, category, CASE WHEN {_HASH.format(seed=42)} / 4294967296.0::DOUBLE < 0.7 THEN 'train'
  WHEN {_HASH.format(seed=42)} / 4294967296.0::DOUBLE < 0.7::DOUBLE + 0.15::DOUBLE THEN 'val' ELSE 'test' END AS split FROM images""",
    "sample_per_class": _first_per_class(str(_PER_CLASS)),
    "stratified_quota": _first_per_class("CASE category WHEN 'NORMAL' THEN 3 ELSE 2 END"),
    "ab_assign": f"""SELECT image_id, CAST({_HASH.format(seed=7)} % 100 AS INTEGER) AS traffic_slot,
  CASE WHEN {_HASH.format(seed=7)} % 100 < 90 THEN 'clf-1' ELSE 'clf_alt-1' END AS served_model_name FROM images""",
    "batch_score": f"""SELECT image_id, ROUND(p, 6) AS prediction_probability, CAST(p > 0.5 AS INTEGER) AS predicted_label,
  ROUND(GREATEST(p, 1 - p), 6) AS confidence_score
FROM (SELECT CAST(vec_id AS VARCHAR) AS image_id, 1 / (1 + EXP(-({_LINEAR}))) AS p FROM embeddings)""",
    "prediction_log": f"""SELECT 'pred-' || substr(sha256(s.image_id || '|clf|1|{_RUN_TIME}'), 1, 32) AS prediction_id, s.image_id,
  CAST(p > 0.5 AS INTEGER) AS predicted_label, ROUND(p, 6) AS prediction_probability,
  ROUND(GREATEST(p, 1 - p), 6) AS confidence_score,
  CASE WHEN i.image_id IS NULL THEN NULL WHEN i.category = 'PNEUMONIA' THEN 1 ELSE 0 END AS true_label,
  CASE WHEN i.image_id IS NOT NULL THEN (p > 0.5) = (i.category = 'PNEUMONIA') END AS is_correct,
  'clf' AS model_name, '1' AS model_version, {_RUN} AS predicted_at, '{_RUN_TIME[:10]}' AS prediction_date
FROM (SELECT CAST(vec_id AS VARCHAR) AS image_id, 1 / (1 + EXP(-({_LINEAR}))) AS p FROM embeddings) s
LEFT JOIN images i ON s.image_id = i.image_id""",
    "scale_vector": f"""SELECT CAST(vec_id AS VARCHAR) AS image_id, CAST(i - 1 AS INTEGER) AS position,
  ROUND(embedding[i]::DOUBLE / 255.0::DOUBLE, 9) AS value
FROM embeddings, (SELECT UNNEST(range(1, 65)) AS i)""",
    "vector_stats": """SELECT CAST(vec_id AS VARCHAR) AS image_id,
  ROUND(list_avg(embedding::DOUBLE[]), 6) AS mean_pixel_value,
  ROUND(list_stddev_pop(embedding::DOUBLE[]), 6) AS std_pixel_value FROM embeddings""",
    "image_features": f"""SELECT CAST(vec_id AS VARCHAR) AS image_id, CAST(len(embedding) AS INTEGER) AS vector_length,
  'embedding-64' AS feature_extraction_model, ROUND(list_avg(embedding::DOUBLE[]), 6) AS mean_pixel_value,
  ROUND(list_stddev_pop(embedding::DOUBLE[]), 6) AS std_pixel_value, {_RUN} AS extracted_at FROM embeddings""",
    "retrain_set": """SELECT r.image_id, CASE WHEN r.ground_truth = 'PNEUMONIA' THEN 1 ELSE 0 END AS label, r.reviews,
  CAST(len(e.embedding) AS INTEGER) AS vector_length
FROM (SELECT p.image_id, f.ground_truth, COUNT(*) OVER (PARTITION BY p.image_id) AS reviews
  FROM latest f JOIN predictions p ON f.prediction_id = p.prediction_id
  QUALIFY ROW_NUMBER() OVER (PARTITION BY p.image_id ORDER BY f."timestamp" DESC, f.feedback_id DESC) = 1) r
JOIN embeddings e ON CAST(e.vec_id AS VARCHAR) = r.image_id""",
    "silver_transform": f"""SELECT image_id, CASE category WHEN 'PNEUMONIA' THEN 1 WHEN 'NORMAL' THEN 0 END AS label,
  category AS label_name, dataset_split, regexp_replace(file_path, '^dbfs:', '') AS file_path,
  CAST(NULL AS INTEGER) AS image_width, CAST(NULL AS INTEGER) AS image_height,
  (3 + CASE WHEN file_size_bytes > 0 THEN 1 ELSE 0 END) / 4.0::DOUBLE AS quality_score, {_RUN} AS processed_at,
  ingestion_batch_id AS source_batch_id FROM images""",
    "quality_report": _QUALITY,
    "ab_chi_square": f"""SELECT champion_correct, champion_wrong, challenger_correct, challenger_wrong, champion, challenger,
  ROUND(champion_accuracy, 6) AS champion_accuracy, ROUND(challenger_accuracy, 6) AS challenger_accuracy,
  ROUND(chi, 6) AS chi_square, chi > 3.841459 AS significant FROM ({_CHI})""",
    "ab_p_value": f"""SELECT champion, challenger, ROUND(chi, 6) AS chi_square,
  ROUND(1 - SQRT(2 * chi / PI()) * EXP(-chi / 2) * list_sum(list_transform(range(0, 150), lambda n:
    EXP(n * LN(chi) + n * LN(2.0::DOUBLE) + lgamma((n + 1)::DOUBLE) - lgamma((2 * n + 2)::DOUBLE)))), 6) AS p_value
FROM ({_CHI})""",
    "ab_decision": f"""SELECT champion, challenger, champion_correct + champion_wrong AS champion_reviewed,
  challenger_correct + challenger_wrong AS challenger_reviewed,
  ROUND(challenger_accuracy - champion_accuracy, 6) AS accuracy_difference, ROUND(chi, 6) AS chi_square,
  chi > 3.841459 AS significant,
  CASE WHEN champion_correct + champion_wrong < 30 OR challenger_correct + challenger_wrong < 30
      OR chi <= 3.841459 THEN 'KEEP TESTING'
    WHEN challenger_accuracy > champion_accuracy THEN 'PROMOTE'
    WHEN challenger_accuracy < champion_accuracy THEN 'ROLLBACK' ELSE 'KEEP TESTING' END AS decision
FROM ({_CHI})""",
    "stream_daily_error_rate": f"""SELECT *, "date" + INTERVAL 1 DAY + INTERVAL 1 DAY > {_NEWEST} AS provisional
FROM ({_daily(f"{_pct(_n(_MISS))} AS error_rate_pct, COUNT(*) AS total_predictions")})""",
    "stream_sliding_accuracy": f"""SELECT window_start, window_start + INTERVAL 7 DAYS AS window_end, COUNT(*) AS reviews,
  {_pct(_n(_HIT))} AS accuracy_pct, window_start + INTERVAL 7 DAYS + INTERVAL 1 DAY > {_NEWEST} AS provisional
FROM (SELECT feedback_type, DATE_TRUNC('day', "timestamp")::TIMESTAMP - to_days(CAST(UNNEST(range(0, 7)) AS INTEGER))
  AS window_start FROM feedback)
GROUP BY window_start""",
    "stream_review_sessions": f"""SELECT radiologist_id, MIN("timestamp") AS first_review, MAX("timestamp") AS last_review,
  COUNT(*) AS reviews, MAX("timestamp") + INTERVAL 30 MINUTES > {_NEWEST} - INTERVAL 1 DAY AS is_open
FROM (SELECT *, SUM(CASE WHEN gap <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END)
    OVER (PARTITION BY radiologist_id ORDER BY "timestamp", feedback_id) AS session
  FROM (SELECT *, "timestamp" - LAG("timestamp") OVER (PARTITION BY radiologist_id ORDER BY "timestamp", feedback_id) AS gap
    FROM feedback))
GROUP BY radiologist_id, session""",
    "stream_feedback_join": f"""SELECT p.prediction_id, p.model_name, p.predicted_at, f.feedback_id, f.feedback_type, f."timestamp",
  f.feedback_id IS NULL AND p.predicted_at + INTERVAL 96 HOURS
    >= LEAST((SELECT MAX(predicted_at) FROM predictions), {_NEWEST}) - INTERVAL 1 DAY AS is_open
FROM predictions p LEFT JOIN feedback f ON p.prediction_id = f.prediction_id
  AND f."timestamp" BETWEEN p.predicted_at AND p.predicted_at + INTERVAL 96 HOURS""",
    "stream_late_split": """SELECT feedback_id, "timestamp", batch_id, CASE WHEN "timestamp" < mark THEN mark END AS watermark,
  COALESCE("timestamp" < mark, FALSE) AS late
FROM (SELECT f.feedback_id, f."timestamp",
    LEAST(date_diff('day', DATE '2024-01-01', p.prediction_date) // 8, 3) AS batch_id
  FROM feedback f JOIN predictions p ON f.prediction_id = p.prediction_id) arrived
JOIN (SELECT batch, MAX(MAX("timestamp")) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      - INTERVAL 1 DAY AS mark
  FROM (SELECT f."timestamp", LEAST(date_diff('day', DATE '2024-01-01', p.prediction_date) // 8, 3) AS batch
    FROM feedback f JOIN predictions p ON f.prediction_id = p.prediction_id) GROUP BY batch) marks
  ON arrived.batch_id = marks.batch""",
    "stream_dedup": f"""SELECT {_FEEDBACK_COLUMNS} FROM feedback
QUALIFY ROW_NUMBER() OVER (PARTITION BY prediction_id, ground_truth ORDER BY "timestamp", feedback_id) = 1""",
}
SELECTS["batch_score_pandas"] = SELECTS["batch_score"]

ORACLES: dict[str, str] = {name: f"{BASE}\n{select}" for name, select in SELECTS.items()}
