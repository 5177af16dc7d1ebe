"""Declared table schemas and conformance to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(*columns: tuple[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_B, _TS, _DT = T.BooleanType(), T.TimestampType(), T.DateType()

RAW_IMAGES = _schema(
    ("image_id", _S),
    ("filename", _S),
    ("category", _S),
    ("dataset_split", _S),
    ("file_path", _S),
    ("file_size_bytes", _L),
    ("ingested_at", _TS),
    ("ingestion_batch_id", _S),
)

CLEAN_IMAGES = _schema(
    ("image_id", _S),
    ("label", _I),
    ("label_name", _S),
    ("dataset_split", _S),
    ("file_path", _S),
    ("image_width", _I),
    ("image_height", _I),
    ("quality_score", _D),
    ("processed_at", _TS),
    ("source_batch_id", _S),
)

IMAGE_FEATURES = _schema(
    ("image_id", _S),
    ("feature_vector", T.ArrayType(_D)),
    ("feature_extraction_model", _S),
    ("mean_pixel_value", _D),
    ("std_pixel_value", _D),
    ("extracted_at", _TS),
)

PREDICTIONS = _schema(
    ("prediction_id", _S),
    ("image_id", _S),
    ("predicted_label", _I),
    ("prediction_probability", _D),
    ("confidence_score", _D),
    ("true_label", _I),
    ("is_correct", _B),
    ("model_name", _S),
    ("model_version", _S),
    ("predicted_at", _TS),
    ("prediction_date", _DT),
)

FEEDBACK = _schema(
    ("feedback_id", _S),
    ("prediction_id", _S),
    ("timestamp", _TS),
    ("ground_truth", _S),
    ("feedback_type", _S),
    ("radiologist_id", _S),
    ("confidence", _S),
    ("feedback_source", _S),
    ("notes", _S),
    required=("feedback_id", "prediction_id", "timestamp", "ground_truth"),
)

MODEL_PERFORMANCE = _schema(
    ("evaluation_id", _S),
    ("model_name", _S),
    ("model_version", _S),
    ("dataset_split", _S),
    ("accuracy", _D),
    ("precision", _D),
    ("recall", _D),
    ("f1_score", _D),
    ("auc_roc", _D),
    ("confusion_matrix", _S),
    ("total_samples", _L),
    ("evaluated_at", _TS),
    ("evaluation_date", _DT),
)

# Request log, one row per call, model name inside a map.
PAYLOAD_LOG = _schema(
    ("request_metadata", T.MapType(_S, _S)),
    ("response", _S),
    ("timestamp_ms", _L),
    ("status_code", _I),
)

# Request log, one row per call, served model as a column.
REQUEST_LOG = _schema(
    ("request_id", _S),
    ("served_model_name", _S),
    ("timestamp", _TS),
    ("timestamp_ms", _L),
    ("date", _DT),
    ("response", _S),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to exactly the columns and types of ``schema``.

    Missing columns become NULL, extra ones are dropped, text timestamps are cast. Values that do
    not fit become NULL, so a bad row shows up in ``quality_report`` instead of failing the load.
    """
    present = set(df.columns)
    typed = {f.name: f.dataType.simpleString() for f in schema.fields}
    return df.selectExpr(
        *[
            f"try_cast(`{name}` AS {kind}) AS `{name}`" if name in present else f"CAST(NULL AS {kind}) AS `{name}`"
            for name, kind in typed.items()
        ]
    )


def required_columns(schema: T.StructType) -> list[str]:
    """Names of the NOT NULL columns."""
    return [f.name for f in schema.fields if not f.nullable]
