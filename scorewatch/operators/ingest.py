"""Loading raw metadata: freshness, keyed upsert, change feed, batch summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import labels, payloads, texts, times
from scorewatch.schemas import PREDICTIONS, conform


def freshness_gate(table: DataFrame, source_updated_at: Column, loaded_col: str = "ingested_at") -> DataFrame:
    """One row: when the source changed, when the table was last loaded, whether to load again.

    An empty table always loads; a source no newer than the last load does not.
    """
    newest = table.agg(F.max(loaded_col).alias("last_ingested"))
    updated = source_updated_at
    run = F.col("last_ingested").isNull() | (F.col("source_updated_at") > F.col("last_ingested"))
    return newest.withColumn("source_updated_at", updated).select(
        "source_updated_at",
        "last_ingested",
        run.alias("should_run"),
        F.when(F.col("last_ingested").isNull(), "first load").when(run, "source is newer").otherwise("up to date").alias(
            "reason"
        ),
    )


def high_water_mark(table: DataFrame, ts_col: str):
    """Newest timestamp of a table, None when it is empty (one value)."""
    return table.agg(F.max(ts_col)).first()[0]


def incremental_slice(source: DataFrame, ts_col: str, since) -> DataFrame:
    """Rows newer than ``since``; all rows when it is None. A literal bound reaches the scan."""
    return source if since is None else source.filter(F.col(ts_col) > F.lit(since))


def stamp_batch(rows: DataFrame, loaded_at: Column) -> DataFrame:
    """Mark rows with their load time and the batch id made of it."""
    return rows.withColumns({"ingested_at": loaded_at, "ingestion_batch_id": times.batch_id(loaded_at)})


def unique_by_key(source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows of a load; two rows with one key are an error, raised while the job runs."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = F.struct(*[c for c in source.columns if c not in keys])
    grouped = source.groupBy(*keys).agg(F.first(payload).alias("row"), F.count("*").alias("copies"))
    message = F.concat(F.lit("duplicate source key: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
    checked = grouped.withColumn("row", F.when(F.col("copies") > 1, F.raise_error(message)).otherwise(F.col("row")))
    return checked.select(*keys, "row.*").select(*source.columns)


def upsert_by_key(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Target after a keyed merge: matched rows take the source's values, new rows are added.

    The rows only; ``sources.keyed`` keeps them in a table whose other files stay as they are. Two source rows
    with one key are an error, raised while the job runs. The target is only filtered: with a batch small
    enough to broadcast, by its measured size, it is not shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(source.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(unique_by_key(source, keys).select(*target.columns))


def change_feed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Row changes between two versions: insert, delete, update_preimage, update_postimage.

    One full outer join on the key; values are compared NULL-safe, unchanged rows are left out.
    """
    values = [c for c in old.columns if c != key]
    before = old.select(key, F.struct(*values).alias("before"))
    after = new.select(key, F.struct(*values).alias("after"))
    tag = lambda name, row: F.struct(F.lit(name).alias("change_type"), F.col(row).alias("row"))
    changes = (
        F.when(F.col("before").isNull(), F.array(tag("insert", "after")))
        .when(F.col("after").isNull(), F.array(tag("delete", "before")))
        .otherwise(F.array(tag("update_preimage", "before"), tag("update_postimage", "after")))
    )
    return (
        before.join(after, key, "full_outer")
        .filter(~F.col("before").eqNullSafe(F.col("after")))
        .select(key, F.explode(changes).alias("change"))
        .select("change.change_type", key, "change.row.*")
    )


def migrate_log(log: DataFrame) -> DataFrame:
    """Request log in the layout of the prediction table.

    Image and truth are not in the log. The raw score is kept as the confidence, and a response
    without a score gets label 0.
    """
    score = payloads.response_score(F.col("response"))
    at = times.from_epoch_ms(F.col("timestamp_ms"))
    return conform(
        log.select(
            F.col("request_id").alias("prediction_id"),
            F.when(score > K.DECISION_THRESHOLD, 1).otherwise(0).alias("predicted_label"),
            score.alias("prediction_probability"),
            score.alias("confidence_score"),
            F.col("served_model_name").alias("model_name"),
            texts.version_suffix(F.col("served_model_name")).alias("model_version"),
            at.alias("predicted_at"),
            F.to_date(at).alias("prediction_date"),
        ),
        PREDICTIONS,
    )


def batch_count(images: DataFrame, batch: str | None = None) -> DataFrame:
    """Number of rows, of one batch or of all."""
    return _of_batch(images, batch).agg(F.count("*").alias("total"))


def count_by_category(images: DataFrame) -> DataFrame:
    return images.groupBy("category").agg(F.count("*").alias("count"))


def ingest_summary(images: DataFrame, batch: str | None = None) -> DataFrame:
    """Count, sizes and load times by class and split, of one batch or of all."""
    return (
        _of_batch(images, batch)
        .groupBy("category", "dataset_split")
        .agg(
            F.count("*").alias("image_count"),
            F.sum("file_size_bytes").alias("total_size_bytes"),
            F.avg("file_size_bytes").alias("avg_size_bytes"),
            F.min("ingested_at").alias("first_ingested"),
            F.max("ingested_at").alias("last_ingested"),
        )
        .orderBy("category", "dataset_split")
    )


def _of_batch(images: DataFrame, batch: str | None) -> DataFrame:
    return images if batch is None else images.filter(F.col("ingestion_batch_id") == batch)


def sample_rows(images: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows by id, so that a limit always means the same rows."""
    return images.orderBy("image_id").limit(rows)


def lookup_by_id(images: DataFrame, image_id: str) -> DataFrame:
    """Path and name of one image. The id is a bound value, never part of a SQL text."""
    return images.filter(F.col("image_id") == F.lit(image_id)).select("file_path", "filename").limit(1)


def normalize_paths(images: DataFrame) -> DataFrame:
    """Local path and stem of every file."""
    return images.select(
        "image_id",
        texts.strip_storage_prefix(F.col("file_path")).alias("local_path"),
        texts.file_stem(F.col("filename")).alias("stem"),
    )


def image_labels(images: DataFrame) -> DataFrame:
    """Class name with its label."""
    return images.select("image_id", "category", labels.encode_label(F.col("category")).alias("label"))
