"""Listing of image files as metadata rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import texts, times
from scorewatch.schemas import RAW_IMAGES, conform
from scorewatch.sources.listing import list_files


def list_images(
    spark: SparkSession,
    folder: str,
    ingested_at: Column,
    suffix: str = K.IMAGE_SUFFIX,
    split: str = "train",
) -> DataFrame:
    """One raw metadata row per file below ``folder``, class taken from the file's own folder.

    The file contents are never read; only names, sizes and times leave the file system. Each sub-folder is
    listed by a task (``sources.listing``).
    """
    files = list_files(spark, folder, suffix)
    name = texts.base_name(F.col("path"))
    return conform(
        files.select(
            texts.file_stem(name, suffix).alias("image_id"),
            name.alias("filename"),
            F.upper(F.regexp_replace(texts.parent_name(F.col("path")), "^[^=]*=", "")).alias("category"),
            F.lit(split).alias("dataset_split"),
            F.col("path").alias("file_path"),
            F.col("length").alias("file_size_bytes"),
            ingested_at.alias("ingested_at"),
            times.batch_id(ingested_at).alias("ingestion_batch_id"),
        ),
        RAW_IMAGES,
    )
