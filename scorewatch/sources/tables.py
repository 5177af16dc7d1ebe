"""Reading and writing parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.schemas import conform


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_or_replace(df: DataFrame, name: str, path: str) -> None:
    """Write a catalog table below ``path``, in place of what it held.

    ``df`` must not read the table itself; a table that is changed from its own rows is a keyed table
    (``sources.keyed``).
    """
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows after conforming them to the table's schema."""
    conform(df, schema).write.mode("append").parquet(path)


def write_by_date(df: DataFrame, path: str, date_col: str) -> None:
    """One folder per date, few files each.

    The rebalance hint gathers a date's rows by their measured size: small dates share a task, and
    a date with a third of all rows is written by as many tasks as its size asks for.
    """
    df.hint("rebalance", date_col).write.mode("overwrite").partitionBy(date_col).parquet(path)


def read_dates(spark: SparkSession, path: str, date_col: str, first: str, last: str) -> DataFrame:
    """Rows of a date range; folders outside it are never listed as input."""
    return spark.read.parquet(path).filter(F.col(date_col).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "nullValue": "\\N",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def write_csv(df: DataFrame, path: str) -> None:
    """Text export; timestamps keep their microseconds, NULL stays apart from empty text."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with a declared schema; inference would read the data twice."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
