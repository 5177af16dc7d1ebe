"""Tables with one row per key, kept in buckets of the key's hash.

A merge reads and rewrites the buckets whose rows it changes; all other files stay as they are. The buckets are
folders of an ordinary partitioned parquet table, replaced with Spark's dynamic partition overwrite. Rows are
first merged into a staging folder; a failure before that is finished leaves the table as it was, and one while
buckets are replaced is made good from the staging folder by the next merge. A table has one writer at a time.

The number of buckets is part of the partition column's name, so a table cannot be read or written with
another one. A bucket should hold some hundred megabytes: a load of few keys then touches few of many buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16
#: Number of the load that a stored row came with.
LOAD = "load_number"


def _bucket_name(buckets: int) -> str:
    return f"bucket_of_{buckets}"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, root: str, buckets: int = BUCKETS) -> bool:
    """Whether a load has been merged. A finished merge that stored nothing leaves no table."""
    files, path = _path(spark, f"{root}/{_bucket_name(buckets)}=*")
    return bool(files.globStatus(path))


def stored(spark: SparkSession, root: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows of the table with their bucket and load number."""
    finish(spark, root, buckets)
    return spark.read.parquet(root)


def read(spark: SparkSession, root: str, buckets: int = BUCKETS) -> DataFrame:
    """One row per key."""
    return stored(spark, root, buckets).drop(LOAD, _bucket_name(buckets))


def finish(spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
    """Replace the buckets of a merge that was staged but not finished. Doing it again changes nothing."""
    staging = f"{root}/_staged"
    files, done = _path(spark, f"{staging}/_SUCCESS")
    if not files.exists(done):
        return
    name = _bucket_name(buckets)
    rows = spark.read.parquet(staging)
    changed = [r[0] for r in rows.where("_new").select(name).distinct().collect()]
    if changed:
        rows.where(F.col(name).isin(changed)).drop("_new").hint("rebalance", name).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(name).parquet(root)
    files.delete(_path(spark, staging)[1], True)


def merge(
    batch: DataFrame,
    root: str,
    keys: str | Sequence[str],
    number: int,
    order: Sequence[str | Column] = (),
    first: bool = False,
    buckets: int = BUCKETS,
) -> None:
    """Merge a load: per key the row of the highest load number, then of the highest ``order``, is kept.

    With ``first`` the row of the lowest ``order`` is kept instead, whatever its load. Of equal rows the stored
    one stays, so a load that is merged again changes no file. Order values must be comparable and should tell
    rows of one key and load apart; if they do not, the row with the greater hash of all columns is taken. Keys
    may be NULL, which is a key of its own. Columns must be those of the table.

    The load is read once and kept for the merge; rows of a key combine before the shuffle. At most one number
    per bucket reaches the driver.
    """
    spark, name = batch.sparkSession, _bucket_name(buckets)
    keys = [keys] if isinstance(keys, str) else list(keys)
    finish(spark, root, buckets)
    columns = batch.columns
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    incoming = batch.withColumns({LOAD: F.lit(number).cast("long"), name: bucket, "_new": F.lit(True)}).persist()
    try:
        rows = incoming
        if exists(spark, root, buckets):
            touched = [r[0] for r in incoming.select(name).distinct().collect()]
            old = spark.read.parquet(root).where(F.col(name).isin(touched)).withColumn("_new", F.lit(False))
            if set(old.columns) != set(incoming.columns):
                raise ValueError(f"columns {sorted(columns)} are not those of the table: {sorted(old.columns)}")
            rows = old.unionByName(incoming)
        order = [F.col(c) if isinstance(c, str) else c for c in order]
        mark = F.xxhash64(*columns)
        if first:
            best, rank = F.min_by, F.struct(*order, mark, F.col("_new"))
        else:
            best, rank = F.max_by, F.struct(F.col(LOAD), *order, mark, ~F.col("_new"))
        rest = [c for c in rows.columns if c not in keys]
        won = rows.groupBy(*keys).agg(best(F.struct(*rest), rank).alias("row")).select(*keys, "row.*")
        won.select(*columns, LOAD, "_new", name).write.mode("overwrite").parquet(f"{root}/_staged")
    finally:
        incoming.unpersist()
    finish(spark, root, buckets)
