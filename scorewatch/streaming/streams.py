"""Streaming reports, joins and loads.

Results are complete at any time. Windows are updated in a keyed table with every batch and marked provisional
until the watermark has passed them; sessions and predictions that the stream still holds open are added from
the tables by the functions that read the result. Rows that come later than the watermark allows are kept in a
table of their own (``split_late``).

State lives in RocksDB. The number of its partitions is fixed by a query's first start, so it is a parameter;
without one it is the session's number of shuffle partitions.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from scorewatch.functions import labels, numeric
from scorewatch.operators.skew import SALTS, TRACKED_ITEMS
from scorewatch.session import shared_folder
from scorewatch.sources import keyed

#: Buckets of the small tables that hold report windows.
WINDOW_BUCKETS = 2


# --- running ------------------------------------------------------------------------------------


@contextmanager
def _state_partitions(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    name = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(name)
    spark.conf.set(name, partitions or configured)
    try:
        yield
    finally:
        spark.conf.set(name, configured)


class Dropped(StreamingQueryListener):
    """Counts batches and the rows that the watermark dropped, over all batches of the queries that run meanwhile.

    A query's own ``recentProgress`` keeps its last hundred batches only.
    """

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def _of(self, run: object) -> str:
        self.ended.setdefault(str(run), threading.Event())
        return str(run)

    def onQueryStarted(self, event) -> None:
        self._of(event.runId)

    def onQueryProgress(self, event) -> None:
        run, progress = self._of(event.progress.runId), event.progress
        self.batches[run] = self.batches.get(run, 0) + 1
        self.rows[run] = self.rows.get(run, 0) + sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def total(self, run: object, seconds: float = 60) -> int:
        """Rows dropped by a run that has ended; waits until its last events have arrived."""
        self.ended.setdefault(str(run), threading.Event()).wait(seconds)
        return self.rows.get(str(run), 0)


def _run(writer, spark: SparkSession, checkpoint: str, partitions: int | None) -> int:
    """Process everything available and stop; returns how many rows the watermark dropped."""
    listener = Dropped()
    spark.streams.addListener(listener)
    try:
        with _state_partitions(spark, partitions):
            query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return listener.total(query.runId)
    finally:
        spark.streams.removeListener(listener)


def run_to_end(stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None) -> int:
    """Process everything available into a parquet folder and stop.

    Returns how many rows came too late and were dropped by the watermark.
    """
    writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
    return _run(writer, stream.sparkSession, checkpoint, partitions)


def each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", partitions: int | None = None
) -> int:
    """Process everything available, every micro-batch by ``write``; a batch may come again after a failure."""
    return _run(stream.writeStream.foreachBatch(write).outputMode(mode), stream.sparkSession, checkpoint, partitions)


def materialize(stream: DataFrame, purpose: str, partitions: int | None = None) -> DataFrame:
    """Result of a stream over all available data, written below the shared folder."""
    spark: SparkSession = stream.sparkSession
    root = shared_folder(spark, purpose)
    run_to_end(stream, f"{root}/rows", f"{root}/checkpoint", partitions)
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


# --- windows ------------------------------------------------------------------------------------


def outcome_windows(feedback: DataFrame, length: str = "1 day", step: str | None = None, delay: str = "1 day") -> DataFrame:
    """Reviews, hits and misses per window, and its newest review."""
    kind = F.col("feedback_type")
    return (
        feedback.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", length, step) if step else F.window("timestamp", length))
        .agg(
            F.count("*").alias("reviews"),
            numeric.tally(labels.is_hit(kind)).alias("hits"),
            numeric.tally(labels.is_miss(kind)).alias("misses"),
            F.max("timestamp").alias("newest_review"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "reviews", "hits", "misses", "newest_review")
    )


def keep_windows(windows: DataFrame, root: str, checkpoint: str, partitions: int | None = None) -> int:
    """Update a keyed table with the windows that each batch has changed; returns the number of rows dropped.

    A batch that runs again, or a stream that starts again from its source, leaves the table as it is.
    """

    def write(batch: DataFrame, number: int) -> None:
        keyed.merge(batch, root, "window_start", number, buckets=WINDOW_BUCKETS)

    return each_batch(windows, write, checkpoint, "update", partitions)


def read_windows(spark: SparkSession, root: str, delay: str = "1 day") -> DataFrame:
    """All windows so far; a window that the watermark has not passed is ``provisional``."""
    rows = keyed.read(spark, root, WINDOW_BUCKETS)
    newest = rows.agg(F.max("newest_review")).scalar()
    return rows.withColumn("provisional", F.col("window_end") + F.expr(f"INTERVAL {delay}") > newest)


def error_rates(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.col("window_start").alias("date"),
        numeric.percent(F.col("misses"), F.col("reviews")).alias("error_rate_pct"),
        F.col("reviews").alias("total_predictions"),
        "provisional",
    )


def accuracies(windows: DataFrame) -> DataFrame:
    return windows.select(
        "window_start", "window_end", "reviews", numeric.percent(F.col("hits"), F.col("reviews")).alias("accuracy_pct"), "provisional"
    )


# --- sessions -----------------------------------------------------------------------------------


def _sessions(feedback: DataFrame, gap: str) -> DataFrame:
    return (
        feedback.groupBy("radiologist_id", F.session_window("timestamp", gap))
        .agg(F.count("*").alias("reviews"), F.min("timestamp").alias("first_review"), F.max("timestamp").alias("last_review"))
        .select("radiologist_id", "first_review", "last_review", "reviews")
    )


def review_sessions(feedback: DataFrame, gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Closed work sessions per reviewer: reviews less than ``gap`` apart belong together."""
    return _sessions(feedback.withWatermark("timestamp", delay), gap)


def with_open_sessions(closed: DataFrame, feedback: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """The closed sessions of a stream and those still open, marked ``is_open``, from the table of its reviews.

    A reviewer's closed sessions lie before the open one, so the reviews behind the last closed session make up
    the rest; those of a reviewer without closed session do. NULL is a reviewer as any other. Rows that the
    watermark dropped lie before the last closed session and stay out.
    """
    last = closed.groupBy(F.col("radiologist_id").alias("reviewer")).agg(F.max("last_review").alias("last_closed"))
    behind = feedback.select("radiologist_id", "timestamp").join(last, F.col("radiologist_id").eqNullSafe(F.col("reviewer")), "left")
    rest = behind.where(F.col("last_closed").isNull() | (F.col("timestamp") > F.col("last_closed")))
    return closed.withColumn("is_open", F.lit(False)).unionByName(_sessions(rest, gap).withColumn("is_open", F.lit(True)))


# --- predictions and reviews --------------------------------------------------------------------


def watch_keys(stream: DataFrame, key: str, root: str, checkpoint: str, tracked: int = TRACKED_ITEMS) -> None:
    """Keep a frequency sketch of a key, one row per micro-batch; a batch that comes again replaces its row.

    Rows without a key are not counted.
    """

    def write(batch: DataFrame, number: int) -> None:
        sketch = batch.agg(F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("sketch"), F.count("*").alias("rows"))
        sketch.write.mode("overwrite").parquet(f"{root}/batch_id={number}")

    each_batch(stream.select(key).where(F.col(key).isNotNull()), write, checkpoint)


def hot_keys(spark: SparkSession, root: str, most: int = 512, share: float = 1.0 / 512, tracked: int = TRACKED_ITEMS) -> list:
    """Up to ``most`` keys that hold at least ``share`` of the rows seen by ``watch_keys``, and more than one row.

    The batches' sketches are merged, so the keys are those of the whole stream so far.
    """
    merged = spark.read.parquet(root).agg(
        F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("rows").alias("rows")
    )
    top, rows = merged.select(F.expr(f"approx_top_k_estimate(sketch, {most})"), "rows").first()
    return [e["item"] for e in top or [] if e["count"] >= max(share * (rows or 0), 2)]


def feedback_join(
    predictions: DataFrame,
    feedback: DataFrame,
    within: str = "96 hours",
    delay: str = "1 day",
    hot: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Predictions with their reviews; a prediction without one appears when its time is over.

    The time bound is what lets both sides drop old state. Reviews of the predictions listed in
    ``hot`` are spread over ``salts`` parts and only those predictions are repeated; the rows then
    carry their ``part`` and ``settle_hot`` reads them as if nothing had been spread. The list belongs to the
    query's state and stays as it was at its first start.
    """
    left = predictions.select("prediction_id", "model_name", "predicted_at").withWatermark("predicted_at", delay)
    right = feedback.select(
        F.col("prediction_id").alias("reviewed_id"), "feedback_id", "feedback_type", "timestamp"
    ).withWatermark("timestamp", delay)
    condition = (
        (F.col("prediction_id") == F.col("reviewed_id"))
        & (F.col("timestamp") >= F.col("predicted_at"))
        & (F.col("timestamp") <= F.col("predicted_at") + F.expr(f"INTERVAL {within}"))
    )
    columns = ["prediction_id", "model_name", "predicted_at", "feedback_id", "feedback_type", "timestamp"]
    if hot:
        parts = F.when(F.col("prediction_id").isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1)))
        part = F.when(F.col("reviewed_id").isin(*hot), F.pmod(F.xxhash64("feedback_id"), F.lit(salts)).cast("int"))
        left = left.withColumn("part", F.explode(F.coalesce(parts, F.array(F.lit(0)))))
        right = right.withColumn("reviewed_part", F.coalesce(part, F.lit(0)))
        condition = condition & (F.col("part") == F.col("reviewed_part"))
        columns = [*columns, "part"]
    return left.join(right, condition, "left_outer").select(*columns)


def settle_hot(rows: DataFrame, hot: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Rows of a spread ``feedback_join`` without their parts.

    A hot prediction has no review only if none of its parts has one.
    """
    if not hot:
        return rows
    empty = F.col("feedback_id").isNull() & F.col("prediction_id").isin(*hot)
    kept = rows.filter(~empty).drop("part")
    waiting = (
        rows.filter(empty)
        .groupBy("prediction_id", "model_name", "predicted_at")
        .agg(F.count_distinct("part").alias("parts"))
        .filter(F.col("parts") == salts)
        .drop("parts")
    )
    return kept.unionByName(waiting, allowMissingColumns=True)


def with_waiting(joined: DataFrame, predictions: DataFrame) -> DataFrame:
    """The result of a stream join and the predictions that it still holds, marked ``is_open``, from their table.

    ``joined`` are the settled rows. A prediction that has come out is reviewed or its time is over; all others
    wait for a review.
    """
    columns = ["prediction_id", "model_name", "predicted_at"]
    waiting = predictions.select(*columns).join(joined.select("prediction_id").distinct(), "prediction_id", "left_anti")
    return joined.withColumn("is_open", F.lit(False)).unionByName(
        waiting.withColumn("is_open", F.lit(True)), allowMissingColumns=True
    )


# --- late rows ----------------------------------------------------------------------------------


def split_late(stream: DataFrame, time: str, root: str, checkpoint: str, delay: str = "1 day") -> None:
    """Deal a stream's rows into the folders ``on_time`` and ``late`` below ``root``; none is dropped.

    A row is late if it is older than the watermark, which is the newest time of all batches before less
    ``delay``, as in Spark. Late rows carry the ``watermark`` that they missed. Each batch has a folder of its
    own in both, and one with the newest time so far, so a batch that comes again replaces its own. A stream
    over ``on_time`` with the same delay drops nothing. Rows without a time are on time.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        before = None
        if number:
            before = spark.read.parquet(f"{root}/progress/batch_id={number - 1}").first()["newest"]
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(F.col(time) < mark, F.lit(False))
        rows = batch.withColumn("watermark", mark).persist()
        try:
            rows.where(~late).drop("watermark").write.mode("overwrite").parquet(f"{root}/on_time/batch_id={number}")
            rows.where(late).write.mode("overwrite").parquet(f"{root}/late/batch_id={number}")
            newest = rows.agg(F.greatest(F.max(time), F.lit(before).cast("timestamp")).alias("newest"))
            newest.write.mode("overwrite").parquet(f"{root}/progress/batch_id={number}")
        finally:
            rows.unpersist()

    each_batch(stream, write, checkpoint)


# --- loads --------------------------------------------------------------------------------------


def deduplicate(feedback: DataFrame, keys: Sequence[str], root: str, checkpoint: str, partitions: int | None = None) -> None:
    """Keep the first review per key with all its columns in a keyed table: retried saves are dropped.

    First is the earliest by its time, then by its id. A retry is recognised however late it comes.
    """

    def write(batch: DataFrame, number: int) -> None:
        keyed.merge(batch, root, keys, number, order=["timestamp", "feedback_id"], first=True)

    each_batch(feedback, write, checkpoint, partitions=partitions)


def load_batches(stream: DataFrame, root: str, key: str, order: str, checkpoint: str) -> None:
    """Merge every micro-batch into a keyed table: the newest batch counts, in it the highest ``order``.

    A batch costs its own rows and the buckets they fall into; one that runs again changes nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        keyed.merge(batch, root, key, number, order=[order])

    each_batch(stream, write, checkpoint)
