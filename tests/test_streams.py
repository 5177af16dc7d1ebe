"""Streams: replays, late rows, several batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import ingest
from scorewatch.session import shared_folder
from scorewatch.sources import keyed, testbed
from scorewatch.streaming import streams

START = dt.datetime(2024, 1, 1)
FEEDBACK = "feedback_id string, prediction_id string, timestamp timestamp, ground_truth string, feedback_type string, radiologist_id string"


@pytest.fixture()
def source(spark):
    """A folder that a stream reads, and a way to add files to it."""
    folder = shared_folder(spark, "test-source")

    def add(*reviews):
        data = [(f, p, START + dt.timedelta(hours=h), "NORMAL", kind, "DR1") for f, p, h, kind in reviews]
        spark.createDataFrame(data, FEEDBACK).coalesce(1).write.mode("append").parquet(folder)

    stream = lambda: spark.readStream.schema(FEEDBACK).parquet(folder)
    return add, stream


def windows(spark, root):
    rows = streams.error_rates(streams.read_windows(spark, f"{root}/rows")).collect()
    return sorted((r.date.day, r.total_predictions, r.error_rate_pct, r.provisional) for r in rows)


def test_windows_are_updated_and_replays_change_nothing(spark, source):
    add, stream = source
    root = shared_folder(spark, "test-windows")
    run = lambda state: streams.keep_windows(streams.outcome_windows(stream()), f"{root}/rows", f"{root}/{state}", 2)
    add(("a", "1", 1, "false-positive"), ("b", "2", 2, "true-positive"), ("c", "3", 60, "true-positive"))
    run("state")
    assert windows(spark, root) == [(1, 2, 50.0, False), (3, 1, 0.0, True)]
    run("state")
    add(("d", "4", 61, "false-negative"), ("e", "5", 120, "true-positive"))
    run("state")
    want = [(1, 2, 50.0, False), (3, 2, 50.0, False), (6, 1, 0.0, True)]
    assert windows(spark, root) == want
    # A lost checkpoint runs everything again, under numbers that are taken.
    run("lost")
    assert windows(spark, root) == want


def test_dropped_rows_of_many_batches_are_counted(spark):
    """More batches than a query's own progress remembers; every second one brings a late row."""
    folder = shared_folder(spark, "test-many")
    schema = "feedback_type string, timestamp timestamp"
    for k in range(104):
        at = START + dt.timedelta(days=k if k % 2 == 0 else k - 50)
        spark.createDataFrame([("true-positive", at)], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    root = shared_folder(spark, "test-many-out")
    counts = streams.outcome_windows(stream).select("window_start", "reviews")
    assert streams.run_to_end(counts, f"{root}/rows", f"{root}/state", 1) == 51


def test_late_rows_are_kept(spark, source):
    """On-time and late rows are all rows; a stream over the former drops none, in several runs."""
    add, stream = source
    root = shared_folder(spark, "test-split")
    run = lambda: streams.split_late(stream(), "timestamp", root, f"{root}/state")
    add(("a", "1", 1, "true-positive"), ("b", "2", 200, "true-positive"), ("none", "2", 0, None))
    run()
    add(("late", "3", 2, "true-positive"), ("edge", "3", 176, None), ("c", "4", 300, "true-positive"))
    run()
    run()
    add(("later", "5", 275, "true-positive"), ("d", "6", 276, "true-positive"))
    run()
    late = spark.read.parquet(f"{root}/late")
    assert sorted((r.feedback_id, r.batch_id, r.watermark) for r in late.collect()) == [
        ("late", 1, START + dt.timedelta(hours=176)), ("later", 2, START + dt.timedelta(hours=276))
    ]
    on_time = spark.read.parquet(f"{root}/on_time")
    assert sorted(r.feedback_id for r in on_time.collect()) == ["a", "b", "c", "d", "edge", "none"]
    again = spark.readStream.schema(on_time.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/on_time")
    assert streams.keep_windows(streams.outcome_windows(again), f"{root}/windows", f"{root}/windows-state", 1) == 0
    # A batch that comes again after a lost checkpoint replaces its own folders.
    streams.split_late(stream(), "timestamp", root, f"{root}/lost")
    assert spark.read.parquet(f"{root}/on_time").where("batch_id = 0").count() == 8


def test_deduplication_keeps_whole_first_reviews(spark, source):
    add, stream = source
    root = shared_folder(spark, "test-dedup")
    run = lambda state: streams.deduplicate(stream(), ["prediction_id", "ground_truth"], f"{root}/rows", f"{root}/{state}")
    add(("a", "1", 5, "true-positive"), ("b", "2", 2, "false-positive"), ("a2", "2", 2, "true-positive"))
    run("state")
    add(("again", "1", 900, "false-positive"), ("earlier", "1", 4, None), ("c", "3", 2, None))
    run("state")
    held = lambda: sorted(tuple(r) for r in keyed.read(spark, f"{root}/rows").select(stream().columns).collect())
    row = lambda f, p, h, kind: (f, p, START + dt.timedelta(hours=h), "NORMAL", kind, "DR1")
    want = [row("a2", "2", 2, "true-positive"), row("c", "3", 2, None), row("earlier", "1", 4, None)]
    assert held() == want
    run("lost")
    assert held() == want


def test_loading_batches_is_idempotent(spark, sf_dir):
    root = shared_folder(spark, "test-load")
    log = testbed.request_log_from(testbed.event_stream(spark, sf_dir))
    marks = []
    for state in ("first", "replay"):
        # A lost checkpoint runs every batch again under the same numbers.
        streams.load_batches(ingest.migrate_log(log), f"{root}/rows", "prediction_id", "predicted_at", f"{root}/{state}")
        marks.append(sorted({r[0] for r in spark.read.parquet(f"{root}/rows").select(F.input_file_name()).distinct().collect()}))
    assert marks[0] == marks[1]
    assert keyed.read(spark, f"{root}/rows").count() == testbed.request_log(spark, sf_dir).count()


def test_newest_batch_wins(spark):
    folder, root = shared_folder(spark, "test-latest"), shared_folder(spark, "test-latest-out")
    for value in ("old", "new"):
        spark.createDataFrame([("k", value, 9 if value == "old" else 1), (value, value, 1)], "id string, v string, at int").write.mode(
            "append"
        ).parquet(folder)
        stream = spark.readStream.schema("id string, v string, at int").parquet(folder)
        streams.load_batches(stream, f"{root}/rows", "id", "at", f"{root}/state")
    rows = keyed.read(spark, f"{root}/rows").select("id", "v", "at").collect()
    assert sorted(map(tuple, rows)) == [("k", "new", 1), ("new", "new", 1), ("old", "old", 1)]


def test_open_sessions_are_added(spark):
    """Closed sessions of the stream and open ones from the table; NULL reviewers and reviewers without a closed session."""
    data = [("a", 1, "DR1"), ("b", 1.2, "DR1"), ("c", 90, "DR1"), ("d", 90.3, "DR1"), ("e", 1, None), ("f", 99, None), ("g", 98, "DR2")]
    folder = shared_folder(spark, "test-sessions")
    reviews = [(f, "9", START + dt.timedelta(hours=h), "NORMAL", None, who) for f, h, who in data]
    spark.createDataFrame(reviews, FEEDBACK).coalesce(1).write.parquet(folder)
    live = spark.readStream.schema(FEEDBACK).parquet(folder)
    closed = streams.materialize(streams.review_sessions(live), "test-closed", 2)
    rows = streams.with_open_sessions(closed, spark.read.parquet(folder)).collect()
    hours = lambda t: round((t - START) / dt.timedelta(hours=1), 1)
    found = sorted((str(r.radiologist_id), hours(r.first_review), hours(r.last_review), r.reviews, r.is_open) for r in rows)
    assert found == [
        ("DR1", 1.0, 1.2, 2, False), ("DR1", 90.0, 90.3, 2, True), ("DR2", 98.0, 98.0, 1, True),
        ("None", 1.0, 1.0, 1, False), ("None", 99.0, 99.0, 1, True),
    ]


def test_hot_keys_of_all_batches(spark):
    """Sketches of several batches merge; a key that is hot only over all of them is found."""
    folder, root = shared_folder(spark, "test-keys"), shared_folder(spark, "test-sketches")
    for part in range(3):
        keys = ["hot"] * 40 + [f"own{part}"] * 30 + [f"k{part}-{i}" for i in range(100)] + [None] * 50
        spark.createDataFrame([(k,) for k in keys], "prediction_id string").write.mode("append").parquet(folder)
        stream = spark.readStream.schema("prediction_id string").parquet(folder)
        streams.watch_keys(stream, "prediction_id", f"{root}/rows", f"{root}/state")
    assert spark.read.parquet(f"{root}/rows").count() == 3
    assert streams.hot_keys(spark, f"{root}/rows", share=0.1) == ["hot"]
    assert set(streams.hot_keys(spark, f"{root}/rows", share=0.0)) == {"hot", "own0", "own1", "own2"}
    assert streams.hot_keys(spark, f"{root}/rows", most=1, share=0.0) == ["hot"]


def test_unreviewed_predictions_appear_when_their_time_is_over(spark, source):
    add, stream = source
    folder = shared_folder(spark, "test-predictions")
    data = [(f"p{i}", "m", START + dt.timedelta(hours=h)) for i, h in enumerate((0, 1, 400))]
    schema = "prediction_id string, model_name string, predicted_at timestamp"
    spark.createDataFrame(data, schema).write.parquet(folder)
    add(("f", "p0", 5, "true-positive"), ("g", "p1", 300, "true-positive"), ("h", "other", 400, "true-positive"))
    joined = streams.feedback_join(spark.readStream.schema(schema).parquet(folder), stream())
    got = sorted((r.prediction_id, r.feedback_id) for r in streams.materialize(joined, "test-join").collect())
    assert got == [("p0", "f"), ("p1", None)]


def test_waiting_predictions_are_added(spark, source):
    """Every prediction comes out: reviewed, its time over, or still open."""
    add, stream = source
    folder = shared_folder(spark, "test-waiting")
    schema = "prediction_id string, model_name string, predicted_at timestamp"
    spark.createDataFrame([(f"p{i}", "m", START + dt.timedelta(hours=h)) for i, h in enumerate((0, 1, 399, 400))], schema).write.parquet(folder)
    add(("f", "p0", 5, "true-positive"), ("h", "p3", 401, "true-positive"))
    joined = streams.materialize(streams.feedback_join(spark.readStream.schema(schema).parquet(folder), stream()), "test-join", 2)
    rows = streams.with_waiting(streams.settle_hot(joined, []), spark.read.parquet(folder)).collect()
    assert sorted((r.prediction_id, r.feedback_id, r.is_open) for r in rows) == [
        ("p0", "f", False), ("p1", None, False), ("p2", None, True), ("p3", "h", False)
    ]


def test_hot_predictions_can_be_spread(spark, source):
    add, stream = source
    folder = shared_folder(spark, "test-hot")
    data = [(f"p{i}", "m", START) for i in range(4)] + [("last", "m", START + dt.timedelta(hours=400))]
    schema = "prediction_id string, model_name string, predicted_at timestamp"
    spark.createDataFrame(data, schema).write.parquet(folder)
    add(*[(f"f{i}", "p0", 5, "true-positive") for i in range(30)], ("g", "p1", 6, "true-positive"), ("h", "x", 400, None))
    predictions = lambda: spark.readStream.schema(schema).parquet(folder)
    plain = streams.materialize(streams.feedback_join(predictions(), stream()), "test-plain")
    hot = ["p0", "p2"]
    spread = streams.materialize(streams.feedback_join(predictions(), stream(), hot=hot, salts=4), "test-spread")
    assert spread.filter("prediction_id = 'p0' AND feedback_id IS NOT NULL").select("part").distinct().count() > 1
    settled = streams.settle_hot(spread, hot, salts=4)
    assert sorted(map(str, settled.collect())) == sorted(map(str, plain.collect()))
    assert sorted(r.prediction_id for r in settled.filter("feedback_id IS NULL").collect()) == ["p2", "p3"]


def test_windows_match_the_batch_report(spark, sf_dir):
    from scorewatch.operators import metrics

    root = shared_folder(spark, "test-daily")
    stream = testbed.feedback_from(testbed.event_stream(spark, sf_dir))
    streams.keep_windows(streams.outcome_windows(stream), f"{root}/rows", f"{root}/state", 2)
    rates = streams.error_rates(streams.read_windows(spark, f"{root}/rows"))
    batch = metrics.daily_error_rate(testbed.feedback(spark, sf_dir))
    assert rates.select(batch.columns).exceptAll(batch).count() == batch.exceptAll(rates.select(batch.columns)).count() == 0
    assert 0 < rates.where("provisional").count() < rates.count() == batch.count()
