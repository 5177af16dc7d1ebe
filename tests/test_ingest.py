"""Loads: upsert, change feed, freshness, versions, listing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import ingest
from scorewatch.schemas import FEEDBACK, RAW_IMAGES, conform, required_columns
from scorewatch.session import shared_folder
from scorewatch.sources import files, listing, tables, testbed

SCHEMA = "id string, v int, w string"


def table(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert(rows):
    target = rows([("a", 1, "x"), ("b", 2, "x")], SCHEMA)
    source = rows([("b", 3, None), ("c", 4, "y")], SCHEMA)
    once = ingest.upsert_by_key(target, source, "id")
    assert table(once.fillna("-")) == [("a", 1, "x"), ("b", 3, "-"), ("c", 4, "y")]
    assert table(ingest.upsert_by_key(once, source, "id").fillna("-")) == table(once.fillna("-"))


def test_upsert_into_empty_target(rows):
    source = rows([("b", 3, "y")], SCHEMA)
    assert table(ingest.upsert_by_key(rows([], SCHEMA), source, "id")) == [("b", 3, "y")]


def test_upsert_rejects_duplicate_source_keys(rows):
    source = rows([("b", 3, "y"), ("b", 4, "z")], SCHEMA)
    with pytest.raises(Exception, match="duplicate source key: b"):
        ingest.upsert_by_key(rows([("a", 1, "x")], SCHEMA), source, "id").collect()


def test_upsert_by_two_keys(rows):
    target = rows([("a", 1, "x"), ("a", 2, "x")], SCHEMA)
    merged = ingest.upsert_by_key(target, rows([("a", 2, "new")], SCHEMA), ["id", "v"])
    assert table(merged) == [("a", 1, "x"), ("a", 2, "new")]


def test_change_feed(rows):
    old = rows([("keep", 1, "x"), ("gone", 2, "x"), ("to_null", 3, "x"), ("from_null", 4, None)], SCHEMA)
    new = rows([("keep", 1, "x"), ("new", 9, None), ("to_null", 3, None), ("from_null", 4, "y")], SCHEMA)
    got = [(r.change_type, r.id, r.w) for r in ingest.change_feed(old, new, "id").collect()]
    assert sorted(got, key=str) == sorted(
        [
            ("insert", "new", None),
            ("delete", "gone", "x"),
            ("update_preimage", "to_null", "x"),
            ("update_postimage", "to_null", None),
            ("update_preimage", "from_null", None),
            ("update_postimage", "from_null", "y"),
        ],
        key=str,
    )


@pytest.mark.parametrize(
    ("loaded", "source", "run", "reason"),
    [
        ([], "2024-01-01 00:00:00", True, "first load"),
        ([dt.datetime(2024, 1, 1)], "2024-01-01 00:00:00", False, "up to date"),
        ([dt.datetime(2024, 1, 1)], "2024-01-01 00:00:01", True, "source is newer"),
    ],
)
def test_freshness(rows, loaded, source, run, reason):
    gate = ingest.freshness_gate(rows([(t,) for t in loaded], "ingested_at timestamp"), F.lit(source).cast("timestamp"))
    row = gate.collect()[0]
    assert (row.should_run, row.reason) == (run, reason)


def test_incremental_slice_pushes_its_bound(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert ingest.incremental_slice(events, "event_id", None).count() == events.count()
    part = ingest.incremental_slice(events, "event_id", 900)
    assert "GreaterThan(event_id,900)" in part._jdf.queryExecution().executedPlan().toString()


def test_conform(rows):
    frame = rows([("f1", "p1", "2024-01-01 00:00:00", "bad date", 5)], "feedback_id string, prediction_id string, timestamp string, confidence string, extra int")
    got = conform(frame, FEEDBACK)
    assert got.columns == FEEDBACK.fieldNames()
    assert got.collect()[0].timestamp == dt.datetime(2024, 1, 1)
    assert required_columns(FEEDBACK) == ["feedback_id", "prediction_id", "timestamp", "ground_truth"]
    assert conform(rows([("x",)], "ingested_at string"), RAW_IMAGES).collect()[0].ingested_at is None


def test_tables_are_replaced(spark, rows):
    path = shared_folder(spark, "test-tables")
    name = "test_" + path[-12:]
    assert not tables.table_exists(spark, name)
    for value in (1, 2):
        tables.create_or_replace(rows([("a", value, "x")], SCHEMA), name, path)
        assert tables.table_exists(spark, name) and table(spark.table(name)) == [("a", value, "x")]


def test_date_folders_are_pruned(spark, sf_dir):
    path = shared_folder(spark, "test-dates")
    tables.write_by_date(testbed.predictions(spark, sf_dir), path, "prediction_date")
    part = tables.read_dates(spark, path, "prediction_date", "2024-01-10", "2024-01-11")
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(prediction_date" in scan
    days = {r[0] for r in part.select("prediction_date").distinct().collect()}
    assert days == {dt.date(2024, 1, 10), dt.date(2024, 1, 11)}


def test_listing(spark):
    folder = shared_folder(spark, "test-listing")
    data = [("NORMAL", "one"), ("PNEUMONIA", "two")]
    spark.createDataFrame(data, "category string, value string").write.partitionBy("category").text(folder)
    found = files.list_images(spark, folder, F.lit("2024-01-02 03:04:05").cast("timestamp"), suffix=".txt")
    got = found.collect()
    assert {r.category for r in got} == {"NORMAL", "PNEUMONIA"}
    assert all(r.filename == r.image_id + ".txt" and r.file_size_bytes == 4 for r in got)
    assert {r.ingestion_batch_id for r in got} == {"20240102_030405"}
    assert files.list_images(spark, folder, F.current_timestamp()).count() == 0


def test_listing_of_nested_and_hidden_files(tmp_path, spark):
    """Any depth, files of the folder itself, hidden names left out; one task per sub-folder."""
    sizes = {"top.txt": 3, "a/one.txt": 1, "a/deep/er/two.txt": 2, "b/none.csv": 9, "b/_hid/x.txt": 9, ".c/x.txt": 9, "b/.x.txt": 9}
    for name, size in sizes.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x" * size)
    (tmp_path / "empty").mkdir()
    found = listing.list_files(spark, str(tmp_path), ".txt")
    assert {(r.path.removeprefix(f"file:{tmp_path}/"), r.length) for r in found.collect()} == {
        ("top.txt", 3), ("a/one.txt", 1), ("a/deep/er/two.txt", 2)
    }
    assert found.rdd.getNumPartitions() == 4 and all(r.modified for r in found.collect())
    assert listing.list_files(spark, f"file://{tmp_path}/a").count() == 2
    assert listing.list_files(spark, f"{tmp_path}/absent").count() == 0


def test_lookup_takes_any_text(spark, sf_dir):
    images = testbed.images(spark, sf_dir)
    assert ingest.lookup_by_id(images, "7").collect()[0].filename == "7.jpeg"
    assert ingest.lookup_by_id(images, "x' OR '1'='1").count() == 0


def test_migration_of_a_bad_response(rows):
    log = rows(
        [("r1", "clf", "broken", 1704067200123)],
        "request_id string, served_model_name string, response string, timestamp_ms bigint",
    )
    row = ingest.migrate_log(log).collect()[0]
    assert (row.predicted_label, row.prediction_probability, row.model_version, row.image_id) == (0, None, None, None)
    assert row.predicted_at == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
