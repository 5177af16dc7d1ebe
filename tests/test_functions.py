"""Edge values of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorewatch.functions import labels, numeric, payloads, texts, times, vectors


def values(spark, column, data, schema):
    df = spark.createDataFrame([(d,) if not isinstance(d, tuple) else d for d in data], schema)
    return [r[0] for r in df.select(column.alias("out")).collect()]


def test_threshold_is_strict(spark):
    assert values(spark, labels.score_to_label(F.col("p")), [0.5, 0.5000001, 0.2, None], "p double") == [0, 1, 0, None]


def test_confidence(spark):
    got = values(spark, labels.confidence(F.col("p")), [0.5, 0.9, 0.25, None], "p double")
    assert got == [0.5, 0.9, 0.75, None]


def test_decode_and_encode(spark):
    assert values(spark, labels.decode_label(F.col("x")), [1, 0, None], "x int") == ["PNEUMONIA", "NORMAL", "NORMAL"]
    assert values(spark, labels.encode_label(F.col("x")), ["PNEUMONIA", "NORMAL", "?", None], "x string") == [1, 0, 0, 0]


@pytest.mark.parametrize(
    ("said", "truth", "expected"),
    [
        ("PNEUMONIA", "PNEUMONIA", "true-positive"),
        ("PNEUMONIA", "NORMAL", "false-positive"),
        ("NORMAL", "NORMAL", "true-negative"),
        ("NORMAL", "PNEUMONIA", "false-negative"),
        ("NORMAL", "", "unknown"),
        ("NORMAL", None, "unknown"),
        ("other", "NORMAL", "unknown"),
    ],
)
def test_outcome(spark, said, truth, expected):
    got = values(spark, labels.outcome(F.col("a"), F.col("b")), [(said, truth)], "a string, b string")
    assert got == [expected]


def test_outcome_views(spark):
    data = ["true-positive", "true-negative", "false-positive", "false-negative", "unknown", None]
    o = F.col("o")
    assert values(spark, labels.outcome_tristate(o), data, "o string") == [True, True, False, False, None, None]
    assert values(spark, labels.correctness(o), data, "o string") == ["Correct"] * 2 + ["Incorrect"] * 4
    assert values(spark, labels.outcome_order(o), data, "o string") == [1, 4, 2, 3, 5, 5]


def test_model_family(spark):
    names = ["my_classifier_pytorch-1", "my_classifier-1", "other", None]
    assert values(spark, labels.model_family(F.col("n")), names, "n string") == ["PyTorch", "Keras", "other", None]


def test_size_band(spark):
    got = values(spark, labels.size_band(F.col("n")), [29999, 30000, 59999, 60000, None], "n bigint")
    assert got == ["Small (<30KB)", "Medium (30-60KB)", "Medium (30-60KB)", "Large (>60KB)", "Large (>60KB)"]


def test_ratio_and_f1(spark):
    assert values(spark, numeric.ratio(F.col("a"), F.col("b")), [(1, 3), (0, 0), (1, None)], "a int, b int") == [
        1 / 3,
        None,
        None,
    ]
    got = values(spark, numeric.f1(F.col("a"), F.col("b")), [(0.5, 0.5), (0.0, 0.0), (None, 1.0)], "a double, b double")
    assert got == [0.5, None, None]


def test_paths(spark):
    got = values(spark, texts.strip_storage_prefix(F.col("p")), ["dbfs:/a/dbfs:/b", "/a"], "p string")
    assert got == ["/a/dbfs:/b", "/a"]
    assert values(spark, texts.file_stem(F.col("p")), ["a.jpeg.jpeg", "b.png"], "p string") == ["a.jpeg", "b.png"]
    assert values(spark, texts.image_link(F.col("p")), ["7", "", None], "p string") == ["?image=7", None, None]
    assert values(spark, texts.version_suffix(F.col("p")), ["clf-7", "clf", "a-b-c"], "p string") == ["7", None, "b"]


def test_derived_ids_repeat(spark):
    column = texts.derived_id("fb-", F.col("a"), F.col("b"))
    first = values(spark, column, [("x", "y"), ("x", None), ("x|", "y")], "a string, b string")
    assert first == values(spark, column, [("x", "y"), ("x", None), ("x|", "y")], "a string, b string")
    assert len(set(first)) == 3 and all(len(v) == 35 for v in first)


def test_times(spark):
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert values(spark, times.epoch_ms(F.col("t")), [at], "t timestamp")[0] % 1000 == 0
    assert values(spark, times.epoch_ms(F.col("t"), True), [at], "t timestamp")[0] % 1000 == 678
    assert values(spark, times.batch_id(F.col("t")), [at], "t timestamp") == ["20240102_030405"]
    parsed = values(spark, times.parse_source_time(F.col("t")), ["2024-01-02T03:04:05Z", "soon"], "t string")
    assert parsed == [dt.datetime(2024, 1, 2, 3, 4, 5), None]


def test_payloads(spark):
    texts_in = ['{"predictions":[[0.07]]}', '{"predictions":[[1.0E-4]]}', '{"predictions":[]}', "no json", None]
    assert values(spark, payloads.response_score(F.col("r")), texts_in, "r string") == [0.07, 0.0001, None, None, None]
    entries = [{"model_name": "a"}, {}, None]
    got = values(spark, payloads.metadata_value(F.col("m"), "model_name"), [(e,) for e in entries], "m map<string,string>")
    assert got == ["a", None, None]


def test_vectors(spark):
    data = [([1.0, 2.0, 3.0, 4.0],), ([],), (None,)]
    assert values(spark, vectors.mean(F.col("v")), data, "v array<float>") == [2.5, None, None]
    assert values(spark, vectors.std(F.col("v")), data, "v array<float>")[0] == pytest.approx(1.118033988749895)
    assert values(spark, vectors.scale(F.col("v")), [([255.0, 51.0],)], "v array<float>") == [[1.0, 0.2]]
