"""Metrics, areas, splits, samples and scores against brute force and edge cases."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorewatch.operators import evaluation, sampling, scoring
from scorewatch.plans import catalog as C
from scorewatch.sources import testbed

PAIRS = "label int, score double"


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return 0.5
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-5, 5).map(float)), min_size=1, max_size=40))
def test_auc_equals_brute_force(spark, pairs):
    frame = spark.createDataFrame(pairs, PAIRS)
    area = evaluation.auc(frame).collect()[0].auc
    assert area == pytest.approx(brute_auc(pairs))
    mirrored = evaluation.auc(frame.withColumn("score", -F.col("score"))).collect()[0].auc
    if 0 < sum(y for y, _ in pairs) < len(pairs):
        assert area + mirrored == pytest.approx(1.0)


def test_auc_per_group_and_one_class(rows):
    frame = rows([("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.3), ("b", None, 0.2), ("b", 0, None)], "g string, " + PAIRS)
    got = {r.g: (r.auc, r.positives, r.negatives) for r in evaluation.auc(frame, by=["g"]).collect()}
    assert got == {"a": (1.0, 1, 1), "b": (0.5, 1, 0)}


def test_auc_is_the_library_value(spark, sf_dir):
    pairs = testbed.evaluation_pairs(spark, sf_dir)
    library = evaluation.auc_mllib(pairs).collect()[0].auc
    assert evaluation.auc(pairs).collect()[0].auc == pytest.approx(library, abs=1e-9)


def test_auc_of_one_hot_score(spark):
    """90 percent of the rows share one score."""
    frame = spark.range(20000).selectExpr(
        "CAST(id % 3 = 0 AS INT) AS label", "CASE WHEN id % 10 < 9 THEN 0.5D ELSE id % 97 / 97.0D END AS score"
    )
    pairs = [(r.label, r.score, r.n) for r in frame.groupBy("label", "score").agg(F.count("*").alias("n")).collect()]
    pos, neg = [(s, n) for y, s, n in pairs if y == 1], [(s, n) for y, s, n in pairs if y == 0]
    wins = sum(a * b * ((p > q) + 0.5 * (p == q)) for p, a in pos for q, b in neg)
    expected = wins / (sum(a for _, a in pos) * sum(b for _, b in neg))
    assert evaluation.auc(frame).collect()[0].auc == pytest.approx(expected)


@pytest.mark.parametrize(
    ("data", "fill", "expected"),
    [
        ([(0, 0)], 0.0, (1.0, 0.0, 0.0, 0.0)),
        ([(0, 0)], None, (1.0, None, None, None)),
        ([(1, 0)], 0.0, (0.0, 0.0, 0.0, 0.0)),
        ([], 0.0, (None, 0.0, 0.0, 0.0)),
        ([(1, 1), (0, 1), (1, 0), (0, 0)], 0.0, (0.5, 0.5, 0.5, 0.5)),
    ],
)
def test_binary_eval(rows, data, fill, expected):
    row = evaluation.binary_eval(rows(data, "label int, predicted int"), zero_division=fill).collect()[0]
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == expected


def test_confusion_json(rows):
    frame = rows([(1, 1), (1, 1), (0, 1), (0, 0), (0, 0), (0, 0), (1, 0)], "label int, predicted int")
    text = evaluation.binary_eval(frame).select(evaluation.confusion_json()).collect()[0][0]
    assert text == "[[3,1],[1,2]]"


def test_log_loss_clips(rows):
    row = evaluation.log_loss(rows([(1, 0.0), (0, 0.0), (1, 0.5)], PAIRS)).collect()[0]
    assert row.log_loss == pytest.approx((-math.log(1e-7) - math.log(1 - 1e-7) - math.log(0.5)) / 3)
    assert row.accuracy == pytest.approx(1 / 3)


def test_threshold_sweep_scans_once(spark, sf_dir):
    pairs = testbed.scored_pairs(spark, sf_dir)
    sweep = evaluation.threshold_sweep(pairs, [0.7, 0.5])
    assert sweep._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    at_half = [r for r in sweep.collect() if r.threshold == 0.5][0]
    once = evaluation.binary_eval(pairs.withColumn("predicted", (F.col("score") > 0.5).cast("int"))).collect()[0]
    assert at_half.true_positives == once.true_positives and at_half.f1_score == once.f1_score


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 101, 3000])
def test_exact_split_sizes(spark, n):
    frame = spark.range(n).selectExpr("CAST(id AS STRING) AS id")
    split = sampling.exact_split(frame, "id")
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    train, val = int(n * 0.70), int(n * 0.15)
    expected = {"train": train, "val": val, "test": n - train - val}
    assert sizes == {k: v for k, v in expected.items() if v}
    assert split.exceptAll(sampling.exact_split(frame.repartition(3), "id")).count() == 0


def test_keys_at_any_place(spark):
    """Cut texts split the sorted keys at the place, also among keys with the same beginning and repeated keys."""
    keys = [f"{(k * 7919) % 4096:03x}" * 10 + "00" for k in range(300)] + [f"{'ab' * 15}{k:02x}" for k in range(200)]
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    places = [0, 1, 150, 277, 299, 400, 499, 500, 900]
    for place, cut in zip(places, sampling.keys_at(frame, places)):
        assert sum(k < cut for k in keys) == min(place, len(keys))
    same = spark.createDataFrame([("c" * 32,)] * 9 + [("d" * 32,)], "key string")
    assert sampling.keys_at(same, [4, 9]) == ["c" * 32, "ddd"]


def test_samples_without_a_label_count(spark, rows):
    from scorewatch.schemas import PREDICTIONS, conform

    data = [("a", "i", 1, 0.9, 1, "m", "1"), ("b", "i", 0, 0.2, None, "m", "1"), ("c", "i", 1, 0.8, 0, "m", "1"), ("d", "x", 1, 0.8, 0, "m", "1")]
    names = "prediction_id string, image_id string, predicted_label int, prediction_probability double, true_label int, model_name string, model_version string"
    images = rows([("i", "train")], "image_id string, dataset_split string")
    row = evaluation.evaluation_run(conform(rows(data, names), PREDICTIONS), images, F.lit("2024-01-01").cast("timestamp")).collect()[0]
    assert (row.total_samples, row.confusion_matrix, row.auc_roc) == (3, "[[0,1],[0,1]]", 1.0)


def test_exact_split_depends_on_the_seed(spark):
    frame = spark.range(500).selectExpr("CAST(id AS STRING) AS id")
    other = sampling.exact_split(frame, "id", seed=1)
    assert sampling.exact_split(frame, "id").exceptAll(other).count() > 50


def test_hash_split_is_stable_under_growth(spark):
    small, large = (spark.range(n).selectExpr("CAST(id AS STRING) AS id") for n in (400, 800))
    assert sampling.hash_split(small, "id").exceptAll(sampling.hash_split(large, "id")).count() == 0


def test_first_per_class_of_a_dominant_class(spark):
    frame = spark.range(5000).selectExpr("format_string('%05d', id) AS id", "IF(id % 100 = 0, 'rare', 'common') AS class")
    got = sampling.first_per_class(frame, "class", "id", 60)
    ids = {c: sorted(r.id for r in got.collect() if r["class"] == c) for c in ("rare", "common")}
    assert ids["rare"] == [f"{i:05d}" for i in range(0, 5000, 100)]
    assert ids["common"] == [f"{i:05d}" for i in range(100) if i % 100][:60]
    quota = sampling.first_per_class(frame, "class", "id", {"rare": 3, "common": 2})
    assert sorted(r.id for r in quota.collect()) == ["00000", "00001", "00002", "00100", "00200"]


def test_traffic(spark):
    ids = spark.range(4000).selectExpr("CAST(id AS STRING) AS id")
    routed = sampling.assign_variant(ids, "id", [("a", 90), ("b", 10)])
    share = routed.filter("served_model_name = 'b'").count() / 4000
    assert 0.07 < share < 0.13
    assert sampling.assign_variant(ids, "id", [("a", 100), ("b", 0)]).filter("served_model_name = 'b'").count() == 0
    with pytest.raises(ValueError):
        sampling.assign_variant(ids, "id", [("a", 60), ("b", 30)])


def test_scores_agree_between_jvm_and_python(spark, sf_dir):
    vectors = testbed.vectors(spark, sf_dir)
    jvm = scoring.batch_score(vectors, C.WEIGHTS, C.BIAS)
    python = scoring.batch_score_pandas(vectors, lambda: scoring.LogisticModel(C.WEIGHTS, C.BIAS))
    both = jvm.alias("a").join(python.alias("b"), "image_id")
    worst = both.agg(F.max(F.abs(F.col("a.prediction_probability") - F.col("b.prediction_probability")))).first()[0]
    assert both.count() == vectors.count() and worst < 1e-12


def test_rows_without_a_vector_are_dropped(rows):
    frame = rows([("a", [1.0, 2.0]), ("b", None)], "image_id string, feature_vector array<float>")
    load = lambda: scoring.LogisticModel([0.0, 0.0], 0.0)
    assert [r.image_id for r in scoring.batch_score_pandas(frame, load).collect()] == ["a"]
    assert [r.prediction_probability for r in scoring.batch_score(frame, [0.0, 0.0], 0.0).collect()] == [0.5]
    assert [r.image_id for r in scoring.batch_score_pandas(frame.limit(0), load).collect()] == []
    assert scoring.scale_vectors(frame, 2.0).collect()[0].feature_vector == [0.5, 1.0]


def test_models_may_take_paths(rows):
    """A model that opens files itself gets their paths; it is loaded once per partition."""

    class PathModel:
        def predict(self, paths):
            return paths.str.contains("ill").astype("float64").to_numpy()

    frame = rows([("a", "/x/ill.jpeg"), ("b", "/x/good.jpeg"), ("c", None)], "image_id string, file_path string")
    scored = scoring.batch_score_pandas(frame, PathModel, "file_path").collect()
    assert {r.image_id: (r.prediction_probability, r.predicted_label) for r in scored} == {"a": (1.0, 1), "b": (0.0, 0)}
