"""Reports, review queue, quality, significance and trends on small hand-made frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import abtest, joins, metrics, monitor, quality, review
from scorewatch.schemas import FEEDBACK, conform
from scorewatch.session import shared_folder
from scorewatch.sources import tables, testbed

TP, FP, TN, FN = "true-positive", "false-positive", "true-negative", "false-negative"
PREDICTIONS = (
    "prediction_id string, image_id string, predicted_label int, true_label int, prediction_probability double,"
    " confidence_score double, model_name string, model_version string, predicted_at timestamp, prediction_date date"
)
DAY = dt.datetime(2024, 1, 1)


@pytest.fixture()
def predictions(rows):
    def build(*specs):
        """(id, model, label, probability, day offset)"""
        data = [
            (pid, "i" + pid, label, 1, p, max(p, 1 - p), model, "1", DAY + dt.timedelta(days=d), (DAY + dt.timedelta(days=d)).date())
            for pid, model, label, p, d in specs
        ]
        return rows(data, PREDICTIONS)

    return build


@pytest.fixture()
def feedback(rows):
    def build(*specs):
        """(id, prediction, outcome, hours offset, reviewer, truth)"""
        data = [
            (fid, pid, DAY + dt.timedelta(hours=h), truth, outcome, who, "confirmed", "app", "")
            for fid, pid, outcome, h, who, truth in specs
        ]
        return rows(data, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FEEDBACK.fields))

    return build


def test_only_true_negatives(predictions, feedback):
    p = predictions(("1", "m", 0, 0.1, 0))
    f = feedback(("f1", "1", TN, 1, "a", "NORMAL"))
    row = metrics.model_metrics(p, f).collect()[0]
    assert (row.precision, row.recall, row.f1_score, row.specificity, row.accuracy) == (None, None, None, 1.0, 1.0)


def test_only_false_negatives(predictions, feedback):
    p = predictions(("1", "m", 0, 0.1, 0))
    f = feedback(("f1", "1", FN, 1, "a", "PNEUMONIA"))
    row = metrics.model_metrics(p, f).collect()[0]
    assert (row.precision, row.recall, row.f1_score, row.specificity, row.accuracy) == (None, 0.0, None, None, 0.0)


def test_empty_feedback(predictions, feedback):
    p, f = predictions(("1", "m", 0, 0.1, 0)), feedback()
    assert metrics.model_metrics(p, f).count() == 0
    assert [tuple(r) for r in metrics.confusion_grid(f).collect()] == [
        ("Predicted PNEUMONIA", None, None),
        ("Predicted NORMAL", None, None),
    ]
    assert metrics.feedback_coverage(p, f).collect()[0].feedback_coverage_pct == 0.0


def test_accuracy_counts_unknown_outcomes_and_distinct_ids(predictions, feedback):
    """One id on two predictions counts once in the total and twice in the outcome sums."""
    p = predictions(("1", "m", 1, 0.9, 0), ("2", "m", 1, 0.9, 0))
    f = feedback(("f1", "1", TP, 1, "a", "x"), ("f1", "2", TP, 1, "a", "x"), ("f2", "2", None, 2, "a", "x"))
    row = metrics.model_metrics(p, f).collect()[0]
    assert (row.total_feedback, row.true_positives, row.accuracy) == (2, 2, 1.0)


def test_coverage_past_one_hundred(predictions, feedback):
    p = predictions(("1", "m", 1, 0.9, 0))
    f = feedback(("f1", "1", TP, 1, "a", "x"), ("f2", "1", TP, 2, "a", "x"), ("f3", "gone", TP, 2, "a", "x"))
    row = metrics.feedback_coverage(p, f).collect()[0]
    assert (row.feedback_coverage_pct, row.predictions_pending_feedback, row.reviewed_pct) == (200.0, -1, 100.0)


def test_weights_repeat_reviews(predictions, feedback):
    p = predictions(("1", "m", 1, 0.9, 0), ("2", "m", 1, 0.6, 0))
    f = feedback(("a", "1", TP, 1, "x", "t"), ("b", "1", TP, 1, "x", "t"), ("c", "2", TP, 1, "x", "t"), ("d", "2", None, 1, "x", "t"))
    got = {r.prediction_outcome: (r.avg_confidence, r["count"]) for r in metrics.confidence_by_outcome(p, f).collect()}
    assert got == {"Correct": (0.8, 3), "Incorrect": (0.6, 1)}


def test_expected_walkthrough_figures(rows, feedback):
    """5 + 5 requests share the traffic; 2 of 3 right is 66.67."""
    data = [(f"r{i}", "a-1" if i < 5 else "b-1", DAY, DAY.date(), "{}") for i in range(10)]
    log = rows(data, "request_id string, served_model_name string, timestamp timestamp, date date, response string")
    share = metrics.traffic_share(log, F.lit("2024-01-02").cast("date")).collect()
    assert [(r.served_model_name, r.traffic_pct) for r in share] == [("a-1", 50.0), ("b-1", 50.0)]
    f = feedback(("1", "r0", TP, 1, "x", "t"), ("2", "r1", TN, 1, "x", "t"), ("3", "r2", FP, 1, "x", "t"))
    assert metrics.served_accuracy(log, f).collect()[0].accuracy_pct == 66.67
    daily = metrics.served_daily(log, f, F.lit("2024-01-02").cast("date")).collect()
    assert [(r.daily_accuracy, r.daily_accuracy_reviewed) for r in daily] == [(40.0, 66.67), (0.0, None)]
    assert metrics.traffic_share(log, F.lit("2024-01-09").cast("date")).count() == 0


def test_queue_and_reviewed_make_all(spark, sf_dir):
    p, f = testbed.predictions(spark, sf_dir), testbed.feedback(spark, sf_dir)
    waiting = joins.unreviewed(p, f).count()
    assert waiting + f.select("prediction_id").distinct().count() == p.count()


def test_queue_keeps_predictions_of_unknown_images(predictions, feedback, rows):
    p = predictions(("1", "m", 1, 0.9, 0), ("2", "m", 0, 0.2, 1), ("3", "m", 0, 0.3, 2))
    images = rows([("i1", "dbfs:/a")], "image_id string, file_path string")
    f = feedback(("f", "3", TN, 1, "a", "NORMAL"))
    got = [(r.prediction_id, r.image_path) for r in review.review_queue(p, f, images).collect()]
    assert got == [("2", None), ("1", "dbfs:/a")]
    assert [r.prediction_id for r in review.review_queue(p, f, images, newest=1).collect()] == ["2"]
    assert review.review_queue_filtered(p, f, images, max_confidence=0.85).count() == 1


def test_latest_feedback_breaks_ties_by_id(feedback):
    f = feedback(("a", "1", TP, 5, "x", "t"), ("c", "1", FP, 9, "x", "t"), ("b", "1", TN, 9, "x", "t"))
    assert [r.feedback_id for r in review.latest_feedback(f).collect()] == ["c"]


def test_assessments(rows):
    sheet = rows(
        [("p1", "NORMAL", "NORMAL"), ("p2", "NORMAL", ""), ("p3", "NORMAL", None), ("p4", "PNEUMONIA", "odd")],
        "prediction_id string, ai_prediction string, radiologist_assessment string",
    )
    kept = review.classify_assessments(sheet)
    assert [(r.prediction_id, r.feedback_type) for r in kept.collect()] == [("p1", TN)]
    saved = review.feedback_rows(kept, "DR1", F.lit(DAY))
    assert saved.columns == FEEDBACK.fieldNames()
    assert saved.collect() == review.feedback_rows(kept, "DR1", F.lit(DAY)).collect()


def test_csv_keeps_odd_text(spark, feedback):
    f = feedback(("a", "1", None, 5, "O'Neil, \"Dr\"", ""), ("b", "1", TP, 5, None, "x,y"))
    path = shared_folder(spark, "test-csv")
    tables.write_csv(conform(f, FEEDBACK), path)
    assert sorted(map(tuple, tables.read_csv(spark, path, FEEDBACK).collect())) == sorted(map(tuple, f.collect()))


def test_outcomes_add_up(spark, sf_dir):
    f = testbed.feedback(spark, sf_dir)
    shares = metrics.outcome_distribution(f).collect()
    assert sum(r["count"] for r in shares) == f.count()
    assert sum(r.percentage for r in shares) == pytest.approx(100.0, abs=0.05)
    assert [r.sort_order for r in shares] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize(
    ("champion", "challenger", "decision"),
    [((50, 50), (80, 20), "PROMOTE"), ((80, 20), (50, 50), "ROLLBACK"), ((50, 50), (52, 48), "KEEP TESTING"), ((2, 20), (20, 2), "KEEP TESTING")],
)
def test_decisions(predictions, feedback, champion, challenger, decision):
    p, f = [], []
    for model, (right, wrong) in (("a", champion), ("b", challenger)):
        for i in range(right + wrong):
            pid = f"{model}{i}"
            p.append((pid, model, 1, 0.9, 0))
            f.append((f"f{pid}", pid, TP if i < right else FP, 1, "x", "t"))
    frames = predictions(*p), feedback(*f)
    test = abtest.chi_square(*frames, "a", "b")
    assert abtest.decide(test).collect()[0].decision == decision
    row, library = abtest.p_value(test).collect()[0], abtest.chi_square_mllib(*frames, "a", "b").collect()[0]
    assert row.chi_square == pytest.approx(library.chi_square)
    assert row.p_value == pytest.approx(library.p_value)


def test_no_verdicts_keep_testing(predictions, feedback):
    test = abtest.chi_square(predictions(), feedback(), "a", "b")
    row = abtest.decide(test).collect()[0]
    assert (row.decision, row.chi_square, row.significant) == ("KEEP TESTING", None, False)
    assert abtest.p_value(test).collect()[0].p_value is None


def test_critical_value(rows):
    got = rows([(3.841459,), (0.0,)], "chi_square double").select(abtest.upper_tail(F.col("chi_square"))).collect()
    assert got[0][0] == pytest.approx(0.05, abs=1e-6) and got[1][0] == 1.0


def test_upper_tail_of_any_size(rows):
    values = [1e-12, 1e-4, 0.3, 1.0, 7.0, 11.999, 12.0, 12.001, 25.0, 80.0, 400.0]
    found = rows([(v,) for v in values], "x double").select(abtest.upper_tail(F.col("x"))).collect()
    for v, (p,) in zip(values, found):
        assert p == pytest.approx(math.erfc(math.sqrt(v / 2)), rel=1e-9)


def test_drift(predictions, feedback):
    p = predictions(*[(f"{d}-{i}", "m", 1, 0.9, d) for d in range(20) for i in range(10)])
    f = feedback(*[(f"f{d}-{i}", f"{d}-{i}", TP if i < (9 if d < 10 else 7) else FP, d * 24 + 1, "x", "t") for d in range(20) for i in range(10)])
    row = monitor.drift_alert(p, f).collect()[0]
    assert (row.baseline_accuracy, row.recent_accuracy, row.alert) == (0.9, 0.7, True)
    assert not monitor.drift_alert(p, f, max_drop=0.3).collect()[0].alert
    rolled = {r.day: r.rolling_accuracy_pct for r in monitor.rolling_accuracy(p, f, days=2).collect()}
    assert rolled[DAY + dt.timedelta(days=10)] == 80.0
    changes = {r.day: r.change_pct for r in monitor.accuracy_trend(p, f).collect()}
    assert changes[DAY] is None and changes[DAY + dt.timedelta(days=10)] == -20.0


def test_quality_report_finds_what_is_wrong(spark, sf_dir):
    images, p, f = testbed.images(spark, sf_dir), testbed.predictions(spark, sf_dir), testbed.feedback(spark, sf_dir)
    broken_images = images.unionByName(images.limit(2)).withColumn(
        "category", F.when(F.col("image_id") == "5", "cat").otherwise(F.col("category"))
    )
    broken_feedback = f.withColumn("prediction_id", F.when(F.col("feedback_id") == f.first().feedback_id, "none").otherwise(F.col("prediction_id")))
    found = {r.rule: r.failed for r in quality.quality_report(broken_images, p, broken_feedback).collect()}
    assert found["images.image_id unique"] == 2
    assert found["images.category known"] >= 1
    assert found["feedback.prediction_id in predictions"] == 1
    assert found["predictions.prediction_probability in range"] == 0


def test_key_rules_of_missing_and_empty(spark):
    """NULL keys, a hot orphan, a parent without rows and empty tables."""
    make = lambda data: spark.createDataFrame(data, "id string, ref string")
    rules = lambda a, b: {
        r.rule: (r.failed, r.total)
        for r in quality.key_rules({"a": a, "b": b}, {"a": "id", "b": "id"}, {("b", "ref"): "a"}).collect()
    }
    a = make([("1", None), ("1", None), ("2", None), (None, None)])
    b = make([("x", "1"), ("y", "9"), ("z", None)] + [(f"h{i}", "8") for i in range(500)])
    assert rules(a, b) == {"a.id unique": (1, 4), "b.id unique": (0, 503), "b.ref in a": (501, 503)}
    assert rules(a.limit(0), b) == {"a.id unique": (0, 0), "b.id unique": (0, 503), "b.ref in a": (502, 503)}
    assert rules(a.limit(0), b.limit(0)) == {"a.id unique": (0, 0), "b.id unique": (0, 0), "b.ref in a": (0, 0)}


def test_silver(rows):
    data = [("a", "a.jpeg", "NORMAL", "train", "dbfs:/x/a.jpeg", 10, DAY, "b1"), (None, None, "cat", "train", "", 0, DAY, "b1")]
    schema = "image_id string, filename string, category string, dataset_split string, file_path string, file_size_bytes bigint, ingested_at timestamp, ingestion_batch_id string"
    good, bad = quality.silver_transform(rows(data, schema), F.lit(DAY)).collect()
    assert (good.label, good.file_path, good.quality_score, good.source_batch_id) == (0, "/x/a.jpeg", 1.0, "b1")
    assert (bad.label, bad.quality_score) == (None, 0.0)
