"""Hot keys: a third and more of all rows on one key must change nothing but the plan."""

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import joins, metrics, review, skew


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 reviews, half of them of one prediction; predictions p0..p999."""
    feedback = spark.range(30000).selectExpr(
        "concat('f', id) AS feedback_id",
        "CASE WHEN id % 2 = 0 THEN 'p0' ELSE concat('p', id % 1200) END AS prediction_id",
        "timestamp_seconds(1700000000 + id) AS timestamp",
        "CASE id % 3 WHEN 0 THEN 'NORMAL' ELSE 'PNEUMONIA' END AS ground_truth",
        "CASE id % 4 WHEN 0 THEN 'true-positive' WHEN 1 THEN 'false-negative' WHEN 2 THEN 'false-positive' END AS feedback_type",
        "'r' AS radiologist_id",
    )
    predictions = spark.range(1000).selectExpr(
        "concat('p', id) AS prediction_id",
        "concat('m', id % 3) AS model_name",
        "'1' AS model_version",
        "id % 100 / 100.0D AS prediction_probability",
    )
    return feedback, predictions


def test_hot_keys_are_found(hot):
    feedback, _ = hot
    expected = feedback.filter("prediction_id = 'p0'").select(F.xxhash64("prediction_id")).first()[0]
    assert skew.hot_keys(feedback, ["prediction_id"], share=0.01) == [expected]
    assert skew.hot_keys(feedback, ["prediction_id"]) == [expected]
    assert skew.hot_keys(feedback.filter("false"), ["prediction_id"]) == []


def test_many_equally_hot_keys_are_found(spark):
    feedback = spark.range(40_000).selectExpr("IF(id % 2 = 0, concat('h', id % 800), string(id)) AS k", "id")
    assert len(skew.hot_keys(feedback, ["k"], share=1 / 1000)) == 400


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(hot, how):
    feedback, predictions = hot
    plain = feedback.join(predictions, "prediction_id", how)
    salted = skew.salted_join(feedback, predictions, "prediction_id", "feedback_id", how, salts=8, share=0.01)
    assert "_salt" not in salted.columns
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain.select(salted.columns)).count() == 0


def test_salted_join_spreads_the_hot_key(spark, hot):
    feedback, predictions = hot
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(feedback, predictions, "prediction_id", "feedback_id", salts=64, share=0.01)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = feedback.join(predictions, "prediction_id")
        plain_sizes = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == sum(plain_sizes)
    assert max(plain_sizes) >= 15000 > 6000 > max(sizes)


def test_salted_join_refuses_other_types(hot):
    with pytest.raises(ValueError):
        skew.salted_join(*hot, "prediction_id", "feedback_id", how="full_outer")


def test_salted_join_refuses_keys_of_different_types(spark):
    """Their hashes would differ although the values are equal."""
    with pytest.raises(ValueError):
        skew.salted_join(spark.range(3), spark.range(3).selectExpr("CAST(id AS INT) AS id"), "id", "id")


def test_salted_join_on_numbers(spark):
    """Signed zeros and NaN are equal to a join; NULL is equal to nothing."""
    values = "stack(4, 0.0D, -0.0D, CAST('NaN' AS DOUBLE), NULL) AS (score)"
    many = spark.range(2000).select("id", F.expr(values))
    one = spark.createDataFrame([(0.0, "zero"), (float("nan"), "nan"), (None, "null")], "score double, name string")
    plain = many.join(one, ["score"], "left").groupBy("name").count()
    salted = skew.salted_join(many, one, ["score"], "id", "left", share=0.01).groupBy("name").count()
    expected = {"zero": 4000, "nan": 2000, None: 2000}
    assert {r.name: r["count"] for r in plain.collect()} == expected
    assert {r.name: r["count"] for r in salted.collect()} == expected


def test_metrics_with_salting(hot, monkeypatch):
    feedback, predictions = hot
    plain = [tuple(r) for r in metrics.model_metrics(predictions, feedback).collect()]
    found = skew.hot_keys(feedback, ["prediction_id"])
    monkeypatch.setattr(skew, "hot_keys", lambda *args, **kwargs: found)
    assert len(found) == 1
    assert [tuple(r) for r in metrics.model_metrics(predictions, feedback).collect()] == plain


def test_tallies_and_latest_combine_before_the_shuffle(hot):
    feedback, _ = hot
    for frame in (joins.review_tallies(feedback), review.latest_feedback(feedback)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan and "Window" not in plan


def test_disagreement_of_a_hot_prediction(hot):
    feedback, _ = hot
    row = joins.reviewer_disagreement(feedback.filter("prediction_id = 'p0'")).collect()[0]
    votes = {r[0]: r[1] for r in feedback.filter("prediction_id = 'p0'").groupBy("ground_truth").count().collect()}
    assert row.disagreeing_pairs == votes["NORMAL"] * votes["PNEUMONIA"]
