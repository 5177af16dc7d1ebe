"""Matching predictions to calls by score and time, against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import joins, metrics

PREDICTIONS = "prediction_id string, image_id string, prediction_probability double, predicted_at timestamp"
PAYLOAD = "request_metadata map<string,string>, response string, timestamp_ms bigint, status_code int"
T0 = 1704067200000


def at(ms):
    return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)


def call(score, ms, model="m", status=200):
    response = '{"predictions":[[%r]]}' % score if score is not None else "{}"
    return ({"model_name": model}, response, ms, status)


@pytest.mark.parametrize(("delta", "found"), [(4999, True), (5000, False), (-4999, True), (-5000, False), (0, True)])
def test_band_edges(rows, delta, found):
    predictions = rows([("p", "i", 0.25, at(T0))], PREDICTIONS)
    payload = rows([call(0.25, T0 + delta)], PAYLOAD)
    assert joins.log_attribution(predictions, payload).count() == int(found)
    assert joins.log_attribution_nearest(predictions, payload).count() == int(found)
    assert joins.calls_near(predictions, payload).count() == int(found)


def test_two_calls_failures_and_missing_scores(rows):
    predictions = rows([("p", "i", 0.25, at(T0 + 700)), ("q", "i", None, at(T0))], PREDICTIONS)
    calls = [call(0.25, T0 + 10), call(0.25, T0 + 20), call(0.25, T0, status=500), call(None, T0), call(0.26, T0)]
    row = joins.log_attribution(predictions, rows(calls, PAYLOAD)).collect()
    assert [(r.prediction_id, r.matches, r.nearest_ms) for r in row] == [("p", 2, 10)]
    nearest = joins.log_attribution_nearest(predictions, rows(calls, PAYLOAD)).collect()
    assert [(r.prediction_id, r.delta_ms) for r in nearest] == [("p", -680)]


def test_against_brute_force(rows):
    rng = random.Random(5)
    data = [(f"p{i}", "i", rng.randrange(4) / 4, at(T0 + rng.randrange(60000))) for i in range(150)]
    calls = [call(rng.randrange(4) / 4, T0 + rng.randrange(60000), rng.choice("ab"), rng.choice([200, 200, 500])) for _ in range(150)]
    predictions, payload = rows(data, PREDICTIONS), rows(calls, PAYLOAD)
    ms = lambda t: round((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    good = [(float(c[1][17:-3]), c[2], c[0]["model_name"]) for c in calls if c[3] == 200]

    expected = {}
    for pid, _, score, t in data:
        for s, m, model in good:
            if s == score and abs(ms(t) // 1000 * 1000 - m) < 5000:
                expected[pid, model] = expected.get((pid, model), 0) + 1
    got = {(r.prediction_id, r.model_name): r.matches for r in joins.log_attribution(predictions, payload).collect()}
    assert got == expected

    best = {}
    for pid, _, score, t in data:
        near = [(abs(ms(t) - m), m, model) for s, m, model in good if s == score and abs(ms(t) - m) < 5000]
        if near:
            best[pid] = min(near)
    nearest = joins.log_attribution_nearest(predictions, payload).collect()
    assert {r.prediction_id: (abs(r.delta_ms), r.timestamp_ms, r.model_name) for r in nearest} == best

    around = {}
    for pid, _, _, t in data:
        near = [abs(ms(t) // 1000 * 1000 - m) for _, m, _ in good if abs(ms(t) // 1000 * 1000 - m) < 2000]
        if near:
            around[pid] = (len(near), min(near))
    counted = joins.calls_near(predictions, payload, band_ms=2000).collect()
    assert {r.prediction_id: (r.calls_in_band, r.nearest_ms) for r in counted} == around


def test_one_score_at_one_instant_forms_no_pairs(spark):
    """3,000 predictions and 3,000 calls of one score at one time: 9 million pairs, one point each."""
    predictions = spark.range(3000).selectExpr(
        "concat('p', id) AS prediction_id", "'i' AS image_id", "0.5D AS prediction_probability",
        f"timestamp_millis({T0}) AS predicted_at",
    )
    payload = spark.range(3000).selectExpr(
        "map('model_name', 'x_pytorch') AS request_metadata", """'{"predictions":[[0.5]]}' AS response""",
        f"{T0} AS timestamp_ms", "200 AS status_code",
    )
    matches = joins.log_attribution(predictions, payload)
    assert matches.agg(F.sum("matches"), F.count("*")).first() == (9000000, 3000)
    feedback = spark.range(3000).selectExpr(
        "concat('f', id) AS feedback_id", "concat('p', id) AS prediction_id", "'false-positive' AS feedback_type",
        f"timestamp_millis({T0}) AS timestamp",
    )
    counts = metrics.confusion_by_model(predictions, feedback, payload).collect()
    assert [(r.model_display_name, r["count"]) for r in counts] == [("PyTorch", 9000000)]
    feed = metrics.false_positive_feed(predictions, feedback, payload).collect()
    assert [r.feedback_id for r in feed] == ["f0"] * 10
