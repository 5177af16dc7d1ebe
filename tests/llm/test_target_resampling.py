"""The draw towards a target distribution against plain Python and SQL, and odd input."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from oracle_check import connect, difference, duck_rows, spark_rows

from scorewatch.llm import oracles, queries, target_resampling

ODD = "doc_id long, text string, lang string, weight long, place long, _row long, score string"


def features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])], len(words)


def by_force(docs, target, percent=25):
    count = lambda texts: np.bincount([zlib.crc32(g.encode()) % 10_000 for t in texts for g in features(t)[0]], minlength=10_000)
    s, t = count([text for _, text in docs]), count(target)
    gains = [math.floor(1000 * math.log((int(b) + 1) * (int(s.sum()) + 10_000) / ((int(a) + 1) * (int(t.sum()) + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for k, (doc_id, text) in enumerate(docs):
        grams, n_words = features(text)
        weight = sum(gains[zlib.crc32(g.encode()) % 10_000] for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((n_words >= 20, -score, doc_id is None, doc_id or 0, k, (doc_id, len(grams), weight, score)))
    fit = sorted(r for r in rows if r[0])
    drawn = {r[4]: place for place, r in enumerate(fit[: percent * len(fit) // 100], 1)}
    return sorted((str((*r[5], drawn.get(r[4]))) for r in rows))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 5, 6, 7, "s") for i, t in rows], ODD)


@pytest.mark.parametrize("part", [1, 5, 40])
def test_features_of_texts_in_slices(monkeypatch, part):
    monkeypatch.setattr(target_resampling, "SLICE", part)
    for text in (None, "", " -- ", "a", "The END of the naïve wörld " * 9, "日本 x1 " * 30 + "tail", "x" * 200 + " y"):
        grams, n_words = features(text)
        counts, found = target_resampling.bucket_counts(text)
        assert found == n_words
        assert counts.tolist() == np.bincount([zlib.crc32(g.encode()) % 10_000 for g in grams], minlength=10_000).tolist()


def test_weights_and_ranks(spark):
    """Odd texts, repeated ids and rows, extra columns with clashing names."""
    rng = random.Random(4)
    words = ["the", "Of", "x1", "naïve", "日本語", "a-b", "wörld", "İ", "end"]
    docs = [(k, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(90)]
    docs += [(5, docs[5][1]), (5, docs[5][1]), (7, "other " * 30), (None, "the end " * 15), (None, "the end " * 15)]
    docs += [(200, None), (201, ""), (202, " \n-- "), (203, "long " * 20_000 + "tail"), (-4, docs[9][1])]
    target = ["the end of the naïve wörld", None, "日本語 end", ""]
    found = target_resampling.resample(
        frame(spark, docs), spark.createDataFrame([(t,) for t in target], "text string")
    )
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)) for r in found.collect()) == by_force(docs, target)


def test_sliced_sums_are_exact():
    rng = np.random.default_rng(2)
    for size in (1, 63, 64, 65, 10_000):
        gains = rng.integers(-20_000, 20_000, size)
        counts = rng.integers(0, 9, size) * rng.integers(0, 10**9, size)
        assert target_resampling.sliced_sum(counts, *target_resampling.gain_planes(gains)) == sum(
            int(a) * int(b) for a, b in zip(counts, gains)
        )
    assert target_resampling.sliced_sum(np.zeros(5, np.int64), *target_resampling.gain_planes(np.zeros(5, np.int64))) == 0


def test_empty_tables(spark):
    none, some = frame(spark, []), frame(spark, [(1, "a b " * 20)])
    target = spark.createDataFrame([], "text string")
    assert target_resampling.resample(none, target).count() == 0
    assert [tuple(r)[:2] for r in target_resampling.resample(some, target, percent=100).collect()] == [(1, 79)]


def test_many_equal_rows_spread_over_ranges(spark):
    """Rows that are all alike get places 1 to n, and no range of the order holds them all."""
    rows = spark.range(0, 4000, 1, 8).selectExpr("1L as doc_id", "cast(7 as bigint) as score")
    placed = target_resampling.ranked(rows, [rows["score"].desc(), rows["doc_id"].asc()])
    assert sorted(r["place"] for r in placed.collect()) == list(range(1, 4001))


def test_query_equals_sql(spark, sf_dir):
    name = "op12_target_resampling"
    assert difference(spark_rows(queries.QUERIES[name](spark, sf_dir)), duck_rows(connect(sf_dir), oracles.ORACLES[name])) is None
