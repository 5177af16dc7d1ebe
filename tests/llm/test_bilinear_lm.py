"""The log-bilinear model and the count model against plain Python, held-out texts and odd input."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from scorewatch.llm import bilinear_lm as L
from scorewatch.llm import bilinear_net as N

ODD = "doc_id long, text string, row long, held_out string, words string, c long"


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lowered)] + [b"\n"]


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["The", "of", "wörld,", "ÀB", "x.", "end!", "日本", *(f"rare{k}" for k in range(60))]
    docs = [(k, " ".join(rng.choices(words, [40, 30, 20, 9, 8, 7, 6] + [1] * 60, k=rng.randint(0, 40)))) for k in range(80)]
    return [*docs, (3, docs[3][1]), (3, "another text"), (None, "the new"), (None, "the new"), (90, None), (91, ""), (92, " \n "),
            (93, "LONG\ttext\x0bof " * 3000 + "y" * 5000)]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "h", "w", 2) for i, t in docs], ODD)


def expected(docs, own_words, net=None):
    """Rows by plain Python; the model's part with a given network."""
    count = Counter(w for i, t in docs if not is_held_out(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    own = [w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))][:own_words]
    symbol = lambda w: own.index(w) if w in own else len(own) + L.class_of(w)
    sizes = [sum(c + 0.5 for w, c in count.items() if w not in own and L.class_of(w) == k) + 0.5 for k in range(L.CLASSES)]
    out = []
    for i, t in docs:
        words = tokens(t)
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        line = [len(own) + L.CLASSES] * N.CONTEXT + [symbol(w) for w in words]
        model = 0.0
        for k, w in enumerate(words if net else []):
            before = np.array([line[k : k + N.CONTEXT][::-1]])
            model += net.log_probabilities(before, np.array([symbol(w)]))[0] / math.log(10)
            model += 0 if w in own else math.log10((count[w] + 0.5) / sizes[L.class_of(w)])
        out.append((i, is_held_out(i), len(words), sum(w in count for w in words), n, base, model))
    return out


def same(found, want):
    key = lambda r: (r[0] is None, r[0], r[2], r[5])
    assert len(found) == len(want)
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-4, atol=1e-4)


@pytest.mark.parametrize("size", [1, 2, 7, 30, 1 << 20])
def test_tokens_of_any_part(size):
    for _, text in corpus():
        parts = list(L.tokens_of(text, size))
        assert [w for p in parts for w in p] == tokens(text)
        assert size > 7 or len(parts) > 2 or len(tokens(text)) < 5


@pytest.mark.parametrize("frequent", [200_000, 12])
def test_scores_are_whole(spark, monkeypatch, frequent):
    """Counts and probabilities, also with most words counted by the join."""
    monkeypatch.setattr(L, "FREQUENT", frequent)
    monkeypatch.setattr(L, "OWN_WORDS", 6)
    nets = []
    monkeypatch.setattr(L, "train_network", lambda docs, counts: nets.append(N.Network.initial(counts.frequency())) or nets[0])
    docs = corpus()
    found = L.score(frame(spark, docs))
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = found.collect()
    assert sum(r["held_out"] for r in rows) > 5 and any(r["n_known"] < r["n_tokens"] for r in rows)
    same(rows, expected(docs, 6, nets[0]))


def test_probabilities_are_normalised(spark):
    docs = corpus(2)
    vocabulary = L.token_counts(frame(spark, docs).where("doc_id is not null"))
    counts = L.gather_counts(vocabulary)
    frequency = counts.frequency()
    net = N.Network.initial(frequency, 3)
    before = np.random.default_rng(1).integers(0, len(frequency) + 1, (50, N.CONTEXT))
    for k in range(0, 50, 10):
        every = np.arange(len(frequency))
        assert abs(np.exp(net.log_probabilities(np.repeat(before[k : k + 1], len(every), 0), every)).sum() - 1) < 1e-5
    shares = np.zeros(L.CLASSES)
    for r in vocabulary.collect():
        if bytes(r["word"]) not in counts.words[: counts.own]:
            shares[L.class_of(bytes(r["word"]))] += r["c"] + 0.5
    assert np.allclose((shares + 0.5) / counts.class_sizes(), 1)


def test_slopes_of_the_contrastive_loss():
    rng = np.random.default_rng(4)
    frequency = rng.random(9) + 0.1
    frequency /= frequency.sum()
    net = N.Network.initial(frequency)
    for p in net.parts():
        p += rng.standard_normal(p.shape).astype(np.float32) * 0.3
    before, target, drawn = rng.integers(0, 10, (20, N.CONTEXT)), rng.integers(0, 9, 20), rng.integers(0, 9, 7)
    log_noise = np.log(frequency)

    def loss():
        q = net.predicted(before).astype(float)
        margin = q @ net.output.T + net.bias - log_noise - math.log(7)
        soft = lambda x: np.log1p(np.exp(x))
        return soft(-margin[np.arange(20), target]).sum() + soft(margin[:, drawn]).sum()

    for weights, slope in zip(net.parts(), N.gradients(net, before, target, drawn, log_noise.astype(np.float32)), strict=True):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        old = weights[at]
        weights[at] = old + 1e-2
        more = loss()
        weights[at] = old - 1e-2
        less = loss()
        weights[at] = old
        assert abs((more - less) / 2e-2 - slope[at]) < 0.01 * max(1, abs(slope[at]))


def test_training_learns_what_follows(spark):
    """Each word tells the next one; after training the texts are likelier than by counts, and the same on every run."""
    rng = random.Random(5)
    docs = []
    for k in range(300):
        at = rng.randrange(20)
        docs.append((k, " ".join(f"w{(at + j) % 20}" for j in range(60))))
    first, again = (L.score(frame(spark, docs).repartition(4, "doc_id")).orderBy("doc_id").collect() for _ in range(2))
    assert [r["score"] for r in first] == [r["score"] for r in again]
    held = [r for r in first if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.5 * sum(r["base_score"] for r in held)


def test_held_out_texts_are_likelier_than_by_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = L.score(docs).where("held_out").collect()
    n = sum(r["n_tokens"] for r in held)
    assert sum(r["score"] - r["base_score"] for r in held) / n > 0.1
    assert np.mean([r["score"] > r["base_score"] for r in held]) > 0.9


def test_without_training_texts(spark):
    held = [(k, t) for k, t in corpus() if is_held_out(k)]
    rows = L.score(frame(spark, held)).collect()
    same([(*tuple(r)[:6], 0) for r in rows], expected(held, 0))
    assert all(math.isfinite(r["score"]) and r["n_known"] == r["train_tokens"] == 0 for r in rows)
    assert L.score(frame(spark, [])).count() == 0


def test_both_ways_to_normalise_agree():
    """Products of exponentials, and scores shifted by their maximum where the former could overflow."""
    rng = np.random.default_rng(8)
    net = N.Network.initial(np.full(30, 1 / 30))
    net.context += rng.standard_normal(net.context.shape).astype(np.float32) * 0.5
    before, target = rng.integers(0, 31, (700, N.CONTEXT)), rng.integers(0, 30, 700)
    plain = net.log_probabilities(before, target)
    scores = [(net.context * p) @ net.output.T for p in net.places]
    scores[0] = scores[0] + net.bias
    assert np.allclose(plain, net._shifted(scores, before, target), atol=1e-4)
    net.output *= 1e4
    assert np.isfinite(net.log_probabilities(before, target)).all()


def test_large_scores_stay_products(monkeypatch):
    """Scores whose sum over the places passes 60, as after long training, are still read by products of rows."""
    rng = np.random.default_rng(9)
    net = N.Network.initial(np.full(30, 1 / 30))
    net.context += rng.standard_normal(net.context.shape).astype(np.float32)
    net.output += rng.standard_normal(net.output.shape).astype(np.float32) * 0.6
    scores = [(net.context * p) @ net.output.T for p in net.places]
    scores[0] = scores[0] + net.bias
    assert 40 < sum(float(np.abs(s).max()) for s in scores)
    net.bias[:] += 40
    scores[0] = scores[0] + 40
    before, target = rng.integers(0, 31, (700, N.CONTEXT)), rng.integers(0, 30, 700)
    shifted = net._shifted(scores, before, target)
    read = []
    monkeypatch.setattr(N.Network, "_shifted", lambda net, scores, before, target: read.append(len(target)) or np.zeros(len(target)))
    assert np.allclose(net.log_probabilities(before, target), shifted, atol=1e-3) and not read


def test_training_reads_symbols_only(spark):
    """Texts are cut into words once; the rounds of training need no text."""
    docs = L.token_counts(frame(spark, corpus()))
    counts = L.gather_counts(docs)
    texts = frame(spark, corpus()).select("doc_id", "text").withColumn("held_out", L.held_out(L.F.col("doc_id")))
    read = L.read_texts(texts, counts, "bigint")
    own = {w: k for k, w in enumerate(counts.words[: counts.own])}
    found = sorted((r["doc_id"] is None, r["doc_id"], np.frombuffer(r["symbols"], L.SYMBOL).tolist()) for r in read.collect())
    symbols = lambda t: [own.get(w, counts.own + L.class_of(w)) for w in tokens(t)]
    assert found == sorted((i is None, i, symbols(t)) for i, t in corpus())
    net = L.train_network(read.select("doc_id", "symbols"), counts)
    assert np.isfinite(net.flat()).all() and not np.array_equal(net.flat(), N.Network.initial(counts.frequency(), L.SEED).flat())
