"""What the join of near duplicates moves when there are many parts, and when chance ties sets together."""

import random

import numpy as np
from pyspark.sql import functions as F

from scorewatch.llm import jaccard_join


def brute_force(texts):
    """Smallest index that each text reaches by links, from all pairs."""
    sets = [set(jaccard_join.shingle_set(t).tolist()) for t in texts]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    return root


def test_tokens_of_many_parts(spark):
    """With about one token of a set in a part, the sets' numbers do not come along for every token."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(404)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    size = jaccard_join.packed_tokens(docs, 2000).agg(F.sum(F.length("blob") - 16)).first()[0]
    assert size <= 60 * 400 * 10


def test_groups_tied_by_chance_are_split(spark, monkeypatch):
    """Texts of two passages, each in six texts, form one chain without a link; copies at about the threshold are linked."""
    rng = random.Random(7)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, columns = [words(40) for _ in range(6)], [words(40) for _ in range(6)]
    made = [r + c for r in rows for c in columns]
    texts = [" ".join(t) for t in made]
    for k, t in enumerate(made[::3]):
        texts += [" ".join(t[: 57 + k % 6]), " ".join([*t[:-1], "x"]), " ".join(t + words(18 + k % 8))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = []
    pin = jaccard_join.pin
    monkeypatch.setattr(jaccard_join, "pin", lambda df, purpose: kept.append((purpose, pin(df, purpose))) or kept[-1][1])
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 600)
    monkeypatch.setattr(jaccard_join, "SKETCH_SETS", 30)
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs).collect()}
    assert [found[k] for k in range(len(texts))] == brute_force(texts)
    members = [df for purpose, df in kept if purpose == "jaccard-members"][-1]
    assert members.groupBy("root").agg(F.sum("n_shingles").alias("n")).agg(F.max("n")).first()[0] <= 600


def test_linked_sets_share_what_they_send():
    """Two sets at the threshold both send the spare tokens of the smaller size, at least, whatever is different."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        both = rng.integers(0, 2**63, n).astype(np.uint64)
        most = n * 25 // 75
        a = int(rng.integers(0, most + 1))
        low, high = (0, 2**40) if rng.random() < 0.5 else (2**62, 2**63)
        x, y = (np.unique(np.concatenate([both, rng.integers(low, high, k).astype(np.uint64)])) for k in (a, most - a))
        sent = [s[: jaccard_join.sent_length(len(s))] for s in (x, y)]
        shared = len(np.intersect1d(*sent))
        for s in (x, y):
            least = (75 * len(s) + 99) // 100
            assert shared >= (jaccard_join.SPARE * least + 99) // 100
