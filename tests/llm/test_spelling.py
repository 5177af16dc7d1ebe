"""Spelling variants against plain Python and SQL, and odd input."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle_check import connect, difference, duck_rows, spark_rows

from scorewatch.llm import gram_index, oracles, queries, spelling

ODD = "doc_id long, text string, word string, n long, list long, role string"


def words_by_force(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def by_force(docs):
    words = words_by_force(docs)
    forms, out = {}, []
    for w, n in words.items():
        around = [(-words[o], o) for o in words if near(w, o)]
        best = min(around, default=(0, None))
        forms[w] = best[1] if -best[0] >= 10 * n else None
        out.append([w, forms[w], w, n, len(around), -best[0] if forms[w] else None])
    for row in out:
        while forms[row[2]]:
            row[2] = forms[row[2]]
    return sorted(map(str, out))


def corpus(seed, size=60):
    """Frequent words, their misspellings, chains of forms, accents and many words alike in all but one place."""
    rng = random.Random(seed)
    letters = "abcdeéßÿ"
    stems = ["".join(rng.choices(letters, k=rng.randint(6, 16))) for _ in range(size)]
    bag = []
    for k, stem in enumerate(stems):
        bag += [stem] * (1, 2, 3, 30, 200)[k % 5]
        at = rng.randrange(len(stem))
        bag += [stem[:at] + stem[at + 1 :], stem[:at] + rng.choice(letters) + stem[at:], stem[:at] + "x" + stem[at + 1 :]] * 2
    bag += ["internationall"] * 400 + ["internationalll"] * 30 + ["internationallll"] * 2 + ["aaaaaaaa"] * 2 + ["aaaaaaaaa"] * 25
    bag += [f"commonstart{a}{b}" for a in letters for b in letters] * 2
    rng.shuffle(bag)
    docs = [(k, " ".join(bag[k::40])) for k in range(40)]
    return [*docs, (3, docs[3][1]), (None, "Nothing NOTHING nothing"), (50, None), (51, ""), (52, "×÷ 1a2 日本語 short"),
            (53, "Long" * 9000 + " " + "Long" * 9000 + " " + "long" * 8999 + "lon " * 2 + "long" * 8999 + "lon")]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "w", 1, 2, "r") for i, t in docs], ODD)


@pytest.mark.parametrize(("limit", "cells", "floor", "entries"), [(8000, 1 << 20, 50, 200_000), (20, 2000, 3, 200_000), (7, 300, 0, 30)])
def test_variants(spark, monkeypatch, limit, cells, floor, entries):
    """Whole results for any size of lists, tiles, tasks and dictionary."""
    monkeypatch.setattr(spelling, "SHARD_CELLS", cells)
    monkeypatch.setattr(spelling.gram_dictionary, "__defaults__", (entries, floor))
    monkeypatch.setattr(spelling.tiled, "__defaults__", (limit,))
    docs = corpus(5)
    found = spelling.group_variants(frame(spark, docs))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(str([*r]) for r in found.collect()) == by_force(docs)


def test_dictionary_is_bounded(spark):
    words = spark.createDataFrame([(w, 2) for w in words_by_force(corpus(7))], "word string, n long")
    for entries in (1, 10, 100):
        found, counts = spelling.gram_dictionary(words, entries, 0)
        assert len(found) <= entries and (np.diff(found.view(np.int64)) > 0).all() and (counts > 0).all()


def test_bounds_hold():
    """Words one edit apart keep all grams but the bound, and one of two grams that do not overlap, in about its place."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        letters = int(rng.integers(1, 5))
        make = lambda n: bytes((97 + rng.integers(0, letters, n)).astype(np.uint8))
        a = make(int(rng.integers(7, 15)))
        at = int(rng.integers(0, len(a) + 1))
        b = a[:at] + make(1) + a[at + int(rng.integers(0, 2)) :]
        if a == b or len(b) < len(a):
            continue
        rows, lengths = gram_index.matrix_of([a, b])
        known = np.unique(gram_index.all_grams(rows, lengths))
        dictionary = known[rng.random(len(known)) < rng.random()]
        grams, sizes, bounds = gram_index.decompose(rows, lengths, dictionary)
        n_grams = (sizes > 0).sum(axis=1)
        common = gram_index.common_grams(grams, np.array([0]), np.array([1]))[0]
        assert (n_grams > bounds).all() and common >= max(n_grams - bounds)
        weights = rng.integers(0, 9, sizes.shape)
        two = gram_index.two_apart(sizes, weights)
        assert (two[:, 0] + sizes[[0, 1], two[:, 0]] <= two[:, 1]).all() and (sizes[[0, 1], two[:, 1]] > 0).all()
        pairs = [(p, q) for q in range(n_grams[0]) for p in range(q) if p + sizes[0, p] <= q]
        assert weights[0, two[0]].sum() == min(weights[0, p] + weights[0, q] for p, q in pairs)
        later = (0, 1) if len(b) > len(a) else (0,)
        assert any(grams[1, p + k] == grams[0, p] for p in two[0] for k in later)
        sketch = gram_index.pair_sketch(rows, lengths)
        assert (int(sketch[0]) ^ int(sketch[1])).bit_count() <= gram_index.SKETCH_BITS
        assert gram_index.one_edit_apart(rows, lengths, np.array([0]), np.array([1]))[0] == near(a, b)


def test_empty_table(spark):
    assert spelling.group_variants(frame(spark, [])).count() == 0
    assert spelling.group_variants(frame(spark, [(1, None), (None, "once only")])).count() == 0


def test_query_equals_sql(spark, sf_dir):
    name = "op13_spelling_variants"
    assert difference(spark_rows(queries.QUERIES[name](spark, sf_dir)), duck_rows(connect(sf_dir), oracles.ORACLES[name])) is None
