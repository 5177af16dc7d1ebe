"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import id_share, map_batches, pin, rows_out

FOLDS, HELD_FOLD = 5, 0
#: Labelled documents to learn from (those of lowest hashed id), and their shares for the lexicon,
#: the trees and the calibration.
SAMPLE_DOCS = 20_000
SHARES = (0.4, 0.4, 0.2)
#: Lexicon: beginnings of words, how many toxic documents must hold one, and how many entries are kept.
STEMS = range(4, 9)
LEAST_TOXIC = 5
LEAST_LOG_ODDS = 1.5
LEXICON = 5_000
#: An entry of at least this log odds is a hit.
STRONG = 3.0
NEAR_WORDS = 5
TREES, DEPTH, BINS, RATE, LEAST_LEAF = 80, 3, 32, 0.15, 12
CACHE_WORDS = 600_000

#: Second-person words of the four languages, and characters that stand in for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti contigo tuyo usted ustedes vosotros vuestro".split()
)
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""})

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\W\d_][\d@$!*#%&._-]+[^\W\d_]")

_PUNCTUATION = np.frombuffer(b".,;:|-()\"'", np.uint8)
_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)])

FEATURES = (
    "log_words", "hit_rate", "hits", "weight_sum", "weight_max", "weight_second", "weight_rate", "hits_near_second_person",
    "second_person_rate", "capital_rate", "capital_words", "exclamations", "questions", "punctuation", "digits",
    "obfuscated_rate", "obfuscated_hits", "repeated_letters",
)

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)


def entries_of(word: str) -> list[str]:
    """Lexicon entries that a bare lower-case word can match: itself and its beginnings."""
    return [word + "$", *(word[:k] for k in STEMS if k <= len(word))]


def bare(token: str) -> str:
    return _EDGES.sub("", token).lower()


class Lexicon(dict):
    """What is known of a token: lexicon weight, second person, obfuscated, weight without stand-ins."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> tuple[float, int, int, float] | None:
        word = bare(token)
        weight, second = self.weight(word), int(word in SECOND_PERSON)
        odd = int(bool(_INNER.search(token)))
        hidden = max(self.weight(bare(token.translate(STAND_INS))), 0.0) if odd else 0.0
        found = (max(weight, hidden), second, odd, hidden) if weight or second or odd else None
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(token) <= 64:
            self[token] = found
        return found

    def weight(self, word: str) -> float:
        return max((self.weights[e] for e in entries_of(word) if e in self.weights), default=0.0)

    def features(self, text: str) -> list[float]:
        tokens = text.split()
        n = max(len(tokens), 1)
        chars = max(len(text), 1)
        told = [(k, *v) for k, v in enumerate(map(self.__getitem__, tokens)) if v]
        weights = sorted([v[1] for v in told if v[1]], reverse=True)
        hits = [v[0] for v in told if v[1] >= STRONG]
        second = [v[0] for v in told if v[2]]
        near = 0
        for at in hits if second else ():
            k = bisect.bisect(second, at)
            near += min(abs(x - at) for x in second[max(k - 1, 0) : k + 1]) <= NEAR_WORDS
        data = np.frombuffer(text.encode(), np.uint8)
        of = np.bincount(data, minlength=256)
        letters = np.flatnonzero((data[2:] == data[1:-1]) & (data[2:] == data[:-2]))
        total = sum(weights)
        return [
            math.log1p(len(tokens)), len(hits) / n, float(len(hits)), total, weights[0] if weights else 0.0,
            weights[1] if len(weights) > 1 else 0.0, total / n, float(near), len(second) / n,
            of[65:91].sum() / chars, sum(map(str.isupper, tokens)) / n, of[33] / n, of[63] / n,
            of[_PUNCTUATION].sum() / n, of[48:58].sum() / chars,
            sum(v[3] for v in told) / n, float(sum(v[4] >= STRONG for v in told)),
            (_LETTER[data[letters]].sum() if len(letters) else 0) / n,
        ]


@dataclass
class Trees:
    """Boosted trees over binned features and the isotonic map from their sum to a probability."""

    edges: list[np.ndarray]
    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    knots: np.ndarray | None = None
    levels: np.ndarray | None = None

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1)

    def margin(self, binned: np.ndarray) -> np.ndarray:
        total = np.full(len(binned), self.base)
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(binned), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[np.arange(len(binned)), feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = self.margin(self.bins(x))
        if self.knots is None:
            return 1.0 / (1.0 + np.exp(-margin))
        # A share of the raw order is kept, so that texts of one calibrated level stay ranked.
        raw = 1.0 / (1.0 + np.exp(-margin))
        return np.clip(0.98 * np.interp(margin, self.knots, self.levels) + 0.02 * raw, 0.0, 1.0)


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting of complete trees on the logistic loss."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(edges, float(np.log(mean / (1 - mean))))
    binned = model.bins(x)
    width = BINS + 1
    flat = binned + np.arange(x.shape[1]) * width
    margin = np.full(len(y), model.base)
    for _ in range(TREES):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - y, p * (1 - p) + 1e-6
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, width)
        for level in range(DEPTH):
            first = 2**level - 1
            for k in range(first, 2 * first + 1):
                rows = np.flatnonzero(node == k)
                if len(rows) < 2 * LEAST_LEAF:
                    continue
                shape = (x.shape[1], width)
                at = flat[rows].ravel()
                sums = [
                    np.bincount(at, np.repeat(v, x.shape[1]), minlength=x.shape[1] * width).reshape(shape).cumsum(1)
                    for v in (g[rows], h[rows], np.ones(len(rows)))
                ]
                left_g, left_h, left_n = sums
                all_g, all_h = g[rows].sum(), h[rows].sum()
                gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
                gain[(left_n < LEAST_LEAF) | (len(rows) - left_n < LEAST_LEAF)] = 0.0
                best = int(gain.argmax())
                if gain.flat[best] > 1e-6:
                    feature[k], cut[k] = divmod(best, width)
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - (2**DEPTH - 1)
        sums_g = np.bincount(leaf, g, minlength=2**DEPTH)
        sums_h = np.bincount(leaf, h, minlength=2**DEPTH)
        values = -RATE * sums_g / (sums_h + 1)
        margin += values[leaf]
        model.trees.append((feature, cut, values))
    return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the middle and the level of each pool, in ascending order."""
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []
    for m, label in zip(margin[order].tolist(), y[order].tolist(), strict=True):
        pools.append([label, 1.0, m])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            label_sum, n, m_sum = pools.pop()
            pools[-1] = [pools[-1][0] + label_sum, pools[-1][1] + n, pools[-1][2] + m_sum]
    found = np.array(pools)
    return found[:, 2] / found[:, 1], found[:, 0] / found[:, 1]


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of the sample, each with its place in [0, 1) for the split into shares."""
    marks = labels.where("doc_id is not null and toxic is not null").where(id_share(F.col("doc_id"), FOLDS) != HELD_FOLD)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.lit(7), "doc_id")
    chosen = marks.orderBy(order, "doc_id").limit(SAMPLE_DOCS)
    place = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1000)) / 1000.0
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return pin(found.select(F.coalesce("text", F.lit("")).alias("text"), "toxic", place.alias("place")), "toxicity")


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Smoothed log odds of word beginnings between toxic and other documents.

    Each task counts its documents and emits one row per entry; only the best entries are collected.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {bare(t) for t in set(text.split())}
                found[int(toxic > 0)].update({e for w in words if 1 < len(w) <= 40 for e in entries_of(w)})
        keys = [*found[0].keys() | found[1].keys()]
        for k in range(0, len(keys), 20_000):
            part = keys[k : k + 20_000]
            out = [pa.array(part, pa.string()), *(pa.array([c[e] for e in part], pa.int64()) for c in found)]
            yield pa.RecordBatch.from_arrays(out, names=["entry", "clean", "toxic"])

    n_clean, n_toxic = (
        float(v or 0) for v in sample.agg(F.sum(1 - F.signum("toxic")), F.sum(F.signum("toxic"))).first()
    )
    counted = sample.select("text", "toxic").mapInArrow(count, "entry string, clean long, toxic long")
    counted = counted.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    best = (
        counted.where(F.col("toxic") >= LEAST_TOXIC)
        .select("entry", odds.alias("odds"), (odds * F.sqrt("toxic")).alias("rank"))
        .where(F.col("odds") >= LEAST_LOG_ODDS)
        .orderBy(F.desc("rank"), "entry")
        .limit(LEXICON)
    )
    return {r["entry"]: r["odds"] for r in best.collect()}


def learn(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], Trees] | None:
    """Lexicon and calibrated trees; None unless both classes are labelled."""
    sample = labelled_sample(docs, labels)
    weights = learn_lexicon(sample.where(F.col("place") < SHARES[0]))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        lexicon = Lexicon(weights)
        rows = [lexicon.features(t) for t in batch.column("text").to_pylist()]
        out = [batch.column("toxic").cast(pa.int32()), batch.column("place"), pa.array(rows, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(out, names=["toxic", "place", "features"])

    rest = sample.where(F.col("place") >= SHARES[0])
    rows = map_batches(rest, measure, "toxic int, place double, features array<double>").collect()
    rows.sort(key=lambda r: (r["place"], r["features"]))
    if len({r["toxic"] > 0 for r in rows}) < 2:
        return None
    x = np.array([r["features"] for r in rows])
    y = np.array([float(r["toxic"] > 0) for r in rows])
    fitted = np.array([r["place"] < SHARES[0] + SHARES[1] for r in rows])
    if len(set(y[fitted])) < 2:
        fitted[:] = True
    model = fit_trees(x[fitted], y[fitted])
    if len(set(y[~fitted])) == 2:
        model.knots, model.levels = isotonic(model.margin(model.bins(x[~fitted])), y[~fitted])
    return weights, model


def score_texts(model: tuple[dict[str, float], Trees] | None, lexicon: Lexicon | None, texts: list[str]) -> np.ndarray:
    if model is None or not texts:
        return np.zeros(len(texts))
    return model[1].score(np.array([lexicon.features(t) for t in texts]))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity score of every document.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``toxic``; other columns are
    ignored. Labels count only outside the held-out fold; a document labelled both ways counts as
    toxic. NULL and empty texts are scored like a text without words. Repeated rows and NULL ids are
    scored row by row; an empty table gives no rows. Unless both classes are labelled all scores are 0.
    """
    model = learn(docs, labels)
    held = (id_share(F.col("doc_id"), FOLDS) == HELD_FOLD).alias("held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model[0]) if model else None
        for batch in batches:
            found = score_texts(model, lexicon, [t or "" for t in batch.column(2).to_pylist()])
            ids, fold = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            yield rows_out(_ARROW, (ids, fold, found.tolist(), (found >= 0.5).astype(int).tolist()))

    return docs.select("doc_id", held, "text").mapInArrow(run, SCHEMA)


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """Documents that score below ``limit``, with all their columns as they were."""
    model = learn(docs, labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model[0]) if model else None
        for batch in batches:
            found = score_texts(model, lexicon, [t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(found < limit))

    return docs.mapInArrow(run, docs.schema)
