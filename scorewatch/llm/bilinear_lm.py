"""Log probability of whole texts under a log-bilinear model and under plain word counts.

The counts cover every word of every training text. The model's symbols are the most frequent words and
classes of the others by their last letters; a word of a class has its share of the class by its count. So a
text's probability is a product of normalised parts over all counted words and one unseen word per class.

All training texts train the model: in each round every task goes on from the same network over its own
share of the texts, and the networks are averaged by their tokens. Counts of the ``FREQUENT`` most frequent
words go to every task; the few tokens of other words meet their counts by a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.llm import bilinear_net as B
from scorewatch.llm.common import id_share, pieces_of, pin

#: Documents with this remainder of their id are held out.
PARTS, HELD_OUT = 5, 1
#: Words that are symbols of their own, and classes of all other words.
OWN_WORDS, CLASSES = 384, 127
#: Counted words that every task receives, of at most ``FREQUENT_BYTES`` each.
FREQUENT, FREQUENT_BYTES = 200_000, 64
ROUNDS = 2
SEED = 5
#: Bytes of a text that are cut into words at once, and distinct words that a task counts before it passes them on.
SLICE, HELD_WORDS = 1 << 20, 300_000
#: The token after the last word; no word holds white space.
END = b"\n"

_UPPER = bytes(range(65, 91))
_FOLD = bytes.maketrans(_UPPER + b"\t\n\x0b\x0c\r", _UPPER.lower() + b" " * 5)
_STOPS = b".,;:!?\"')"
_STEP = 1 << 20
#: How the symbols of a text are kept.
SYMBOL = np.dtype("<i2")


def tokens_of(text: str | None, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text in lists of about ``size`` bytes, then the end token; NULL is empty."""
    data = (text or "").encode("utf-8", "replace").translate(_FOLD)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + size) if len(data) - start > size else -1
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end
    yield [END]


def class_of(word: bytes) -> int:
    """Class of a word by the last bytes before its closing marks."""
    return crc32((word.rstrip(_STOPS) or word)[-3:]) % CLASSES


def token_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all tokens of the texts, words as bytes; added up in each task first."""

    def rows(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total, pa.binary()), pa.array(total.values(), pa.int64())], ["word", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in pieces_of(batches):
            for text in batch.column("text").to_pylist():
                for words in tokens_of(text):
                    total.update(words)
                    if len(total) > HELD_WORDS:
                        yield rows(total)
                        total = Counter()
        yield rows(total)

    return docs.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Counts:
    """What every task knows of the counts: the frequent words, most frequent first, and sums."""

    words: list[bytes]
    numbers: list[int]
    tokens: int
    types: int
    #: How many of the words are symbols of their own.
    own: int
    #: The symbol of each of the words.
    symbols: np.ndarray
    class_tokens: np.ndarray
    class_types: np.ndarray

    def class_sizes(self) -> np.ndarray:
        """Tokens of each class with one half for every counted word and for an unseen one."""
        return self.class_tokens + 0.5 * (self.class_types + 1)

    def frequency(self) -> np.ndarray:
        """Share of each symbol."""
        sizes = np.concatenate([np.array(self.numbers[: self.own]) + 0.5, self.class_sizes()])
        return sizes / sizes.sum()


def gather_counts(vocabulary: DataFrame) -> Counts:
    """The sums over the whole vocabulary and its bounded head."""
    tokens, types = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    short = vocabulary.where(F.length("word") <= FREQUENT_BYTES)
    head = short.orderBy(F.desc("c"), "word").limit(FREQUENT).toArrow()
    words, numbers = head.column("word").to_pylist(), head.column("c").to_pylist()
    own = set(words[:OWN_WORDS])

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist(), strict=True):
                if word not in own:
                    k = class_of(word)
                    total[k] += c
                    distinct[k] += 1
        yield pa.RecordBatch.from_arrays([*map(pa.array, (np.arange(CLASSES), total, distinct))], ["k", "n", "types"])

    sums = vocabulary.mapInArrow(classes, "k long, n long, types long").groupBy("k").agg(F.sum("n"), F.sum("types"))
    class_tokens, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, n, t in sums.collect():
        class_tokens[k], class_types[k] = n, t
    symbols = [k if k < len(own) else len(own) + class_of(w) for k, w in enumerate(words)]
    return Counts(words, numbers, tokens, types, len(own), np.array(symbols, np.int64), class_tokens, class_types)


class Reader:
    """Texts as symbols."""

    def __init__(self, counts: Counts):
        self.counts, self.own, self.symbols = counts, counts.own, counts.symbols
        self.start = self.own + CLASSES

    @cached_property
    def places(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.counts.words)}

    def read(self, text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        """(symbols, places among the frequent words or -1, the words without a place) of a text, part by part."""
        get = self.places.get
        for words in tokens_of(text):
            places = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
            lost = np.flatnonzero(places < 0)
            others = [words[k] for k in lost.tolist()]
            symbols = self.symbols[places] if len(self.symbols) else np.zeros(len(words), np.int64)
            symbols[lost] = [self.own + class_of(w) for w in others]
            yield symbols, places, others

    def examples(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols before, symbol) of the tokens of texts whose symbols are given."""
        edge = np.full(B.CONTEXT, self.start, np.int64)
        line = np.concatenate([x for p in parts for x in (edge, p)])
        at = np.flatnonzero(line != self.start)
        return np.stack([line[at - k] for k in range(1, B.CONTEXT + 1)], axis=1), line[at]


def train_network(read: DataFrame, counts: Counts, rounds: int = ROUNDS, seed: int = SEED) -> B.Network:
    """Network trained on all texts of ``read_texts``, each in one of the rounds by its id and symbols.

    A task returns its network as sums of whole numbers, so the average is the same in any order of the tasks.
    The driver holds one network, whose size does not depend on the input.
    """
    frequency = counts.frequency()
    net = B.Network.initial(frequency, seed)
    turn = F.pmod(F.xxhash64("doc_id", "symbols"), F.lit(rounds))
    for k in range(rounds):
        flat = net.flat()

        def work(batches: Iterator[pa.RecordBatch], flat=flat, k=k) -> Iterator[pa.RecordBatch]:
            own = B.Network.from_flat(flat, len(frequency))
            reader, trainer = Reader(counts), B.Trainer(own, frequency, seed + k)
            held, size, tokens = [], 0, 0

            def learn():
                before, target = reader.examples(held)
                trainer.learn(before, target)
                return len(target)

            for batch in batches:
                for line in batch.column("symbols").to_pylist():
                    symbols = np.frombuffer(line, SYMBOL)
                    held.append(symbols)
                    size += len(symbols)
                    if size >= 1 << 19:
                        tokens += learn()
                        held, size = [], 0
            tokens += learn() if held else 0
            if tokens:
                weight = -(-tokens // 1000)
                sums = np.round(own.flat().astype(np.float64) * _STEP).astype(np.int64) * weight
                place = np.arange(-1, len(sums), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.append(weight, sums))], ["place", "total"])

        share = read.where(turn == k).select("symbols")
        found = share.mapInArrow(work, "place int, total long").groupBy("place").agg(F.sum("total").alias("total")).toArrow()
        if found.num_rows:
            places = np.asarray(found.column("place"))
            totals = np.zeros(len(flat) + 1)
            totals[places + 1] = np.asarray(found.column("total"))
            net = B.Network.from_flat(totals[1:] / totals[0] / _STEP, len(frequency))
    return net


def read_texts(docs: DataFrame, counts: Counts, kind: str) -> DataFrame:
    """Per document its symbols, what needs no other counts, and its words that do. A text is cut into words once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(counts)
        log_counts = np.log10(np.array(counts.numbers, np.float64) + 0.5)
        # A word of a class has its share of the class; of a symbol of its own the whole.
        sizes = np.concatenate([np.zeros(counts.own), np.log10(counts.class_sizes())])
        shares = np.where(np.arange(len(counts.words)) < counts.own, 0.0, log_counts) - sizes[counts.symbols]
        for batch in pieces_of(batches):
            texts, lines, lengths, known, base, extra = batch.column("text").to_pylist(), [], [], [], [], []
            words, numbers = [], []
            for text in texts:
                parts, held, logs, more, rare = [], 0, 0.0, 0.0, Counter()
                for symbols, places, others in reader.read(text):
                    parts.append(symbols.astype(SYMBOL))
                    rare.update(others)
                    more -= float(sizes[symbols[places < 0]].sum())
                    places = places[places >= 0]
                    held += len(places)
                    logs += float(log_counts[places].sum())
                    more += float(shares[places].sum())
                line = np.concatenate(parts)
                lines.append(line.tobytes())
                lengths.append(len(line))
                known.append(held)
                base.append(logs)
                extra.append(more)
                words.append(list(rare))
                numbers.append(list(rare.values()))
            columns = [batch.column("doc_id"), batch.column("held_out"), *map(pa.array, (lengths, known, base, extra))]
            columns += [pa.array(words, pa.list_(pa.binary())), pa.array(numbers, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.binary())], names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "extra", "words", "numbers", "symbols"]
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, extra double,"
        " words array<binary>, numbers array<long>, symbols binary"
    )
    return docs.select("doc_id", "held_out", "text").mapInArrow(work, schema)


def _scored(read: DataFrame, counts: Counts, net: B.Network) -> DataFrame:
    """The documents with the model's part of their score, ``model``."""
    kept = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(counts)
        for batch in pieces_of(batches, 4 << 20, "symbols"):
            lines = [np.frombuffer(line, SYMBOL) for line in batch.column("symbols").to_pylist()]
            before, target = reader.examples(lines)
            logs = net.log_probabilities(before, target) / math.log(10)
            lengths = np.array([len(x) for x in lines])
            own = np.add.reduceat(logs, np.cumsum(lengths) - lengths) + batch.column("extra").to_numpy()
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(own)], [*kept, "model"])

    wanted = read.select(*kept, "extra", "symbols")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.select(*kept).schema)
    return wanted.mapInArrow(work, schema + ", model double")


def held_out(doc_id: Column) -> Column:
    return id_share(doc_id, PARTS) == HELD_OUT


def score(docs: DataFrame) -> DataFrame:
    """Log10 probability of every whole text by word counts and by the model.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. NULL and empty texts consist of the end
    token. NULL ids count as empty text for the share of held-out documents; rows that repeat an id are
    documents of their own. Without training texts every token is unseen and the model knows no words. An empty
    table gives no rows.
    """
    docs = docs.select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    kind = docs.select("doc_id").schema.simpleString()[len("struct<doc_id:") : -1]
    training = docs.where(~F.col("held_out"))
    vocabulary = pin(token_counts(training), "token-counts")
    counts = gather_counts(vocabulary)
    read = pin(read_texts(docs, counts, kind).withColumn("row", F.monotonically_increasing_id()), "read-texts")
    net = train_network(read.where(~F.col("held_out")), counts)
    rows = _scored(read, counts, net)
    other = read.select("row", F.explode(F.arrays_zip("words", "numbers")).alias("w")).select("row", "w.words", "w.numbers")
    met = other.withColumnRenamed("words", "word").join(vocabulary, "word", "left")
    log_count = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    sums = met.groupBy("row").agg(
        F.sum(F.col("numbers") * log_count).alias("logs"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("numbers")).otherwise(0)).alias("found"),
    )
    logs = F.coalesce("logs", F.lit(0.0))
    whole = math.log10(counts.tokens + 0.5 * (counts.types + 1))
    return rows.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )
