"""Spelling variants of the words of a corpus by an index of variable-length grams.

Words within one edit meet in the list of a gram that both have at about the same place (``gram_index``).
Lists are dealt over the cluster by gram, place and word length. A word stands in the list of each of its
grams and is looked up in those of two rare grams that do not overlap, among words of its own length and of
one letter more. A list over ``LIST_LIMIT`` entries is dealt into tiles.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.llm import gram_index as G
from scorewatch.llm.common import mix64, pieces_of, pin

MIN_LENGTH = 7
MIN_COUNT = 2
#: A form occurs at least this many times as often as the word.
RATIO = 10
#: One run in so many of a document loses a letter.
DROPPED = 31
#: Frequent grams that tasks and driver receive, at most; grams in ``GRAM_FLOOR`` words or fewer are never frequent.
DICTIONARY = 200_000
GRAM_FLOOR = 50
#: Entries of a list that one tile holds.
LIST_LIMIT = 8_000
#: Characters of the words that one task loads at once.
SHARD_CELLS = 1 << 20
#: Words that a task counts before it passes them on.
HELD_WORDS = 300_000

_LOWER = b"abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes.maketrans(_LOWER.upper(), _LOWER)
#: Latin-1 bytes of runs: a-z and U+00C0 to U+00FF, A-Z as a-z; the rest is a space.
_FOLD = bytes(_FOLD[b] if _FOLD[b] in _LOWER or b >= 0xC0 else 32 for b in range(256))


def document_words(doc_id: object, text: str | None, total: Counter) -> None:
    """Add a document's runs, some of them with a letter dropped, to the counts; a NULL id counts as empty."""
    data = (text or "").encode("latin-1", "replace").translate(_FOLD)
    runs = Counter(w for w in data.split() if len(w) >= MIN_LENGTH)
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DROPPED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_LENGTH:
                continue
        total[run] += n


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words with ``MIN_COUNT`` occurrences in all texts; counts are added up in each task first."""

    def rows(total: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in pieces_of(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                document_words(doc_id, text, total)
                if len(total) > HELD_WORDS:
                    yield rows(total)
                    total = Counter()
        yield rows(total)

    parts = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _sorted_parts(words: list[bytes], cells: int = SHARD_CELLS) -> Iterator[np.ndarray]:
    """Indexes of words in parts of similar length, of about ``cells`` characters with padding."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        # A part ends before the padded size of its rows would pass the limit, and where lengths double.
        widths = lengths[order[start : start + cells]]
        full = (widths * np.arange(1, len(widths) + 1) > cells) | (widths > 2 * widths[0])
        size = max(int(full.argmax()) if full.any() else len(widths), 1)
        yield order[start : start + size]
        start += size


def gram_dictionary(words: DataFrame, entries: int = DICTIONARY, floor: int = GRAM_FLOOR) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes and counts of the grams that more than ``floor`` words have, or more where they could be over ``entries``.

    All words are counted. The floor rises with the number of grams, so that no more than ``entries`` can pass.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            for part in _sorted_parts(texts):
                grams, n = np.unique(G.all_grams(*G.matrix_of([texts[k] for k in part])), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], ["gram", "n"])

    marked = F.length("word") + 2
    sizes = [F.greatest(marked - (size - 1), F.lit(0)) for size in range(G.SHORTEST, G.LONGEST + 1)]
    total = words.agg(F.sum(sum(sizes[1:], sizes[0]))).first()[0] or 0
    least = max(floor, math.ceil(total / entries))
    found = words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = found.where(F.col("n") > least).toArrow()
    codes = np.asarray(rows.column("gram"), np.int64).view(np.uint64)
    order = np.argsort(codes)
    return codes[order], np.asarray(rows.column("n"), np.int64)[order]


def _list_ids(grams: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    places = (starts.astype(np.uint64) << np.uint64(32)) + lengths.astype(np.uint64)
    return mix64(mix64(grams + np.uint64(0x9E3779B97F4A7C15)) + places).view(np.int64)


def list_entries(words: DataFrame, dictionary: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(list, width, left, word, n): every word in the lists of its grams and in those where it is looked up.

    ``width`` is the length with marks of the words that a list is for. A word of one letter more has the same
    gram at the same place or one later, as the letter comes behind the gram or before it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, numbers = batch.column("word"), batch.column("n")
            texts = [w.encode("latin-1") for w in names.to_pylist()]
            for part in _sorted_parts(texts):
                rows, lengths = G.matrix_of([texts[k] for k in part])
                grams, sizes, _ = G.decompose(rows, lengths, dictionary)
                two = G.two_apart(sizes, G.frequency_of(grams, dictionary, counts)).ravel()
                own, start = np.nonzero(sizes[:, : G.WINDOW + 1])
                up = np.repeat(np.arange(len(rows)), 2)
                row = np.concatenate([own, up, up, up])
                place = np.concatenate([start, two, two, two + 1])
                width = lengths[row] + np.repeat([0, 0, 1, 1], [len(own), len(up), len(up), len(up)])
                lists = _list_ids(np.concatenate([grams[own, start], *[grams[up, two]] * 3]), place, width)
                left, at = pa.array(np.arange(len(row)) >= len(own)), pa.array(part[row])
                columns = [pa.array(lists), pa.array(width.astype(np.int32)), left, names.take(at), numbers.take(at)]
                yield pa.RecordBatch.from_arrays(columns, ["list", "width", "left", "word", "n"])

    return words.mapInArrow(work, "list long, width int, left boolean, word string, n long")


def tiled(entries: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """Entries of long lists dealt into tiles of two parts each; every pair of entries meets in one tile.

    Lists over ``limit`` are few; they are broadcast only if they were counted to be under 100,000.
    """
    long_lists = entries.groupBy("list").count().where(F.col("count") > limit)
    long_lists = pin(long_lists.select("list", F.ceil(F.col("count") / limit).cast("int").alias("parts")), "long-lists")
    n = long_lists.count()
    if not n:
        return entries
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    tiles = F.transform(
        every,
        lambda k: F.when(F.col("left"), F.xxhash64("list", "own", k)).otherwise(F.xxhash64("list", k, F.col("own"))),
    )
    dealt = entries.join(F.broadcast(long_lists) if n < 100_000 else long_lists, "list", "left").withColumn("own", own)
    to = F.when(F.col("parts").isNull(), F.array("list")).otherwise(tiles)
    return dealt.withColumn("list", F.explode(to)).select("list", "width", "left", "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b) of the words one edit apart, once each.

    A task loads lists of words of similar length, of about ``SHARD_CELLS`` characters by the measured sizes.
    """
    dictionary, known = gram_dictionary(words)
    entries = pin(list_entries(words, dictionary, known), "gram-lists")
    sizes = {r[0]: r[1] for r in entries.groupBy(_width_class()).agg(F.sum("width")).collect()}
    parts = [math.ceil(sizes.get(k, 0) / SHARD_CELLS) for k in range(max(sizes, default=0) + 1)]
    before = [sum(parts[:k]) for k in range(len(parts))]
    of_class = lambda numbers: F.get(F.from_json(F.lit(str(numbers)), "array<int>"), _width_class())
    shard = of_class(before) + F.pmod("list", of_class(parts)).cast("int")

    def work(table: pa.Table) -> pa.Table:
        coded = table.column("word").combine_chunks().dictionary_encode()
        texts = [w.encode("latin-1") for w in coded.dictionary.to_pylist()]
        # Rows in the order of the words, which is the same in every task.
        order = np.array(sorted(range(len(texts)), key=texts.__getitem__))
        index = np.argsort(order)[np.asarray(coded.indices)]
        names, texts = coded.dictionary.take(pa.array(order)), [texts[k] for k in order.tolist()]
        counts = np.zeros(len(texts), np.int64)
        counts[index] = np.asarray(table.column("n"))
        lists, left = np.asarray(table.column("list")), np.asarray(table.column("left"))
        rows, lengths = G.matrix_of(texts)
        a, b = G.merge_lists(lists, left, index, rows, lengths, dictionary)
        columns = [names.take(pa.array(a)), pa.array(counts[a]), names.take(pa.array(b)), pa.array(counts[b])]
        return pa.Table.from_arrays(columns, ["a", "n_a", "b", "n_b"])

    found = tiled(entries).groupBy(shard.alias("shard")).applyInArrow(work, "a string, n_a long, b string, n_b long")
    return found.distinct()


def _width_class():
    return F.ceil(F.log2("width")).cast("int")


def last_forms(links: DataFrame, most: int) -> DataFrame:
    """(word, root) of words with a form: the end of the chain of forms.

    Each link multiplies the count by ``RATIO`` at least, so a chain has no more links than ``most`` allows;
    each round doubles the links gone over.
    """
    longest = max(int(math.log(max(most, 1)) / math.log(RATIO)), 1)
    roots = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("end"))
        roots = pin(roots.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root")), "roots")
    return roots


def group_variants(docs: DataFrame) -> DataFrame:
    """Every word of the corpus with its more frequent form, the last of its chain of forms and its near words.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Whole texts count; NULL and blank texts
    have no words, a NULL id counts as empty text, repeated rows count again. Runs of letters have no greatest
    length. A word's form is the most frequent of its near words (equal counts: the first by code points) if
    it occurs ``RATIO`` times as often. An empty table gives no rows.
    """
    words = pin(word_counts(docs), "words")
    pairs = pin(near_pairs(words), "near-words")
    both = pairs.selectExpr("a as word", "b as other", "n_b as other_n").union(
        pairs.selectExpr("b as word", "a as other", "n_a as other_n")
    )
    near = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best")
    )
    frequent = -F.col("best.rank") >= RATIO * F.col("n")
    table = pin(
        words.join(near, "word", "left").select(
            "word",
            F.when(frequent, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    )
    most = table.agg(F.max("form_n")).first()[0] or 1
    roots = last_forms(table.where("form is not null"), most)
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
