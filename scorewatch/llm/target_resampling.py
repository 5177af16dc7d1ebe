"""Importance resampling towards a target distribution by bit-sliced bucket counts.

A document's features fall into ``BUCKETS`` buckets. Its counts are cut into bit planes (plane ``i`` holds
bit ``i`` of every bucket's count), the buckets' gains into planes of their two's complement. The dot product
of counts and gains is then a sum over pairs of planes: the number of common bits times a power of two, with
the sign plane taken off. It is exact in whole numbers, whatever the length of a text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import pieces_of, pin

BUCKETS = 10_000
MIN_WORDS = 20
#: Percent of the documents with enough words that are drawn.
PERCENT = 25
SEED = 7
#: Bytes of a text that are cut into words at once.
SLICE = 4 << 20

_DIGITS, _LOWER, _UPPER = b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEPT = _DIGITS + _LOWER + bytes(range(128, 256))
#: Bytes of words: A-Z as a-z, digits, a-z and all bytes of other characters; the rest is a space.
_FOLD = bytes.maketrans(_UPPER, _LOWER)
_FOLD = bytes(_FOLD[b] if _FOLD[b] in _KEPT else 32 for b in range(256))


def _slices(data: bytes) -> Iterator[bytes]:
    """The folded text in slices that end between words."""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + SLICE) if len(data) - start > SLICE else -1
        end = len(data) if end < 0 else end
        yield data[start:end]
        start = end


def bucket_counts(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """Features of a text per bucket, and its words; none without text.

    A pair's checksum goes on from that of its first word, so pairs are never put together.
    """
    counts = np.zeros(buckets, np.int64)
    n_words, last = 0, None
    for part in _slices((text or "").encode("utf-8", "replace").translate(_FOLD)):
        words = part.split()
        if not words:
            continue
        sums = list(map(crc32, words))
        before = sums[:-1] if last is None else [last, *sums[:-1]]
        second = words[1:] if last is None else words
        pairs = list(map(crc32, [b" " + w for w in second], before))
        counts += np.bincount(np.array(sums + pairs, np.int64) % buckets, minlength=buckets)
        n_words, last = n_words + len(words), sums[-1]
    return counts, n_words


def planes_of(numbers: np.ndarray, width: int) -> np.ndarray:
    """Bit planes of whole numbers, lowest first, as rows of 64-bit words; negative ones in two's complement."""
    bits = (numbers[None, :] >> np.arange(width)[:, None]) & 1
    packed = np.packbits(bits.astype(bool), axis=1)
    padded = np.zeros((width, -(-len(numbers) // 64) * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


def gain_planes(gains: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Planes of signed gains and what a bit of each plane is worth; the last plane is the sign."""
    width = max(int(np.abs(gains).max(initial=0)).bit_length(), 1) + 1
    return planes_of(gains, width), [1 << i for i in range(width - 1)] + [-(1 << (width - 1))]


def sliced_sum(counts: np.ndarray, planes: np.ndarray, worth: list[int]) -> int:
    """Exact sum of counts times gains."""
    total = 0
    for i, plane in enumerate(planes_of(counts, int(counts.max(initial=0)).bit_length())):
        common = np.bitwise_count(planes & plane).sum(axis=1)
        total += sum(w * n for w, n in zip(worth, common.tolist(), strict=True)) << i
    return total


def bucket_totals(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of a whole table per bucket: added up in each task, then at most one row per bucket and task moves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in pieces_of(batches):
            for text in batch.column("text").to_pylist():
                total += bucket_counts(text, buckets)[0]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], ["bucket", "n"])

    parts = texts.select("text").mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of target over raw probability per bucket in thousandths, rounded down."""
    s_all, t_all, buckets = int(raw.sum()), int(target.sum()), len(raw)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
            for t, s in zip(target.tolist(), raw.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of the digest of seed and id; a NULL id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of every document."""
    planes, worth = gain_planes(gains)
    buckets = len(gains)
    kind = docs.select("doc_id").schema.simpleString()[len("struct<doc_id:") : -1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            features, words, weights = [], [], []
            for text in batch.column("text").to_pylist():
                counts, n_words = bucket_counts(text, buckets)
                n = int(counts.sum())
                features.append(n)
                words.append(n_words)
                weights.append(sliced_sum(counts, planes, worth) // n if n else 0)
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (features, words, weights))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_features", "n_words", "weight"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_features long, n_words long, weight long")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, their number from 1 in a total order.

    Rows are dealt by ranges of the order, sorted in their range and written; a row's place is its number in
    the range plus the sizes of the ranges before, one number each. Equal rows are told apart by their number
    in the table read, so many of them spread over several ranges.
    """
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = numbered.repartitionByRange(parts, *order, F.col("_at")).sortWithinPartitions(*order, F.col("_at"))
    dealt = pin(dealt.drop("_at").withColumn("_row", F.monotonically_increasing_id()), "ranked")
    of_range = F.shiftrightunsigned("_row", 33)
    sizes = {r[0]: r[1] for r in dealt.groupBy(of_range.cast("int")).count().collect()}
    before, starts = 0, []
    for k in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(k, 0)
    start = F.get(F.from_json(F.lit(str(starts)), "array<long>"), of_range.cast("int"))
    return dealt.withColumn("place", start + F.col("_row").bitwiseAND((1 << 33) - 1) + 1).drop("_row")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every document with its weight, score and rank in the draw.

    ``docs`` needs ``doc_id`` and ``text``, ``target`` a column ``text``; other columns are ignored. All texts
    of both tables are counted. Drawn are the highest scores, ``percent`` of the documents with ``MIN_WORDS``
    words, rounded down; the others have no rank. NULL and blank texts have no features and weight 0. Rows that
    repeat an id are documents of their own with the same noise. Equal scores go by the smaller id, NULL ids
    last, equal ids in the order of the table. Empty tables give no rows; an empty target gives every bucket
    the gain of its absence.
    """
    gains = bucket_gains(bucket_totals(target), bucket_totals(docs))
    weighed = pin(weigh(docs, gains), "target-weights")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn(
        "_fit", (F.col("n_words") >= MIN_WORDS).cast("int")
    )
    drawn = percent * weighed.where(F.col("n_words") >= MIN_WORDS).count() // 100
    order = [F.desc("_fit"), F.desc("score"), F.asc_nulls_last("doc_id")]
    return ranked(scored, order).select(
        "doc_id", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    )
