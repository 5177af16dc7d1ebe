"""Hashed n-gram multinomials of a trusted target and of the raw corpus."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import words_of

#: Hash buckets of a multinomial. The model that tasks receive has this many numbers at any input size.
BUCKETS = 10_000
#: Log ratios are kept in thousandths.
SCALE = 1000


def word_codes(words: Column) -> Column:
    """64-bit hash of each word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def joined_codes(left: Column, right: Column, distance: int, shift: int) -> Column:
    """Hash of each run in ``left`` with the run of ``right`` that starts ``distance`` items later.

    Hashes of words are independent bits, so shifting one and adding the other bit by bit keeps the
    order of the words in the result.
    """
    n = F.greatest(F.size(right) - distance, F.lit(0))
    return F.zip_with(
        F.slice(left, 1, n), F.slice(right, distance + 1, n), lambda a, b: F.shiftleft(a, shift).bitwiseXOR(b)
    )


def pair_codes(codes: Column) -> Column:
    """Hash of every pair of neighbouring words, from the words' hashes."""
    return joined_codes(codes, codes, 1, 1)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that are labelled of good quality and never of bad quality."""
    judged = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    return judged.where("q = 1").select("doc_id")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = 1.0) -> list[int]:
    """Log of target over raw probability per bucket, in thousandths.

    The raw counts cover every document, the target's every trusted document. Texts and trusted ids
    meet by a shuffle at any size. Counts are added up in each task before the next shuffle, so at most
    two rows per bucket and task are moved.
    """
    trusted = trusted_ids(labels).withColumn("trusted", F.lit(1))
    words = docs.select("doc_id", "text").join(trusted.hint("merge"), "doc_id", "left").select(
        "trusted", word_codes(words_of(F.col("text"))).alias("codes")
    )
    grams = words.select("trusted", F.explode(F.concat("codes", pair_codes(F.col("codes")))).alias("gram"))
    counts = grams.groupBy(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket"), "trusted").count()
    target, raw = [0] * buckets, [0] * buckets
    for found_bucket, is_trusted, n in counts.collect():
        raw[found_bucket] += n
        if is_trusted:
            target[found_bucket] += n
    t_all, r_all = sum(target) + smoothing * buckets, sum(raw) + smoothing * buckets
    return [
        round(SCALE * (math.log((t + smoothing) / t_all) - math.log((r + smoothing) / r_all)))
        for t, r in zip(target, raw, strict=True)
    ]


def summed_ratio(codes: Column, pairs: Column, ratios: list[int]) -> Column:
    """Sum of the log ratios of a document's words and pairs in thousandths, 0 without words."""
    model = F.from_json(F.lit(str(ratios)), "array<int>")

    def add(total: Column, gram: Column) -> Column:
        return total + F.get(model, F.pmod(gram, F.lit(len(ratios))).cast("int"))

    return F.aggregate(pairs, F.aggregate(codes, F.lit(0).cast("long"), add), add)
