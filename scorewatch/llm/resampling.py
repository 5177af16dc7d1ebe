"""Importance resampling of documents towards trusted text by Gumbel top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.llm import grams as G
from scorewatch.llm.common import words_of
from scorewatch.llm.target_resampling import ranked

#: Share of the documents that the sample holds.
SHARE = 0.9
#: N-grams that a document's mean log ratio stands for; the weight is the mean times this.
STRENGTH = 100.0
SEED = 17


def weigh(docs: DataFrame, ratios: list[int], strength: float = STRENGTH, seed: int = SEED) -> DataFrame:
    """Log weight and perturbed key of every document.

    The noise is a function of the seed and the id, so a retried task draws the same. Documents
    without words have log weight 0.
    """
    codes = G.word_codes(words_of(F.col("text")))

    def mean(c):
        return F.transform(
            F.array(G.pair_codes(c)),
            lambda p: G.summed_ratio(c, p, ratios) / (G.SCALE * F.greatest(F.size(c) + F.size(p), F.lit(1))),
        )[0]

    ratio = F.transform(F.array(codes), mean)[0]
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11).cast("double")
    uniform = (hashed + 0.5) / float(1 << 53)
    scored = docs.select("doc_id", ratio.alias("log_ratio"), (-F.log(-F.log(uniform))).alias("noise"))
    weight = F.col("log_ratio") * strength
    return scored.select("doc_id", "log_ratio", weight.alias("log_weight"), (weight + F.col("noise")).alias("sample_key"))


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE, strength: float = STRENGTH, seed: int = SEED) -> DataFrame:
    """Every document with its weight and whether the sample of ``share`` of the rows holds it.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``quality``; other columns are
    ignored. The weight is the ratio of the target's to the raw corpus's n-gram model, as a mean so
    that long texts are not favoured for their length. The rows with the largest keys (weight plus
    Gumbel noise) are drawn without replacement, as many as the share of all rows comes to; of equal keys
    those of the smaller id, NULL ids last, and of repeated rows as many as are left. NULL ids share one noise;
    an empty table gives no rows.
    """
    keyed = weigh(docs, G.log_ratios(docs, labels), strength, seed)
    placed = ranked(keyed, [F.desc("sample_key"), F.asc_nulls_last("doc_id")])
    drawn = round(share * placed.count())
    return placed.select("doc_id", "log_ratio", "log_weight", "sample_key", (F.col("place") <= drawn).alias("kept"))
