"""Quality rules on counts of words and lines, and a log-likelihood ratio of hashed n-grams.

Everything runs as DataFrame expressions inside the scan of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.llm import grams as G
from scorewatch.llm.common import SPACES, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: Mean log ratio per n-gram below which a document is rejected.
THRESHOLD = -0.05


def repeated_words(codes: Column, pairs: Column) -> Column:
    """Words inside five-word windows that are found twice or more in the text, the first one included.

    Windows are compared by a 64-bit hash, made of the hashes of the words and of their pairs. Only
    where some window repeats are they sorted with their places; each repeated window then adds the
    words that the repeated window before it left out.
    """
    window = WINDOW
    fours = F.transform(F.array(pairs), lambda p: G.joined_codes(p, p, 2, 2))[0]
    found = F.transform(F.array(fours), lambda f: G.joined_codes(f, codes, 4, 1))[0]

    def places(w: Column) -> Column:
        ordered = F.array_sort(F.transform(w, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return F.transform(
            F.array(ordered),
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        F.sequence(F.lit(0), F.size(s) - 1),
                        lambda i: F.coalesce(F.get(s, i - 1)["g"] == s[i]["g"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["g"] == s[i]["g"], F.lit(False)),
                    ),
                    lambda i: s[i]["i"],
                )
            ),
        )[0]

    def covered(starts: Column) -> Column:
        return F.aggregate(
            starts,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last")),
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(window), p - a["last"])).cast("long").alias("n"), p.alias("last")
            ),
            lambda a: a["n"],
        )

    counted = F.transform(
        F.array(found),
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(places(w))),
    )[0]
    return F.when(F.size(codes) <= window, F.lit(0).cast("long")).otherwise(counted)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    blank = lambda line: F.btrim(line, F.lit(SPACES)) == ""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: ~blank(line))
    return F.transform(F.array(lines), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))[0]


def quality_columns(text: Column, ratios: list[int], threshold: float = THRESHOLD) -> Column:
    """Struct of the counts, the verdict of the base rules, the ratio per n-gram and the final verdict."""
    plain = F.coalesce(text, F.lit(""))

    def judged(codes: Column) -> Column:
        return F.transform(F.array(G.pair_codes(codes)), lambda pairs: counted(codes, pairs))[0]

    def counted(codes: Column, pairs: Column) -> Column:
        total = G.summed_ratio(codes, pairs, ratios)
        return F.struct(
            F.size(codes).cast("long").alias("n_words"),
            repeated_words(codes, pairs).alias("n_repeat_words"),
            (total / (G.SCALE * F.greatest(F.size(codes) + F.size(pairs), F.lit(1)))).alias("ratio"),
        )

    first = F.transform(F.array(G.word_codes(words_of(text))), judged)[0]

    def verdict(c: Column) -> Column:
        failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED_PERCENT * c["n_words"])
        return F.struct(
            c["n_words"].alias("n_words"),
            F.char_length(F.translate(plain, SPACES, "")).cast("long").alias("word_chars"),
            (F.char_length(plain) - F.char_length(F.translate(plain, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            duplicate_lines(text).alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
            failed.alias("base_failed"),
            c["ratio"].alias("log_ratio"),
            (~failed & (c["ratio"] >= threshold)).alias("kept"),
        )

    return F.transform(F.array(first), verdict)[0]


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts and verdict of every document.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``quality``; other columns are
    ignored. A NULL text counts as empty, has no words and fails the base rules. Repeated rows and NULL
    ids are judged row by row; an empty table gives no rows. Without trusted labels the target is
    uniform. The ratio lies with the mean over all single words and pairs, so it does not depend on the
    text's length, and one threshold holds for every document.
    """
    ratios = G.log_ratios(docs, labels)
    return docs.select("doc_id", quality_columns(F.col("text"), ratios, threshold).alias("q")).select("doc_id", "q.*")


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that pass, with all their columns as they were; defined for odd input as ``judge``."""
    ratios = G.log_ratios(docs, labels)
    return docs.where(quality_columns(F.col("text"), ratios, threshold)["kept"])
