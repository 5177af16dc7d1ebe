"""Splits, quotas and traffic routing: which rows go where."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of a hash, and how many are found in one round.
HEX_DIGITS, CUT_DIGITS = 32, 3
SUB_BUCKETS = 256
AFTER_ANY_HEX = "g"


def _shuffle_key(id_col: str, seed: int) -> Column:
    """Text that sorts rows in a random but repeatable order; the id breaks ties."""
    text = F.col(id_col).cast("string")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary")), F.lit(":"), text)


def _hash_number(id_col: str, seed: int, hex_digits: int = 8) -> Column:
    """Evenly spread integer below ``16 ** hex_digits`` made of the id."""
    return F.conv(F.substring(_shuffle_key(id_col, seed), 1, hex_digits), 16, 10).cast("long")


def exact_split(
    rows: DataFrame,
    id_col: str,
    train: float = 0.70,
    val: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Shuffled split with exact sizes: int(n * train), int(n * val) and the rest.

    Adds ``split``. The data itself is not shuffled or sorted: the hash at which a split ends is selected
    digit by digit (``keys_at``). Rows that repeat an id go the same way. The selection runs when the split is
    asked for, as the number of rounds depends on the data.
    """
    key = _shuffle_key(id_col, seed)
    keyed = rows.select(key.alias("key"))
    total = keyed.count()
    first = math.floor(total * train)
    train_end, val_end = keys_at(keyed, [first, first + math.floor(total * val)])
    return rows.withColumn("split", F.when(key < train_end, "train").when(key < val_end, "val").otherwise("test"))


def keys_at(keyed: DataFrame, places: Sequence[int]) -> list[str]:
    """The shortest texts that cut off the first ``places`` rows in the order of the column ``key``.

    ``key`` starts with hexadecimal digits. Each round counts the rows that share the digits found so far by
    their next three, at most 4,096 counts per place, until a place's digits belong to one row or all digits
    are used. A place behind the last row is cut off by a text above all.
    """
    found = dict.fromkeys(places, "")
    left = {place: place for place in places}
    open_ = set(places)
    for length in range(CUT_DIGITS, HEX_DIGITS + CUT_DIGITS, CUT_DIGITS):
        starts = {found[place] for place in open_}
        rows = keyed if "" in starts else keyed.where(F.substring("key", 1, length - CUT_DIGITS).isin(*starts))
        counts = sorted(map(tuple, rows.groupBy(F.substring("key", 1, length)).count().collect()))
        for place in list(open_):
            before = 0
            for digits, n in counts:
                if not digits.startswith(found[place]):
                    continue
                if before + n > left[place]:
                    found[place], left[place] = digits, left[place] - before
                    if n == 1:
                        open_.discard(place)
                    break
                before += n
            else:
                found[place] = AFTER_ANY_HEX
                open_.discard(place)
        if not open_:
            break
    return [found[place] for place in places]


def hash_split(rows: DataFrame, id_col: str, train: float = 0.70, val: float = 0.15, seed: int = 42) -> DataFrame:
    """Split by hash alone: sizes are approximate, a row's split never changes as rows are added."""
    share = _hash_number(id_col, seed) / F.lit(float(16**8))
    return rows.withColumn(
        "split", F.when(share < train, "train").when(share < train + val, "val").otherwise("test")
    )


def first_per_class(
    rows: DataFrame, class_col: str, id_col: str, quota: int | Mapping[str, int]
) -> DataFrame:
    """The first rows by id of every class, up to one quota for all or one per named class.

    Two rounds: each class is cut into sub-buckets that keep their own first rows, then the few
    that remain are ranked together. A class with most of the rows is thus sorted by many tasks,
    and Spark cuts each task's rows to the quota before the shuffle.
    """
    largest = quota if isinstance(quota, int) else max(quota.values())
    part = F.pmod(F.xxhash64(id_col), F.lit(SUB_BUCKETS))
    within = Window.partitionBy(class_col, "_part").orderBy(id_col)
    overall = Window.partitionBy(class_col).orderBy(id_col)
    wanted = rows if isinstance(quota, int) else rows.filter(F.col(class_col).isin(*quota))
    ranked = (
        wanted.withColumn("_part", part)
        .withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= largest)
        .withColumn("_rank", F.row_number().over(overall))
        .filter(F.col("_rank") <= largest)
    )
    if not isinstance(quota, int):
        limit = F.lit(0)
        for name, count in quota.items():
            limit = F.when(F.col(class_col) == name, count).otherwise(limit)
        ranked = ranked.filter(F.col("_rank") <= limit)
    return ranked.drop("_part", "_rank")


def assign_variant(
    rows: DataFrame, id_col: str, traffic: Sequence[tuple[str, int]], seed: int = 7
) -> DataFrame:
    """Route every id to a served model by traffic percentage; the same id always goes the same way."""
    if sum(percent for _, percent in traffic) != 100:
        raise ValueError("traffic percentages must add up to 100")
    slot = F.pmod(_hash_number(id_col, seed), F.lit(100))
    variant, upper = F.lit(traffic[-1][0]), 100
    for name, percent in reversed(list(traffic)):
        variant = F.when(F.col("traffic_slot") < upper, name).otherwise(variant)
        upper -= percent
    return rows.withColumn("traffic_slot", slot.cast("int")).withColumn("served_model_name", variant)
