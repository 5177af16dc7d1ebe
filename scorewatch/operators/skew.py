"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED_ITEMS = 10000
HOT_SHARE = 1.0 / 512
SALTS = 64


def fingerprint(df: DataFrame, keys: Sequence[str]) -> Column:
    """64-bit hash of the key columns; 0.0 and -0.0 are one value, as they are to a join."""
    kinds = dict(df.dtypes)
    return F.xxhash64(*[F.col(k) + F.lit(0.0) if kinds[k] in ("float", "double") else F.col(k) for k in keys])


def hot_key_array(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """One row, one array: fingerprints of the keys that hold at least ``share`` of all rows, and more than one row.

    A mergeable frequency sketch: one scan of the key columns, no shuffle of rows, at most one number per key
    that can reach the share. Keys below the share are left to AQE.
    """
    sketch = df.select(fingerprint(df, keys).alias("key")).agg(
        F.expr(f"approx_top_k(key, {math.ceil(1 / share)}, {TRACKED_ITEMS})").alias("top"), F.count("*").alias("total")
    )
    floor = F.greatest(F.lit(share) * F.col("total"), F.lit(2.0))
    hot = F.filter("top", lambda e: e["item"].isNotNull() & (e["count"] >= floor))
    return sketch.select(F.coalesce(F.transform(hot, lambda e: e["item"]), F.array().cast("array<bigint>")).alias("hot"))


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """The fingerprints of ``hot_key_array``, computed now."""
    return hot_key_array(df, keys, share).first()["hot"]


def salted_join(
    many: DataFrame,
    one: DataFrame,
    key: str | Sequence[str],
    spread_by: str,
    how: str = "inner",
    salts: int = SALTS,
    **hot_options,
) -> DataFrame:
    """Equi join of a side with possibly hot keys (``many``) and a side with few rows per key.

    Rows of hot keys are spread over ``salts`` parts by the hash of ``spread_by``, and only those
    keys are repeated on the other side. All other keys join as usual. No row is dropped or counted twice:
    each salted row meets exactly one copy. The hot keys are a subquery of the join, so nothing runs before the
    result is asked for, both sides and every retried task agree on them, and no key is hot in an empty table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    left_kinds, right_kinds = dict(many.dtypes), dict(one.dtypes)
    if any(left_kinds[k] != right_kinds[k] for k in keys):
        raise ValueError("join keys must have the same type on both sides")
    hot = hot_key_array(many, keys, **hot_options).scalar()
    is_hot = lambda df: F.array_contains(hot, fingerprint(df, keys))
    part = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    every_part = F.sequence(F.lit(0), F.lit(salts - 1))
    spread = many.withColumn("_salt", F.when(is_hot(many), part).otherwise(F.lit(0)))
    repeated = one.withColumn("_salt", F.explode(F.when(is_hot(one), every_part).otherwise(F.array(F.lit(0)))))
    return spread.join(repeated, [*keys, "_salt"], how).drop("_salt")
