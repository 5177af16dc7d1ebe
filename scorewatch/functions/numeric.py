"""Counts, ratios and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tally(condition: Column) -> Column:
    """Aggregate: number of rows where the condition holds (NULL over no rows, like SUM)."""
    return F.sum(F.when(condition, 1).otherwise(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient, NULL when the denominator is 0 or NULL.

    Both sides are cast first: quotients of decimals have another scale in every engine.
    """
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.round(numerator.cast("double") * 100.0 / F.nullif(denominator.cast("double"), F.lit(0.0)), digits)


def f1(precision: Column, recall: Column) -> Column:
    """Harmonic mean; NULL when either side is NULL or both are 0."""
    return 2.0 * precision * recall / F.nullif(precision + recall, F.lit(0.0))
