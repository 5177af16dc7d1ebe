"""Arrays of numbers, inside JVM higher-order functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def scale(vector: Column, divisor: float = 255.0) -> Column:
    return F.transform(as_doubles(vector), lambda x: x / F.lit(divisor))


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def mean(vector: Column) -> Column:
    return total(as_doubles(vector)) / F.nullif(F.size(vector).cast("double"), F.lit(0.0))


def std(vector: Column) -> Column:
    """Population standard deviation in one pass over the values.

    Count, running mean and squared distance are carried together (sum of squares would cancel).
    """

    def add(state: Column, x: Column) -> Column:
        n = state["n"] + 1.0
        step = x - state["mean"]
        centre = state["mean"] + step / n
        return F.struct(n.alias("n"), centre.alias("mean"), (state["m2"] + step * (x - centre)).alias("m2"))

    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(as_doubles(vector), start, add, lambda s: F.sqrt(s["m2"] / F.nullif(s["n"], F.lit(0.0))))


def logistic_score(vector: Column, weights: Sequence[float], bias: float) -> Column:
    """1 / (1 + exp(-(w.x + b))) for a vector column."""
    w = F.array(*[F.lit(float(v)) for v in weights])
    products = F.zip_with(as_doubles(vector), w, lambda x, y: x * y)
    return 1.0 / (1.0 + F.exp(-(total(products) + F.lit(float(bias)))))
