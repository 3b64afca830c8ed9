"""Rounding, limits and quantile picks."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int = 0) -> Column:
    """Round the scaled double to the nearest integer, ties to even."""
    scale = 10.0**digits
    return F.rint(value * scale) / scale if digits else F.rint(value)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def floor_or_null(value: Column, low: float) -> Column:
    """Lift small values to ``low`` and keep nulls, which ``greatest`` would skip."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low)))


def weibull_quantile(ordered: Column, fraction: Column) -> Column:
    """Quantile of an ascending array at plotting position ``(n + 1) p``.

    The rank is limited to ``[1, n]`` and neighbours are joined linearly; an empty
    array gives null.
    """
    size = F.size(ordered)
    rank = F.least(F.greatest((size + 1) * fraction, F.lit(1.0)), size.cast("double"))
    below = F.floor(rank).cast("int")
    lower = F.get(ordered, below - 1)
    upper = F.get(ordered, F.least(below + 1, size) - 1)
    return lower + (upper - lower) * (rank - below)
