"""Rounding, ratios and sums that come out the same on every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round the scaled double to the nearest integer, ties to even (numpy's rule)."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def half_away(value: Column, digits: int) -> Column:
    """Round the scaled double, ties away from zero (SQL ``ROUND`` on doubles)."""
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; null where ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def count_where(predicate: Column) -> Column:
    return F.coalesce(F.count_if(predicate), F.lit(0))


def rate(predicate: Column) -> Column:
    """Share of a group's rows for which the predicate holds."""
    return count_where(predicate).cast("double") / F.count(F.lit(1))


def exact_mean(value: Column) -> Column:
    """Mean of doubles below 1e10 in size, summed as decimals of 18 places.

    Decimal sums do not depend on the order in which shuffle blocks arrive, so a
    retried or re-planned job gives the same bits. Eighteen places hold every
    digit in which a double below one prints.
    """
    total = F.sum(value.cast("decimal(28,18)"))
    return total.cast("double") / F.count(value)


def tanh_saturation(count: Column, scale: float = 3.0) -> Column:
    """0 at zero, nearing 1 as the count grows past ``scale``."""
    return F.tanh(count / F.lit(scale))


def capped(value: Column, top: float) -> Column:
    """Upper clip that keeps nulls (``least`` would turn a null into ``top``)."""
    return F.when(value > F.lit(top), F.lit(top)).otherwise(value)
