"""Rounding that does not depend on row order or binary fractions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double half away from zero.

    Passing through a decimal first drops the last-bit noise that a distributed sum has,
    so the result is the same however the rows were partitioned.
    """
    return F.round(value.cast("decimal(28,9)"), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` of two counts, rounded half up in whole numbers; NULL for an empty whole."""
    scale = 10**digits
    part, whole = part.cast("long"), whole.cast("long")
    units = F.call_function("div", part * (200 * scale) + whole, whole * 2)
    return F.when(whole > 0, units.cast("double") / float(scale))
