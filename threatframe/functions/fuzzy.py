"""Fuzzy membership on columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threatframe.config import FUZZY_LEVELS


def membership(value: Column, low: float, high: float, shape: str = "trapezoid") -> Column:
    """Membership grade. ``trapezoid`` is a rising ramp: 0 up to ``low``, 1 from ``high`` on."""
    middle = (low + high) / 2
    if shape == "trapezoid":
        return (
            F.when(value <= low, F.lit(0.0))
            .when(value >= high, F.lit(1.0))
            .otherwise((value - low) / (high - low))
        )
    if shape == "triangle":
        return (
            F.when((value <= low) | (value >= high), F.lit(0.0))
            .when(value <= middle, (value - low) / (middle - low))
            .otherwise((high - value) / (high - middle))
        )
    if shape == "gaussian":
        distance = (value - middle) / ((high - low) / 4)
        return F.exp(-0.5 * distance * distance)
    return F.lit(0.0)


def fuzzy_and(grades: Column) -> Column:
    return F.coalesce(F.array_min(grades), F.lit(0.0))


def fuzzy_or(grades: Column) -> Column:
    return F.coalesce(F.array_max(grades), F.lit(0.0))


def fuzzy_not(grade: Column) -> Column:
    return 1 - grade


def linguistic(value: Column, categories: dict[str, tuple[float, float]] = FUZZY_LEVELS) -> Column:
    """One membership per named category, as a struct."""
    return F.struct(*[membership(value, low, high).alias(name) for name, (low, high) in categories.items()])
