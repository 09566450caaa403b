"""Certainty-factor algebra on columns (values run from -1 to 1)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def combine(a: Column, b: Column) -> Column:
    """Two factors into one; an unknown (null) side leaves the other unchanged."""
    mixed_base = 1 - F.least(F.abs(a), F.abs(b))
    return (
        F.when(a.isNull(), b)
        .when(b.isNull(), a)
        .when((a >= 0) & (b >= 0), a + b * (1 - a))
        .when((a < 0) & (b < 0), a + b * (1 + a))
        .when(mixed_base == 0, F.lit(0.0))
        .otherwise((a + b) / mixed_base)
    )


def combine_array(factors: Column) -> Column:
    """Fold an array of factors from left to right; an empty array gives 0.

    Mixed signs make the fold depend on order, so callers sort the array first.
    """
    folded = F.aggregate(factors, F.lit(None).cast("double"), combine)
    return F.coalesce(folded, F.lit(0.0))


def noisy_or(factor: Column) -> Column:
    """Aggregate: combination of non-negative factors, independent of order and mergeable map-side."""
    return F.coalesce(1 - F.product(1 - factor), F.lit(0.0))


def combine_group(factor: Column) -> Column:
    """Aggregate for factors of any sign, in any order; combined map-side, no array.

    With f(x) = -ln(1 - x) for x >= 0 and ln(1 + x) below, combining is adding: f(combine(a, b)) = f(a) + f(b).
    The ends 1 and -1 win over anything between them. Only with both of them in a group does the fold
    depend on order; such a group is undecided and gives 0. Nulls are left out; no factor gives 0.
    """
    sure = F.count_if(factor >= 1)
    never = F.count_if(factor <= -1)
    inner = F.when(F.abs(factor) < 1, F.when(factor >= 0, -F.log1p(-factor)).otherwise(F.log1p(factor)))
    total = F.coalesce(F.sum(inner), F.lit(0.0))
    back = F.when(total >= 0, -F.expm1(-total)).otherwise(F.expm1(total))
    return F.when((sure > 0) & (never > 0), F.lit(0.0)).when(sure > 0, F.lit(1.0)).when(never > 0, F.lit(-1.0)).otherwise(back)


def sequential(rule: Column, evidence: Column) -> Column:
    """Factor of a conclusion: rule factor times evidence factor."""
    return rule * evidence


def weighted(factor: Column, weight: Column) -> Column:
    """Aggregate: weighted mean kept within -1 and 1; 0 without weight."""
    total = F.sum(weight)
    mean = F.sum(factor * weight) / F.nullif(total, F.lit(0.0))
    return F.coalesce(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), mean)), F.lit(0.0))


def to_probability(factor: Column, prior: float = 0.5) -> Column:
    if prior == 0.5:
        return (factor + 1) / 2
    odds = (prior / (1 - prior)) * (1 + factor) / F.nullif(1 - factor, F.lit(0.0))
    return F.when(factor == 1, F.lit(1.0)).otherwise(odds / (1 + odds))


def from_probability(probability: Column, prior: float = 0.5) -> Column:
    ratio = (probability / F.nullif(1 - probability, F.lit(0.0))) / (prior / (1 - prior))
    return (
        F.when(probability == 1, F.lit(1.0))
        .when(probability == 0, F.lit(-1.0))
        .otherwise((ratio - 1) / (ratio + 1))
    )


def clamp(value: Column, low: float, high: float) -> Column:
    """Value kept inside [low, high]; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def from_measures(belief: Column, disbelief: Column) -> Column:
    return clamp(belief, 0.0, 1.0) - clamp(disbelief, 0.0, 1.0)


def from_value(value: Column) -> Column:
    """Belief and disbelief of one signed value, each kept within 0 and 1."""
    belief = F.when(value >= 0, clamp(value, 0.0, 1.0)).otherwise(F.lit(0.0))
    disbelief = F.when(value < 0, clamp(-value, 0.0, 1.0)).otherwise(F.lit(0.0))
    return F.struct(belief.alias("belief"), disbelief.alias("disbelief"),
                    (belief - disbelief).alias("cf"))


def meets(factor: Column, threshold: float = 0.5) -> Column:
    return factor >= threshold


def is_definite(factor: Column) -> Column:
    return F.abs(factor) > 0.9


def is_unknown(factor: Column) -> Column:
    return F.abs(factor) < 0.1
