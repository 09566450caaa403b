"""Threat scores, confidence bands and other per-row arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threatframe.config import MISSING_FIELD_WEIGHTS, THREAT_LEVELS


def level_number(name: Column) -> Column:
    return lookup(name, THREAT_LEVELS)


def level_name(number: Column) -> Column:
    return lookup(number, {v: k for k, v in THREAT_LEVELS.items()})


def lookup(value: Column, table: dict, default=None) -> Column:
    """Value of a small fixed table as a CASE expression."""
    result = None
    for key, out in table.items():
        result = F.when(value == key, F.lit(out)) if result is None else result.when(value == key, F.lit(out))
    return result.otherwise(F.lit(default)) if default is not None else result


def z_score(value: Column, mean: Column, std: Column) -> Column:
    return F.when(std == 0, F.lit(0.0)).otherwise((value - mean) / std)


def threat_score(level: Column, certainty: Column, evidence_count: Column) -> Column:
    """Score of one anomaly: 20 points per level weighted by certainty, 5 per piece of evidence."""
    return F.least(F.lit(100.0), level * 20 * certainty + F.least(evidence_count * 5, F.lit(20)))


def composite_score(score: Column, combined: Column, indicators: Column | None = None,
                    conflicting: Column | None = None, critical_asset: Column | None = None) -> Column:
    """Score adjusted by combined certainty and context, at most 100.

    ``combined`` is null for an anomaly without evidence, which then keeps its score.
    """
    adjusted = F.when(combined.isNull(), score).otherwise(score * (0.5 + 0.5 * combined))
    if indicators is not None:
        adjusted = F.when(indicators > 2, adjusted * (1 + 0.1 * F.least(indicators - 2, F.lit(3)))).otherwise(adjusted)
    if conflicting is not None:
        adjusted = F.when(conflicting, adjusted * 0.8).otherwise(adjusted)
    if critical_asset is not None:
        adjusted = F.when(critical_asset, adjusted * 1.2).otherwise(adjusted)
    return F.least(F.lit(100.0), adjusted)


def confidence_band(certainty: Column) -> Column:
    return (
        F.when(certainty >= 0.9, "very_high")
        .when(certainty >= 0.75, "high")
        .when(certainty >= 0.5, "medium")
        .when(certainty >= 0.25, "low")
        .otherwise("very_low")
    )


def missing_fields(present: dict[str, Column]) -> Column:
    """Names of absent fields; ``present`` maps a field to "is there" conditions, in report order."""
    names = F.array(*[F.when(~there, F.lit(name)) for name, there in present.items()])
    return F.filter(names, lambda n: n.isNotNull())


def missing_penalty(missing: Column) -> Column:
    """Share of certainty lost to absent fields, at most one half."""
    weights = F.transform(missing, lambda n: lookup(n, MISSING_FIELD_WEIGHTS, 0.05))
    return F.least(F.lit(0.5), F.aggregate(weights, F.lit(0.0), lambda total, w: total + w))
