"""The row every detection layer returns: one finding = one piece of evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threatframe.functions import scoring

COLUMNS = [
    "anomaly_type", "detection_layer", "event_id", "first_ts", "last_ts", "affected_users",
    "source_ips", "threat_level", "threat_score", "certainty", "rule_id", "rule_name",
    "description", "recommendation", "matched_facts", "attrs",
]


def as_array(value: Column) -> Column:
    """One entity as an array; empty when it is missing."""
    return F.filter(F.array(F.nullif(value, F.lit(""))), lambda v: v.isNotNull())


def no_entities() -> Column:
    return F.array().cast("array<string>")


def text_map(**values: Column) -> Column:
    """Contributing attributes as text; attributes without value are left out."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
                        for k, v in values.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def finding(anomaly_type, layer: str, level, certainty: Column, rule_id, rule_name, description,
            recommendation, attrs: Column, *, event_id: Column | None = None,
            users: Column | None = None, ips: Column | None = None, first_ts: Column | None = None,
            last_ts: Column | None = None, matched: Column | None = None) -> list[Column]:
    """Columns of a finding. Plain strings are taken as literals, ``level`` as its number."""
    def text(value):
        return value if isinstance(value, Column) else F.lit(value)

    level = level if isinstance(level, Column) else F.lit(level)
    event_id = event_id if event_id is not None else F.col("event_id")
    first_ts = first_ts if first_ts is not None else F.col("ts")
    certainty = certainty.cast("double")
    values = {
        "anomaly_type": text(anomaly_type),
        "detection_layer": F.lit(layer),
        "event_id": event_id,
        "first_ts": first_ts,
        "last_ts": last_ts if last_ts is not None else first_ts,
        "affected_users": users if users is not None else as_array(F.col("user_id")),
        "source_ips": ips if ips is not None else as_array(F.col("source_ip")),
        "threat_level": level.cast("int"),
        "threat_score": scoring.threat_score(level, certainty, F.lit(1)),
        "certainty": certainty,
        "rule_id": text(rule_id),
        "rule_name": text(rule_name),
        "description": text(description),
        "recommendation": text(recommendation),
        "matched_facts": matched if matched is not None else as_array(event_id),
        "attrs": attrs,
    }
    return [values[name].alias(name) for name in COLUMNS]


def union(layers: list[DataFrame]) -> DataFrame:
    """Findings of all layers in one DataFrame."""
    result = layers[0].select(*COLUMNS)
    for layer in layers[1:]:
        result = result.unionByName(layer.select(*COLUMNS))
    return result
