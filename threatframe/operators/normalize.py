"""Bringing events of all formats to the same fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threatframe.config import FIELD_MAPPINGS
from threatframe.operators.typing import calendar, category, severity, severity_enum
from threatframe.sources.common import text_timestamp


def source_family(source_format: Column) -> Column:
    return (F.when(source_format.startswith("json"), "json").when(source_format.startswith("xml"), "xml")
            .when(source_format.contains("syslog"), "syslog").otherwise("json"))


def mapped(field: str, lower: Column, family: Column) -> Column:
    """First value among the names a source family uses for a standard field."""
    def first(name):
        names = FIELD_MAPPINGS[name].get(field)
        return F.coalesce(*[lower[n.lower()] for n in names]) if names else F.lit(None).cast("string")

    return F.when(family == "xml", first("xml")).when(family == "syslog", first("syslog")).otherwise(first("json"))


def normalize(events: DataFrame) -> DataFrame:
    """Standard fields, severity, category. Values found at ingest are kept; names are matched without case."""
    rows = (events.withColumn("_lower", F.transform_keys("attributes", lambda k, v: F.lower(k)))
            .withColumn("_family", source_family(F.col("source_format"))))
    lower, family = F.col("_lower"), F.col("_family")
    for field in ("source_ip", "destination_ip", "user_id", "service", "message"):
        own = F.col(field) if field in events.columns else F.lit(None).cast("string")
        rows = rows.withColumn(field, F.coalesce(own, mapped(field, lower, family)))
    rows = rows.withColumn("ts", F.coalesce("ts", text_timestamp(mapped("timestamp", lower, family))))
    if "outcome" not in events.columns:
        rows = rows.withColumn("outcome", F.lit(None).cast("string"))
    rows = rows.withColumn("outcome", F.coalesce("outcome", lower["outcome"]))
    rows = rows.withColumn("event_type", F.coalesce("event_type", F.lit("unknown")))
    rows = rows.withColumn("severity", mapped("severity", lower, family)).withColumn(
        "severity_normalized", severity(F.col("severity")))
    return (rows.withColumn("severity_enum", severity_enum(F.col("severity_normalized")))
            .withColumn("event_category", category(F.col("event_type")))
            .withColumn("source_format", F.concat(F.lit("normalized_"), "source_format")).drop("_lower", "_family"))


def unified(events: DataFrame) -> DataFrame:
    """The unified record of normalised events."""
    c = calendar(F.col("ts"))
    return events.select(
        "event_id", F.col("ts").alias("timestamp"), "event_type", "event_category", F.col("severity_normalized").alias("severity"),
        "source_ip", "destination_ip", "user_id", "service", "message", (~c["is_business_hours"]).alias("is_off_hours"),
        c["is_weekend"].alias("is_weekend"), "attributes", c.alias("time_features"))


def get_attribute(name: str, default: str | None = None) -> Column:
    value = F.col("attributes")[name]
    return value if default is None else F.coalesce(value, F.lit(default))


def validate(events: DataFrame, constraints: dict[str, Column]) -> DataFrame:
    """Names of violated constraints per event; a constraint is a condition that must hold."""
    failed = F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in constraints.items()])
    return events.withColumn("violations", F.filter(failed, lambda n: n.isNotNull()))
