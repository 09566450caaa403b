"""Events, anomalies and knowledge as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threatframe.functions import scoring
from threatframe.operators.typing import calendar
from threatframe.sources.common import EVENT_SCHEMA

EVIDENCE = ("array<struct<rule_id: string, rule_name: string, description: string, certainty: double, "
            "matched_facts: array<string>, contributing_attributes: map<string,string>>>")
ANOMALY_SCHEMA = (
    "anomaly_id string, anomaly_type string, detected_at timestamp, detection_layer string, threat_level string, "
    "threat_score double, certainty double, affected_users array<string>, source_ips array<string>, "
    f"affected_systems array<string>, evidence {EVIDENCE}, explanation string, recommendation string, "
    "triggered_rules array<string>, first_occurrence timestamp, last_occurrence timestamp, duration_seconds double, n_members bigint")


def result_rows(anomalies: DataFrame, detected_at: Column | None = None) -> DataFrame:
    """Anomalies as they are stored: score with 2, certainty with 3 decimals, level by name."""
    rounded = F.transform("evidence", lambda e: e.withField("certainty", F.round(e["certainty"], 3)))
    return anomalies.select(
        "anomaly_id", "anomaly_type", (F.current_timestamp() if detected_at is None else detected_at).alias("detected_at"),
        "detection_layer", scoring.level_name(F.col("threat_level")).alias("threat_level"), F.round("threat_score", 2).alias("threat_score"),
        F.round("certainty", 3).alias("certainty"), "affected_users", "source_ips", F.array().cast("array<string>").alias("affected_systems"),
        rounded.alias("evidence"), "explanation", "recommendation", "triggered_rules", "first_occurrence", "last_occurrence",
        "duration_seconds", "n_members")


def write_anomalies(anomalies: DataFrame, path: str, format: str = "json", mode: str = "errorifexists") -> None:
    """Store anomalies, partitioned by detection layer."""
    result_rows(anomalies).write.mode(mode).partitionBy("detection_layer").format(format).save(path)


def read_anomalies(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    """Stored anomalies with defaults for what is missing; the level as a number again."""
    rows = spark.read.schema(ANOMALY_SCHEMA).format(format).load(path)
    texts = {"anomaly_type": "unknown", "detection_layer": "", "explanation": "", "recommendation": ""}
    rows = rows.fillna(texts).fillna({"threat_score": 0.0, "certainty": 0.0}).withColumn(
        "threat_level", F.coalesce(scoring.level_number(F.col("threat_level")), F.lit(1)))
    for name in ("affected_users", "source_ips", "affected_systems", "triggered_rules"):
        rows = rows.withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return rows.withColumn("evidence", F.coalesce("evidence", F.array().cast(EVIDENCE)))


def find_anomaly(anomalies: DataFrame, anomaly_id: str) -> DataFrame:
    return anomalies.filter(F.col("anomaly_id") == anomaly_id)


def write_events(events: DataFrame, path: str, format: str = "parquet", mode: str = "errorifexists") -> None:
    """Store events by day; XML is written with one ``Log`` element per event."""
    if format == "xml":
        pairs = F.transform(F.map_entries("attributes"), lambda e: F.struct(e["key"].alias("_name"), e["value"].alias("_VALUE")))
        shaped = events.select(
            F.col("event_id").alias("EventID"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("Timestamp"),
            F.coalesce("source_ip", F.lit("")).alias("SourceIP"), F.coalesce("user_id", F.lit("")).alias("UserID"),
            F.coalesce("service", F.lit("")).alias("Service"), F.col("event_type").alias("EventType"),
            F.struct(pairs.alias("Attribute")).alias("Attributes"))
        shaped.write.mode(mode).option("rootTag", "Logs").option("rowTag", "Log").xml(path)
        return
    rows = events.withColumn("time_features", calendar(F.col("ts")))
    if format == "json":
        rows.write.mode(mode).json(path)
    else:
        rows.withColumn("event_date", F.to_date("ts")).write.mode(mode).partitionBy("event_date").format(format).save(path)


def read_events(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    if format == "json":
        return spark.read.schema(EVENT_SCHEMA).json(path)
    return spark.read.format(format).load(path)


def write_knowledge(spark: SparkSession, path: str, rules=None, mode: str = "errorifexists") -> None:
    """Store graph and rules as four JSON tables."""
    from threatframe.config import RULES
    from threatframe.operators import graph, rules as rule_ops

    rules = RULES if rules is None else rules
    for name, table in {"nodes": graph.nodes(spark), "edges": graph.edges(spark), "rules": rule_ops.rules_table(spark, rules),
                        "conditions": rule_ops.conditions_table(spark, rules)}.items():
        table.coalesce(1).write.mode(mode).json(f"{path}/{name}")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    from threatframe.operators.graph import EDGE_SCHEMA, NODE_SCHEMA

    return spark.read.schema(NODE_SCHEMA).json(f"{path}/nodes"), spark.read.schema(EDGE_SCHEMA).json(f"{path}/edges")
