"""The whole analysis as one lazily composed plan, and the jobs around it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from threatframe.config import RULES, SIGNATURES
from threatframe.operators import behavioral, facts, findings, merge, normalize, rules as rule_ops, signature, statistical
from threatframe.plans.demo import spread
from threatframe.session import cut_lineage, stage

LAYERS = ("signature", "statistical", "behavioral", "inference")


def find(events: DataFrame, layers: Iterable[str] = LAYERS, *, signatures=SIGNATURES, rules=RULES, peers: DataFrame | None = None,
         users: DataFrame | None = None, geo: DataFrame | None = None, lookback: int | None = None) -> DataFrame:
    """Findings of the chosen layers on normalised events."""
    chosen = set(layers)
    unknown = chosen - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    found = []
    deviations = z_scores = None
    if chosen & {"behavioral", "inference"}:
        slim = events.select("event_id", "ts", "user_id", "source_ip", "service", "event_type")
        # written once: the behavioural layer and the rules both read it
        deviations = cut_lineage(behavioral.prequential_deviations(slim))
    if chosen & {"inference"}:
        z_scores = statistical.payload_scores(events)
    if "signature" in chosen:
        found.append(signature.detect(events, signatures))
    if "statistical" in chosen:
        found.append(statistical.detect(events))
    if "behavioral" in chosen:
        found.append(behavioral.deviation_findings(deviations))
        found.append(behavioral.sequence_findings(slim, lookback=lookback))
        if peers is not None:
            found.append(behavioral.peer_findings(slim, slim, peers))
    if "inference" in chosen:
        found.append(rule_ops.detect(events, rules, users, geo, deviations, z_scores))
    return findings.union(found)


def conclude(found: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Findings merged per entity, scored, adjusted for history and for missing data."""
    anomalies = merge.rescore(merge.merge(found))
    if history is not None:
        anomalies = merge.with_history(anomalies, history)
    return merge.penalise_missing(anomalies)


def analyze(events: DataFrame, layers: Iterable[str] = LAYERS, *, history: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(anomalies, metrics) of a table of events.

    ``options`` are those of :func:`find`. The normalised events are read by every layer and the
    findings by two results, so both are written once to the shared folder; each layer then scans
    only the columns it needs, and a lost executor costs a scan, not the parsing.
    """
    ready = stage(normalize.normalize(events))
    layers = tuple(layers)
    found = stage(find(ready, layers, **options))
    # findings of a table are alike and packed well, so a split of it holds many
    anomalies = conclude(spread(found), history)
    return merge.ranked(anomalies), metrics(ready, found, anomalies, layers)


def metrics(events: DataFrame, found: DataFrame, anomalies: DataFrame, layers: Iterable[str]) -> DataFrame:
    """One row: events, facts, fired rules, anomalies, layers."""
    def number(df):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    return events.sparkSession.range(1).select(
        number(events).alias("processed_events"), number(facts.from_events(events)).alias("working_memory_facts"),
        number(found.filter("detection_layer = 'inference'")).alias("rules_fired"), number(anomalies).alias("anomaly_count"),
        F.lit(",".join(layers)).alias("detection_layers"))


def knowledge_status(spark: SparkSession, found: DataFrame, rules=RULES, signatures=SIGNATURES) -> DataFrame:
    """Rules and signatures with how often each one was hit, by kind and name."""
    known = rule_ops.rules_table(spark, rules).select(F.lit("rule").alias("kind"), "rule_id", F.col("category").alias("group_name")).unionByName(
        spark.createDataFrame([("signature", s.rule_id, s.anomaly_type) for s in signatures if s.enabled], "kind string, rule_id string, group_name string"))
    layer = F.when(F.col("detection_layer") == "inference", "rule").when(F.col("detection_layer") == "signature", "signature")
    hits = found.withColumn("kind", layer).filter("kind IS NOT NULL").groupBy("kind", "rule_id").agg(F.count(F.lit(1)).alias("hits"))
    return known.join(hits, ["kind", "rule_id"], "left").select("kind", "rule_id", "group_name", F.coalesce("hits", F.lit(0)).alias("hits"))
