"""Windowed detection on streams, with built-in state only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threatframe.operators import features, merge, rules, signature
from threatframe.config import RULES, SESSION_SECONDS, Rule

DELAY = "10 minutes"


def signatures(events: DataFrame) -> DataFrame:
    """Signature findings; no state."""
    return signature.detect(events)


def without_duplicates(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """First event per id within the watermark delay."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def login_windows(events: DataFrame, seconds: int = 300, slide: int | None = None, delay: str = DELAY) -> DataFrame:
    """Facts of the login rules per address and window; rows later than the delay are dropped.

    Two chained aggregations: per user first, so users are counted exactly and a hot address is
    spread over its users.
    """
    logins = events.filter("event_type = 'authentication' AND source_ip IS NOT NULL").withWatermark("ts", delay)
    window = F.window("ts", f"{seconds} seconds", f"{slide or seconds} seconds").alias("window")
    per_user = logins.groupBy(window, "source_ip", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("outcome") == "failure").alias("failed"),
        F.count_if(F.col("outcome") == "success").alias("succeeded"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    frame = per_user.groupBy("window", "source_ip").agg(
        F.sum("n").alias("n_logins"), F.sum("failed").alias("aggregated__failed_login_count"),
        (F.sum("succeeded") / F.sum("n")).alias("aggregated__success_rate"), F.count("user_id").alias("aggregated__unique_usernames"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    span = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6
    return frame.select("*", span.alias("aggregated__time_window_seconds"),
                        (F.col("n_logins") / F.greatest(span, F.lit(1.0))).alias("aggregated__event_rate_per_second"))


def flood_windows(events: DataFrame, seconds: int = 60, slide: int | None = None, delay: str = DELAY) -> DataFrame:
    """Facts of the flood rule per destination and window."""
    rows = events.filter("event_type = 'network_connection' AND destination_ip IS NOT NULL").withWatermark("ts", delay)
    window = F.window("ts", f"{seconds} seconds", f"{slide or seconds} seconds").alias("window")
    per_source = rows.groupBy(window, "destination_ip", "source_ip").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    frame = per_source.groupBy("window", "destination_ip").agg(
        F.sum("n").alias("aggregated__connection_count"), F.count("source_ip").alias("aggregated__unique_source_ips"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    return frame.withColumn("aggregated__time_window_seconds", (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6)


def scan_windows(events: DataFrame, port, seconds: int = 300, slide: int | None = None, delay: str = DELAY) -> DataFrame:
    """Facts of the port scan rule per source address and window."""
    rows = events.filter(F.col("source_ip").isNotNull() & port.isNotNull()).withWatermark("ts", delay).withColumn("_port", port)
    window = F.window("ts", f"{seconds} seconds", f"{slide or seconds} seconds").alias("window")
    per_port = rows.groupBy(window, "source_ip", "_port").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    frame = per_port.groupBy("window", "source_ip").agg(
        F.count("_port").alias("aggregated__unique_destination_ports"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    return (frame.withColumn("aggregated__time_window_seconds", (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6)
            .withColumn("aggregated__source_ip", F.lit("single")))


def rule_findings(frame: DataFrame, rule_ids: list[str], all_rules: list[Rule] = RULES) -> DataFrame:
    """Findings of the named rules on a windowed frame."""
    return rules.rule_hits(frame, [r for r in all_rules if r.rule_id in rule_ids])


def frequency_windows(events: DataFrame, key: str, seconds: int = 300, slide: int = 60, delay: str = DELAY) -> DataFrame:
    """Frequency features per key in sliding windows; distinct numbers are estimates (HyperLogLog)."""
    rows = events.filter(F.col(key).isNotNull()).withWatermark("ts", delay)
    frame = rows.groupBy(F.window("ts", f"{seconds} seconds", f"{slide} seconds").alias("window"), key).agg(
        F.count(F.lit(1)).alias("event_count"), F.approx_count_distinct("user_id").alias("unique_users"),
        F.approx_count_distinct("source_ip").alias("unique_ips"), F.approx_count_distinct("service").alias("unique_services"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    span = F.unix_micros("last_ts") - F.unix_micros("first_ts")
    return frame.select(key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_count",
                        features.events_per_minute(F.col("event_count"), span).alias("events_per_minute"), "unique_users", "unique_ips", "unique_services")


def sessions(events: DataFrame, seconds: int = SESSION_SECONDS, delay: str = DELAY) -> DataFrame:
    return features.sessions(events.withWatermark("ts", delay), seconds)


def merge_each_batch(findings: DataFrame, out: str, checkpoint: str):
    """Store the mergeable rows (one per anomaly, layer and rule) of every micro-batch under its number.

    A batch that is retried overwrites its own folder, so each batch counts once. :func:`merged` finishes
    them: an anomaly seen in several batches is one row, with the score it has in a single batch.
    """
    def write(batch: DataFrame, number: int) -> None:
        merge.partials(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return findings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(partials: DataFrame) -> DataFrame:
    """Anomalies over the stored rows of all batches."""
    return merge.penalise_missing(merge.rescore(merge.finish(merge.combine_partials(partials.drop("batch")))))
