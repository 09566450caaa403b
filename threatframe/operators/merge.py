"""Merging findings per entity, scoring the result, history, missing data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threatframe.config import LAYER_WEIGHTS
from threatframe.functions import certainty, scoring, text
from threatframe.functions.scoring import lookup

GROUP = ["anomaly_type", "affected_users", "source_ips"]
LAYER_ORDER = {"signature": 0, "statistical": 1, "behavioral": 2, "inference": 3}


def anomaly_id(*key: Column) -> Column:
    """Short id from the group key, so the same input gives the same id."""
    parts = [F.array_join(k, ",") if name != "anomaly_type" else k for name, k in zip(GROUP, key)]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def keyed(findings: DataFrame) -> DataFrame:
    """Findings with sorted entity lists and the id of the anomaly they belong to."""
    ready = (findings.withColumn("affected_users", F.array_sort(F.array_distinct("affected_users")))
             .withColumn("source_ips", F.array_sort(F.array_distinct("source_ips"))))
    return ready.withColumn("anomaly_id", anomaly_id(*[F.col(c) for c in GROUP]))


def merge(findings: DataFrame, weights: dict[str, float] | None = LAYER_WEIGHTS) -> DataFrame:
    """One anomaly per (type, users, addresses).

    A group of one finding keeps its layer, score and text. A larger group becomes a ``meta``
    anomaly: evidence is the first per (layer, rule), certainty the combination of all members,
    score the weighted sum over the sum of weights (the maximum without weights).

    Two aggregations: the first leaves one row per (anomaly, layer, rule) and is combined
    map-side, so the second, which builds the evidence array, sees at most one row per rule.
    The member events stay a table of their own, see :func:`members`.
    """
    return finish(partials(findings, weights), weights)


def partials(findings: DataFrame, weights: dict[str, float] | None = LAYER_WEIGHTS) -> DataFrame:
    """First aggregation: one row per (anomaly, layer, rule)."""
    weight = lookup(F.col("detection_layer"), weights, 1.0) if weights else F.lit(1.0)
    evidence = F.struct("rule_name", "description", "certainty", "matched_facts", "attrs", "recommendation",
                        "threat_level", "threat_score")
    first_key = F.struct(F.col("first_ts"), F.col("event_id"), F.col("description"))
    return keyed(findings).groupBy("anomaly_id", *GROUP, "detection_layer", "rule_id").agg(
        F.min_by(evidence, first_key).alias("ev"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("threat_score") * weight).alias("weighted"),
        F.max("threat_score").alias("top"),
        F.product(1 - F.col("certainty")).alias("doubt"),
        F.max("threat_level").alias("level"),
        F.min("first_ts").alias("first_ts"),
        F.min(first_key).alias("place"),
        F.max("last_ts").alias("last_ts"))


def combine_partials(rows: DataFrame) -> DataFrame:
    """Rows of several first aggregations, such as those of micro-batches, as one would have them."""
    return rows.groupBy("anomaly_id", *GROUP, "detection_layer", "rule_id").agg(
        F.min_by("ev", "place").alias("ev"), F.sum("n").alias("n"), F.sum("weighted").alias("weighted"), F.max("top").alias("top"),
        F.product("doubt").alias("doubt"), F.max("level").alias("level"), F.min("first_ts").alias("first_ts"),
        F.min("place").alias("place"), F.max("last_ts").alias("last_ts"))


def finish(per_rule: DataFrame, weights: dict[str, float] | None = LAYER_WEIGHTS) -> DataFrame:
    """Second aggregation: anomalies from rows per rule."""
    order = lookup(F.col("detection_layer"), LAYER_ORDER, 9)
    # evidence in the order layer, time, event; the map is kept out of the sorted part
    position = F.struct(order.alias("layer_order"), "place", "rule_id", "detection_layer")
    # dealt by the id alone, so that what follows by id (conflicts, steps as text) needs no other shuffle
    groups = per_rule.repartition("anomaly_id").groupBy("anomaly_id", *GROUP).agg(
        F.sum("n").alias("n_members"),
        F.sum("weighted").alias("weighted"),
        F.max("top").alias("top"),
        F.product("doubt").alias("doubt"),
        F.max("level").alias("max_threat_level"),
        F.min("first_ts").alias("first_occurrence"),
        F.max("last_ts").alias("last_occurrence"),
        F.collect_list(F.struct(position.alias("position"), "ev")).alias("ev"),
        F.array_sort(F.collect_set("rule_id")).alias("triggered_rules"))
    groups = groups.withColumn("ev", F.array_sort(
        "ev", lambda a, b: F.when(a["position"] < b["position"], -1).when(a["position"] > b["position"], 1).otherwise(0)))
    single = F.col("n_members") == 1
    only, only_layer = F.col("ev")[0]["ev"], F.col("ev")[0]["position"]["detection_layer"]
    merged_score = F.col("weighted") / sum(weights.values()) if weights else F.col("top")
    out = groups.select(
        "anomaly_id", "anomaly_type",
        F.when(single, only_layer).otherwise("meta").alias("detection_layer"),
        "affected_users", "source_ips", "n_members", "max_threat_level",
        F.when(single, only["threat_level"]).otherwise(1).alias("threat_level"),
        F.when(single, only["threat_score"]).otherwise(merged_score).alias("threat_score"),
        F.when(single, only["certainty"]).otherwise(1 - F.col("doubt")).alias("certainty"),
        F.transform("ev", lambda e: F.struct(
            e["position"]["rule_id"].alias("rule_id"), e["ev"]["rule_name"].alias("rule_name"),
            e["ev"]["description"].alias("description"), e["ev"]["certainty"].alias("certainty"),
            e["ev"]["matched_facts"].alias("matched_facts"),
            e["ev"]["attrs"].alias("contributing_attributes"))).alias("evidence"),
        F.when(single, only["recommendation"]).otherwise("").alias("recommendation"),
        "first_occurrence", "last_occurrence",
        ((F.unix_micros("last_occurrence") - F.unix_micros("first_occurrence")) / 1e6).alias("duration_seconds"),
        "triggered_rules")
    return out.withColumn("explanation", F.when(F.col("detection_layer") == "meta", meta_text())
                          .otherwise(finding_text()))


def members(findings: DataFrame) -> DataFrame:
    """Which finding went into which anomaly: one row per member, however large the anomaly."""
    return keyed(findings).select("anomaly_id", "event_id", "detection_layer", "rule_id", "first_ts")


def meta_text() -> Column:
    """Text of a merged anomaly."""
    return text.lines(
        F.concat(F.lit("Aggregated Anomaly: "), "anomaly_type"),
        F.concat(F.lit("Sources: "), F.col("n_members").cast("string"), F.lit(" detection layers")),
        F.concat(F.lit("Combined Certainty: "), text.percent(F.col("certainty"))),
        F.concat(F.lit("Evidence Count: "), F.size("evidence").cast("string")))


def finding_text() -> Column:
    """Full text of one anomaly with its evidence."""
    body = F.transform("evidence", lambda e, i: F.concat(
        F.lit("  "), (i + 1).cast("string"), F.lit(". "), e["rule_name"], F.lit(" (CF: "),
        text.percent(e["certainty"]), F.lit(")\n     "), e["description"]))
    return text.lines(
        F.concat(F.lit("ANOMALY DETECTED: "), text.title(F.col("anomaly_type"))),
        F.concat(F.lit("Threat Level: "), scoring.level_name(F.col("threat_level")), F.lit(" (Score: "),
                 text.fixed(F.col("threat_score")), F.lit("/100)")),
        F.concat(F.lit("Certainty: "), text.percent(F.col("certainty"))),
        F.lit(""),
        F.concat(F.lit("Detection Method: "), text.title(F.col("detection_layer"))),
        F.concat(F.lit("Affected Users: "), text.listed(F.col("affected_users"))),
        F.concat(F.lit("Source IPs: "), text.listed(F.col("source_ips"))),
        F.lit(""),
        F.lit("Evidence:"),
        F.array_join(body, "\n"),
        F.when(F.col("recommendation") != "", F.concat(F.lit("\nRecommendation: "), "recommendation")))


def evidence_certainties() -> Column:
    return F.transform("evidence", lambda e: e["certainty"])


def rescore(anomalies: DataFrame, has_conflict: Column | None = None, critical_asset: Column | None = None) -> DataFrame:
    """Composite score from the combined evidence; indicator count is the number of evidence rows."""
    combined = F.when(F.size("evidence") > 0, certainty.combine_array(evidence_certainties()))
    return anomalies.withColumn("threat_score", scoring.composite_score(
        F.col("threat_score"), combined, F.size("evidence"), has_conflict, critical_asset))


def penalise_missing(anomalies: DataFrame, missing: Column | None = None) -> DataFrame:
    """Lower certainty for absent fields and say so in the text."""
    if missing is None:
        missing = scoring.missing_fields({"user_id": F.size("affected_users") > 0,
                                          "source_ip": F.size("source_ips") > 0})
    ready = anomalies.withColumn("missing_fields", missing).withColumn(
        "_after", F.col("certainty") * (1 - scoring.missing_penalty(F.col("missing_fields"))))
    note = F.concat(
        F.lit("\n\nNote: Analysis based on incomplete data. Missing fields: "),
        F.array_join("missing_fields", ", "), F.lit(". Certainty adjusted from "),
        text.percent(F.col("certainty")), F.lit(" to "), text.percent(F.col("_after")), F.lit("."))
    return (ready.withColumn("explanation", F.when(F.size("missing_fields") > 0, F.concat("explanation", note))
                             .otherwise(F.col("explanation")))
            .withColumn("certainty", F.col("_after")).drop("_after"))


def with_history(anomalies: DataFrame, history: DataFrame) -> DataFrame:
    """Certainty and text adjusted by how often the type occurred before (``anomaly_type`` rows)."""
    before = history.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("similar_count"))
    any_history = F.coalesce(history.select(F.lit(True).alias("x")).limit(1).scalar(), F.lit(False))
    n = F.coalesce(F.col("similar_count"), F.lit(0))
    boosted = F.least(F.lit(1.0), F.col("certainty") + F.least(F.lit(0.15), n * 0.02))
    note = F.when(~any_history, "").when(n >= 5, F.concat(
        F.lit("\n\nTemporal Analysis: This is the "), n.cast("string"),
        F.lit("th occurrence of this anomaly type, indicating a pattern."))).when(
        n == 0, "\n\nTemporal Analysis: First occurrence of this anomaly type.").otherwise("")
    return (anomalies.join(before, "anomaly_type", "left")
            .withColumn("explanation", F.concat("explanation", note))
            .withColumn("certainty", F.when(n >= 5, boosted).otherwise(F.col("certainty")))
            .withColumn("similar_count", n))


def evidence_rows(anomalies: DataFrame) -> DataFrame:
    """One row per piece of evidence."""
    return anomalies.select("anomaly_id", "anomaly_type", F.posexplode("evidence").alias("position", "e")).select(
        "anomaly_id", "anomaly_type", "position", "e.*")


def split_conflicts(evidence: DataFrame, key: str = "anomaly_id") -> DataFrame:
    """Evidence at or above the mean certainty of its anomaly supports it, the rest conflicts."""
    mean = F.avg("certainty").over(Window.partitionBy(key))
    # the mean of equal values may differ from them in the last bit
    return evidence.withColumn("mean_certainty", mean).withColumn(
        "is_supporting", F.col("certainty") >= F.col("mean_certainty") - 1e-12)


def uncertainty_report(anomalies: DataFrame) -> DataFrame:
    """Fuzzy threat levels, evidence statistics and confidence band per anomaly."""
    from threatframe.functions.fuzzy import linguistic

    values = evidence_certainties()
    n = F.size("evidence")
    total = F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    return anomalies.select(
        "anomaly_id", "certainty", linguistic(F.col("threat_score")).alias("levels"),
        n.alias("evidence_count"),
        F.when(n > 0, total / n).otherwise(0.0).alias("avg_certainty"),
        F.coalesce(F.array_min(values), F.lit(0.0)).alias("min_certainty"),
        F.coalesce(F.array_max(values), F.lit(0.0)).alias("max_certainty"),
        scoring.confidence_band(F.col("certainty")).alias("confidence_level"))


def dominant_type(findings: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent anomaly type per key; the alphabetically first among equals."""
    counts = findings.groupBy(*keys, "anomaly_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(
        F.min_by("anomaly_type", F.struct((-F.col("n")).alias("n"), "anomaly_type")).alias("anomaly_type"),
        F.max("n").alias("n"))


def ranked(anomalies: DataFrame) -> DataFrame:
    return anomalies.orderBy(F.desc("threat_score"), "anomaly_id")


def top(anomalies: DataFrame, n: int = 10) -> DataFrame:
    """The n highest scores and how many anomalies are left out."""
    return (ranked(anomalies).limit(n)
            .withColumn("more", F.greatest(anomalies.agg(F.count(F.lit(1)).alias("n")).scalar() - n, F.lit(0))))
