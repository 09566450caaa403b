"""Explanations in text: why, how, step by step, contradictions, summary."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from threatframe.functions import scoring, text

# Text per anomaly type; a type without entry, or with a missing value, gets another text
WHY_TEMPLATES = {
    "brute_force_attack": """
A brute force attack was detected because:
- {failed_count} failed login attempts were observed
- All attempts originated from the same source ({source_ip})
- The attempts occurred within a {time_window}-second window
- This pattern is characteristic of automated password guessing attacks.
""",
    "credential_stuffing": """
Credential stuffing was detected because:
- {failed_count} failed login attempts from {unique_users} different usernames
- Only {success_rate} of attempts were successful
- This pattern suggests use of leaked credential databases
- The attack is highly automated and distributed.
""",
    "impossible_travel": """
Impossible travel was detected because:
- User {user_id} logged in from {location1} and {location2}
- Time between logins: {time_diff} minutes
- Distance between locations: {distance} km
- Physical travel between these locations in this time is impossible.
""",
    "privilege_escalation": """
Unauthorized privilege escalation was detected because:
- User {user_id} with role '{user_role}' attempted elevation
- The action required privileges beyond their authorization level
- This may indicate account compromise or insider threat.
""",
    "data_exfiltration": """
Potential data exfiltration was detected because:
- {data_volume} MB of data was transferred
- Transfer occurred outside business hours ({timestamp})
- Direction: {direction}
- This pattern is consistent with data theft activity.
""",
}
DEFAULT_TEMPLATE = """
Anomaly detected: {anomaly_type}
Certainty: {certainty}
Evidence: {evidence_count} supporting indicators
Recommendation: {recommendation}
"""
# values used where no evidence tells more; a value without default sends the type to the generic text
DEFAULTS = {"failed_count": "0", "source_ip": "unknown", "time_window": "0", "unique_users": "0", "user_id": "unknown",
            "user_role": "unknown", "data_volume": "0", "timestamp": "unknown", "direction": "unknown"}
ATTRIBUTE_NAMES = {"time_diff": "time_between_logins_minutes", "distance": "distance_km"}


def _from_evidence(name: str) -> Column:
    """Value of an attribute in the last piece of evidence that has it."""
    values = F.filter(F.transform("evidence", lambda e: e["contributing_attributes"][name]), lambda v: v.isNotNull())
    return F.try_element_at(values, F.lit(-1))


def _value(name: str) -> Column:
    if name == "anomaly_type":
        return F.col("anomaly_type")
    if name == "certainty":
        return text.percent(F.col("certainty"))
    if name == "evidence_count":
        return F.size("evidence").cast("string")
    if name == "recommendation":
        return F.coalesce("recommendation", F.lit(""))
    if name == "success_rate":
        return text.percent(F.coalesce(_from_evidence(name).try_cast("double"), F.lit(0.0)))
    value = _from_evidence(ATTRIBUTE_NAMES.get(name, name))
    return F.coalesce(value, F.lit(DEFAULTS[name])) if name in DEFAULTS else value


def _filled(template: str) -> Column:
    parts = []
    for before, name, _, _ in string.Formatter().parse(template):
        parts.append(F.lit(before))
        if name:
            parts.append(_value(name))
    return F.concat(*parts)


def why() -> Column:
    """Why an anomaly was flagged, from the values in its evidence."""
    chain = None
    for kind, template in WHY_TEMPLATES.items():
        value = F.coalesce(_filled(template), generic())
        chain = F.when(F.col("anomaly_type") == kind, value) if chain is None else chain.when(F.col("anomaly_type") == kind, value)
    return chain.otherwise(_filled(DEFAULT_TEMPLATE))


def generic() -> Column:
    items = F.transform("evidence", lambda e, i: F.concat(
        F.lit("  "), (i + 1).cast("string"), F.lit(". "), e["rule_name"], F.lit("\n     "), e["description"]))
    return text.lines(
        F.concat(F.lit("ANOMALY: "), text.title(F.col("anomaly_type"))),
        F.concat(F.lit("Threat Level: "), scoring.level_name(F.col("threat_level"))),
        F.concat(F.lit("Certainty: "), text.percent(F.col("certainty"))),
        F.concat(F.lit("Threat Score: "), text.fixed(F.col("threat_score")), F.lit("/100")),
        F.lit(""), F.lit("Evidence:"), F.array_join(items, "\n"),
        F.when(F.col("recommendation") != "", F.concat(F.lit("\nRecommendation: "), "recommendation")))


def how() -> Column:
    """How the conclusion was reached: every rule with its factors, then the combination."""
    def one(e, i):
        attrs = F.transform(F.map_entries(e["contributing_attributes"]), lambda a: F.concat(
            F.lit("\n     - "), a["key"], F.lit(": "), F.coalesce(a["value"], F.lit("None"))))
        return F.concat(
            F.lit("\n"), (i + 1).cast("string"), F.lit(". Rule Applied: "), e["rule_name"],
            F.lit("\n   Rule ID: "), e["rule_id"], F.lit("\n   Description: "), e["description"],
            F.lit("\n   Certainty Factor: "), text.percent(e["certainty"]),
            F.lit("\n   Matched Facts: "), F.size(e["matched_facts"]).cast("string"),
            F.when(F.size(attrs) > 0, F.concat(F.lit("\n   Contributing Factors:"), F.array_join(attrs, ""))).otherwise(""))

    final = text.percent(F.col("certainty"))
    inputs = F.array_join(F.transform("evidence", lambda e: F.concat(F.lit("'"), text.percent(e["certainty"]), F.lit("'"))), ", ")
    several = F.concat(F.lit("  Multiple evidence sources combined using CF algebra:\n  Input CFs: ["), inputs,
                       F.lit("]\n  Combined CF: "), final)
    return F.concat(
        F.lit("How was '"), "anomaly_type", F.lit("' detected?\n\nInference Chain:\n"),
        F.array_join(F.transform("evidence", one), "\n"),
        F.when(F.size("evidence") > 0, "\n").otherwise(""), F.lit("\nCertainty Combination:\n"),
        F.when(F.size("evidence") == 1, F.concat(F.lit("  Final certainty = Rule CF × Evidence CF = "), final)).otherwise(several))


def reasoning_steps(anomalies: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Steps from observation to conclusion, one row each. ``facts`` holds (anomaly_id, fact_id)."""
    step_type = "struct<description:string,rule_id:string,facts:array<string>,certainty:double>"
    none = F.array().cast("array<string>")

    def step(description, rule_id, used, certainty):
        return F.struct(description.alias("description"), rule_id.cast("string").alias("rule_id"), used.alias("facts"),
                        certainty.cast("double").alias("certainty"))

    null = F.lit(None)
    observed = F.array(step(F.lit("Security events were observed and parsed from log sources."), null, none, F.lit(1.0)))
    extracted = F.array().cast(f"array<{step_type}>")
    if facts is not None:
        # the number by a count, the first five by a ranked filter: never the whole list
        ranked = facts.withColumn("_r", F.row_number().over(Window.partitionBy("anomaly_id").orderBy("fact_id"))).filter("_r <= 5")
        shown = ranked.groupBy("anomaly_id").agg(F.array_sort(F.collect_list("fact_id")).alias("_facts"))
        count = facts.groupBy("anomaly_id").agg(F.count(F.lit(1)).alias("_n_facts"))
        anomalies = anomalies.join(count, "anomaly_id", "left").join(shown, "anomaly_id", "left")
        extracted = F.when(F.col("_n_facts") > 0, F.array(step(
            F.concat(F.lit("Extracted "), F.col("_n_facts").cast("string"), F.lit(" relevant facts from events.")),
            null, F.col("_facts"), F.lit(0.95)))).otherwise(extracted)
    fired = F.transform("evidence", lambda e: step(
        F.concat(F.lit("Rule '"), e["rule_name"], F.lit("' matched: "), e["description"]), e["rule_id"], e["matched_facts"], e["certainty"]))
    combined = F.array(step(F.concat(F.lit("Combined evidence using certainty factor algebra to reach final certainty of "),
                                     text.percent(F.col("certainty")), F.lit(".")), null, none, F.col("certainty")))
    rows = anomalies.select("anomaly_id", "anomaly_type", "threat_level", F.col("certainty").alias("final_certainty"),
                            F.posexplode(F.concat(observed, extracted, fired, combined)).alias("_i", "s"))
    return rows.select("anomaly_id", "anomaly_type", "threat_level", "final_certainty", (F.col("_i") + 1).alias("step_number"), "s.*")


def fired_steps(fired: DataFrame) -> DataFrame:
    """Steps for fired rules (entity, rule_id, fact_ids, effective_cf, ts), numbered per entity by time."""
    order = Window.partitionBy("entity").orderBy("ts", "rule_id")
    return fired.select("entity", F.row_number().over(order).alias("step_number"), F.concat(F.lit("Fired rule: "), "rule_id").alias("description"),
                        "rule_id", F.col("fact_ids").alias("facts"), F.col("effective_cf").alias("certainty"))


def trace_text(steps: DataFrame) -> DataFrame:
    """Steps of each anomaly as text. There are as many steps as rules that took part, plus three."""
    line = F.concat(
        F.lit("  Step "), F.col("step_number").cast("string"), F.lit(": "), "description",
        F.when(F.col("certainty") > 0, F.concat(F.lit("\n    Certainty: "), text.percent(F.col("certainty")))).otherwise(""),
        F.when(F.size("facts") > 0, F.concat(F.lit("\n    Based on: "), F.array_join("facts", ", "))).otherwise(""))
    rows = steps.withColumn("_line", line).groupBy("anomaly_id", "anomaly_type", "threat_level", "final_certainty").agg(
        F.array_sort(F.collect_list(F.struct("step_number", "_line"))).alias("_lines"))
    kind = F.col("anomaly_type")
    return rows.select("anomaly_id", F.concat(
        F.lit("EXPLANATION FOR ANOMALY: "), kind, F.lit("\nConclusion: Detected "), scoring.level_name(F.col("threat_level")),
        F.lit(" threat: "), kind, F.lit("\nOverall Certainty: "), text.percent(F.col("final_certainty")), F.lit("\n\nReasoning Chain:\n"),
        F.array_join(F.transform("_lines", lambda s: s["_line"]), "\n")).alias("trace"))


def contradiction(conflicting: Column) -> Column:
    """How conflicting evidence (an array like ``evidence``) was resolved; only strong evidence is listed."""
    def listed(values: Column, sign: str) -> Column:
        strong = F.filter(values, lambda e: e["certainty"] > 0.5)
        rows = F.transform(strong, lambda e: F.concat(F.lit(f"\n  {sign} "), e["rule_name"], F.lit(": "), text.percent(e["certainty"]), F.lit(" confidence")))
        return F.array_join(rows, "")

    return F.concat(
        F.lit("Contradiction Resolution:\nAnomaly: "), "anomaly_type", F.lit("\n\nSupporting Evidence:"), listed(F.col("evidence"), "+"),
        F.lit("\n\nContradicting Evidence:"), listed(conflicting, "-"), F.lit("\n\nResolution: Final certainty of "),
        text.percent(F.col("certainty")), F.lit(" reflects\nthe net belief after weighing all evidence."))


def summary_by_type(anomalies: DataFrame) -> DataFrame:
    """Per type: number, mean certainty, how many are HIGH or above, and the highest score with its id."""
    best = F.struct("threat_score", "anomaly_id")
    return anomalies.groupBy("anomaly_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("certainty").alias("avg_certainty"), F.count_if(F.col("threat_level") >= 4).alias("high_severity"),
        F.max("threat_score").alias("top_score"), F.max_by("anomaly_id", best).alias("top_anomaly_id")).orderBy(F.desc("n"), "anomaly_type")


def summary_text(anomalies: DataFrame) -> DataFrame:
    """The summary as one text row. The list inside has one entry per anomaly type."""
    types = summary_by_type(anomalies)
    entry = F.concat(F.lit("\n  "), text.title(F.col("anomaly_type")), F.lit(":\n    Count: "), F.col("n").cast("string"),
                     F.lit("\n    Average Certainty: "), text.percent(F.col("avg_certainty")), F.lit("\n    High Severity: "),
                     F.col("high_severity").cast("string"))
    total = types.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"), F.max("top_score").alias("top"),
        F.min_by("anomaly_type", F.struct((-F.col("top_score")).alias("s"), "anomaly_type")).alias("top_type"),
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "anomaly_type", entry.alias("entry")))).alias("entries"))
    body = F.concat(
        F.lit("SECURITY ANALYSIS SUMMARY\nTotal Anomalies Detected: "), F.col("n").cast("string"), F.lit("\nUnique Threat Types: "),
        F.col("kinds").cast("string"), F.lit("\n\nBreakdown by Type:\n"), F.array_join(F.transform("entries", lambda e: e["entry"]), "\n"),
        F.lit("\n\nHighest Risk: "), "top_type", F.lit("\nThreat Score: "), text.fixed(F.col("top")), F.lit("/100"))
    return total.select(F.when(F.col("n") > 0, body).otherwise("No anomalies detected.").alias("summary"))
