"""Context from reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threatframe.operators.typing import calendar


def enrich(events: DataFrame, user_profiles: DataFrame | None = None, ip_reputation: DataFrame | None = None) -> DataFrame:
    """User risk, address reputation and off-hours flags.

    ``user_profiles`` holds (user_id, typical_hours, risk_score), ``ip_reputation`` (source_ip,
    score, category), one row per key. The joins carry no hint: Spark broadcasts a table it
    measures as small and otherwise joins by shuffle, splitting hot keys.
    """
    out = events
    if user_profiles is not None:
        extra = user_profiles.select("user_id", F.coalesce("typical_hours", F.lit("unknown")).alias("user_typical_hours"),
                                     F.coalesce("risk_score", F.lit(0)).alias("user_risk_score"))
        out = out.join(extra, "user_id", "left")
    if ip_reputation is not None:
        extra = ip_reputation.select("source_ip", F.coalesce("score", F.lit(0)).alias("ip_reputation_score"),
                                     F.coalesce("category", F.lit("unknown")).alias("ip_threat_category"))
        out = out.join(extra, "source_ip", "left")
    return (out.withColumn("_c", calendar(F.col("ts")))
            .withColumn("is_off_hours", ~F.col("_c.is_business_hours"))
            .withColumn("is_weekend", F.col("_c.is_weekend")).drop("_c"))
