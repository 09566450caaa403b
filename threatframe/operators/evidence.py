"""Dempster-Shafer combination of evidence per case."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def combine_simple(evidence: DataFrame, case: str = "case_id") -> DataFrame:
    """Belief, plausibility and uncertainty per (case, hypothesis) from rows (case, hypothesis, belief).

    Beliefs in the same hypothesis are averaged; each mean b is a mass on its hypothesis with the
    rest on "any". Combining all of them with Dempster's rule has a closed form: with
    m_i = b_i prod_{j != i}(1 - b_j), P = prod(1 - b_j) and K = P + sum(m_i), the belief is m_i / K
    and the plausibility (m_i + P) / K. Two certain rivals (K = 0) give belief 0, plausibility 1.
    A case has one row per hypothesis here, so the window over it is short.
    """
    mean = evidence.groupBy(case, "hypothesis").agg(F.avg("belief").alias("b"))
    whole = Window.partitionBy(case)
    certain = F.col("b") >= 1
    rows = (mean.withColumn("_certain", F.count_if(certain).over(whole))
            .withColumn("_doubt", F.product(F.when(certain, F.lit(1.0)).otherwise(1 - F.col("b"))).over(whole))
            .withColumn("_n", F.count(F.lit(1)).over(whole)))
    others = (F.when(F.col("_certain") == 0, F.col("_doubt") / (1 - F.col("b")))
              .when((F.col("_certain") == 1) & certain, F.col("_doubt")).otherwise(F.lit(0.0)))
    rows = rows.withColumn("_m", F.col("b") * others).withColumn(
        "_p", F.when(F.col("_certain") == 0, F.col("_doubt")).otherwise(F.lit(0.0)))
    rows = rows.withColumn("_k", F.col("_p") + F.sum("_m").over(whole))
    belief = F.when(F.col("_n") == 1, F.col("b")).when(F.col("_k") > 0, F.col("_m") / F.col("_k")).otherwise(F.lit(0.0))
    plausible = (F.when(F.col("_n") == 1, F.lit(1.0)).when(F.col("_k") > 0, (F.col("_m") + F.col("_p")) / F.col("_k"))
                 .otherwise(F.lit(1.0)))
    return rows.select(case, "hypothesis", belief.alias("belief"), plausible.alias("plausibility"),
                       (plausible - belief).alias("uncertainty"))


def mass_function(evidence: DataFrame, frame: list[str] | None = None, case: str = "case_id") -> DataFrame:
    """Normalised masses (case, hypothesis_set, mass): one per hypothesis, the remainder on the frame."""
    single = evidence.select(case, F.array("hypothesis").alias("hypothesis_set"), F.col("confidence").alias("mass"))
    if frame:
        rest = (evidence.groupBy(case).agg((1 - F.sum("confidence")).alias("mass")).filter("mass > 0")
                .select(case, F.array_sort(F.array(*[F.lit(h) for h in frame])).alias("hypothesis_set"), "mass"))
        single = single.unionByName(rest)
    return normalise(single, case)


def normalise(masses: DataFrame, case: str = "case_id") -> DataFrame:
    summed = masses.groupBy(case, "hypothesis_set").agg(F.sum("mass").alias("mass"))
    total = F.sum("mass").over(Window.partitionBy(case))
    return summed.withColumn("mass", F.when(total > 0, F.col("mass") / total).otherwise(F.col("mass")))


def combine(first: DataFrame, second: DataFrame, case: str = "case_id") -> DataFrame:
    """Dempster's rule for two mass functions per case.

    The rule is defined on pairs of focal sets; a case has at most 2^|frame| of them, however
    much evidence there is.
    """
    right = second.select(case, F.col("hypothesis_set").alias("_set"), F.col("mass").alias("_mass"))
    pairs = first.join(right, case).select(
        case, F.array_sort(F.array_intersect("hypothesis_set", "_set")).alias("hypothesis_set"),
        (F.col("mass") * F.col("_mass")).alias("mass"))
    return normalise(pairs.filter(F.size("hypothesis_set") > 0), case)


def belief(masses: DataFrame, hypothesis: list[str], case: str = "case_id") -> DataFrame:
    """Belief, plausibility and uncertainty of one set of hypotheses per case."""
    wanted = F.array(*[F.lit(h) for h in hypothesis])
    inside = F.size(F.array_except("hypothesis_set", wanted)) == 0
    outside = F.size(F.array_intersect("hypothesis_set", wanted)) == 0
    out = masses.groupBy(case).agg(
        F.sum(F.when(inside, F.col("mass")).otherwise(0.0)).alias("belief"),
        (1 - F.sum(F.when(outside, F.col("mass")).otherwise(0.0))).alias("plausibility"))
    return out.withColumn("uncertainty", F.col("plausibility") - F.col("belief"))


def threat(beliefs: DataFrame, weights: dict[str, float] | None = None, case: str = "case_id") -> DataFrame:
    """Weighted mean of the beliefs of a case on a scale of 0 to 100."""
    from threatframe.functions.scoring import lookup

    weight = lookup(F.col("hypothesis"), weights, 1.0) if weights else F.lit(1.0)
    total = F.sum(weight)
    mean = F.sum(F.col("belief") * weight) / F.nullif(total, F.lit(0.0)) * 100
    return beliefs.groupBy(case).agg(
        F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(100.0), mean)), F.lit(0.0)).alias("threat_score"))
