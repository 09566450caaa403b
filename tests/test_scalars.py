import random

import pytest
from pyspark.sql import functions as F

from threatframe.functions import certainty, fuzzy, scoring, text
from threatframe.operators import evidence, features, merge


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("a, b, want", [(0.6, 0.7, 0.88), (-0.5, -0.4, -0.7), (0.8, -0.3, 0.5 / 0.7), (1.0, -1.0, 0.0), (None, 0.3, 0.3), (0.3, None, 0.3)])
def test_combine(spark, a, b, want):
    assert value(spark, certainty.combine(F.lit(a).cast("double"), F.lit(b).cast("double"))) == pytest.approx(want)


def test_combine_many(spark):
    arr = F.array(F.lit(0.5), F.lit(0.6), F.lit(0.7))
    assert value(spark, certainty.combine_array(arr)) == pytest.approx(0.94)
    assert value(spark, certainty.combine_array(F.array().cast("array<double>"))) == 0.0
    df = spark.createDataFrame([(0.5,), (0.6,), (0.7,)], "c double")
    assert df.agg(certainty.noisy_or(F.col("c"))).first()[0] == pytest.approx(0.94)


def test_conversions(spark):
    assert value(spark, certainty.to_probability(F.lit(0.5))) == 0.75
    assert value(spark, certainty.to_probability(F.lit(1.0), 0.2)) == 1.0
    assert value(spark, certainty.from_probability(F.lit(1.0))) == 1.0
    assert value(spark, certainty.from_probability(F.lit(0.0))) == -1.0
    assert value(spark, certainty.from_probability(F.lit(0.75))) == pytest.approx(0.5)
    assert value(spark, certainty.from_measures(F.lit(1.4), F.lit(0.3))) == pytest.approx(0.7)
    row = value(spark, certainty.from_value(F.lit(-0.4)))
    assert (row.belief, row.disbelief, row.cf) == (0.0, 0.4, -0.4)


def test_scores(spark):
    assert value(spark, scoring.composite_score(F.lit(73.0), F.lit(0.85))) == pytest.approx(67.525)
    assert value(spark, scoring.composite_score(F.lit(50.0), F.lit(None).cast("double"), F.lit(5), F.lit(True), F.lit(True))) == pytest.approx(50 * 1.3 * 0.8 * 1.2)
    both = scoring.missing_penalty(F.array(F.lit("user_id"), F.lit("source_ip")))
    assert value(spark, both) == pytest.approx(0.35)
    many = scoring.missing_penalty(F.array(*[F.lit(n) for n in ("user_id", "event_type", "severity", "other")]))
    assert value(spark, many) == pytest.approx(0.5)
    for cf, band in ((0.9, "very_high"), (0.75, "high"), (0.5, "medium"), (0.25, "low"), (0.1, "very_low")):
        assert value(spark, scoring.confidence_band(F.lit(cf))) == band


def test_fuzzy(spark):
    row = value(spark, fuzzy.linguistic(F.lit(65.0)))
    assert (row.low, row.medium, row.critical) == (1.0, 0.9, 0.0)
    assert row.high == pytest.approx(1 / 6)
    assert value(spark, fuzzy.membership(F.lit(1.0), 0, 2, "other")) == 0.0
    assert value(spark, fuzzy.fuzzy_and(F.array().cast("array<double>"))) == 0.0


def test_dempster_shafer(spark):
    rows = spark.createDataFrame([("c", "x", 0.6), ("c", "y", 0.5), ("one", "x", 0.3), ("sure", "x", 1.0), ("sure", "y", 1.0),
                                  ("half", "x", 1.0), ("half", "y", 0.4)], "case_id string, hypothesis string, belief double")
    got = {(r.case_id, r.hypothesis): r for r in evidence.combine_simple(rows).collect()}
    assert got["c", "x"].belief == pytest.approx(0.428571, abs=1e-6) and got["c", "y"].belief == pytest.approx(0.285714, abs=1e-6)
    assert got["c", "x"].plausibility == pytest.approx(0.714286, abs=1e-6) and got["c", "y"].uncertainty == pytest.approx(0.285714, abs=1e-6)
    assert got["one", "x"].belief == pytest.approx(0.3)
    assert (got["sure", "x"].belief, got["sure", "x"].plausibility) == (0.0, 1.0)
    assert got["half", "x"].belief == pytest.approx(1.0) and got["half", "y"].belief == pytest.approx(0.0)


def test_closed_form_equals_folding_the_rule(spark):
    beliefs = {"a": 0.3, "b": 0.7, "c": 0.55}
    masses = None
    for h, b in beliefs.items():
        one = evidence.mass_function(spark.createDataFrame([("k", h, b)], "case_id string, hypothesis string, confidence double"), list(beliefs))
        masses = one if masses is None else evidence.combine(masses, one)
    rows = spark.createDataFrame([("k", h, b) for h, b in beliefs.items()], "case_id string, hypothesis string, belief double")
    closed = {r.hypothesis: r for r in evidence.combine_simple(rows).collect()}
    for h in beliefs:
        folded = evidence.belief(masses, [h]).first()
        assert folded.belief == pytest.approx(closed[h].belief) and folded.plausibility == pytest.approx(closed[h].plausibility)


def test_entropy(spark):
    # users a, a, b and one row without user
    e = features.normalised_entropy(F.lit(4), F.lit(3), features.clogc(F.lit(2)) + features.clogc(F.lit(1)), F.lit(2))
    assert value(spark, e) == pytest.approx(1.0)


def test_number_text_rounds_like_python(spark):
    rng = random.Random(5)
    xs = [rng.choice([rng.random() * 100, rng.randint(0, 10000) / 100, rng.randint(0, 4000) / 8, rng.randint(0, 2000) / 2000]) for _ in range(4000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", text.fixed(F.col("x")).alias("a"), text.fixed(F.col("x"), 2).alias("b"))
    for r in df.collect():
        assert (r.a, r.b) == ("%.1f" % round(r.x, 9), "%.2f" % round(r.x, 9)), r.x


def finding_rows(spark, rows):
    from threatframe.operators.findings import COLUMNS

    schema = ("anomaly_type string, detection_layer string, event_id string, first_ts timestamp, last_ts timestamp, affected_users array<string>, "
              "source_ips array<string>, threat_level int, threat_score double, certainty double, rule_id string, rule_name string, description string, "
              "recommendation string, matched_facts array<string>, attrs map<string,string>")
    import datetime

    t0 = datetime.datetime(2024, 1, 6)
    data = [(r["type"], r["layer"], r["event"], t0, t0, r.get("users", ["u1"]), r.get("ips", ["i1"]), r.get("level", 4), r["score"], r["cf"], r["rule"],
             r["rule"] + " name", "text", "advice", [r["event"]], {}) for r in rows]
    return spark.createDataFrame(data, schema).select(*COLUMNS)


def test_merge_two_signatures(spark):
    rows = finding_rows(spark, [dict(type="x", layer="signature", event="1", score=73.0, cf=0.85, rule="A"), dict(type="x", layer="signature", event="2", score=73.0, cf=0.85, rule="A")])
    merged = merge.merge(rows).first()
    assert merged.threat_score == pytest.approx(146 / 3.7) and merged.certainty == pytest.approx(1 - 0.15 ** 2)
    assert merged.detection_layer == "meta" and len(merged.evidence) == 1 and merged.evidence[0].matched_facts == ["1"]
    assert (merged.threat_level, merged.max_threat_level, merged.n_members) == (1, 4, 2)
    assert merged.explanation == "Aggregated Anomaly: x\nSources: 2 detection layers\nCombined Certainty: 97.8%\nEvidence Count: 1"
    assert merge.rescore(merge.merge(rows)).first().threat_score == pytest.approx(146 / 3.7 * (0.5 + 0.5 * 0.85))


def test_merge_does_not_depend_on_order_and_keeps_single(spark):
    spec = [dict(type="x", layer=layer, event=str(i), score=50.0 + i, cf=0.3 + i / 20, rule=f"R{i % 3}", users=["b", "a"] if i % 2 else ["a", "b"])
            for i, layer in enumerate(["signature", "statistical", "behavioral", "inference", "signature"])]
    single = dict(type="y", layer="statistical", event="9", score=29.0, cf=0.6, rule="S")
    one = merge.merge(finding_rows(spark, spec + [single])).orderBy("anomaly_type").collect()
    two = merge.merge(finding_rows(spark, [single] + spec[::-1])).orderBy("anomaly_type").collect()
    assert [(r.anomaly_id, [e.rule_id for e in r.evidence], r.explanation) for r in one] == [(r.anomaly_id, [e.rule_id for e in r.evidence], r.explanation) for r in two]
    assert one[0].threat_score == pytest.approx(two[0].threat_score)
    assert one[0].affected_users == ["a", "b"] and one[0].n_members == 5
    assert (one[1].detection_layer, one[1].threat_score, one[1].recommendation) == ("statistical", 29.0, "advice")
    assert "ANOMALY DETECTED: Y" in one[1].explanation and "1. S name (CF: 60.0%)" in one[1].explanation


def test_missing_data_note(spark):
    rows = finding_rows(spark, [dict(type="x", layer="signature", event="1", score=73.0, cf=0.8, rule="A", users=[], ips=[])])
    out = merge.penalise_missing(merge.merge(rows)).first()
    assert out.certainty == pytest.approx(0.8 * 0.65) and out.missing_fields == ["user_id", "source_ip"]
    assert out.explanation.endswith("Missing fields: user_id, source_ip. Certainty adjusted from 80.0% to 52.0%.")


def test_combine_group_is_the_fold_in_any_order(spark):
    import random

    from pyspark.sql import functions as F

    from threatframe.functions import certainty

    def fold(values):
        out = None
        for b in values:
            a = out
            if a is None:
                out = b
            elif a >= 0 and b >= 0:
                out = a + b * (1 - a)
            elif a < 0 and b < 0:
                out = a + b * (1 + a)
            else:
                out = (a + b) / (1 - min(abs(a), abs(b)))
        return out or 0.0

    r = random.Random(2)
    groups = {g: [r.uniform(-0.95, 0.95) for _ in range(r.randint(1, 12))] for g in range(60)} | {100: [1.0, -0.5, 0.2], 101: [-1.0, 0.7], 102: [1.0, -1.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [(103, None)]
    got = {x.g: x.c for x in spark.createDataFrame(rows, "g int, v double").groupBy("g").agg(certainty.combine_group(F.col("v")).alias("c")).collect()}
    assert all(abs(got[g] - fold(groups[g])) < 1e-9 for g in range(60))
    assert (got[100], got[101], got[102], got[103]) == (1.0, -1.0, 0.0, 0.0)
