from dataclasses import replace

import pytest
from conftest import make_events
from pyspark.sql import functions as F

from threatframe.config import RULES, Action, Condition, Rule
from threatframe.operators import behavioral, explain, facts, features, merge, rules, statistical
from threatframe.plans import analysis, jobs
from threatframe.sources.tables import find_anomaly, read_anomalies, write_anomalies


def logins(n=30, ip="203.0.113.9", start=36000):
    return [dict(t=start + i, user_id=f"u{i % 4}", source_ip=ip, service="ssh", event_type="authentication", outcome="failure" if i % 20 else "success",
                 raw_log=f"Failed password for u{i % 4} from {ip}") for i in range(n)]


@pytest.fixture(scope="module")
def result(spark):
    quiet = [dict(t=36000 + 500 * i, user_id="calm", source_ip="10.0.0.1", service="web", event_type="data_access", raw_log="page read",
                  attributes={"payload_size": 100 + i % 7, "direction": "egress"}) for i in range(60)]
    big = [dict(t=80000, user_id="thief", source_ip="10.0.0.2", service="file_server", event_type="data_access", raw_log="copy",
                attributes={"payload_size": 9000, "file_size_mb": 700, "direction": "egress"})]
    tool = [dict(t=36500, user_id="eve", source_ip="10.0.0.3", service="host", event_type="process_execution", raw_log="x",
                 attributes={"process_name": "powershell.exe", "command_line": "powershell -noprofile -windowstyle hidden -EncodedCommand QQ"})]
    events = make_events(spark, logins() + quiet + big + tool)
    anomalies, metrics = analysis.analyze(events)
    return anomalies.cache(), metrics, events


def test_whole_analysis(result):
    anomalies, metrics, _ = result
    rows = anomalies.collect()
    assert all(0 <= r.threat_score <= 100 and 0 <= r.certainty <= 1 and r.explanation for r in rows)
    assert [r.threat_score for r in rows] == sorted((r.threat_score for r in rows), reverse=True)
    rules_hit = {rule for r in rows for rule in r.triggered_rules}
    assert {"SIG-AUTH-001", "AUTH-001", "AUTH-006", "STAT-002", "STAT-003", "MAL-003", "DATA-001", "DATA-002", "SIG-MAL-002"} <= rules_hit
    brute = [r for r in rows if r.anomaly_type == "brute_force_attack" and r.detection_layer == "inference"]
    assert brute[0].source_ips == ["203.0.113.9"] and brute[0].missing_fields == ["user_id"]
    m = metrics.first()
    assert m.processed_events == 92 and m.anomaly_count == len(rows) and m.rules_fired > 0 and m.working_memory_facts == 92 * 10


def test_layers(spark, result):
    events = result[2]
    only = analysis.find(events.withColumn("severity", F.lit(None)), ["signature"])
    assert {r.detection_layer for r in only.select("detection_layer").distinct().collect()} == {"signature"}
    with pytest.raises(ValueError):
        analysis.find(events, ["magic"])


def test_store_and_explain(spark, result, tmp_path):
    anomalies = result[0]
    write_anomalies(anomalies, str(tmp_path / "out"))
    back = read_anomalies(spark, str(tmp_path / "out"))
    assert back.count() == anomalies.count()
    first = anomalies.first()
    again = find_anomaly(back, first.anomaly_id).first()
    assert again.threat_score == round(first.threat_score, 2) and again.threat_level == first.threat_level
    assert [e.rule_id for e in again.evidence] == [e.rule_id for e in first.evidence]
    texts = {r.anomaly_id: r for r in jobs.explanations(spark, str(tmp_path / "out")).collect()}
    brute = back.filter("anomaly_type = 'brute_force_attack' AND detection_layer = 'inference'").first()
    why = texts[brute.anomaly_id].why
    assert why.startswith("\nA brute force attack was detected because:\n- 28 failed login attempts were observed\n- All attempts originated from the same source (203.0.113.9)")
    assert "Final certainty = Rule CF × Evidence CF = 68.0%" in texts[brute.anomaly_id].how
    assert "     - failed_login_count: 28" in texts[brute.anomaly_id].how
    assert jobs.explanations(spark, str(tmp_path / "out"), "none").count() == 0
    other = back.filter("anomaly_type = 'off_hours_access'").first()
    assert "supporting indicators" in texts[other.anomaly_id].why


def test_summary_steps_and_traces(spark, result):
    anomalies, _, events = result
    text = explain.summary_text(anomalies).first().summary
    assert text.startswith(f"SECURITY ANALYSIS SUMMARY\nTotal Anomalies Detected: {anomalies.count()}\n") and "/100" in text
    assert explain.summary_text(anomalies.limit(0)).first().summary == "No anomalies detected."
    one = anomalies.filter("detection_layer <> 'meta'").limit(1)
    links = one.select("anomaly_id", F.explode(F.array(*[F.lit(f"f{i}") for i in range(7)])).alias("fact_id"))
    steps = explain.reasoning_steps(one, links).orderBy("step_number").collect()
    assert [s.step_number for s in steps] == [1, 2, 3, 4] and steps[1].facts == [f"f{i}" for i in range(5)]
    assert steps[1].description == "Extracted 7 relevant facts from events."
    trace = explain.trace_text(explain.reasoning_steps(one, links)).first().trace
    assert trace.startswith("EXPLANATION FOR ANOMALY: ") and "    Based on: f0, f1, f2, f3, f4" in trace
    conflict = anomalies.filter("size(evidence) > 1").limit(1)
    said = conflict.select(explain.contradiction(F.col("evidence")).alias("t")).first().t
    assert said.startswith("Contradiction Resolution:") and "\n  - " in said


def test_conditions(spark):
    df = spark.createDataFrame([("5", 5.0, True), ("abc", None, None)], "s string, n double, b boolean")

    def hits(op, value, column, check=None):
        return [r[0] for r in df.select(rules.to_column(Condition("a", "b", op, value, check), F.col(column))).collect()]

    assert hits(">=", 5, "s") == [True, False] and hits("<", 5, "n") == [False, False] and hits("==", True, "b") == [True, False]
    assert hits("in", ("abc", "x"), "s") == [False, True] and hits("matches", "^a", "s") == [False, True]
    assert hits("exists", None, "n") == [True, False] and hits("!=", "abc", "s") == [True, False]
    assert hits("==", None, "n", lambda c: c > 4) == [True, False]


def test_rules_by_category():
    assert len(RULES) == 22 and len({r.category for r in RULES}) == 8
    assert [r.rule_id for r in rules.select_rules(category="statistical")] == ["STAT-001"]
    assert rules.by_id("NET-001").priority == "CRITICAL" and rules.by_id("X") is None
    assert len(rules.select_rules(priority="CRITICAL")) == 7


def test_windowed_rules(spark):
    scan = [dict(t=i, source_ip="6.6.6.6", event_type="network_connection", attributes={"destination_port": i}) for i in range(25)]
    beacon = [dict(t=1000 + 60 * i, source_ip="7.7.7.7", destination_ip="8.8.8.8", event_type="network_connection") for i in range(8)]
    move = [dict(t=5000 + i, user_id="mover", source_ip="10.0.0.9", destination_ip=f"10.0.1.{i}", service="ssh", event_type="authentication", outcome="success") for i in range(6)]
    sudo = [dict(t=8000 + i, user_id="root2", service="sudo", event_type="privilege_escalation", attributes={"command": "sudo x"}) for i in range(12)] + [
        dict(t=60000, user_id="root2", service="web", event_type="data_access")]
    files = [dict(t=70000 + i, user_id="leaver", event_type="file_access", attributes={"data_classification": "confidential"}) for i in range(50)]
    usb = [dict(t=100, user_id="usb", event_type="system_event", attributes={"usb_inserted": "true", "data_copied_to_removable": "true", "dlp_policy": "violated"})]
    secret = [dict(t=100, user_id="low", event_type="data_access", attributes={"resource_classification": "sensitive", "access_granted": "true"})]
    tables_ = [dict(t=100 + 86400 * d, user_id="dba", event_type="data_access", attributes={"database_tables_accessed": "9", "query_type": "SELECT"}) for d in range(2)]
    travel = [dict(t=0, user_id="far", source_ip="1.1.1.1", event_type="authentication", outcome="success"), dict(t=1800, user_id="far", source_ip="2.2.2.2", event_type="authentication", outcome="success")]
    users = spark.createDataFrame([("leaver", "user", 1, True), ("low", "user", 1, False), ("root2", "user", 5, False)],
                                  "user_id string, user_role string, user_clearance_level int, resignation_notice boolean")
    geo = spark.createDataFrame([("1.1.1.1", "FR", 48.86, 2.35), ("2.2.2.2", "US", 40.71, -74.0)], "source_ip string, country string, lat double, lon double")
    events = make_events(spark, scan + beacon + move + sudo + files + usb + secret + tables_ + travel)
    rows = rules.detect(events, users=users, geo=geo).collect()
    got = {(r.rule_id, (r.affected_users or r.source_ips or ["-"])[0]) for r in rows}
    assert {("NET-002", "6.6.6.6"), ("MAL-002", "7.7.7.7"), ("NET-003", "mover"), ("PRIV-002", "root2"), ("INS-001", "leaver"), ("INS-002", "usb"),
            ("PRIV-003", "low"), ("DATA-003", "dba"), ("AUTH-003", "far"), ("PRIV-001", "root2")} <= got
    far = next(r for r in rows if r.rule_id == "AUTH-003")
    assert 5800 < float(far.attrs["distance_km"]) < 5900
    merged = merge.merge(rules.detect(events, [rules.by_id("AUTH-003")], geo=geo)).withColumn("why", explain.why()).first()
    assert "User far logged in from FR and US" in merged.why


def test_flood_threshold(spark):
    rows = [dict(t=i / 100, source_ip=f"9.{i % 3}.0.1", destination_ip="5.5.5.5", event_type="network_connection") for i in range(200)]
    rule = rules.by_id("NET-001")
    small = replace(rule, conditions=tuple(replace(c, value={"connection_count": 200, "unique_source_ips": 3}.get(c.predicate, c.value)) for c in rule.conditions))
    assert rules.rule_hits(rules.flood_frame(make_events(spark, rows)), [small]).count() == 1
    assert rules.rule_hits(rules.flood_frame(make_events(spark, rows)), [rule]).count() == 0


def test_inference_to_a_fixpoint(spark):
    events = make_events(spark, [dict(t=1, user_id="a", event_type="privilege_escalation"), dict(t=2, user_id="b", event_type="data_access")])
    base = facts.from_events(events)
    chain = [
        Rule("U1", "one", "x", "LOW", 0.8, "", (Condition("event", "event_type", "==", "privilege_escalation"),), (Action("assert_fact", parameters={"predicate": "risky", "value": True}),)),
        Rule("U2", "two", "x", "HIGH", 0.5, "", (Condition("inferred", "risky", "==", True),), (Action("assert_fact", parameters={"predicate": "watched", "value": 3}), Action("update_score", parameters={"delta": 50}))),
        Rule("U3", "three", "x", "HIGH", 1.0, "", (Condition("inferred", "watched", ">=", 3), Condition("event", "event_type", "exists")), (Action("create_anomaly", "insider_threat", "HIGH", "look"),)),
    ]
    all_facts, fired, scores = rules.infer(base, chain)
    assert {(r.entity, r.rule_id, round(r.effective_cf, 6)) for r in fired.collect()} == {("a", "U1", 0.8), ("a", "U2", 0.4), ("a", "U3", 1.0)}
    new = {r.predicate: r for r in all_facts.filter("fact_type = 'inferred'").collect()}
    assert new["risky"].certainty == pytest.approx(0.8) and new["watched"].value_num == 3.0 and new["watched"].derived_from
    assert scores.first().threat_score == pytest.approx(20)
    made = rules.anomalies_from_matches(fired, chain).collect()
    assert [(r.anomaly_type, r.affected_users, r.threat_level) for r in made] == [("insider_threat", ["a"], 4)]
    assert [r.rule_id for r in rules.in_firing_order(fired, chain).collect()] == ["U3", "U2", "U1"]
    assert rules.new_activations(rules.match_rules(all_facts, chain), fired).count() == 0
    assert explain.fired_steps(fired).count() == 3
    with pytest.raises(RuntimeError):
        rules.infer(base, chain, max_rounds=2)


def test_facts(spark):
    events = make_events(spark, [dict(t=1, user_id="a", source_ip="i", event_type="data_access"), dict(t=2, event_type="unknown")])
    rows = facts.from_events(events)
    assert rows.count() == 10 + 8 and facts.query(rows, "event", subject="system").count() == 1
    again = facts.assert_facts(rows, rows.withColumn("certainty", F.lit(0.5)))
    assert again.count() == rows.count() and again.agg(F.min("certainty")).first()[0] == 1.0
    assert facts.query(rows, event_id="e00000").count() == 10


def test_profiles_and_peers(spark):
    train = make_events(spark, [dict(t=36000 + i, user_id=f"u{i % 4}", source_ip="i", service="ssh", event_type="data_access") for i in range(80)])
    odd = make_events(spark, [dict(t=80000, user_id="u1", source_ip="j", service="vpn", event_type="data_access", event_id="odd"),
                              dict(t=36100, user_id="u2", source_ip="i", service="ssh", event_type="data_access", event_id="even"),
                              dict(t=36100, user_id="nobody", source_ip="i", service="x", event_type="data_access", event_id="new")])
    scored = {r.event_id: r.deviation_score for r in behavioral.deviations(train, odd).collect()}
    assert scored == {"odd": pytest.approx(1.0), "even": 0.0}
    hit = behavioral.deviation_findings(behavioral.deviations(train, odd)).first()
    assert (hit.threat_level, hit.certainty, hit.rule_id) == (4, 0.85, "BEH-001")
    peers = spark.createDataFrame([(f"u{i}", "g") for i in range(4)] + [("u1", "later")], "user_id string, group_name string")
    assert [r.event_id for r in behavioral.peer_deviations(train, odd, peers).collect()] == ["odd"]
    assert behavioral.peer_findings(train, odd, peers).first().source_ips == []
    assert behavioral.peer_deviations(train, odd, peers.filter("user_id IN ('u0', 'u1')")).count() == 0
    summary = behavioral.profile_summary(behavioral.entity_profiles(train)).filter("user_id = 'u1'").first()
    assert (summary.total_events, summary.typical_hours, summary.typical_services) == (20, [10], ["ssh"])


def test_payload_value(spark):
    rows = [({"payload_size": "10"}, 10.0), ({"payload_size": "0", "bytes_sent": "5"}, 5.0), ({"payload_size": "abc", "bytes_sent": "5"}, None), ({"payload_size": "", "bytes_sent": "7.5"}, 7.5), ({}, None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, attributes map<string,string>")
    got = [r.v for r in df.select("i", statistical.payload_value(F.col("attributes")).alias("v")).orderBy("i").collect()]
    assert got == [v for _, v in rows]


def test_job(spark, tmp_path):
    log = tmp_path / "in.json"
    log.write_text("\n".join('{"timestamp": "2024-01-06T10:00:%02dZ", "src_ip": "9.9.9.9", "user": "bob", "message": "login failed for user bob bad password", "outcome": "failure"}' % i for i in range(9)) + "\n{bad")
    jobs.run_analysis(spark, str(log), str(tmp_path / "out"))
    rows = read_anomalies(spark, str(tmp_path / "out" / "anomalies")).collect()
    assert {"credential_stuffing", "brute_force_attack"} <= {r.anomaly_type for r in rows}
    assert spark.read.json(str(tmp_path / "out" / "rejected")).count() == 1
    assert spark.read.json(str(tmp_path / "out" / "metrics")).first().processed_events == 9
    assert jobs.status(spark).filter("kind = 'rules_by_category'").count() == 8


def test_repeated_ids_multiply_no_rows(spark):
    rows = [{"event_id": "same", "t": 60.0, "user_id": "u", "source_ip": "1.1.1.1", "service": "ssh", "event_type": "authentication", "attributes": {"file_size_mb": i}} for i in range(10)]
    timed = make_events(spark, rows + [{"event_id": "other", "t": 90.0, "user_id": "v", "source_ip": "1.1.1.2", "service": "web", "event_type": "web_access"}])
    events = timed.unionByName(timed.filter("event_id = 'other'").withColumn("ts", F.lit(None).cast("timestamp")))
    z = events.select("event_id", "ts", "user_id", "source_ip", F.lit(4.0).alias("z_score"))
    frame = rules.event_frame(events, deviations=behavioral.prequential_deviations(events), z_scores=z).collect()
    assert len(frame) == 12 and all(r.statistical__z_score == 4.0 for r in frame)
    assert sorted({r.user_id: r.behavioral__confidence for r in frame if r.ts is not None}.items()) == [("u", 0.09), ("v", 0.0)]
    got = features.with_features(events).collect()
    assert len(got) == 12 and sorted(r.temporal_time_since_last for r in got if r.temporal_time_since_last is not None) == [0.0] * 9
    assert {r.freq_event_count for r in got if r.event_id == "other" and r.ts is not None} == {10}
