"""SQL fragments for the DuckDB side of the query catalogue."""

from __future__ import annotations

from threatframe.config import SIGNATURES, THREAT_LEVELS
from threatframe.plans.demo import TEXTS


def literal(text) -> str:
    if text is None:
        return "NULL"
    if isinstance(text, bool):
        return "TRUE" if text else "FALSE"
    if isinstance(text, (int, float)):
        return str(text)
    return "'" + str(text).replace("'", "''") + "'"


K = "CAST(json_extract_string(props, '$.k') AS INT)"
LOG_EVENTS = f"""
le AS (SELECT CAST(event_id AS VARCHAR) AS event_id,
  1704499200000000 + (epoch_us(ts) - 1704067200000000) // 60 AS ts_us,
  'u' || user_id AS user_id,
  '10.0.0.' || ({K} % 5) AS source_ip,
  (['ssh','web','database','file_server','ldap','vpn','api'])[{K} % 7 + 1] AS service,
  CASE WHEN event_type IN ('error','signup') THEN 'authentication' WHEN event_type = 'view' THEN 'data_access'
       WHEN event_type = 'click' THEN 'network_connection'
       WHEN {K} % 2 = 0 THEN 'privilege_escalation' ELSE 'authorization' END AS event_type,
  CASE event_type WHEN 'error' THEN 'failure' WHEN 'signup' THEN 'success' END AS outcome,
  ([{", ".join(literal(t) for t in TEXTS)}])[{K} % 23 + 1] AS raw_log,
  value AS payload_size,
  CASE WHEN event_type = 'click' THEN '192.168.1.' || ({K} % 11) END AS destination_ip,
  CASE WHEN event_type = 'click' THEN {K} % 60 END AS destination_port, {K} AS k
FROM events),
cal AS (SELECT *, CAST((ts_us // 3600000000) % 24 AS INT) AS hour,
  CAST(((ts_us // 86400000000) + 3) % 7 AS INT) AS dow FROM le)"""


def with_events(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([LOG_EVENTS.strip(), *[c.strip() for c in ctes if c.strip()]]) + "\n"


def signature_union(source: str, columns: str, text: str) -> str:
    """One SELECT per signature, so every pattern is a constant."""
    parts = []
    for s in SIGNATURES:
        level = THREAT_LEVELS[s.level]
        pattern = literal("(?i)" + s.pattern)
        parts.append(
            f"SELECT {columns}, {literal(s.rule_id)} AS rule_id, {literal(s.name)} AS rule_name, "
            f"{literal(s.description)} AS description, {literal(s.anomaly_type)} AS anomaly_type, {level} AS threat_level, "
            f"CAST({s.certainty} AS DOUBLE) AS certainty, least(100.0, {level} * 20 * CAST({s.certainty} AS DOUBLE) + 5) AS threat_score, "
            f"regexp_extract({text}, {pattern}, 0) AS matched_text "
            f"FROM {source} WHERE regexp_matches({text}, {pattern})")
    return "\nUNION ALL\n".join(parts)


HITS = f"hits AS ({signature_union('le', 'event_id, ts_us, user_id, source_ip', 'raw_log')})"
PAYLOAD = """
pbase AS (SELECT count(payload_size) AS n, avg(payload_size) AS mean, coalesce(stddev_samp(payload_size), 0) AS std FROM le
  WHERE payload_size <> 0),
pscore AS (SELECT le.*, CASE WHEN std = 0 THEN 0 ELSE (payload_size - mean) / std END AS z, n, mean, std FROM le, pbase WHERE payload_size <> 0)"""
FINDINGS = HITS + "," + PAYLOAD + """,
findings AS (
  SELECT event_id, ts_us, user_id, source_ip, anomaly_type, 'signature' AS layer, 0 AS layer_order, rule_id, rule_name, description,
    threat_level, certainty, threat_score FROM hits
  UNION ALL SELECT event_id, ts_us, user_id, source_ip, 'off_hours_access', 'statistical', 1, 'STAT-003', 'Off-Hours Activity',
    'Activity detected during night time on weekend', 2, CAST(0.6 AS DOUBLE), CAST(2 * 20 * 0.6 + 5 AS DOUBLE)
    FROM cal WHERE dow >= 5 AND (hour < 6 OR hour >= 22)
  UNION ALL SELECT event_id, ts_us, user_id, source_ip, 'large_download', 'statistical', 1, 'STAT-002',
    'Statistical Payload Size Anomaly', '', 3, least(0.85, z / 5), least(100.0, 60 * least(0.85, z / 5) + 5) FROM pscore WHERE n >= 10 AND z > 3),
weighted AS (SELECT *, CASE layer WHEN 'statistical' THEN 0.8 ELSE 1.0 END AS w FROM findings),
mgroups AS (SELECT anomaly_type, user_id, source_ip, count(*) AS n_members, sum(threat_score * w) AS weighted, max(threat_score) AS top,
    1 - product(1 - certainty) AS certainty, max(threat_level) AS max_threat_level, min(layer) AS layer1, min(threat_level) AS level1,
    min(threat_score) AS score1, min(certainty) AS certainty1, min(rule_name) AS rule_name1, min(description) AS description1,
    min(ts_us) AS first_us, max(ts_us) AS last_us, string_agg(DISTINCT rule_id, ',' ORDER BY rule_id) AS rules
  FROM weighted GROUP BY ALL),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anomaly_type, user_id, source_ip, layer, rule_id ORDER BY ts_us, event_id, description) AS rn
    FROM weighted) WHERE rn = 1),
ev AS (SELECT anomaly_type, user_id, source_ip, count(*) AS n_evidence, 1 - product(1 - certainty) AS evidence_cf,
    avg(certainty) AS avg_cf, min(certainty) AS min_cf, max(certainty) AS max_cf,
    list(certainty ORDER BY layer_order, ts_us, event_id, description, rule_id) AS cfs,
    list(rule_name ORDER BY layer_order, ts_us, event_id, description, rule_id) AS names,
    list(description ORDER BY layer_order, ts_us, event_id, description, rule_id) AS descriptions,
    list(rule_id ORDER BY layer_order, ts_us, event_id, description, rule_id) AS rule_ids,
    list(event_id ORDER BY layer_order, ts_us, event_id, description, rule_id) AS event_ids FROM firsts GROUP BY ALL),
merged AS (SELECT g.anomaly_type, g.user_id, g.source_ip, substr(sha256(g.anomaly_type || '|' || g.user_id || '|' || g.source_ip), 1, 16) AS anomaly_id,
    CASE WHEN n_members = 1 THEN layer1 ELSE 'meta' END AS detection_layer, n_members, max_threat_level,
    CASE WHEN n_members = 1 THEN level1 ELSE 1 END AS threat_level,
    CASE WHEN n_members = 1 THEN score1 ELSE weighted / 3.7 END AS threat_score, top,
    CASE WHEN n_members = 1 THEN certainty1 ELSE g.certainty END AS certainty, first_us, last_us, rules,
    n_evidence, evidence_cf, avg_cf, min_cf, max_cf, cfs, names, descriptions, rule_ids, event_ids
  FROM mgroups g JOIN ev USING (anomaly_type, user_id, source_ip)),
scored AS (SELECT *, least(100.0, threat_score * (0.5 + 0.5 * evidence_cf)
    * CASE WHEN n_evidence > 2 THEN 1 + 0.1 * least(n_evidence - 2, 3) ELSE 1 END) AS composite FROM merged)"""
