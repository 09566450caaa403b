"""Detection content: signatures, sequences, production rules, word lists, security graph."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Callable

# --------------------------------------------------------------------------------------
# enumerations
# --------------------------------------------------------------------------------------
EVENT_TYPES = [
    "authentication", "authorization", "privilege_escalation", "data_access",
    "data_exfiltration", "network_connection", "process_execution", "file_access",
    "system_event", "security_alert", "unknown",
]
SEVERITIES = {"CRITICAL": 5, "HIGH": 4, "MEDIUM": 3, "LOW": 2, "INFO": 1, "DEBUG": 0}
THREAT_LEVELS = {"CRITICAL": 5, "HIGH": 4, "MEDIUM": 3, "LOW": 2, "INFO": 1}
ANOMALY_TYPES = [
    "brute_force_attack", "credential_stuffing", "impossible_travel", "suspicious_login_time",
    "failed_login_anomaly", "privilege_escalation", "unauthorized_access", "sudo_abuse",
    "data_exfiltration", "large_download", "unusual_data_access", "malware_behavior",
    "c2_communication", "suspicious_process", "insider_threat", "off_hours_access",
    "policy_violation", "ddos_attack", "port_scan", "lateral_movement", "sql_injection",
    "xss_attack", "path_traversal", "statistical_outlier", "behavioral_anomaly", "unknown",
]
EVENT_CATEGORIES = {
    "authentication": "security", "authorization": "security", "privilege_escalation": "security",
    "data_access": "data", "data_exfiltration": "security", "network_connection": "network",
    "process_execution": "system", "file_access": "data", "system_event": "system",
    "security_alert": "security", "unknown": "unknown",
}


@dataclass(frozen=True)
class Signature:
    rule_id: str
    name: str
    pattern: str
    anomaly_type: str
    level: str
    description: str
    certainty: float
    enabled: bool = True


@dataclass(frozen=True)
class SequencePattern:
    name: str
    sequence: tuple[str, ...]
    max_seconds: int
    certainty: float
    anomaly_type: str


@dataclass(frozen=True)
class Condition:
    """One test on facts. ``check`` replaces ``op`` by a Column predicate of the caller."""

    fact_type: str
    predicate: str
    op: str
    value: Any = None
    check: Callable | None = None


@dataclass(frozen=True)
class Action:
    kind: str = "create_anomaly"
    anomaly_type: str | None = None
    level: str | None = None
    recommendation: str = ""
    parameters: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    category: str
    priority: str
    certainty: float
    description: str
    conditions: tuple[Condition, ...]
    actions: tuple[Action, ...]
    window_seconds: int | None = None


# --------------------------------------------------------------------------------------
# Signatures (searched case-insensitively)
# --------------------------------------------------------------------------------------
SIGNATURES = [
    Signature("SIG-AUTH-001", "SSH Brute Force Pattern",
              r"Failed password for .* from (\d+\.\d+\.\d+\.\d+)",
              "brute_force_attack", "HIGH",
              "Multiple SSH authentication failures indicating brute force", 0.85),
    Signature("SIG-AUTH-002", "Credential Stuffing Pattern",
              r"(login|auth).*failed.*user.*password",
              "credential_stuffing", "HIGH",
              "Rapid authentication attempts with different credentials", 0.80),
    Signature("SIG-AUTH-003", "Default Credential Attempt",
              r"(admin|root|test|guest|user).*password.*(admin|123456|password)",
              "brute_force_attack", "MEDIUM",
              "Attempt to login with default/weak credentials", 0.75),
    Signature("SIG-WEB-001", "SQL Injection Attempt",
              r"(union\s+select|insert\s+into|delete\s+from|drop\s+table|'\s+or\s+'|';\s*--|\d+\s*=\s*\d+)",
              "sql_injection", "CRITICAL",
              "SQL injection pattern detected in request", 0.90),
    Signature("SIG-WEB-002", "XSS Attempt",
              r"(<script|javascript:|onerror=|onload=|alert\(|document\.cookie)",
              "xss_attack", "HIGH",
              "Cross-site scripting attempt detected", 0.85),
    Signature("SIG-WEB-003", "Path Traversal Attempt",
              r"(\.\./|\.\.\\|%2e%2e%2f|%252e%252e%252f)",
              "path_traversal", "HIGH",
              "Directory traversal attack attempt", 0.88),
    Signature("SIG-WEB-004", "Command Injection",
              r"(;\s*\||\|\s*|`.*`|\$\(.*\)|&&\s*|\|\s*bash|\|\s*sh)",
              "malware_behavior", "CRITICAL",
              "Command injection attempt detected", 0.90),
    Signature("SIG-MAL-001", "Mimikatz Usage",
              r"mimikatz|sekurlsa::|kerberos::|lsadump::",
              "malware_behavior", "CRITICAL",
              "Credential dumping tool detected", 0.95),
    Signature("SIG-MAL-002", "PowerShell Obfuscation",
              r"(FromBase64String|EncodedCommand|bypass.*executionpolicy|noprofile.*windowstyle)",
              "suspicious_process", "HIGH",
              "Obfuscated PowerShell command execution", 0.85),
    Signature("SIG-MAL-003", "Reverse Shell Pattern",
              r"(bash\s+-i|/bin/sh\s+-i|nc\s+-e|netcat.*-e|python.*-c.*socket)",
              "c2_communication", "CRITICAL",
              "Reverse shell connection attempt", 0.90),
    Signature("SIG-MAL-004", "Base64 Executable",
              r"TVqQAAMAAAAEAAAA|TVqQAAMAAAAEAAAA//8AALgAAAA",
              "malware_behavior", "CRITICAL",
              "Base64 encoded Windows executable detected", 0.92),
    Signature("SIG-PRIV-001", "Sudo Privilege Escalation",
              r"sudo:.*user NOT in sudoers|sudo:.*incorrect password attempts",
              "privilege_escalation", "HIGH",
              "Unauthorized sudo attempt detected", 0.80),
    Signature("SIG-PRIV-002", "Setuid Binary Execution",
              r"setuid|setgid|chmod.*4755|chmod.*6755",
              "privilege_escalation", "MEDIUM",
              "Setuid/setgid permission modification", 0.70),
    Signature("SIG-DATA-001", "Large Data Transfer",
              r"(download|upload).*\d{3,}MB|transferred.*\d{3,}.*bytes",
              "large_download", "MEDIUM",
              "Large volume data transfer detected", 0.65),
    Signature("SIG-DATA-002", "Database Dump",
              r"(mysqldump|pg_dump|\.sql\.gz|database.*backup.*\d{4,}MB)",
              "data_exfiltration", "HIGH",
              "Database dump activity detected", 0.80),
    Signature("SIG-NET-001", "Port Scan Detection",
              r"(nmap|masscan|zmap).*-(sS|sT|sU|p)",
              "port_scan", "MEDIUM",
              "Port scanning tool usage detected", 0.85),
    Signature("SIG-NET-002", "C2 Beacon Pattern",
              r"(GET|POST)\s+/[a-f0-9]{16,}|(GET|POST)\s+/[A-Za-z0-9+/]{20,}={0,2}",
              "c2_communication", "CRITICAL",
              "Potential command and control beacon", 0.75),
]

# --------------------------------------------------------------------------------------
# Attack sequences
# --------------------------------------------------------------------------------------
SEQUENCE_PATTERNS = [
    SequencePattern("Lateral Movement Chain",
                    ("authentication", "network_connection", "authentication", "network_connection"),
                    30 * 60, 0.75, "lateral_movement"),
    SequencePattern("Privilege Escalation Chain",
                    ("authentication", "privilege_escalation", "authorization"),
                    15 * 60, 0.80, "privilege_escalation"),
    SequencePattern("Data Exfiltration Chain",
                    ("authentication", "data_access", "data_access", "network_connection"),
                    60 * 60, 0.70, "data_exfiltration"),
]


def _rule(rule_id, name, category, priority, certainty, description, conditions, anomaly_type, level,
          recommendation, window_seconds=None):
    return Rule(rule_id, name, category, priority, certainty, description,
                tuple(Condition(*c) for c in conditions),
                (Action("create_anomaly", anomaly_type, level, recommendation),), window_seconds)


# --------------------------------------------------------------------------------------
# Production rules
# --------------------------------------------------------------------------------------
RULES = [
    _rule("AUTH-001", "Brute Force Attack Detection", "authentication", "HIGH", 0.85,
          "Detect multiple failed login attempts from same source",
          [("aggregated", "failed_login_count", ">=", 5),
           ("aggregated", "time_window_seconds", "<=", 300),
           ("aggregated", "unique_usernames", ">=", 1)],
          "brute_force_attack", "HIGH", "Block source IP and review authentication logs", 300),
    _rule("AUTH-002", "Credential Stuffing Detection", "authentication", "HIGH", 0.90,
          "Detect credential stuffing using multiple usernames from same source",
          [("aggregated", "failed_login_count", ">=", 10),
           ("aggregated", "unique_usernames", ">=", 5),
           ("aggregated", "success_rate", "<=", 0.1)],
          "credential_stuffing", "CRITICAL", "Implement CAPTCHA and rate limiting immediately", 600),
    _rule("AUTH-003", "Impossible Travel Detection", "authentication", "CRITICAL", 0.92,
          "Detect logins from geographically distant locations in short time",
          [("temporal", "same_user_different_country", "==", True),
           ("temporal", "time_between_logins_minutes", "<=", 60),
           ("temporal", "distance_km", ">=", 500)],
          "impossible_travel", "CRITICAL", "Force password reset and verify user identity"),
    _rule("AUTH-004", "Off-Hours Login Detection", "authentication", "MEDIUM", 0.65,
          "Detect login attempts outside normal business hours",
          [("event", "is_business_hours", "==", False),
           ("event", "is_night", "==", True),
           ("behavioral", "user_typical_hours", "==", "business_hours")],
          "suspicious_login_time", "LOW", "Review access patterns for this user"),
    _rule("AUTH-005", "Weekend Access Anomaly", "authentication", "MEDIUM", 0.60,
          "Detect unusual weekend access by users who typically don't work weekends",
          [("event", "is_weekend", "==", True),
           ("behavioral", "user_weekend_access_frequency", "<=", 0.1)],
          "off_hours_access", "LOW", "Verify business justification for weekend access"),
    _rule("AUTH-006", "Rapid Authentication Failures", "authentication", "HIGH", 0.80,
          "Detect burst of authentication failures indicating automated attack",
          [("aggregated", "failed_login_count", ">=", 3),
           ("aggregated", "time_window_seconds", "<=", 60),
           ("aggregated", "event_rate_per_second", ">=", 1.0)],
          "failed_login_anomaly", "MEDIUM", "Monitor for potential brute force attack", 60),
    _rule("PRIV-001", "Unauthorized Privilege Escalation", "privilege_escalation", "CRITICAL", 0.90,
          "Detect privilege escalation by non-admin users",
          [("event", "event_type", "==", "privilege_escalation"),
           ("event", "user_role", "in", ("guest", "user", "standard"))],
          "privilege_escalation", "CRITICAL", "Immediately revoke elevated privileges and investigate"),
    _rule("PRIV-002", "Sudo Abuse Detection", "privilege_escalation", "HIGH", 0.75,
          "Detect unusual sudo command usage patterns",
          [("event", "event_type", "==", "privilege_escalation"),
           ("aggregated", "sudo_commands_count", ">=", 10),
           ("behavioral", "user_typical_sudo_frequency", "<=", 2)],
          "sudo_abuse", "HIGH", "Review sudo commands executed and user activity", 3600),
    _rule("PRIV-003", "Unauthorized Sensitive Resource Access", "privilege_escalation", "HIGH", 0.85,
          "Detect access to sensitive resources by unauthorized users",
          [("event", "resource_classification", "==", "sensitive"),
           ("event", "user_clearance_level", "<", 3),
           ("event", "access_granted", "==", True)],
          "unauthorized_access", "HIGH", "Review access controls and revoke unauthorized access"),
    _rule("DATA-001", "Data Exfiltration Pattern", "data_exfiltration", "CRITICAL", 0.78,
          "Detect potential data exfiltration based on volume and timing",
          [("event", "data_volume_mb", ">=", 100),
           ("event", "is_business_hours", "==", False),
           ("event", "direction", "==", "egress")],
          "data_exfiltration", "CRITICAL", "Block data transfer and investigate data loss prevention"),
    _rule("DATA-002", "Large Download Anomaly", "data_exfiltration", "HIGH", 0.70,
          "Detect unusually large data downloads",
          [("event", "data_volume_mb", ">=", 500),
           ("statistical", "z_score", ">=", 3.0)],
          "large_download", "MEDIUM", "Verify legitimacy of large data transfer"),
    _rule("DATA-003", "Unusual Data Access Pattern", "data_exfiltration", "MEDIUM", 0.65,
          "Detect access to data not typically accessed by user",
          [("event", "database_tables_accessed", ">=", 5),
           ("behavioral", "user_typical_table_access", "<=", 2),
           ("event", "query_type", "==", "SELECT")],
          "unusual_data_access", "MEDIUM", "Review database access logs for this user"),
    _rule("MAL-001", "Suspicious Process Execution", "malware", "CRITICAL", 0.88,
          "Detect execution of potentially malicious processes",
          [("event", "process_name", "in", ("mimikatz", "pwdump", "nc.exe", "nmap", "metasploit")),
           ("event", "event_type", "==", "process_execution")],
          "malware_behavior", "CRITICAL", "Isolate system and perform malware scan immediately"),
    _rule("MAL-002", "Command and Control Communication", "malware", "CRITICAL", 0.82,
          "Detect potential C2 communication patterns",
          [("event", "connection_pattern", "==", "beaconing"),
           ("aggregated", "unique_external_ips", "==", 1),
           ("aggregated", "connection_interval_variance", "<=", 5)],
          "c2_communication", "CRITICAL", "Block external IP and investigate for malware", 1800),
    _rule("MAL-003", "PowerShell Obfuscation Detection", "malware", "HIGH", 0.85,
          "Detect obfuscated PowerShell commands",
          [("event", "process_name", "==", "powershell.exe"),
           ("event", "command_line", "matches",
            "(FromBase64String|EncodedCommand|bypass|noprofile|windowstyle hidden)")],
          "suspicious_process", "HIGH", "Analyze PowerShell command and check for malware"),
    _rule("INS-001", "Insider Data Theft Pattern", "insider_threat", "HIGH", 0.75,
          "Detect potential insider threat based on data access patterns",
          [("event", "data_classification", "==", "confidential"),
           ("event", "is_business_hours", "==", False),
           ("aggregated", "files_accessed_count", ">=", 50),
           ("behavioral", "user_resignation_notice", "==", True)],
          "insider_threat", "HIGH", "Review user's data access and consider access revocation"),
    _rule("INS-002", "Security Policy Violation", "insider_threat", "MEDIUM", 0.70,
          "Detect violations of security policies",
          [("event", "usb_inserted", "==", True),
           ("event", "data_copied_to_removable", "==", True),
           ("event", "dlp_policy", "==", "violated")],
          "policy_violation", "MEDIUM", "Review DLP logs and enforce removable media policy"),
    _rule("NET-001", "DDoS Attack Detection", "network_anomaly", "CRITICAL", 0.85,
          "Detect potential DDoS attack patterns",
          [("aggregated", "connection_count", ">=", 10000),
           ("aggregated", "time_window_seconds", "<=", 60),
           ("aggregated", "unique_source_ips", ">=", 100)],
          "ddos_attack", "CRITICAL", "Activate DDoS mitigation and contact ISP", 60),
    _rule("NET-002", "Port Scan Detection", "network_anomaly", "HIGH", 0.80,
          "Detect network port scanning activity",
          [("aggregated", "unique_destination_ports", ">=", 20),
           ("aggregated", "time_window_seconds", "<=", 300),
           ("aggregated", "source_ip", "==", "single")],
          "port_scan", "MEDIUM", "Block scanning IP and review firewall rules", 300),
    _rule("NET-003", "Lateral Movement Detection", "network_anomaly", "CRITICAL", 0.78,
          "Detect potential lateral movement in network",
          [("aggregated", "unique_internal_targets", ">=", 5),
           ("event", "authentication_success", "==", True),
           ("aggregated", "time_window_seconds", "<=", 600),
           ("event", "service", "in", ("smb", "rdp", "ssh", "winrm"))],
          "lateral_movement", "CRITICAL", "Isolate compromised account and scan affected systems", 600),
    _rule("STAT-001", "Statistical Outlier Detection", "statistical", "MEDIUM", 0.70,
          "Detect events that are statistical outliers",
          [("statistical", "z_score", ">=", 3.0),
           ("statistical", "outlier_direction", "==", "high")],
          "statistical_outlier", "MEDIUM", "Review anomalous activity for potential security issue"),
    _rule("BEH-001", "Behavioral Baseline Deviation", "behavioral", "MEDIUM", 0.65,
          "Detect deviation from established behavioral baseline",
          [("behavioral", "baseline_deviation_score", ">=", 0.8),
           ("behavioral", "confidence", ">=", 0.7)],
          "behavioral_anomaly", "MEDIUM", "Review user's recent activity against historical baseline"),
]
RULE_PRIORITIES = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}

# --------------------------------------------------------------------------------------
# Event typing words, Windows ids, message kinds
# --------------------------------------------------------------------------------------
LOGIN_WORDS = ["login", "logon", "authentication", "signin"]
LOGIN_FAILURE_WORDS = ["fail", "denied", "invalid", "error"]
LOGIN_SUCCESS_WORDS = ["success", "granted", "authenticated"]
TYPE_WORDS = [
    ("authorization", ["access denied", "unauthorized", "forbidden"]),
    ("privilege_escalation", ["privilege", "escalation", "sudo", "elevated"]),
    ("data_access", ["file", "download", "upload", "data"]),
    ("network_connection", ["connection", "network", "tcp", "udp"]),
    ("process_execution", ["process", "execution", "command", "shell"]),
]
WINDOWS_EVENT_IDS = {
    "authentication": [4624, 4625, 4634, 4647, 4648, 4778, 4779],
    "authorization": [4720, 4722, 4723, 4724, 4725, 4726, 4738, 4740],
    "privilege_escalation": [4672, 4673, 4674],
    "file_access": [4656, 4658, 4659, 4660, 4661, 4663, 4664],
    "system_event": [4719, 4739, 612, 613],
}
# (kind, phrases, semantic type, outcome, indicators); the first kind with a hit wins
MESSAGE_KINDS = [
    ("login_success", ["login successful", "authentication success", "logged in"],
     "authentication", "success", []),
    ("login_failure", ["login failed", "authentication failure", "invalid credentials", "wrong password",
                       "user not found"], "authentication", "failure", ["multiple_failed_logins"]),
    ("logout", ["logout", "session ended", "user logged out"], "authentication", "logout", []),
    ("access_denied", ["access denied", "permission denied", "unauthorized", "not authorized",
                       "access forbidden"], "authorization", "denied", ["unauthorized_access"]),
    ("access_granted", ["access granted", "permission granted", "authorized"],
     "authorization", "granted", []),
    ("privilege_escalation", ["privilege escalation", "sudo", "elevated privileges",
                              "admin access granted", "root access"],
     "privilege_escalation", "escalated", ["privilege_change"]),
    ("file_access", ["file accessed", "file opened", "file read"], "data_access", "accessed", []),
    ("file_download", ["file downloaded", "download complete", "bulk download"],
     "data_exfiltration", "downloaded", ["large_data_transfer"]),
    ("database_query", ["sql query", "database access", "select", "insert", "update"],
     "data_access", "queried", []),
    ("connection_established", ["connection established", "connected to", "tcp established"],
     "network_connection", "connected", []),
    ("connection_blocked", ["connection blocked", "firewall drop", "connection refused"],
     "network_connection", "blocked", []),
    ("process_started", ["process started", "process created", "execution started"],
     "process_execution", "started", ["suspicious_process"]),
    ("process_terminated", ["process terminated", "process ended", "execution completed"],
     "process_execution", "terminated", []),
]
SEVERITY_WORDS = {
    "critical": ["critical", "emergency", "alert"],
    "high": ["high", "error", "err"],
    "medium": ["medium", "warning", "warn"],
    "low": ["low", "notice"],
    "info": ["info", "information", "informational", "debug"],
}

# --------------------------------------------------------------------------------------
# Field names looked up at ingest and when unifying schemas
# --------------------------------------------------------------------------------------
TIMESTAMP_FIELDS = ["timestamp", "time", "date", "datetime", "@timestamp", "eventTime", "event_time",
                    "created", "generated", "ts", "t", "eventTimestamp"]
MESSAGE_FIELDS = ["message", "msg", "text", "description", "details", "eventName", "event_name",
                  "activity", "action"]
PROMOTED_FIELDS = {
    "source_ip": ["source_ip", "src_ip", "client_ip", "sourceIPAddress"],
    "destination_ip": ["destination_ip", "dst_ip", "dest_ip"],
    "user_id": ["user_id", "user", "username", "userName", "user_identity"],
    "service": ["service", "eventSource", "application"],
}
FIELD_MAPPINGS = {
    "json": {
        "timestamp": ["timestamp", "time", "date", "@timestamp", "eventTime", "created"],
        "source_ip": ["source_ip", "src_ip", "client_ip", "sourceIPAddress", "remote_addr"],
        "destination_ip": ["destination_ip", "dst_ip", "dest_ip", "target_ip"],
        "user_id": ["user_id", "user", "username", "userName", "user_identity", "subject"],
        "service": ["service", "eventSource", "application", "app", "source"],
        "message": ["message", "msg", "text", "description", "eventName", "activity"],
        "severity": ["severity", "level", "priority", "syslog_severity"],
    },
    "xml": {
        "timestamp": ["timestamp", "time", "TimeCreated", "created"],
        "source_ip": ["ipaddress", "clientaddress", "sourceip", "ip"],
        "user_id": ["targetusername", "subjectusername", "username", "user"],
        "service": ["service", "application", "provider"],
        "message": ["message", "text", "renderinginfo_message"],
        "severity": ["level", "severity", "priority"],
    },
    "syslog": {
        "timestamp": ["timestamp", "time", "received_at"],
        "source_ip": ["source_ip", "remote_addr", "fromhost"],
        "user_id": ["user", "username", "uid"],
        "service": ["programname", "appname", "tag", "facility"],
        "message": ["message", "msg", "content"],
        "severity": ["severity", "level", "priority"],
    },
}
CLOUDTRAIL_SCHEMA = {"timestamp": "eventTime", "message": "eventName",
                     "user": "userIdentity.userName", "source_ip": "sourceIPAddress"}
WINDOWS_JSON_SCHEMA = {"timestamp": "TimeCreated", "message": "Message", "event_id": "Id", "level": "Level"}
XML_EVENT_TAGS = ["event", "Event", "log", "Log", "entry", "Entry", "record", "Record"]

# --------------------------------------------------------------------------------------
# Weights and thresholds
# --------------------------------------------------------------------------------------
LAYER_WEIGHTS = {"signature": 1.0, "statistical": 0.8, "behavioral": 0.9, "inference": 1.0}
MISSING_FIELD_WEIGHTS = {"user_id": 0.2, "source_ip": 0.15, "timestamp": 0.1, "event_type": 0.2,
                         "message": 0.1, "severity": 0.15, "destination_ip": 0.1}
FUZZY_LEVELS = {"low": (0, 30), "medium": (20, 70), "high": (60, 90), "critical": (80, 100)}
Z_THRESHOLD = 3.0
MIN_SAMPLES = 10
WINDOW_SECONDS = 300
SESSION_SECONDS = 1800

# --------------------------------------------------------------------------------------
# Security graph
# --------------------------------------------------------------------------------------
GRAPH_NODES = {
    "attack_type": ["authentication_attack", "authorization_attack", "data_attack", "network_attack",
                    "malware_attack", "insider_threat"],
    "specific_attack": ["brute_force", "credential_stuffing", "impossible_travel",
                        "privilege_escalation", "unauthorized_access", "data_exfiltration",
                        "sql_injection", "ddos", "port_scan", "lateral_movement", "c2_communication",
                        "ransomware", "data_theft", "sabotage"],
    "indicator": ["multiple_failed_logins", "rapid_fire_attempts", "unusual_location",
                  "off_hours_access", "privilege_change", "large_data_transfer", "suspicious_process",
                  "external_communication"],
}
GRAPH_IS_A = {
    "authentication_attack": ["brute_force", "credential_stuffing", "impossible_travel"],
    "authorization_attack": ["privilege_escalation", "unauthorized_access"],
    "data_attack": ["data_exfiltration", "sql_injection"],
    "network_attack": ["ddos", "port_scan", "lateral_movement"],
    "malware_attack": ["c2_communication", "ransomware"],
    "insider_threat": ["data_theft", "sabotage"],
}
GRAPH_INDICATES = [
    ("multiple_failed_logins", "brute_force"), ("rapid_fire_attempts", "brute_force"),
    ("rapid_fire_attempts", "credential_stuffing"), ("unusual_location", "impossible_travel"),
    ("off_hours_access", "data_exfiltration"), ("off_hours_access", "insider_threat"),
    ("privilege_change", "privilege_escalation"), ("large_data_transfer", "data_exfiltration"),
    ("suspicious_process", "ransomware"), ("external_communication", "c2_communication"),
]
GRAPH_PRECEDES = [
    ("port_scan", "lateral_movement"), ("brute_force", "privilege_escalation"),
    ("privilege_escalation", "data_exfiltration"), ("c2_communication", "ransomware"),
    ("lateral_movement", "data_exfiltration"),
]
