"""Signature layer: regular expressions over the text of an event, in one pass over the events."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threatframe.config import SIGNATURES, THREAT_LEVELS, Signature
from threatframe.operators.findings import finding

# Java flags that give the searches their usual meaning: case-insensitive (i) with digits, blanks
# and letters of all scripts (U), and only a line feed ends a line (d).
FLAGS = "(?iUd)"

# Words a text must hold for a signature to be possible: one of each group. They only spare the
# regular expression, whose result decides. Signatures without an entry are always tried, and so is
# one that has the id of an entry, but another pattern than the fixed signature of that id.
NEEDED_WORDS = {
    "SIG-AUTH-001": [["failed password for "], [" from "]],
    "SIG-AUTH-002": [["failed"], ["password"], ["login", "auth"], ["user"]],
    "SIG-AUTH-003": [["password"], ["admin", "root", "test", "guest", "user"]],
    "SIG-WEB-001": [["=", "'", "union", "insert", "delete", "drop"]],
    "SIG-WEB-002": [["<script", "javascript:", "onerror=", "onload=", "alert(", "document.cookie"]],
    "SIG-WEB-003": [["../", "..\\", "%2e%2e%2f", "%252e%252e%252f"]],
    "SIG-WEB-004": [["|", "`", "$(", "&&"]],
    "SIG-MAL-001": [["mimikatz", "sekurlsa::", "kerberos::", "lsadump::"]],
    "SIG-MAL-002": [["frombase64string", "encodedcommand", "bypass", "noprofile"]],
    "SIG-MAL-003": [["-i", "-e", "-c"], ["bash", "/bin/sh", "nc", "netcat", "python"]],
    "SIG-MAL-004": [["tvqqaamaaaaeaaaa"]],
    "SIG-PRIV-001": [["sudo:"], ["user not in sudoers", "incorrect password attempts"]],
    "SIG-PRIV-002": [["setuid", "setgid", "chmod"]],
    "SIG-DATA-001": [["mb", "bytes"], ["download", "upload", "transferred"]],
    "SIG-DATA-002": [["mysqldump", "pg_dump", ".sql.gz", "database"]],
    "SIG-NET-001": [["nmap", "masscan", "zmap"], ["-s", "-p"]],
    "SIG-NET-002": [["/"], ["get", "post"]],
}

FIXED_PATTERNS = {s.rule_id: s.pattern for s in SIGNATURES}


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def folded(text: Column) -> Column:
    """Lower case, with the four non-ASCII letters that equal an ASCII one without case."""
    return F.lower(F.translate(text, "ſıİK", "siik"))


def search_text(raw: Column, message: Column | None = None, command: Column | None = None,
                command_line: Column | None = None, url: Column | None = None,
                request_url: Column | None = None) -> Column:
    """Text to search: raw log, message, command and address, joined by blanks."""
    def first(*values):
        present = [F.nullif(v, F.lit("")) for v in values if v is not None]
        return F.coalesce(*present) if present else None

    parts = [raw, first(message), first(command, command_line), first(url, request_url)]
    return F.concat_ws(" ", *[p for p in parts if p is not None])


def event_text() -> Column:
    """Search text of a log event with an attribute map."""
    def get(name):
        return F.col("attributes")[name]

    return search_text(F.col("raw_log"), get("message"), get("command"), get("command_line"),
                       get("url"), get("request_url"))


def hit(signature: Signature, text: str = "_text", fold: str = "_fold") -> str:
    """SQL condition: the signature is found in column ``text``, whose folded form is ``fold``."""
    tests = ["(" + " OR ".join(f"contains({fold}, {quoted(w)})" for w in words) + ")"
             for words in (NEEDED_WORDS.get(signature.rule_id, []) if FIXED_PATTERNS.get(signature.rule_id) == signature.pattern else [])]
    return " AND ".join([*tests, f"{text} RLIKE {quoted(FLAGS + signature.pattern)}"])


def valid(signatures: list[Signature], spark: SparkSession) -> tuple[list[Signature], dict[str, str]]:
    """Enabled signatures whose pattern compiles, and the message for each one that does not."""
    good, bad = [], {}
    for signature in signatures:
        if not signature.enabled:
            continue
        try:
            spark.range(1).select(F.lit("").rlike(FLAGS + signature.pattern)).collect()
            good.append(signature)
        except Exception as error:  # the JVM reports the broken pattern
            bad[signature.rule_id] = str(error).split("\n", 1)[0]
    return good, bad


def matches(df: DataFrame, text: Column, signatures: list[Signature] = SIGNATURES) -> DataFrame:
    """Rows x signatures found in ``text``: all columns of ``df`` plus one row per hit."""
    ready = df.withColumn("_text", text).withColumn("_fold", folded(F.col("_text")))
    # as SQL text: one parser call instead of some thousand calls that build columns
    tests = F.expr("array(" + ", ".join(f"CASE WHEN {hit(s)} THEN {_facts(s)} END" for s in signatures if s.enabled) + ")")
    found = ready.select(*df.columns, F.filter(tests, lambda h: h.isNotNull()).alias("_hits"))
    # The outer form: for inline() the optimizer would add a filter "has hits" that evaluates every
    # test a second time, with the text expression copied into each of them.
    return found.select(*df.columns, F.inline_outer("_hits")).filter(F.col("signature_id").isNotNull())


def _facts(signature: Signature, text: str = "_text") -> str:
    pattern = quoted(FLAGS + signature.pattern)
    groups = [f"regexp_extract({text}, {pattern}, {i + 1})" for i in range(re.compile(signature.pattern).groups)]
    return (f"named_struct('signature_id', {quoted(signature.rule_id)}, 'signature_name', {quoted(signature.name)}, "
            f"'signature_description', {quoted(signature.description)}, 'signature_type', {quoted(signature.anomaly_type)}, "
            f"'signature_level', {THREAT_LEVELS[signature.level]}, 'signature_certainty', {float(signature.certainty)}D, "
            f"'signature_attrs', map('matched_pattern', {quoted(signature.pattern)}, "
            f"'matched_text', regexp_extract({text}, {pattern}, 0), "
            f"'match_groups', concat_ws(', ', {', '.join(groups) or quoted('')})))")


def detect(events: DataFrame, signatures: list[Signature] = SIGNATURES, text: Column | None = None) -> DataFrame:
    """One finding per event and signature found in it. Works on batches and streams."""
    rows = matches(events, event_text() if text is None else text, signatures)
    return rows.select(*finding(
        F.col("signature_type"), "signature", F.col("signature_level"), F.col("signature_certainty"),
        F.col("signature_id"), F.col("signature_name"), F.col("signature_description"),
        F.concat(F.lit("Review signature match: "), "signature_name"), F.col("signature_attrs")))


def counts(df: DataFrame, text: Column, signatures: list[Signature] = SIGNATURES) -> DataFrame:
    """Number of rows per signature."""
    return (matches(df, text, signatures)
            .groupBy(F.col("signature_id").alias("rule_id"), F.col("signature_type").alias("anomaly_type"))
            .agg(F.count(F.lit(1)).alias("hits")))
