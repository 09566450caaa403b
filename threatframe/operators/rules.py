"""Production rules: the facts they read, computed as windowed aggregates, and their matching.

Two ways to the same semantics (a rule holds for an entity when every condition has some fact):

* shipped rules run on wide *frames*, one row per entity and window with a column per fact, so
  a rule is a filter;
* rules of the caller run on fact rows: :func:`match_rules` tests every fact once against all
  conditions and counts the conditions met per entity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threatframe.config import RULE_PRIORITIES, RULES, THREAT_LEVELS, Condition, Rule
from threatframe.functions import certainty
from threatframe.operators import facts as fact_ops, ordered, statistical
from threatframe.operators.findings import as_array, finding, no_entities, text_map
from threatframe.operators.typing import calendar
from threatframe.session import cut_lineage

PRIVATE = r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)"
FRAME_KEYS = ["user_id", "source_ip", "event_id", "first_ts", "last_ts"]


def by_id(rule_id: str, rules: list[Rule] = RULES) -> Rule | None:
    return next((r for r in rules if r.rule_id == rule_id), None)


def select_rules(rules: list[Rule] = RULES, category: str | None = None, priority: str | None = None) -> list[Rule]:
    return [r for r in rules if category in (None, r.category) and priority in (None, r.priority)]


# ------------------------------------------------------------------------------ conditions

def fact_column(condition: Condition) -> str:
    return f"{condition.fact_type}__{condition.predicate}"


def to_column(condition: Condition, value: Column) -> Column:
    """Condition on one value; a missing value does not meet it."""
    if condition.check is not None:
        test = condition.check(value)
    elif condition.op == "exists":
        return value.isNotNull()
    elif condition.op == "in":
        test = value.isin(*condition.value)
    elif condition.op == "matches":
        test = value.cast("string").rlike(condition.value)
    else:
        given = condition.value
        if isinstance(given, (int, float)) and not isinstance(given, bool):
            value = value.try_cast("double")
        test = {"==": lambda: value == given, "!=": lambda: value != given, "<": lambda: value < given,
                ">": lambda: value > given, "<=": lambda: value <= given, ">=": lambda: value >= given}[condition.op]()
    return F.coalesce(test, F.lit(False))


# ------------------------------------------------------------------------------ frames

def _window(seconds: int) -> Column:
    return F.window("ts", f"{seconds} seconds")["start"].alias("window_start")


def _span_seconds() -> Column:
    return (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6


def login_minutes(events: DataFrame) -> DataFrame:
    """Logins per (address, user, minute): the common, much smaller input of all login windows."""
    return (events.filter("event_type = 'authentication' AND source_ip IS NOT NULL")
            .groupBy("source_ip", "user_id", F.window("ts", "1 minute")["start"].alias("ts")).agg(
                F.count(F.lit(1)).alias("n"), F.count_if(F.col("outcome") == "failure").alias("failed"),
                F.count_if(F.col("outcome") == "success").alias("succeeded"),
                F.min(F.col("ts")).alias("first_ts"), F.max(F.col("ts")).alias("last_ts")))


def login_frame(minutes: DataFrame, seconds: int) -> DataFrame:
    """Logins per address and window, from :func:`login_minutes` (``seconds`` in whole minutes)."""
    frame = minutes.groupBy("source_ip", _window(seconds)).agg(
        F.sum("n").alias("n_logins"), F.sum("failed").alias("aggregated__failed_login_count"),
        (F.sum("succeeded") / F.sum("n")).alias("aggregated__success_rate"),
        F.count_distinct("user_id").alias("aggregated__unique_usernames"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    return frame.withColumn("aggregated__time_window_seconds", _span_seconds()).withColumn(
        "aggregated__event_rate_per_second",
        F.col("n_logins") / F.greatest(F.col("aggregated__time_window_seconds"), F.lit(1.0)))


def flood_frame(events: DataFrame, seconds: int = 60) -> DataFrame:
    """Connections per destination and window."""
    frame = (events.filter("event_type = 'network_connection' AND destination_ip IS NOT NULL")
             .groupBy("destination_ip", _window(seconds)).agg(
                 F.count(F.lit(1)).alias("aggregated__connection_count"),
                 F.count_distinct("source_ip").alias("aggregated__unique_source_ips"),
                 F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))
    return frame.withColumn("aggregated__time_window_seconds", _span_seconds())


def destination_port() -> Column:
    return F.col("attributes")["destination_port"]


def scan_frame(events: DataFrame, seconds: int = 300, port: Column | None = None) -> DataFrame:
    """Destination ports per source address and window."""
    port = destination_port() if port is None else port
    frame = (events.filter(F.col("source_ip").isNotNull() & port.isNotNull())
             .groupBy("source_ip", _window(seconds)).agg(
                 F.count_distinct(port).alias("aggregated__unique_destination_ports"),
                 F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))
    return (frame.withColumn("aggregated__time_window_seconds", _span_seconds())
            .withColumn("aggregated__source_ip", F.lit("single")))


def movement_frame(events: DataFrame, seconds: int = 600, services: tuple = ("smb", "rdp", "ssh", "winrm")) -> DataFrame:
    """Internal targets, successful logins and services per user and window."""
    internal = F.when(F.col("destination_ip").rlike(PRIVATE), F.col("destination_ip"))
    login = (F.col("event_type") == "authentication") & (F.col("outcome") == "success")
    frame = events.filter("user_id IS NOT NULL").groupBy("user_id", _window(seconds)).agg(
        F.count_distinct(internal).alias("aggregated__unique_internal_targets"),
        F.max(F.coalesce(login, F.lit(False))).alias("event__authentication_success"),
        F.max(F.when(F.col("service").isin(*services), F.col("service"))).alias("event__service"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return frame.withColumn("aggregated__time_window_seconds", _span_seconds())


def beacon_frame(events: DataFrame, seconds: int = 1800) -> DataFrame:
    """External targets and regularity of connections per source address and window."""
    outside = F.when(~F.col("destination_ip").rlike(PRIVATE), F.col("destination_ip"))
    rows = (events.filter("source_ip IS NOT NULL AND destination_ip IS NOT NULL AND ts IS NOT NULL")
            .select("source_ip", "destination_ip", "ts", "event_id", _window(seconds)))
    linked = ordered.look_back(rows, ["source_ip", "window_start"], ["ts", "event_id"], {"_p": ("ts", 1)})
    gap = (F.unix_micros("ts") - F.unix_micros("_p")) / 1e6
    frame = linked.groupBy("source_ip", "window_start").agg(
        F.count(F.lit(1)).alias("n_connections"), F.count_distinct(outside).alias("aggregated__unique_external_ips"),
        F.var_samp(gap).alias("aggregated__connection_interval_variance"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    regular = (F.col("aggregated__connection_interval_variance") <= 5) & (F.col("n_connections") >= 5)
    return frame.withColumn("event__connection_pattern", F.when(regular, "beaconing"))


def is_sudo() -> Column:
    command = F.coalesce(F.col("attributes")["command"], F.col("attributes")["command_line"], F.lit(""))
    return (F.coalesce(F.col("service"), F.lit("")) == "sudo") | F.lower(command).contains("sudo")


def sudo_frame(events: DataFrame, seconds: int = 3600, sudo: Column | None = None) -> DataFrame:
    """Sudo use per user and window, against the user's mean per hour of history."""
    rows = events.filter("user_id IS NOT NULL").withColumn("_sudo", is_sudo() if sudo is None else sudo)
    frame = rows.groupBy("user_id", _window(seconds)).agg(
        F.count_if("_sudo").alias("aggregated__sudo_commands_count"),
        F.max(F.when(F.col("event_type") == "privilege_escalation", F.col("event_type"))).alias("event__event_type"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    hours = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 3.6e9
    history = rows.groupBy("user_id").agg(
        (F.count_if("_sudo") / F.greatest(hours, F.lit(1.0))).alias("behavioral__user_typical_sudo_frequency"))
    return frame.join(history, "user_id")


def files_frame(events: DataFrame, users: DataFrame) -> DataFrame:
    """Files per user and day with data class and notice; ``users`` holds (user_id, resignation_notice)."""
    c = calendar(F.col("ts"))
    files = F.col("event_type").isin("data_access", "file_access")
    secret = F.col("attributes")["data_classification"]
    frame = events.filter("user_id IS NOT NULL").groupBy("user_id", _window(86400)).agg(
        F.count_if(files).alias("aggregated__files_accessed_count"),
        F.max(F.when(secret == "confidential", secret)).alias("event__data_classification"),
        F.min(c["is_business_hours"]).alias("event__is_business_hours"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    notice = users.select("user_id", F.col("resignation_notice").alias("behavioral__user_resignation_notice"))
    return frame.join(notice, "user_id", "left")


def travel_frame(events: DataFrame, geo: DataFrame) -> DataFrame:
    """Consecutive logins of a user with distance; ``geo`` holds (source_ip, country, lat, lon)."""
    logins = events.filter("event_type = 'authentication' AND user_id IS NOT NULL AND ts IS NOT NULL "
                           "AND coalesce(outcome, '') <> 'failure'").join(geo, "source_ip")
    rows = ordered.look_back(logins.select("user_id", "source_ip", "ts", "event_id", "country", "lat", "lon"),
                             ["user_id"], ["ts", "event_id"],
                             {f"_p_{c}": (c, 1) for c in ("ts", "country", "lat", "lon")}).filter("_p_ts IS NOT NULL")
    return (rows.withColumn("temporal__same_user_different_country", F.col("country") != F.col("_p_country"))
            .withColumn("temporal__time_between_logins_minutes", (F.unix_micros("ts") - F.unix_micros("_p_ts")) / 6e7)
            .withColumn("temporal__distance_km", haversine_km(F.col("_p_lat"), F.col("_p_lon"), F.col("lat"), F.col("lon")))
            .withColumn("location1", F.col("_p_country")).withColumn("location2", F.col("country"))
            .withColumn("first_ts", F.col("_p_ts")).withColumn("last_ts", F.col("ts")).drop("_p_ts", "_p_country", "_p_lat", "_p_lon"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2))
    chord = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * 6371.0 * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def user_facts(events: DataFrame) -> DataFrame:
    """Behavioural facts per user, all mergeable sums (no lists)."""
    hour = F.hour("ts")
    tables = F.col("event_type").isin("data_access", "file_access")
    return events.filter("user_id IS NOT NULL").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("profile_n"),
        F.when((F.min(hour) >= 9) & (F.max(hour) <= 16), "business_hours").alias("behavioral__user_typical_hours"),
        F.avg((F.weekday("ts") >= 5).cast("int")).alias("behavioral__user_weekend_access_frequency"),
        (F.count_if(tables) / F.count_distinct(F.to_date("ts"))).alias("behavioral__user_typical_table_access"))


EVENT_ATTRIBUTES = ["direction", "query_type", "process_name", "command_line", "dlp_policy", "resource_classification",
                    "database_tables_accessed"]
EVENT_FLAGS = ["usb_inserted", "data_copied_to_removable", "access_granted"]


EVENT_KEY = ["event_id", "ts", "user_id", "source_ip"]


def with_scores(frame: DataFrame, scores: DataFrame, values: dict[str, Column]) -> DataFrame:
    """The frame with ``values`` of its events' rows in ``scores``, the first of them decides: events that share id, time, user
    and address (repeated lines) take the highest. Never more rows than before, and events without a time keep their scores."""
    key = [name for name in EVENT_KEY if name in scores.columns]
    best = scores.groupBy(*[F.col(name).alias(f"_{name}") for name in key]).agg(
        F.max(F.struct(*[value.alias(name) for name, value in values.items()])).alias("_best"))
    same = F.lit(True)
    for name in key:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return frame.join(best, same, "left").select(*frame.columns, *[F.col(f"_best.{name}").alias(name) for name in values])


def event_frame(events: DataFrame, history: DataFrame | None = None, users: DataFrame | None = None,
                deviations: DataFrame | None = None, z_scores: DataFrame | None = None) -> DataFrame:
    """One row per event with the facts of the event and, where given, of its user and its scores.

    ``history`` are the events user habits are taken from, ``users`` holds (user_id, user_role,
    user_clearance_level), ``deviations`` (event_id, ts, deviation_score, profile_events) and
    ``z_scores`` (event_id, ts, z_score), both best with user_id and source_ip. What is not given stays null, and so do its conditions.
    """
    a = F.col("attributes")
    c = calendar(F.col("ts"))
    volume = F.coalesce(*[a[n].try_cast("double") for n in ("data_volume_mb", "file_size_mb", "data_transferred_mb")])
    frame = events.select(
        "event_id", "ts", "user_id", "source_ip", F.col("ts").alias("first_ts"), F.col("ts").alias("last_ts"),
        F.col("event_type").alias("event__event_type"), F.col("service").alias("event__service"),
        *[c[n].alias(f"event__{n}") for n in ("is_business_hours", "is_night", "is_weekend")],
        volume.alias("event__data_volume_mb"), *[a[n].alias(f"event__{n}") for n in EVENT_ATTRIBUTES],
        *[a[n].try_cast("boolean").alias(f"event__{n}") for n in EVENT_FLAGS])
    if history is not None:
        frame = frame.join(user_facts(history), "user_id", "left")
    if users is not None:
        frame = frame.join(users.select("user_id", F.col("user_role").alias("event__user_role"),
                                        F.col("user_clearance_level").alias("event__user_clearance_level")), "user_id", "left")
    if deviations is not None:
        frame = with_scores(frame, deviations, {
            "behavioral__baseline_deviation_score": F.col("deviation_score"),
            "behavioral__confidence": F.least(F.lit(1.0), F.col("profile_events") / 100)})
    if z_scores is not None:
        frame = with_scores(frame, z_scores, {
            "statistical__z_score": F.col("z_score"),
            "statistical__outlier_direction": F.when(F.col("z_score") > 0, "high").otherwise("low")})
    return frame


# ------------------------------------------------------------------------------ shipped rules

def evaluable(rule: Rule, frame: DataFrame) -> bool:
    """True when the frame has a column for every condition."""
    return all(fact_column(c) in frame.columns for c in rule.conditions)


def rule_hits(frame: DataFrame, rules: list[Rule], fact_certainty: Column | None = None) -> DataFrame:
    """Findings of the rules on a frame, in one pass. Rules the frame has no facts for are left out.

    ``fact_certainty`` is the combined certainty of the facts of a row (1 unless given).
    """
    usable = [r for r in rules if evaluable(r, frame)]
    if not usable:
        raise ValueError("the frame has the facts of none of the rules")
    for key in FRAME_KEYS:
        if key not in frame.columns:
            frame = frame.withColumn(key, F.lit(None).cast("timestamp" if key.endswith("_ts") else "string"))
    strength = F.lit(1.0) if fact_certainty is None else fact_certainty
    hits = []
    for rule in usable:
        test = reduce(lambda a, b: a & b, [to_column(c, F.col(fact_column(c))) for c in rule.conditions])
        action = rule.actions[0]
        seen = {c.predicate: F.col(fact_column(c)) for c in rule.conditions}
        seen |= {alias: seen[name] for name, alias in (
            ("failed_login_count", "failed_count"), ("unique_usernames", "unique_users"),
            ("time_window_seconds", "time_window"), ("data_volume_mb", "data_volume")) if name in seen}
        seen |= {name: F.col(name) for name in ("source_ip", "user_id", "location1", "location2") if name in frame.columns}
        hits.append(F.when(test, F.struct(
            F.lit(action.anomaly_type).alias("r_type"), F.lit(THREAT_LEVELS[action.level]).alias("r_level"),
            certainty.sequential(F.lit(rule.certainty), strength).alias("r_cf"), F.lit(rule.rule_id).alias("r_id"),
            F.lit(rule.name).alias("r_name"), F.lit(rule.description).alias("r_text"),
            F.lit(action.recommendation).alias("r_advice"),
            F.array(*[F.concat(F.lit(f"{c.fact_type}.{c.predicate}="), F.coalesce(F.col(fact_column(c)).cast("string"), F.lit("")))
                      for c in rule.conditions]).alias("r_facts"), text_map(**seen).alias("r_attrs"))))
    rows = frame.select(*FRAME_KEYS, F.inline_outer(F.filter(F.array(*hits), lambda h: h.isNotNull())))
    return rows.filter("r_id IS NOT NULL").select(*finding(
        F.col("r_type"), "inference", F.col("r_level"), F.col("r_cf"), F.col("r_id"), F.col("r_name"), F.col("r_text"),
        F.col("r_advice"), F.col("r_attrs"), first_ts=F.col("first_ts"), last_ts=F.col("last_ts"), matched=F.col("r_facts")))


def detect(events: DataFrame, rules: list[Rule] = RULES, users: DataFrame | None = None, geo: DataFrame | None = None,
           deviations: DataFrame | None = None, z_scores: DataFrame | None = None) -> DataFrame:
    """Findings of all shipped rules whose facts can be computed from what is given."""
    from threatframe.operators.findings import union

    ids = {r.rule_id for r in rules}
    minutes = login_minutes(events)
    frames = {
        ("AUTH-001",): lambda: login_frame(minutes, 300), ("AUTH-002",): lambda: login_frame(minutes, 600),
        ("AUTH-006",): lambda: login_frame(minutes, 60), ("NET-001",): lambda: flood_frame(events),
        ("NET-002",): lambda: scan_frame(events), ("NET-003",): lambda: movement_frame(events),
        ("MAL-002",): lambda: beacon_frame(events), ("PRIV-002",): lambda: sudo_frame(events),
        ("INS-001",): (lambda: files_frame(events, users)) if users is not None and "resignation_notice" in users.columns else None,
        ("AUTH-003",): (lambda: travel_frame(events, geo)) if geo is not None else None,
    }
    placed = {i for key in frames for i in key}
    roles = users if users is not None and "user_role" in users.columns else None
    frames[tuple(r.rule_id for r in rules if r.rule_id not in placed)] = lambda: event_frame(
        events, events, roles, deviations, z_scores)
    layers = []
    for key, build in frames.items():
        wanted = [r for r in rules if r.rule_id in key]
        if build is None or not wanted or not ids & set(key):
            continue
        frame = build()
        if any(evaluable(r, frame) for r in wanted):
            layers.append(rule_hits(frame, wanted))
    return union(layers)


# ------------------------------------------------------------------------------ rules on fact rows

def _condition_on_fact(condition: Condition) -> Column:
    if condition.check is not None or condition.op in ("in", "matches", "exists") or isinstance(condition.value, str):
        value = F.col("value_str")
    elif isinstance(condition.value, bool):
        value = F.col("value_bool")
    else:
        value = F.coalesce(F.col("value_num"), F.col("value_str").try_cast("double"))
    return ((F.col("fact_type") == condition.fact_type) & (F.col("predicate") == condition.predicate)
            & to_column(condition, value))


def met_conditions(facts: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per fact and condition it meets, all rules tested in one scan."""
    tests = [F.when(_condition_on_fact(c), F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(i).alias("condition_no")))
             for r in rules for i, c in enumerate(r.conditions)]
    rows = facts.select(*facts.columns, F.inline_outer(F.filter(F.array(*tests), lambda t: t.isNotNull())))
    return rows.filter("rule_id IS NOT NULL")


def match_rules(facts: DataFrame, rules: list[Rule], scope: str = "entity") -> DataFrame:
    """Rules all of whose conditions some fact meets: per subject, or over all facts (``global``).

    The earliest fact stands for its condition. Effective certainty is the rule's times the
    combination of those facts'. The list per rule is as short as the rule.
    """
    entity = F.col("subject") if scope == "entity" else F.lit("all")
    first = met_conditions(facts, rules).groupBy(entity.alias("entity"), "rule_id", "condition_no").agg(
        F.min_by(F.struct("fact_id", "certainty", "source_event_id", "ts"), F.struct("ts", "fact_id")).alias("f"))
    sizes = {r.rule_id: len(r.conditions) for r in rules}
    factors = {r.rule_id: r.certainty for r in rules}
    from threatframe.functions.scoring import lookup

    matched = first.groupBy("entity", "rule_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("f.ts").alias("ts"),
        F.array_sort(F.collect_list(F.struct("condition_no", "f"))).alias("facts"))
    matched = matched.filter(F.col("n") == lookup(F.col("rule_id"), sizes))
    combined = certainty.combine_array(F.transform("facts", lambda x: x["f"]["certainty"]))
    return matched.select(
        "entity", "rule_id", F.transform("facts", lambda x: x["f"]["fact_id"]).alias("fact_ids"),
        certainty.sequential(lookup(F.col("rule_id"), factors), combined).alias("effective_cf"), "ts")


def new_activations(matches: DataFrame, fired: DataFrame) -> DataFrame:
    """Matches whose rule has not fired for the same facts yet."""
    def key(df):
        return df.withColumn("_facts", F.array_join(F.array_sort("fact_ids"), ","))

    return key(matches).join(key(fired).select("rule_id", "_facts"), ["rule_id", "_facts"], "left_anti").select(*matches.columns)


def in_firing_order(matches: DataFrame, rules: list[Rule]) -> DataFrame:
    """By priority, then more conditions first, then the most recent."""
    from threatframe.functions.scoring import lookup

    priority = lookup(F.col("rule_id"), {r.rule_id: RULE_PRIORITIES[r.priority] for r in rules})
    specific = lookup(F.col("rule_id"), {r.rule_id: len(r.conditions) for r in rules})
    return (matches.withColumn("priority", priority).withColumn("specificity", specific)
            .orderBy("priority", F.desc("specificity"), F.desc("ts"), "rule_id", "entity"))


def affected_entities(findings: DataFrame) -> DataFrame:
    """Distinct users, addresses and events per rule, as rows (rule_id, kind, value)."""
    rows = findings.select("rule_id", F.explode(F.concat(
        F.transform("affected_users", lambda v: F.struct(F.lit("user").alias("kind"), v.alias("value"))),
        F.transform("source_ips", lambda v: F.struct(F.lit("ip").alias("kind"), v.alias("value"))),
        F.transform(as_array(F.col("event_id")), lambda v: F.struct(F.lit("event").alias("kind"), v.alias("value"))))).alias("e"))
    return rows.select("rule_id", "e.*").distinct()


def infer(facts: DataFrame, rules: list[Rule], scope: str = "entity", max_rounds: int = 1000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fire rules until nothing new matches. Returns (facts, fired, score changes).

    ``assert_fact`` actions add facts that can make further rules match; the loop ends when no
    activation is new, and raises if that needs more than ``max_rounds``. Each round is one job over the facts, cut off by a checkpoint.
    """
    by = {r.rule_id: r for r in rules}
    asserting = [r for r in rules if any(a.kind == "assert_fact" for a in r.actions)]
    fired = None
    for _ in range(max_rounds):
        matches = match_rules(facts, rules, scope)
        fresh = cut_lineage(matches if fired is None else new_activations(matches, fired))
        if fresh.isEmpty():
            break
        fired = fresh if fired is None else cut_lineage(fired.unionByName(fresh))
        if not asserting:
            break
        added = None
        for rule in asserting:
            for action in (a for a in rule.actions if a.kind == "assert_fact"):
                p = action.parameters
                subject = F.lit(p["subject"]) if "subject" in p else F.col("entity")
                value = p.get("value")
                kind = "bool" if isinstance(value, bool) else "num" if isinstance(value, (int, float)) else "str"
                made = fresh.filter(F.col("rule_id") == rule.rule_id).select(
                    fact_ops.fact(p.get("fact_type", "inferred"), subject, p.get("predicate", "derived"), F.lit(value), kind,
                                  certainty=F.col("effective_cf"), ts=F.col("ts")).alias("f"), "fact_ids")
                made = made.select("f.*", "fact_ids").withColumn("derived_from", F.col("fact_ids")).drop("fact_ids")
                added = made if added is None else added.unionByName(made)
        facts = cut_lineage(fact_ops.assert_facts(facts, added))
    else:
        raise RuntimeError(f"rules still fire after {max_rounds} rounds")
    if fired is None:
        fired = match_rules(facts, rules, scope)
    deltas = {i: sum(a.parameters.get("delta", 0) for a in r.actions if a.kind == "update_score") for i, r in by.items()}
    return facts, fired, score_changes(fired, {i: d for i, d in deltas.items() if d})


def score_changes(fired: DataFrame, deltas: dict[str, float]) -> DataFrame:
    """Sum of delta x certainty per entity, at most 100."""
    from threatframe.functions.scoring import lookup

    delta = lookup(F.col("rule_id"), deltas, 0.0) if deltas else F.lit(0.0)
    return fired.groupBy("entity").agg(F.least(F.lit(100.0), F.sum(delta * F.col("effective_cf"))).alias("threat_score"))


def anomalies_from_matches(matches: DataFrame, rules: list[Rule]) -> DataFrame:
    """Findings for matches of rules with a ``create_anomaly`` action."""
    from threatframe.functions.scoring import lookup

    made = {r.rule_id: (r, a) for r in rules for a in r.actions if a.kind == "create_anomaly"}

    def text(get):
        return lookup(F.col("rule_id"), {i: get(r, a) for i, (r, a) in made.items()})

    return matches.filter(F.col("rule_id").isin(list(made))).select(*finding(
        F.coalesce(text(lambda r, a: a.anomaly_type or "unknown"), F.lit("unknown")), "inference",
        text(lambda r, a: THREAT_LEVELS.get(a.level, 1)), F.col("effective_cf"), F.col("rule_id"),
        text(lambda r, a: r.name), text(lambda r, a: r.description), text(lambda r, a: a.recommendation),
        text_map(subject=F.col("entity")), event_id=F.lit(None).cast("string"), users=as_array(F.col("entity")),
        ips=no_entities(), matched=F.col("fact_ids")))


def equality_matches(facts: DataFrame, conditions: dict[str, list[dict]]) -> DataFrame:
    """(rule_id, condition_no, fact_id) where a fact equals a condition on all its given columns."""
    tests = []
    for rule_id, parts in conditions.items():
        for i, wanted in enumerate(parts):
            test = reduce(lambda a, b: a & b, [F.coalesce(F.col(k) == v, F.lit(False)) for k, v in wanted.items()], F.lit(True))
            tests.append(F.when(test, F.struct(F.lit(rule_id).alias("rule_id"), F.lit(i).alias("condition_no"))))
    rows = facts.select("fact_id", F.inline_outer(F.filter(F.array(*tests), lambda t: t.isNotNull())))
    return rows.filter("rule_id IS NOT NULL")


# ------------------------------------------------------------------------------ rule tables

def rules_table(spark: SparkSession, rules: list[Rule] = RULES) -> DataFrame:
    rows = [(r.rule_id, r.name, r.description, r.category, r.priority, float(r.certainty), len(r.conditions),
             r.actions[0].anomaly_type, r.actions[0].level, r.actions[0].recommendation, r.window_seconds) for r in rules]
    return spark.createDataFrame(rows, "rule_id string, name string, description string, category string, priority string, "
                                 "certainty double, n_conditions int, anomaly_type string, level string, "
                                 "recommendation string, window_seconds int")


def conditions_table(spark: SparkSession, rules: list[Rule] = RULES) -> DataFrame:
    rows = [(r.rule_id, i, c.fact_type, c.predicate, c.op, str(c.value)) for r in rules for i, c in enumerate(r.conditions)]
    return spark.createDataFrame(rows, "rule_id string, condition_no int, fact_type string, predicate string, op string, value string")


def knowledge_statistics(spark: SparkSession, rules: list[Rule] = RULES, signatures=None) -> DataFrame:
    """Rules by category and priority, signatures by anomaly type."""
    from threatframe.config import SIGNATURES

    table = rules_table(spark, rules)
    signatures = SIGNATURES if signatures is None else signatures
    sigs = spark.createDataFrame([(s.anomaly_type,) for s in signatures if s.enabled], "name string")
    parts = [table.select(F.lit("rules_by_category").alias("kind"), F.col("category").alias("name")),
             table.select(F.lit("rules_by_priority").alias("kind"), F.col("priority").alias("name")),
             sigs.select(F.lit("signatures_by_type").alias("kind"), "name")]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))
