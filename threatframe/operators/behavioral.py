"""Behavioural layer: entity profiles, deviation, peers, attack sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threatframe.config import MIN_SAMPLES, SEQUENCE_PATTERNS, SequencePattern
from threatframe.operators import ordered
from threatframe.operators.findings import finding, text_map, union

ORDER = ["ts", "event_id"]
DIMENSIONS = {"hour": 0.3, "service": 0.4, "source_ip": 0.5, "event_type": 0.3}


def _dimension(name: str) -> Column:
    return F.hour("ts").cast("string") if name == "hour" else F.col(name)


def profile_values(events: DataFrame, key: str = "user_id", other: str = "source_ip") -> DataFrame:
    """What an entity has been seen with: one row per (entity, dimension, value).

    A long table, so an entity with millions of addresses is many small rows and not one array.
    """
    dims = {"hour": F.hour("ts").cast("string"), "day": F.weekday("ts").cast("string"),
            "service": F.col("service"), other: F.col(other), "event_type": F.col("event_type")}
    rows = events.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("entity"), "ts", F.inline(F.array(*[
            F.struct(F.lit(name).alias("dimension"), value.alias("value")) for name, value in dims.items()])))
    return (rows.filter(F.col("value").isNotNull()).groupBy("entity", "dimension", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")))


def entity_profiles(events: DataFrame, key: str = "user_id", other: str = "source_ip") -> DataFrame:
    """One row per entity: distinct hours, days, services, peers and types, counts, shares, first / last seen."""
    cal_weekend, hour = F.weekday("ts") >= 5, F.hour("ts")
    login = F.col("event_type") == "authentication"
    totals = events.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("entity")).agg(
        F.count(F.lit(1)).alias("total_events"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
        F.avg(cal_weekend.cast("int")).alias("weekend_access_frequency"),
        F.avg(((hour < 6) | (hour >= 22)).cast("int")).alias("night_access_frequency"),
        F.coalesce(F.avg(F.when(login, (F.col("outcome") == "failure").cast("int"))), F.lit(0.0)).alias("failed_login_rate"))
    values = profile_values(events, key, other)
    arrays = values.groupBy("entity").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("dimension") == name, F.col("value")))).alias(alias)
        for name, alias in (("hour", "typical_hours"), ("day", "typical_days"), ("service", "common_services"),
                            (other, f"common_{other}s"), ("event_type", "common_event_types"))])
    return totals.join(arrays, "entity", "left").withColumn(
        "typical_hours", F.array_sort(F.col("typical_hours").cast("array<int>"))).withColumn(
        "typical_days", F.array_sort(F.col("typical_days").cast("array<int>")))


def profile_summary(profiles: DataFrame) -> DataFrame:
    return profiles.select(F.col("entity").alias("user_id"), "first_seen", "last_seen", "total_events", "typical_hours",
                           F.col("common_services").alias("typical_services"), "common_source_ips")


def deviation_score(unseen: dict[str, Column]) -> Column:
    """Sum of the weights of unseen values, at most 1."""
    total = F.lit(0.0)
    for name, weight in DIMENSIONS.items():
        total = total + F.when(unseen[name], F.lit(weight)).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), total)


def deviations(train: DataFrame, score: DataFrame, min_events: int = MIN_SAMPLES) -> DataFrame:
    """Events of ``score`` with their deviation from the profile built on ``train``.

    Hours and event types are closed lists and travel as arrays in the row of the user; services
    and addresses are open-ended, so they are matched by joins on (user, value).
    """
    known = train.filter(F.col("user_id").isNotNull())
    base = known.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_n"), F.collect_set(F.hour("ts")).alias("_hours"),
        F.collect_set("event_type").alias("_types"),
        F.count("service").alias("_services"), F.count("source_ip").alias("_ips"))
    services = known.filter("service IS NOT NULL").select("user_id", "service").distinct().withColumn("_s", F.lit(True))
    ips = known.filter("source_ip IS NOT NULL").select("user_id", "source_ip").distinct().withColumn("_i", F.lit(True))
    joined = (score.filter(F.col("user_id").isNotNull()).join(base, "user_id")
              .join(services, ["user_id", "service"], "left").join(ips, ["user_id", "source_ip"], "left"))
    unseen = {
        "hour": ~F.array_contains("_hours", F.hour("ts")),
        "service": F.col("service").isNotNull() & (F.col("_services") > 0) & F.col("_s").isNull(),
        "source_ip": F.col("source_ip").isNotNull() & (F.col("_ips") > 0) & F.col("_i").isNull(),
        "event_type": F.col("event_type").isNotNull() & (F.size("_types") > 0) & ~F.array_contains("_types", F.col("event_type")),
    }
    score_column = F.when(F.col("_n") >= min_events, deviation_score(unseen)).otherwise(F.lit(0.0))
    return (joined.withColumn("deviation_score", score_column).withColumn("profile_events", F.col("_n"))
            .drop("_n", "_hours", "_types", "_services", "_ips", "_s", "_i"))


def prequential_deviations(events: DataFrame, min_events: int = MIN_SAMPLES) -> DataFrame:
    """Every event against the profile of the events before it.

    A value is unseen exactly for the first event that shows it, so the past of an event need not
    be kept: the earliest (ts, event_id) of each (user, dimension, value) tells all. These firsts
    are few (one per distinct value) and are joined back to the events once.
    """
    known = events.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    counted = ordered.running(known, ["user_id"], ORDER, {"profile_events": ("sum", F.lit(1))}, inclusive=False)
    values = known.select("user_id", F.struct(*ORDER).alias("place"), F.inline(F.array(*[
        F.struct(F.lit(name).alias("dimension"), _dimension(name).alias("value")) for name in DIMENSIONS])))
    firsts = values.filter(F.col("value").isNotNull()).groupBy("user_id", "dimension", "value").agg(F.min("place").alias("first"))
    # the very first value of a dimension has nothing to deviate from
    start = firsts.groupBy("user_id", "dimension").agg(F.min("first").alias("start"))
    news = (firsts.join(start, ["user_id", "dimension"]).filter(F.col("first") > F.col("start"))
            .groupBy("user_id", F.col("first.ts").alias("ts"), F.col("first.event_id").alias("event_id"))
            .agg(*[F.max(F.col("dimension") == name).alias(f"_new_{name}") for name in DIMENSIONS]))
    joined = counted.join(news, ["user_id", *ORDER], "left")
    score = deviation_score({name: F.coalesce(f"_new_{name}", F.lit(False)) for name in DIMENSIONS})
    before = F.coalesce("profile_events", F.lit(0))
    return joined.select(*events.columns, before.alias("profile_events"),
                         F.when(before >= min_events, score).otherwise(F.lit(0.0)).alias("deviation_score"))


def deviation_findings(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    score = F.col("deviation_score")
    return scored.filter(score > threshold).select(*finding(
        "behavioral_anomaly", "behavioral", F.when(score >= 0.8, 4).otherwise(3), F.least(F.lit(0.85), score),
        "BEH-001", "User Behavior Deviation", "Event deviates from user's typical behavior pattern",
        "Review user's activity for potential account compromise",
        text_map(deviation_score=score, current_hour=F.hour("ts"), current_service=F.col("service"),
                 current_source_ip=F.col("source_ip"))))


def attack_sequences(events: DataFrame, patterns: list[SequencePattern] = SEQUENCE_PATTERNS,
                     lookback: int | None = None) -> DataFrame:
    """Events that complete a sequence: the user's last events have the types of the pattern, in order and in time.

    ``lookback`` also asks that they lie among the last that many events of all users.
    """
    known = events.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    if lookback:
        known = ordered.running(known, [], ORDER, {"_ordinal": ("sum", F.lit(1))})
    deepest = max(len(p.sequence) for p in patterns) - 1
    lags = {}
    for i in range(1, deepest + 1):
        lags |= {f"_type{i}": ("event_type", i), f"_ts{i}": ("ts", i), f"_id{i}": ("event_id", i)}
        if lookback:
            lags[f"_ord{i}"] = ("_ordinal", i)
    rows = (ordered.look_back(known, ["user_id"], ORDER, lags)
            .withColumn("_type0", F.col("event_type")).withColumn("_ts0", F.col("ts")).withColumn("_id0", F.col("event_id")))
    hits = []
    for pattern in patterns:
        n = len(pattern.sequence)
        oldest = n - 1
        test = F.col(f"_id{oldest}").isNotNull() & (
            F.unix_micros("ts") - F.unix_micros(f"_ts{oldest}") <= pattern.max_seconds * 1_000_000)
        if lookback:
            test = test & (F.col("_ordinal") - F.col(f"_ord{oldest}") < lookback)
        for i, wanted in enumerate(pattern.sequence):
            seen = F.col(f"_type{oldest - i}")
            test = test & F.coalesce(seen.contains(wanted), F.lit(True))
        hits.append(F.when(test, F.struct(
            F.lit(pattern.name).alias("pattern_name"), F.lit(pattern.anomaly_type).alias("pattern_type"),
            F.lit(pattern.certainty).alias("pattern_certainty"),
            F.lit(", ".join(pattern.sequence)).alias("pattern_sequence"),
            F.array(*[F.col(f"_id{oldest - i}") for i in range(n)]).alias("matched_events"))))
    found = rows.select(*known.columns, F.inline_outer(F.filter(F.array(*hits), lambda h: h.isNotNull())))
    return found.filter(F.col("pattern_name").isNotNull()).drop("_ordinal")


def sequence_findings(events: DataFrame, patterns: list[SequencePattern] = SEQUENCE_PATTERNS,
                      lookback: int | None = None) -> DataFrame:
    rows = attack_sequences(events, patterns, lookback)
    name = F.col("pattern_name")
    return rows.select(*finding(
        F.col("pattern_type"), "behavioral", 4, F.col("pattern_certainty"), "BEH-002",
        F.concat(F.lit("Sequence Pattern: "), name), F.concat(F.lit("Detected suspicious event sequence: "), name),
        F.concat(F.lit("Investigate potential "), F.lower(name)),
        text_map(pattern_name=name, sequence=F.col("pattern_sequence"), matched_events=F.size("matched_events")),
        matched=F.col("matched_events")))


def peer_deviations(train: DataFrame, score: DataFrame, peers: DataFrame) -> DataFrame:
    """Events whose service no other member of the user's peer group has used.

    ``peers`` holds (user_id, group_name). Members are never paired: a service is foreign to a
    user's peers when the members who used it, less the user, are none.
    """
    member = peers.groupBy("user_id").agg(F.min("group_name").alias("group_name"))  # first group by name
    sizes = peers.select("user_id", "group_name").distinct().groupBy("group_name").agg(F.count(F.lit(1)).alias("peer_group_size"))
    used = train.filter(F.col("user_id").isNotNull()).select("user_id", "service").distinct()
    listed = peers.select("user_id", "group_name").distinct()
    profiled = (used.select("user_id").distinct().join(listed, "user_id").groupBy("group_name")
                .agg(F.count(F.lit(1)).alias("_profiled")))
    users_of = (used.filter("service IS NOT NULL").join(listed, "user_id").groupBy("group_name", "service")
                .agg(F.count(F.lit(1)).alias("_users")))
    own = used.filter("service IS NOT NULL").withColumn("_own", F.lit(1))
    has_profile = used.select("user_id").distinct().withColumn("_has", F.lit(1))
    rows = (score.filter(F.col("user_id").isNotNull() & (F.coalesce("service", F.lit("")) != ""))
            .join(member, "user_id").join(has_profile, "user_id")
            .join(sizes, "group_name").join(profiled, "group_name")
            .filter((F.col("peer_group_size") >= 3) & (F.col("_profiled") - 1 >= 2))
            .join(users_of, ["group_name", "service"], "left").join(own, ["user_id", "service"], "left"))
    others = F.coalesce("_users", F.lit(0)) - F.coalesce("_own", F.lit(0))
    return rows.filter(others == 0).drop("_profiled", "_users", "_own", "_has")


def peer_findings(train: DataFrame, score: DataFrame, peers: DataFrame) -> DataFrame:
    from threatframe.operators.findings import no_entities

    return peer_deviations(train, score, peers).select(*finding(
        "behavioral_anomaly", "behavioral", 2, F.lit(0.65), "BEH-003", "Peer Group Deviation",
        "User accessed service not typically used by peer group", "Review user's role and access requirements",
        text_map(peer_group_size=F.col("peer_group_size"), accessed_service=F.col("service")), ips=no_entities()))


def detect(events: DataFrame, peers: DataFrame | None = None, lookback: int | None = None) -> DataFrame:
    """All findings of this layer; peers are compared when a peer table is given."""
    layers = [deviation_findings(prequential_deviations(events)), sequence_findings(events, lookback=lookback)]
    if peers is not None:
        layers.append(peer_findings(events, events, peers))
    return union(layers)
