"""Time, frequency, diversity and regularity features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from threatframe.config import SESSION_SECONDS, WINDOW_SECONDS
from threatframe.operators import ordered
from threatframe.operators.typing import calendar
from threatframe.session import stage

ORDER = ["ts", "event_id"]
DIVERSITY = {"user": "user_id", "ip": "source_ip", "service": "service"}
# Feature names, in vector order
VECTOR = [
    "temporal_hour", "temporal_day_of_week", "temporal_is_weekend", "temporal_is_business_hours",
    "temporal_is_night", "temporal_session_duration", "temporal_time_since_last",
    "freq_event_count", "freq_events_per_minute", "freq_unique_users", "freq_unique_ips",
    "freq_unique_services", "behavior_user_diversity", "behavior_ip_diversity",
    "behavior_service_diversity", "behavior_pattern_consistency",
]


def events_per_minute(n: Column, span_us: Column) -> Column:
    return F.when((n > 1) & (span_us > 0), n / (span_us / 1e6) * 60).otherwise(F.lit(0.0))


def normalised_entropy(n_all: Column, n_known: Column, sum_clogc: Column, distinct: Column) -> Column:
    """Shannon entropy over the largest possible one, from counts c per value.

    With p = c / n (n includes rows without value) the entropy is
    (sum(c) log2 n - sum(c log2 c)) / n, so only sums are needed.
    """
    raw = (n_known * F.log2(n_all) - sum_clogc) / n_all
    top = F.when(distinct > 1, F.log2(F.greatest(distinct, F.lit(2)))).otherwise(F.lit(1.0))
    return F.when((n_all > 0) & (distinct > 0), F.greatest(raw, F.lit(0.0)) / top).otherwise(F.lit(0.0))


def consistency(n_gaps: Column, sum_gap: Column, sum_gap2: Column) -> Column:
    """1 / (1 + deviation / mean) of the gaps between events; 0 without gaps or with mean 0."""
    mean = sum_gap / n_gaps
    variance = F.when(n_gaps > 1, F.greatest((sum_gap2 - sum_gap * sum_gap / n_gaps) / (n_gaps - 1), F.lit(0.0)))
    std = F.sqrt(F.coalesce(variance, F.lit(0.0)))
    return F.when((n_gaps > 0) & (sum_gap > 0), 1 / (1 + std / mean)).otherwise(F.lit(0.0))


def clogc(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(F.greatest(count, F.lit(1)).cast("double"))).otherwise(F.lit(0.0))


def time_since_last(events: DataFrame, key: str = "user_id") -> DataFrame:
    """Seconds since the previous event of the same key."""
    known = events.filter(F.col(key).isNotNull() & F.col("ts").isNotNull())
    rows = ordered.look_back(known, [key], ORDER, {"_previous": ("ts", 1)})
    return rows.withColumn("time_since_last", (F.unix_micros("ts") - F.unix_micros("_previous")) / 1e6).drop("_previous")


def session_features(events: DataFrame, seconds: int = SESSION_SECONDS) -> DataFrame:
    """``time_since_last`` and ``session_duration`` of each event's user.

    The session is the user's earlier events younger than ``seconds``, provided the last one is
    among them and there are at least two. Instead of a range window per user, events enter when
    they happen and leave after ``seconds``; the oldest one left is the successor of the last
    one that left.
    """
    known = events.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    linked = ordered.look_back(known, ["user_id"], ORDER, {"_prev_ts": ("ts", 1), "_prev_id": ("event_id", 1)})
    t, p = F.unix_micros("ts"), F.unix_micros("_prev_ts")
    enter = linked.withColumn("_v", t).withColumn("_kind", F.lit(1)).withColumn("_last_id", F.col("event_id"))
    # the previous event leaves (before events at that very time); what follows it is this event
    leave = linked.filter("_prev_ts IS NOT NULL").select(
        "user_id", (p + seconds * 1_000_000).alias("_v"), F.lit(0).alias("_kind"), F.col("_prev_id").alias("_last_id"),
        t.alias("_successor"))
    rows = enter.unionByName(leave, allowMissingColumns=True)
    is_event = F.col("_kind") == 1
    seen = ordered.running(rows, ["user_id"], ["_v", "_kind", "_last_id"], {
        "_alive": ("sum", F.when(is_event, 1).otherwise(-1)),
        "_first": ("min", F.when(is_event, F.col("_v"))),
        "_oldest": ("max", F.col("_successor")),
    }, inclusive=False).filter(is_event)
    gap = t - p
    duration = F.when((gap < seconds * 1_000_000) & (F.col("_alive") > 1),
                      (p - F.greatest("_first", "_oldest")) / 1e6)
    return (seen.withColumn("time_since_last", gap / 1e6).withColumn("session_duration", duration)
            .select(*events.columns, "time_since_last", "session_duration"))


def sessions(events: DataFrame, seconds: int = SESSION_SECONDS, key: str = "user_id") -> DataFrame:
    """Sessions per key, closed after ``seconds`` without events.

    A batch numbers the sessions of a key by ordered passes, since a session window sorts all
    rows of a key in one task; a stream uses the session window.
    """
    known = events.filter(F.col(key).isNotNull() & F.col("ts").isNotNull())
    n = F.count(F.lit(1)).alias("n_events")
    if events.isStreaming:
        return (known.groupBy(F.session_window("ts", f"{seconds} seconds").alias("session"), key).agg(n)
                .select(key, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), "n_events"))
    linked = ordered.look_back(known.select(key, *ORDER), [key], ORDER, {"_p": ("ts", 1)})
    opens = F.col("_p").isNull() | (F.unix_micros("ts") - F.unix_micros("_p") >= seconds * 1_000_000)
    numbered = ordered.running(linked, [key], ORDER, {"_session": ("sum", opens.cast("int"))})
    return numbered.groupBy(key, "_session").agg(F.min("ts").alias("session_start"), F.max("ts").alias("_last"), n).select(
        key, "session_start", (F.col("_last") + F.make_dt_interval(secs=F.lit(seconds))).alias("session_end"), "n_events")


def grouped_features(events: DataFrame, key: str) -> DataFrame:
    """Frequency, diversity and regularity per value of a key; rows without key are dropped."""
    known = events.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").withColumn("group_key", F.col(key))
    rows = known.select("group_key", "ts", "event_id", *{*DIVERSITY.values()})
    basics = rows.groupBy("group_key").agg(
        F.count(F.lit(1)).alias("event_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    parts = [basics]
    # counts per value first, so no group is ever gathered; then sums of those counts
    for name, column in DIVERSITY.items():
        per_value = rows.filter(F.col(column).isNotNull()).groupBy("group_key", column).agg(F.count(F.lit(1)).alias("c"))
        parts.append(per_value.groupBy("group_key").agg(
            F.count(F.lit(1)).alias(f"unique_{name}s"), F.sum("c").alias(f"_known_{name}"),
            F.sum(clogc(F.col("c"))).alias(f"_clogc_{name}")))
    gaps = ordered.look_back(rows.filter("ts IS NOT NULL").select("group_key", *ORDER), ["group_key"], ORDER, {"_p": ("ts", 1)})
    gap = (F.unix_micros("ts") - F.unix_micros("_p")) / 1e6
    parts.append(gaps.filter("_p IS NOT NULL").groupBy("group_key").agg(
        F.count(F.lit(1)).alias("_gaps"), F.avg(gap).alias("_gap_mean"), F.stddev_samp(gap).alias("_gap_std")))
    joined = reduce(lambda a, b: a.join(b, "group_key", "left"), parts)
    n, span = F.col("event_count"), F.unix_micros("last_ts") - F.unix_micros("first_ts")
    regular = F.when(F.col("_gap_mean") > 0, 1 / (1 + F.coalesce("_gap_std", F.lit(0.0)) / F.col("_gap_mean")))
    return joined.select(
        "group_key", "event_count", "first_ts", "last_ts", events_per_minute(n, span).alias("events_per_minute"),
        *[F.coalesce(f"unique_{d}s", F.lit(0)).alias(f"unique_{d}s") for d in DIVERSITY],
        *[normalised_entropy(n, F.coalesce(f"_known_{d}", F.lit(0)), F.coalesce(f"_clogc_{d}", F.lit(0.0)),
                             F.coalesce(f"unique_{d}s", F.lit(0))).alias(f"{d}_diversity") for d in DIVERSITY],
        F.coalesce(regular, F.lit(0.0)).alias("pattern_consistency"))


def trailing_features(events: DataFrame, keys: list[str] | None = None, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Features of the events in the last ``seconds`` before each event, the event itself left out.

    ``keys`` restricts the context to events with the same key; without keys it is all events.
    Nothing is paired and no context is gathered. Each event enters the context at its time and
    leaves it after ``seconds``; each of these steps changes the sums the features are made of
    (number, distinct values, sum of c log c per dimension, gaps and their squares), and the
    features of an event are the running totals of the steps before it.
    """
    keys = keys or []
    step = seconds * 1_000_000
    known = events.filter(F.col("ts").isNotNull())
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    n_rows = known.count()
    linked = ordered.look_back(known.select(*{*keys, *ORDER, *DIVERSITY.values()}), keys, ORDER,
                               {"_prev_ts": ("ts", 1), "_prev_id": ("event_id", 1)}, ordered.run_count(known, n_rows))
    t, p = F.unix_micros("ts"), F.unix_micros("_prev_ts")
    # _kind 0 sorts entries before the departures of the same time: the window includes its start
    place = ["_v", "_kind", "_id"]

    # 1. steps of the value counts, per (dimension, value)
    values = linked.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "event_id", t.alias("_t"), F.inline(F.array(*[
        F.struct(F.lit(d).alias("_dim"), F.col(c).alias("_value")) for d, c in DIVERSITY.items()])))
    values = values.filter(F.col("_value").isNotNull()).select("*", F.inline(F.array(
        F.struct(F.col("_t").alias("_v"), F.lit(0).alias("_kind"), F.lit(1).alias("_step")),
        F.struct((F.col("_t") + step).alias("_v"), F.lit(1).alias("_kind"), F.lit(-1).alias("_step")))))
    values = values.withColumnRenamed("event_id", "_id")
    group = [f"_k_{k}" for k in keys]
    counted = ordered.running(values, [*group, "_dim", "_value"], place, {"_c": ("sum", F.col("_step"))},
                              partitions=ordered.run_count(values, 2 * len(DIVERSITY) * n_rows))
    after, before = F.col("_c"), F.col("_c") - F.col("_step")
    change = {"_distinct": (after > 0).cast("int") - (before > 0).cast("int"),
              "_clogc": clogc(after) - clogc(before), "_known": F.col("_step")}
    per_dim = counted.select(*group, *place, *[
        F.when(F.col("_dim") == d, value).otherwise(F.lit(0)).alias(f"{name}_{d}")
        for name, value in change.items() for d in DIVERSITY])
    sums = [f"{name}_{d}" for name in change for d in DIVERSITY]

    # 2. steps of the number of events and of the gaps; the gap before an event leaves with the
    #    event before it, whose departure is therefore written by its successor
    gap = (t - p).cast("decimal(20,0)")
    plain = [F.col(k).alias(f"_k_{k}") for k in keys]
    entry = linked.select(*plain, t.alias("_v"), F.lit(0).alias("_kind"), F.col("event_id").alias("_id"),
                          F.lit(1).alias("_n"), (gap * gap).alias("_gap2"), t.alias("_last"), t.alias("_start"))
    departure = linked.filter("_prev_ts IS NOT NULL").select(
        *plain, (p + step).alias("_v"), F.lit(1).alias("_kind"), F.col("_prev_id").alias("_id"),
        F.lit(-1).alias("_n"), (-(gap * gap)).alias("_gap2"), t.alias("_next"))
    # an entry and a departure for each event, and their changes in each dimension, which lie apart
    tasks = ordered.run_count(known, 2 * n_rows)
    steps = (entry.unionByName(departure, allowMissingColumns=True)
             .unionByName(per_dim, allowMissingColumns=True)
             .repartition(tasks, *group, *place).groupBy(*group, *place).agg(
                 *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_n", *sums)],
                 F.coalesce(F.sum("_gap2").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias("_gap2"),
                 *[F.max(c).alias(c) for c in ("_last", "_start", "_next")]))

    # 3. running totals before each event
    total = ordered.running(steps, group, place, {
        **{f"t{c}": ("sum", F.col(c)) for c in ("_n", *sums, "_gap2")},
        "t_last": ("max", F.col("_last")), "t_start": ("min", F.col("_start")), "t_next": ("max", F.col("_next")),
    }, inclusive=False, partitions=tasks).filter("_kind = 0 AND _last IS NOT NULL")
    n = F.coalesce("t_n", F.lit(0))
    oldest = F.greatest("t_start", "t_next")
    span = F.when(n > 1, F.col("t_last") - oldest).otherwise(F.lit(0))
    gaps2 = F.when(n > 1, F.col("t_gap2").cast("double")).otherwise(F.lit(0.0)) / 1e12
    context = total.select(
        F.col("_id").alias("event_id"), F.timestamp_micros("_v").alias("ts"), *[F.col(f"_k_{k}").alias(k) for k in keys],
        n.alias("freq_event_count"), events_per_minute(n, span).alias("freq_events_per_minute"),
        *[F.coalesce(f"t_distinct_{d}", F.lit(0)).alias(f"freq_unique_{d}s") for d in DIVERSITY],
        *[normalised_entropy(n, F.coalesce(f"t_known_{d}", F.lit(0)), F.coalesce(f"t_clogc_{d}", F.lit(0.0)),
                             F.coalesce(f"t_distinct_{d}", F.lit(0))).alias(f"behavior_{d}_diversity") for d in DIVERSITY],
        F.when(n > 1, consistency(n - 1, span / 1e6, gaps2)).otherwise(F.lit(0.0)).alias("behavior_pattern_consistency"))
    return context


def with_features(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Events with calendar, session and trailing features under their full names.

    Ids and times may repeat: each row gets a number of its own, written once so that it stays the same, and an id that sorts
    by id, then number.
    """
    cal = calendar(F.col("ts"), business_excludes_weekend=True)
    rows = stage(events.withColumn("_row", F.monotonically_increasing_id()))
    rows = rows.withColumn("_row", F.concat_ws("\0", "event_id", F.lpad(F.col("_row").cast("string"), 19, "0")))
    single = rows.select(F.col("_row").alias("event_id"), "ts", *{*DIVERSITY.values(), *(keys or [])})
    sessions_ = session_features(single.select("event_id", "ts", "user_id")).select(
        F.col("event_id").alias("_row"), F.col("session_duration").alias("temporal_session_duration"),
        F.col("time_since_last").alias("temporal_time_since_last"))
    context = trailing_features(single, keys).drop("ts", *(keys or [])).withColumnRenamed("event_id", "_row")
    return (rows.withColumn("_c", cal).select(
        "_row", *events.columns, *[F.col(f"_c.{f}").alias(f"temporal_{f}")
                                   for f in ("hour", "day_of_week", "is_weekend", "is_business_hours", "is_night")])
        .join(sessions_, "_row", "left").join(context, "_row", "left").drop("_row"))


def feature_vector() -> Column:
    """The 16 features as an array of doubles, 0 where missing."""
    return F.array(*[F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in VECTOR])
