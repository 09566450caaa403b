"""Statistical layer: baselines, event rates, outliers, off-hours activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threatframe.config import MIN_SAMPLES, WINDOW_SECONDS, Z_THRESHOLD
from threatframe.functions.scoring import z_score
from threatframe.operators import ordered
from threatframe.operators.findings import as_array, finding, text_map
from threatframe.operators.typing import calendar
from threatframe.session import cut_lineage


def payload_value(attributes: Column) -> Column:
    """Payload size, or bytes sent where there is no size; zero, empty and non-numeric count as none."""
    def given(name):
        text = attributes[name]
        return F.when((text != "") & (F.coalesce(text.try_cast("double"), F.lit(1.0)) != 0), text)

    return F.coalesce(given("payload_size"), given("bytes_sent")).try_cast("double")


def _summary(value: str) -> list[Column]:
    return [F.count(value).alias("n"), F.avg(value).alias("mean"),
            F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"),
            F.min(value).alias("min_value"), F.max(value).alias("max_value")]


def metric_baselines(df: DataFrame, value: Column, scopes: dict[str, Column | None]) -> DataFrame:
    """Mean, sample deviation, range and count of a metric per scope.

    ``scopes`` maps a scope name to its key column, None for the scope of all rows. Every row
    is counted once per scope in one aggregation; rows without key or value are left out.
    """
    rows = df.select(value.alias("value"), F.inline(F.array(*[
        F.struct(F.lit(name).alias("scope"), (F.lit("all") if key is None else key).cast("string").alias("key"))
        for name, key in scopes.items()])))
    return (rows.filter(F.col("value").isNotNull() & F.col("key").isNotNull())
            .groupBy("scope", "key").agg(*_summary("value")))


def payload_baselines(events: DataFrame, value: Column | None = None) -> DataFrame:
    """Payload baseline over all events, per user and per address."""
    value = payload_value(F.col("attributes")) if value is None else value
    return metric_baselines(events, value, {"global": None, "user": F.col("user_id"), "ip": F.col("source_ip")})


def one_row(df: DataFrame) -> Column:
    """The single row of an aggregate as a struct column, read once per query by a scalar subquery."""
    return df.select(F.struct(*df.columns).alias("row")).scalar()


def payload_scores(events: DataFrame, value: Column | None = None) -> DataFrame:
    """Events with a payload, with its z-score against all payloads."""
    value = payload_value(F.col("attributes")) if value is None else value
    # through a generator: a filter on the value would else make it anew for each place it stands at, in the tasks that read the table
    valued = events.select("*", F.explode(F.array(value)).alias("observed_size"))
    base = one_row(valued.agg(*_summary("observed_size")))
    scored = valued.filter(F.col("observed_size").isNotNull()).withColumn("_base", base)
    return (scored.withColumn("z_score", z_score(F.col("observed_size"), F.col("_base.mean"), F.col("_base.std")))
            .withColumn("baseline_mean", F.col("_base.mean")).withColumn("baseline_std", F.col("_base.std"))
            .withColumn("baseline_n", F.col("_base.n")).drop("_base"))


def payload_outliers(events: DataFrame, value: Column | None = None, threshold: float = Z_THRESHOLD,
                     min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Events whose payload lies far above the mean of all payloads."""
    return payload_scores(events, value).filter(
        (F.col("baseline_n") >= min_samples) & (F.col("z_score") > threshold)).drop("baseline_n")


def payload_findings(events: DataFrame, value: Column | None = None) -> DataFrame:
    rows = payload_outliers(events, value)
    z = F.col("z_score")
    return rows.select(*finding(
        "large_download", "statistical", 3, F.least(F.lit(0.85), z / 5), "STAT-002",
        "Statistical Payload Size Anomaly",
        F.concat(F.lit("Payload size "), F.col("observed_size").cast("string"), F.lit(" is "),
                 _two_digits(z), F.lit(" std devs above mean")),
        "Review large data transfer for potential exfiltration",
        text_map(observed_size=F.col("observed_size"), baseline_mean=F.col("baseline_mean"),
                 baseline_std=F.col("baseline_std"), z_score=z)))


def _two_digits(value: Column) -> Column:
    from threatframe.functions.text import fixed

    return fixed(F.abs(value), 2)


def off_hours(events: DataFrame) -> DataFrame:
    """Findings for activity at night on a weekend."""
    rows = events.withColumn("_c", calendar(F.col("ts"))).filter("_c.is_night AND _c.is_weekend")
    return rows.select(*finding(
        "off_hours_access", "statistical", 2, F.lit(0.60), "STAT-003", "Off-Hours Activity",
        "Activity detected during night time on weekend", "Verify business justification for off-hours access",
        text_map(hour=F.col("_c.hour"), day_of_week=F.col("_c.day_of_week"),
                 is_night=F.col("_c.is_night"), is_weekend=F.col("_c.is_weekend"))))


# ------------------------------------------------------------------------------ event rates

def _entities() -> Column:
    return F.inline(F.array(
        F.struct(F.lit("user").alias("entity_type"), F.col("user_id").alias("entity")),
        F.struct(F.lit("ip").alias("entity_type"), F.col("source_ip").alias("entity"))))


def window_counts(events: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Events per user and per address in aligned windows."""
    rows = events.select(F.window("ts", f"{seconds} seconds")["start"].alias("window_start"), _entities())
    return (rows.filter(F.col("entity").isNotNull())
            .groupBy("window_start", "entity_type", "entity").agg(F.count(F.lit(1)).alias("n_events")))


def anchored_window_starts(events: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Starts of windows that open at an event and last ``seconds``: the next window opens at the
    first event after that.

    Which event opens a window depends on the whole past, so the chain is solved over spans of
    time that double in length instead of by a scan in one task. For every span and every time
    at which the chain could enter it, a table holds where the chain goes on behind the span. A
    chain enters a span at a time of its first ``seconds`` or at the first time after those, so
    every doubling halves the table: the work is linear in the distinct times. Going back from
    the longest span to the shortest then yields all window starts.
    """
    times = events.filter(F.col("ts").isNotNull()).select(F.unix_micros("ts").alias("t")).distinct()
    step = seconds * 1_000_000
    marks = times.select("t", F.inline(F.array(
        F.struct(F.col("t").alias("v"), F.lit(0).alias("probe"), F.col("t").alias("data")),
        F.struct((F.col("t") + step).alias("v"), F.lit(1).alias("probe"), F.lit(None).cast("bigint").alias("data")))))
    # the first data time after a probe: the smallest data time among the rows behind it
    ahead = marks.select("t", "probe", "data", (-F.col("v")).alias("back"), (-F.col("probe")).alias("back_probe"),
                         (-F.col("t")).alias("back_t"))
    hop = cut_lineage(ordered.running(ahead, [], ["back", "back_probe", "back_t"], {"target": ("min", F.col("data"))})
                      .filter("probe = 1").select("t", "target"))
    first, last = hop.agg(F.min("t"), F.max("t")).first()
    if first is None:
        return times.select(F.timestamp_micros("t").alias("window_start"))

    hops, width = [hop], step
    while width <= last - first:
        width *= 2
        offset = (F.col("t") - first) % width
        span = F.floor((F.col("t") - first) / width)
        early = hop.filter(offset <= step)
        later = (hop.filter(offset > step).groupBy(span.alias("_span"))
                 .agg(F.min("t").alias("t"), F.min_by("target", "t").alias("target")).select("t", "target"))
        inside = F.col("target") - F.col("t") < width - offset
        entries = early.unionByName(later).select("t", F.when(inside, F.col("target")).alias("via"), "target")
        onward = hop.select(F.col("t").alias("via"), F.col("target").alias("onward"))
        hop = cut_lineage(entries.join(onward, "via", "left").select(
            "t", F.when(F.col("via").isNotNull(), F.col("onward")).otherwise(F.col("target")).alias("target")))
        hops.append(hop)

    starts = times.sparkSession.range(1).select(F.lit(first).alias("t"))
    for hop in reversed(hops):
        onward = starts.join(hop, "t").filter("target IS NOT NULL").select(F.col("target").alias("t"))
        starts = cut_lineage(starts.union(onward).distinct())
    return starts.select(F.timestamp_micros("t").alias("window_start"))


def anchored_window_counts(events: DataFrame, seconds: int = WINDOW_SECONDS, drop_last: bool = True) -> DataFrame:
    """Events per user and per address in anchored windows; the last window is left open and dropped."""
    starts = anchored_window_starts(events, seconds)
    rows = (events.filter(F.col("ts").isNotNull()).select(F.col("ts").alias("v"), F.lit(1).alias("kind"), "event_id",
                                                          "user_id", "source_ip")
            .unionByName(starts.select(F.col("window_start").alias("v"), F.lit(0).alias("kind")),
                         allowMissingColumns=True))
    placed = ordered.running(rows, [], ["v", "kind", "event_id"], {
        "window_start": ("max", F.when(F.col("kind") == 0, F.col("v")))}).filter("kind = 1")
    counts = (placed.select("window_start", _entities()).filter(F.col("entity").isNotNull())
              .groupBy("window_start", "entity_type", "entity").agg(F.count(F.lit(1)).alias("n_events")))
    if drop_last:
        counts = counts.filter(F.col("window_start") < starts.agg(F.max("window_start").alias("w")).scalar())
    return counts


def rate_baselines(counts: DataFrame) -> DataFrame:
    """Baselines of the window counts: all users and addresses together, and each one alone."""
    rows = counts.select("n_events", F.inline(F.array(
        F.struct(F.lit("global").alias("scope"), F.lit("all").alias("key")),
        F.struct(F.col("entity_type").alias("scope"), F.col("entity").alias("key")))))
    return rows.groupBy("scope", "key").agg(*_summary("n_events"))


def trailing_counts(events: DataFrame, key: str = "user_id", seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Events of the same key in the last ``seconds``, the event itself included.

    Every event enters the count at its time and leaves it just after ``seconds``; the count is
    the running sum of both, so a key of any size is handled by ordered runs.
    """
    known = events.filter(F.col(key).isNotNull() & F.col("ts").isNotNull())
    enter = known.withColumn("_v", F.unix_micros("ts")).withColumn("_kind", F.lit(0)).withColumn("_step", F.lit(1))
    leave = known.select(key, "event_id", (F.unix_micros("ts") + seconds * 1_000_000).alias("_v"),
                         F.lit(1).alias("_kind"), F.lit(-1).alias("_step"))
    both = enter.unionByName(leave, allowMissingColumns=True)
    counted = ordered.running(both, [key], ["_v", "_kind", "event_id"], {"recent_count": ("sum", F.col("_step"))})
    return counted.filter("_kind = 0").drop("_v", "_kind", "_step")


def rate_outliers(events: DataFrame, scope: str = "global", counts: DataFrame | None = None,
                  threshold: float = Z_THRESHOLD, min_samples: int = MIN_SAMPLES,
                  seconds: int = WINDOW_SECONDS, key: str = "user_id") -> DataFrame:
    """Events whose recent count is far from the baseline of counts per window.

    The recent count is that of the event's user, or of its address with ``key="source_ip"``.
    ``scope`` is ``global`` (one baseline) or ``user`` (each user's own baseline).
    """
    counts = window_counts(events, seconds) if counts is None else counts
    recent = trailing_counts(events, key, seconds)
    if scope == "global":
        scored = recent.withColumn("_base", one_row(counts.agg(*_summary("n_events"))))
    else:
        own = counts.filter("entity_type = 'user'").groupBy(F.col("entity").alias("user_id")).agg(*_summary("n_events"))
        scored = recent.join(own.select("user_id", F.struct("n", "mean", "std").alias("_base")), "user_id")
    z = z_score(F.col("recent_count"), F.col("_base.mean"), F.col("_base.std"))
    return (scored.withColumn("z_score", z).withColumn("baseline_mean", F.col("_base.mean"))
            .withColumn("baseline_std", F.col("_base.std"))
            .filter((F.col("_base.n") >= min_samples) & (F.abs("z_score") > threshold)).drop("_base"))


def rate_findings(events: DataFrame, scope: str = "global", seconds: int = WINDOW_SECONDS) -> DataFrame:
    # the passes write rows: only the columns a finding has
    rows = rate_outliers(events.select("event_id", "ts", "user_id", "source_ip"), scope, seconds=seconds)
    size = F.abs(F.col("z_score"))
    rate = F.col("recent_count") / seconds
    return rows.select(*finding(
        "statistical_outlier", "statistical", F.when(size >= 5, 4).otherwise(3), F.least(F.lit(0.9), size / 5),
        "STAT-001", "Statistical Event Rate Anomaly",
        F.concat(F.lit("Event rate "), _two_digits(rate), F.lit("/s is "), _two_digits(size),
                 F.lit(" std devs from mean")),
        "Review event rate patterns and investigate source",
        text_map(observed_rate=rate, baseline_mean=F.col("baseline_mean"), baseline_std=F.col("baseline_std"),
                 z_score=F.col("z_score"))))


def detect(events: DataFrame) -> DataFrame:
    """All findings of this layer."""
    from threatframe.operators.findings import union

    return union([rate_findings(events), payload_findings(events), off_hours(events)])
