import random

import pytest
from conftest import make_events
from pyspark.sql import Window, functions as F

from threatframe.operators import behavioral, features, ordered, statistical


def skewed(n=400, seed=3, span=4000):
    """A hot user and address with a third of all rows, equal times, rows without user."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4
        t = rng.choice([rng.uniform(0, span), rng.randint(0, span // 100) * 100, 1000 + rng.uniform(0, 3)])
        rows.append(dict(t=round(t, 3), user_id="hot" if hot else rng.choice([None, "a", "b", "c"]), source_ip="9.9.9.9" if hot else f"1.1.1.{rng.randint(1, 4)}",
                         service=rng.choice(["ssh", "web", None]), event_type=rng.choice(["authentication", "network_connection", "data_access", "privilege_escalation", "authorization"]),
                         outcome=rng.choice(["failure", "success", None]), event_id=f"e{rng.randint(0, 10**9):09d}"))
    return rows


@pytest.fixture(scope="module")
def rows():
    return sorted(skewed(), key=lambda r: (r["t"], r["event_id"]))


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_running_and_look_back_equal_plain_windows(spark, rows, partitions):
    df = make_events(spark, rows).withColumn("v", F.hash("event_id") % 100)
    for keys in ([], ["user_id"], ["user_id", "service"]):
        w = Window.partitionBy(*keys).orderBy("ts", "event_id") if keys else Window.orderBy("ts", "event_id")
        full = w.rowsBetween(Window.unboundedPreceding, 0)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        aggs = {"s": ("sum", F.col("v")), "hi": ("max", F.col("v")), "lo": ("min", F.col("v"))}
        fns = {"sum": F.sum, "max": F.max, "min": F.min}
        for inclusive, frame in ((True, full), (False, before)):
            got = ordered.running(df, keys, ["ts", "event_id"], aggs, inclusive, partitions).select("event_id", *aggs).collect()
            want = df.select("event_id", *[fns[k]("v").over(frame).alias(n) for n, (k, _) in aggs.items()]).collect()
            assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
        got = ordered.look_back(df, keys, ["ts", "event_id"], {"p1": ("event_id", 1), "p5": ("v", 5)}, partitions).select("event_id", "p1", "p5").collect()
        want = df.select("event_id", F.lag("event_id", 1).over(w).alias("p1"), F.lag("v", 5).over(w).alias("p5")).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def brute_features(context):
    import math
    import statistics

    n = len(context)
    span = context[-1]["t"] - context[0]["t"] if n else 0
    out = [n, n / span * 60 if n > 1 and span > 0 else 0.0]
    for dim in ("user_id", "source_ip", "service"):
        out.append(len({r[dim] for r in context if r[dim]}))
    for dim in ("user_id", "source_ip", "service"):
        counts = {}
        for r in context:
            if r[dim]:
                counts[r[dim]] = counts.get(r[dim], 0) + 1
        h = -sum(c / n * math.log2(c / n) for c in counts.values())
        out.append(h / math.log2(len(counts)) if len(counts) > 1 else h)
    gaps = [b["t"] - a["t"] for a, b in zip(context, context[1:])]
    mean = sum(gaps) / len(gaps) if gaps else 0
    std = statistics.stdev(gaps) if len(gaps) > 1 else 0
    out.append(1 / (1 + std / mean) if mean > 0 else 0.0)
    return out


@pytest.mark.parametrize("keys", [[], ["source_ip"]])
def test_trailing_features_against_brute_force(spark, rows, keys):
    cols = ["freq_event_count", "freq_events_per_minute", "freq_unique_users", "freq_unique_ips", "freq_unique_services", "behavior_user_diversity",
            "behavior_ip_diversity", "behavior_service_diversity", "behavior_pattern_consistency"]
    got = {r.event_id: [float(r[c]) for c in cols] for r in features.trailing_features(make_events(spark, rows), keys or None).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        context = [e for e in rows[:i] if e["t"] >= r["t"] - 300 - 1e-9 and all(e[k] == r[k] for k in keys)]
        assert got[r["event_id"]] == pytest.approx(brute_features(context), abs=1e-6), r


def test_sessions_and_counts_against_brute_force(spark, rows):
    events = make_events(spark, rows)
    got = {r.event_id: (r.time_since_last, r.session_duration) for r in features.session_features(events, 600).collect()}
    counts = {r.event_id: r.recent_count for r in statistical.trailing_counts(events).collect()}
    for i, r in enumerate(rows):
        if r["user_id"] is None:
            assert r["event_id"] not in got and r["event_id"] not in counts
            continue
        earlier = [e for e in rows[:i] if e["user_id"] == r["user_id"]]
        since = r["t"] - earlier[-1]["t"] if earlier else None
        inside = [e for e in earlier if r["t"] - e["t"] < 600 - 1e-9]
        duration = inside[-1]["t"] - inside[0]["t"] if since is not None and since < 600 and len(inside) > 1 else None
        assert got[r["event_id"]][0] == (None if since is None else pytest.approx(since, abs=1e-6))
        assert got[r["event_id"]][1] == (None if duration is None else pytest.approx(duration, abs=1e-6))
        assert counts[r["event_id"]] == 1 + len([e for e in earlier if e["t"] >= r["t"] - 300 - 1e-9])


@pytest.mark.parametrize("seed, n, span", [(1, 300, 4000), (2, 60, 60000), (3, 5, 400), (4, 500, 2000), (5, 1, 10)])
def test_anchored_windows_against_brute_force(spark, seed, n, span):
    rng = random.Random(seed)
    rows = sorted([dict(t=round(rng.choice([rng.uniform(0, span), rng.randint(0, span // 300 + 1) * 300]), 3), user_id="u", source_ip="i") for _ in range(n)], key=lambda r: r["t"])
    starts, start = [rows[0]["t"]], rows[0]["t"]
    for r in rows:
        if r["t"] - start > 300 + 1e-9:
            start = r["t"]
            starts.append(start)
    got = sorted(r.t for r in statistical.anchored_window_starts(make_events(spark, rows)).select(((F.unix_micros("window_start") - 1704499200000000) / 1e6).alias("t")).collect())
    assert got == pytest.approx(starts)


def test_anchored_windows_without_events(spark):
    assert statistical.anchored_window_starts(make_events(spark, [dict(t=1)]).limit(0)).count() == 0


def test_sequences_with_lookback_against_brute_force(spark, rows):
    from threatframe.config import SEQUENCE_PATTERNS

    for lookback in (None, 30):
        got = {(r.event_id, r.pattern_name) for r in behavioral.attack_sequences(make_events(spark, rows), lookback=lookback).collect()}
        want = set()
        for i, r in enumerate(rows):
            if r["user_id"]:
                pool = rows[max(0, i + 1 - lookback):i + 1] if lookback else rows[:i + 1]
                mine = [e for e in pool if e["user_id"] == r["user_id"]]
                for p in SEQUENCE_PATTERNS:
                    last = mine[-len(p.sequence):]
                    if len(last) == len(p.sequence) and last[-1]["t"] - last[0]["t"] <= p.max_seconds and all(a in e["event_type"] for a, e in zip(p.sequence, last)):
                        want.add((r["event_id"], p.name))
        assert got == want and want
