"""Per-key state for streams: attack sequences, profiles, running baselines.

Rows of a key are handled in (ts, event_id) order. Sequences wait for the watermark, so late
rows inside the allowed delay take their place; profiles and baselines score a row against the
state before it and then add it. Sequence state is a few rows per user and expires; profile and
baseline state has the size of the profile itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

from threatframe.config import MIN_SAMPLES, SEQUENCE_PATTERNS, SequencePattern
from threatframe.operators.behavioral import DIMENSIONS

SEQUENCE_OUT = "user_id string, event_id string, ts_us bigint, pattern_name string, pattern_type string, certainty double, first_event string"
PROFILE_OUT = "user_id string, event_id string, profile_events bigint, deviation_score double"
BASELINE_OUT = "metric string, event_id string, value double, n bigint, z_score double"


class Sequences(StatefulProcessor):
    """Matches the last events of a user against the patterns, up to the watermark."""

    def __init__(self, patterns: list[SequencePattern]):
        self.patterns = [(p.name, p.sequence, p.max_seconds * 1_000_000, p.certainty, p.anomaly_type) for p in patterns]
        self.keep = max(len(p.sequence) for p in patterns) - 1

    def init(self, handle):
        row = "ts_us bigint, event_id string, event_type string"
        self.handle = handle
        self.waiting = handle.getListState("waiting", row)
        self.tail = handle.getListState("tail", row)

    def _emit(self, key, timer_values, new: list[tuple] = []) -> Iterator[pd.DataFrame]:
        mark = timer_values.getCurrentWatermarkInMs() * 1000
        rows = sorted([*self.waiting.get(), *new])
        ready = [r for r in rows if r[0] <= mark]
        later = [r for r in rows if r[0] > mark]
        if ready:
            chain, found = list(self.tail.get()), []
            for row in ready:
                chain = (chain + [row])[-(self.keep + 1):]
                for name, sequence, limit, certainty, kind in self.patterns:
                    last = chain[-len(sequence):]
                    if (len(last) == len(sequence) and last[-1][0] - last[0][0] <= limit
                            and all(t[2] is None or s in t[2] for s, t in zip(sequence, last))):
                        found.append((key[0], row[1], row[0], name, kind, certainty, last[0][1]))
            self.tail.put(chain[-self.keep:])
            if found:
                yield pd.DataFrame(found, columns=["user_id", "event_id", "ts_us", "pattern_name", "pattern_type", "certainty", "first_event"])
            if later:
                self.waiting.put(later)
            else:
                self.waiting.clear()
        elif new:
            self.waiting.appendList(new)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if later:
            self.handle.registerTimer(later[0][0] // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues):
        new = [row for batch in rows for row in batch[["ts_us", "event_id", "event_type"]].itertuples(index=False, name=None)]
        yield from self._emit(key, timerValues, new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._emit(key, timerValues)

    def close(self):
        pass


def attack_sequences(events: DataFrame, patterns: list[SequencePattern] = SEQUENCE_PATTERNS, delay: str = "10 minutes") -> DataFrame:
    """Streaming counterpart of :func:`threatframe.operators.behavioral.attack_sequences`."""
    rows = (events.filter("user_id IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", delay)
            .select("user_id", "ts", F.unix_micros("ts").alias("ts_us"), "event_id", "event_type"))
    return rows.groupBy("user_id").transformWithStateInPandas(Sequences(patterns), SEQUENCE_OUT, "Append", "EventTime")


class Profiles(StatefulProcessor):
    """Counts how many events of a user came before and which values were seen."""

    def __init__(self, min_events: int):
        self.min_events = min_events
        self.weights = dict(DIMENSIONS)

    def init(self, handle):
        self.total = handle.getValueState("total", "n bigint")
        self.seen = handle.getMapState("seen", "dimension string, value string", "n bigint")
        self.any = handle.getMapState("any", "dimension string", "n bigint")

    def handleInputRows(self, key, rows, timerValues):
        table = pd.concat(list(rows)).sort_values(["ts_us", "event_id"])
        # the state is asked once for each distinct value of the batch, and never for a new user; each question is a round trip
        new = not self.total.exists()
        n = 0 if new else self.total.get()[0]
        some, seen = {}, set()
        out = []
        for row in table.itertuples(index=False):
            score = 0.0
            for name, weight in self.weights.items():
                value = getattr(row, name)
                if value is None or (isinstance(value, float) and value != value):
                    continue
                place = (name, str(value))
                if place in seen:
                    continue
                seen.add(place)
                if not new and self.seen.containsKey(place):
                    continue
                if name not in some:
                    some[name] = not new and self.any.containsKey((name,))
                if some[name]:
                    score += weight
                else:
                    self.any.updateValue((name,), (1,))
                    some[name] = True
                self.seen.updateValue(place, (1,))
            out.append((key[0], row.event_id, n, min(1.0, score) if n >= self.min_events else 0.0))
            n += 1
        self.total.update((n,))
        yield pd.DataFrame(out, columns=["user_id", "event_id", "profile_events", "deviation_score"])

    def close(self):
        pass


def profile_deviations(events: DataFrame, min_events: int = MIN_SAMPLES) -> DataFrame:
    """Deviation of each event from the events of its user before it, as they arrive."""
    rows = events.filter("user_id IS NOT NULL AND ts IS NOT NULL").select(
        "user_id", F.unix_micros("ts").alias("ts_us"), "event_id", F.hour("ts").cast("string").alias("hour"), "service", "source_ip", "event_type")
    return rows.groupBy("user_id").transformWithStateInPandas(Profiles(min_events), PROFILE_OUT, "Append", "None")


class Baselines(StatefulProcessor):
    """Mean and sum of squared deviations of a metric; a value is scored before it is added."""

    def init(self, handle):
        self.moments = handle.getValueState("moments", "n bigint, mean double, m2 double")

    def handleInputRows(self, key, rows, timerValues):
        table = pd.concat(list(rows)).sort_values(["ts_us", "event_id"])
        n, mean, m2 = self.moments.get() if self.moments.exists() else (0, 0.0, 0.0)
        out = []
        for event_id, value in zip(table["event_id"], table["value"]):
            std = (m2 / (n - 1)) ** 0.5 if n > 1 else 0.0
            out.append((key[0], event_id, value, n, (value - mean) / std if std > 0 else 0.0))
            n += 1
            step = value - mean
            mean += step / n
            m2 += step * (value - mean)
        self.moments.update((n, mean, m2))
        yield pd.DataFrame(out, columns=["metric", "event_id", "value", "n", "z_score"])

    def close(self):
        pass


def running_baselines(values: DataFrame) -> DataFrame:
    """Values (metric, ts, event_id, value) with the z-score against the values of their metric before them.

    Put the entity into ``metric`` (``payload:u1``) to keep one baseline per user or address.
    """
    rows = values.filter("value IS NOT NULL").select("metric", F.unix_micros("ts").alias("ts_us"), "event_id", F.col("value").cast("double").alias("value"))
    return rows.groupBy("metric").transformWithStateInPandas(Baselines(), BASELINE_OUT, "Append", "None")
