import uuid

import pytest
from conftest import make_events
from pyspark.sql import functions as F

from threatframe.operators import behavioral
from threatframe.streaming import run, state, windows


def as_stream(spark, tmp_path, batches):
    """Each list of rows becomes one file and, with one file per trigger, one micro-batch."""
    folder = str(tmp_path / uuid.uuid4().hex)
    for i, rows in enumerate(batches):
        make_events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def logins(start, n, ip="9.9.9.9"):
    return [dict(event_id=f"{ip}-{start + i}", t=start + i, user_id=f"u{i % 3}", source_ip=ip, event_type="authentication", outcome="failure") for i in range(n)]


def test_login_windows_over_several_batches(spark, tmp_path):
    stream = as_stream(spark, tmp_path, [logins(0, 4), logins(10, 4), logins(5000, 2), logins(9000, 1)])
    rows = run.run_available(windows.rule_findings(windows.login_windows(stream), ["AUTH-001"])).collect()
    assert [(r.source_ips, r.attrs["failed_login_count"], r.attrs["unique_usernames"]) for r in rows] == [(["9.9.9.9"], "8", "3")]


def test_late_rows_are_dropped(spark, tmp_path):
    # Spark judges lateness by the watermark of the batch before, so the late rows come two batches later
    batches = [logins(0, 6), logins(20000, 1), logins(21000, 1), logins(100, 6, "1.1.1.1"), logins(40000, 1)]
    rows = run.run_available(windows.rule_findings(windows.login_windows(as_stream(spark, tmp_path, batches)), ["AUTH-001"])).collect()
    assert [r.source_ips for r in rows] == [["9.9.9.9"]]


def test_duplicates(spark, tmp_path):
    rows = logins(0, 3)
    stream = as_stream(spark, tmp_path, [rows, rows, logins(2, 2)])
    assert run.run_available(windows.without_duplicates(stream)).count() == 4


def test_sequences_across_batches_and_out_of_order(spark, tmp_path):
    kinds = ["authentication", "privilege_escalation", "authorization"]
    rows = [dict(event_id=f"e{u}{i}", t=60 * i, user_id=u, event_type=k) for u in "ab" for i, k in enumerate(kinds)]
    end = [dict(event_id="z", t=50000, user_id="c", event_type="unknown"), dict(event_id="zz", t=90000, user_id="c", event_type="unknown")]
    batches = [[rows[2], rows[3]], [rows[0], rows[4]], [rows[1], rows[5]], [end[0]], [end[1]]]
    got = {(r.event_id, r.pattern_name, r.first_event) for r in run.run_available(state.attack_sequences(as_stream(spark, tmp_path, batches))).collect()}
    want = {(r.event_id, r.pattern_name, r.matched_events[0]) for r in behavioral.attack_sequences(make_events(spark, rows + end)).collect()}
    assert got == want == {("ea2", "Privilege Escalation Chain", "ea0"), ("eb2", "Privilege Escalation Chain", "eb0")}


def test_profiles_and_baselines_keep_state(spark, tmp_path):
    rows = [dict(event_id=f"e{i:02d}", t=10 * i, user_id="a", source_ip="i", service="ssh", event_type="data_access", attributes={"v": i % 3}) for i in range(14)]
    rows.append(dict(event_id="odd", t=90000, user_id="a", source_ip="j", service="vpn", event_type="data_access", attributes={"v": 50}))
    stream = as_stream(spark, tmp_path, [rows[:6], rows[6:12], rows[12:]])
    got = {r.event_id: (r.profile_events, r.deviation_score) for r in run.run_available(state.profile_deviations(stream)).collect()}
    want = {r.event_id: (r.profile_events, r.deviation_score) for r in behavioral.prequential_deviations(make_events(spark, rows)).collect()}
    assert got == want and got["odd"] == (14, pytest.approx(1.0))
    values = as_stream(spark, tmp_path, [rows[:6], rows[6:]]).select(F.lit("v").alias("metric"), "ts", "event_id", F.col("attributes")["v"].alias("value"))
    z = {r.event_id: (r.n, r.z_score) for r in run.run_available(state.running_baselines(values)).collect()}
    assert z["e00"] == (0, 0.0) and z["odd"][0] == 14 and z["odd"][1] > 3


def test_merge_over_batches_equals_one_batch(spark, tmp_path):
    rows = [dict(event_id="x1", t=1, user_id="a", source_ip="i", raw_log="mimikatz"), dict(event_id="x2", t=2, user_id="a", source_ip="i", raw_log="mimikatz now"), dict(event_id="x3", t=3, user_id="b", source_ip="i", raw_log="nmap -sS")]
    columns = ["anomaly_id", "n_members", "threat_score", "certainty", "explanation"]

    def anomalies(folder, parts):
        folder.mkdir()
        stored = run.run_available(windows.signatures(as_stream(spark, folder, parts)), windows.merge_each_batch)
        return stored.select("batch").distinct().count(), sorted(tuple(r) for r in windows.merged(stored).select(columns).collect())

    split, whole = anomalies(tmp_path / "split", [rows[:1], rows[1:2], rows[2:]]), anomalies(tmp_path / "whole", [rows])
    assert split[0] > 1 and whole[0] == 1 and split[1] == whole[1] and len(whole[1]) == 2


def test_sessions_and_frequency(spark, tmp_path):
    stream = as_stream(spark, tmp_path, [logins(0, 3), logins(10000, 1), logins(30000, 1)])
    rows = run.run_available(windows.sessions(stream)).collect()
    assert sorted(r.n_events for r in rows)[-1] == 1 and len(rows) == 4
    counts = run.run_available(windows.frequency_windows(stream, "source_ip")).agg(F.max("event_count")).first()[0]
    assert counts == 3


class Held:
    """State in memory that counts its questions and writes."""

    def __init__(self):
        self.values, self.calls, self.read = {}, 0, 0

    def _call(self, result=None):
        self.calls += 1
        return result

    def exists(self): return self._call("value" in self.values)

    def get(self):
        self.read += len(self.values.get("value", ()))
        return self._call(self.values.get("value", ()))

    def update(self, value): self._call(self.values.update(value=value))

    put = update

    def appendList(self, rows): self._call(self.values.update(value=[*self.values.get("value", ()), *rows]))

    def clear(self): self._call(self.values.clear())

    def containsKey(self, key): return self._call(key in self.values)

    def updateValue(self, key, value): self._call(self.values.update({key: value}))


def test_profiles_ask_for_each_value_once_a_batch():
    import pandas as pd

    rows = pd.DataFrame([(i, f"{i:03d}", str(i % 3), "web", None if i % 2 else "10.0.0.1", "view") for i in range(300)],
                        columns=["ts_us", "event_id", "hour", "service", "source_ip", "event_type"])

    def run(parts):
        made = state.Profiles(5)
        made.total, made.seen, made.any = Held(), Held(), Held()
        out = pd.concat([o for part in parts for o in made.handleInputRows(("u",), iter([part]), None)])
        return out.values.tolist(), made.total.calls + made.seen.calls + made.any.calls, made.seen.values, made.any.values

    one, calls, seen, some = run([rows])
    many, _, *state_of_many = run([rows.iloc[k:k + 1] for k in range(300)])
    # three hours and one value each of the others are written, nothing is asked but whether the user is known
    assert calls <= 6 + 4 + 2
    assert one == many and state_of_many == [seen, some] and len(seen) == 6


def test_sequences_do_not_read_their_own_rows():
    import pandas as pd

    class Timers:
        def listTimers(self): return []

        def registerTimer(self, at): pass

    class Mark:
        def getCurrentWatermarkInMs(self): return 0

    made = state.Sequences(state.SEQUENCE_PATTERNS)
    made.handle, made.waiting, made.tail = Timers(), Held(), Held()
    rows = pd.DataFrame([(10, "b", "view"), (5, "a", "view")], columns=["ts_us", "event_id", "event_type"])
    for k in range(2):
        list(made.handleInputRows(("u",), iter([rows.iloc[k:k + 1]]), Mark()))
    # nothing is ready: a batch reads what waits and appends what is new, and does not read its own rows again
    assert sorted(made.waiting.values["value"]) == [(5, "a", "view"), (10, "b", "view")] and made.waiting.read == 1
