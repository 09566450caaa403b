import json
import re

import pytest
from pyspark.sql import functions as F

from threatframe.operators import graph, normalize, rules
from threatframe.sources import tables
from threatframe.sources.json_logs import flatten, json_events, read_json
from threatframe.sources.logs import format_of, read_logs
from threatframe.sources.xml_logs import generic_events


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def events(ingest):
    return ingest.events.orderBy("ts", "event_id").collect()


def test_json_lines_with_bad_rows(spark, tmp_path):
    path = write(tmp_path, "a.json", "\n".join([
        '{"timestamp": "2024-01-06T10:00:00Z", "src_ip": "1.2.3.4", "user": "bob", "message": "Login failed", "a": {"b": [1, {"c": true}, [2]]}}',
        "", "{broken", "7", '{"ts": 1704535300, "msg": "sudo ls", "n": null}', '{"t": 1704535400123, "x": 1}', '{"timestamp": "nonsense", "time": 1704535300}']))
    got = read_logs(spark, path)
    assert sorted(r.value for r in got.rejected.collect()) == ["7", "{broken"]
    rows = {r.message if r.message != r.raw_log else "raw": r for r in got.events.collect()}
    assert len(got.events.collect()) == 4
    first = rows["Login failed"]
    assert (first.user_id, first.source_ip, first.event_type, first.outcome) == ("bob", "1.2.3.4", "authentication", "failure")
    assert str(first.ts) == "2024-01-06 10:00:00" and len(first.event_id) == 16
    assert {k: first.attributes[k] for k in ("a.b[0]", "a.b[1].c", "a.b[2]", "src_ip")} == {"a.b[0]": "1", "a.b[1].c": "true", "a.b[2]": "[2]", "src_ip": "1.2.3.4"}
    assert "timestamp" not in first.attributes
    assert str(rows["sudo ls"].ts) == "2024-01-06 10:01:40" and rows["sudo ls"].event_type == "privilege_escalation"
    stamped = {json.loads(r.raw_log).get("t") or json.loads(r.raw_log).get("time"): r for r in got.events.collect()}
    assert str(stamped[1704535400123].ts) == "2024-01-06 10:03:20.123000"
    assert stamped[1704535300].ts is None and stamped[1704535300].ts_missing
    quality = got.quality().first()
    assert (quality.parsed, quality.errors, quality.success_rate) == (4, 2, pytest.approx(4 / 6))


def test_json_document_layouts(spark, tmp_path):
    one = write(tmp_path, "one.json", json.dumps({"time": "2024/01/06 10:00:00", "msg": "x"}, indent=2))
    many = write(tmp_path, "many.json", json.dumps([{"time": "06/Jan/2024:10:00:0" + str(i), "msg": "x"} for i in range(3)], indent=2))
    flat = write(tmp_path, "flat.json", json.dumps([{"time": "2024-01-06 10:00:00.5", "msg": str(i)} for i in range(4)]))
    assert [str(r.ts) for r in events(read_json(spark, one))] == ["2024-01-06 10:00:00"]
    assert [str(r.ts) for r in events(read_json(spark, many))] == [f"2024-01-06 10:00:0{i}" for i in range(3)]
    assert [r.message for r in events(read_json(spark, flat))] and read_json(spark, flat).events.count() == 4


def test_equal_records_share_an_id_whatever_the_field_order(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2}',), ('{"b": 2, "a": 1}',), ('{"a": 2}',)], "value string")
    assert json_events(df).events.select("event_id").distinct().count() == 2


def test_nothing_is_lost_silently(spark, tmp_path):
    junk = ['{"user":"a"} trailing', '{"user":"a"}] {}', '{"user":"a"},{"user":"b"}', '{"user":"a"}{"user":"b"}', '[{"user":"a"}] x']
    got = read_json(spark, write(tmp_path, "junk.json", "\n".join([*junk, '{"user":"ok"}  '])))
    assert [r.user_id for r in got.events.collect()] == ["ok"] and sorted(r.value for r in got.rejected.collect()) == sorted(junk)
    broken = write(tmp_path, "broken.json", "\n".join(["{broken", *[json.dumps({"user": f"u{i}"}) for i in range(4)]]))
    got = read_json(spark, broken)
    assert got.events.count() == 4 and [r.value for r in got.rejected.collect()] == ["{broken"]


def test_layout_is_decided_for_each_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = "\n".join(json.dumps({"user": f"l{i}"}) for i in range(4))
    array = "[\n" + "\n,\n".join(json.dumps({"user": f"a{i}"}) for i in range(4)) + "\n]"
    for name, text in {"lines.json": lines, "array one.json": array, "flat.json": '[{"user":"f0"}]', "object.json": '{\n"user": "o0"\n}', "empty.json": "", "odd.json": '{"user":"x0"}\n}\n[\n'}.items():
        write(tmp_path / "in", name, text)
    got = read_json(spark, str(tmp_path / "in"))
    assert sorted(r.user_id for r in got.events.collect()) == sorted([f"l{i}" for i in range(4)] + [f"a{i}" for i in range(4)] + ["f0", "o0", "x0"])
    assert sorted(r.value for r in got.rejected.collect()) == ["[", "}"]


def test_deep_records_keep_all_keys(spark):
    text = '{"a":' * 12 + '"x"' + "}" * 12
    row = json_events(spark.createDataFrame([(text,), ('{"m": "[{[{ text", "n": {}}',)], "value string")).events.collect()
    assert {k: v for r in row for k, v in r.attributes.items()} == {".".join("a" * 12): "x", "m": "[{[{ text"}


def test_xml_formats_are_decided_for_each_file(spark, tmp_path):
    (tmp_path / "xml").mkdir()
    for name, text in {"win one.xml": f"<Events>{WIN}</Events>", "sys.xml": "<syslog><Entry><Timestamp>2024-01-06 10:00:00</Timestamp><Message>m1</Message></Entry></syslog>",
                       "own.xml": '<Logs><Log UserID="u1"/><Log UserID="u2" />\n<Log><UserID>u3</UserID></Log><Log UserID="u4"/></Logs>',
                       "prefixed.xml": "<e:Events>" + re.sub(r"<(/?)(?=\w)", r"<\1e:", WIN).replace("xmlns=", "xmlns:e=") + "</e:Events>", "junk.xml": "no tags"}.items():
        write(tmp_path / "xml", name, text)
    got = read_logs(spark, str(tmp_path / "xml"), "xml")
    assert sorted((r.source_format, r.user_id) for r in got.events.select("source_format", "user_id").fillna("").collect()) == sorted(
        [("xml_windows_event", "bob"), ("xml_windows_event", "bob"), ("xml_syslog", ""), *[("xml_generic", f"u{i}") for i in range(1, 5)]])
    assert [r.value for r in got.rejected.collect()] == ["no tags"]


def test_flatten_depth_loses_nothing(spark):
    df = spark.createDataFrame([('{"a": {"b": {"c": {"d": 1}}}, "e": {}, "f": []}',)], "value string").select(F.try_parse_json("value").alias("v"))
    assert df.select(flatten(F.col("v"), 1)).first()[0] == {"a.b": '{"c":{"d":1}}'}
    assert df.select(flatten(F.col("v"), 6)).first()[0] == {"a.b.c.d": "1"}


def test_cloudtrail_and_windows_json(spark, tmp_path):
    record = lambda n: {"eventTime": f"2024-01-06T10:00:0{n}Z", "eventName": "ConsoleLogin error", "userIdentity": {"userName": f"u{n}"}, "sourceIPAddress": "1.1.1.1"}
    path = write(tmp_path, "trail.json", json.dumps({"Records": [record(1), record(2)]}))
    rows = events(read_logs(spark, path, "cloudtrail"))
    assert [(r.user_id, r.source_ip, r.event_type, r.outcome) for r in rows] == [(f"u{n}", "1.1.1.1", "authentication", "failure") for n in (1, 2)]
    path = write(tmp_path, "win.json", json.dumps({"TimeCreated": {"@SystemTime": "2024-01-06T10:00:00Z"}, "Message": "hello", "Id": 1}) + "\n"
                 + json.dumps({"TimeCreated": "2024-01-06T10:00:01Z", "Message": "hello", "Id": 2}))
    assert [str(r.ts)[-2:] for r in events(read_logs(spark, path, "windows_json"))] == ["00", "01"]


def test_wrapped_export(spark, tmp_path):
    def exported(i):
        values = {"timestamp": f"2026-04-03T02:42:0{i}.561694", "event_type": "web_access", "source_ip": f"192.168.1.{i}", "url": f"/api?id={i}' OR '1'='1",
                  "response_code": 403, "message": "SQL injection attempt detected"}
        return {"event_id": f"evt_{i}", "timestamp": values["timestamp"], "source_format": "json", "event_type": "data_access", "source_ip": values["source_ip"],
                "user_id": None, "attributes": {k: {"value": v, "certainty": 1.0} for k, v in values.items()}, "time_features": {"hour": 2}, "frame": {"name": "x"}}

    path = write(tmp_path, "export.json", json.dumps([exported(i) for i in range(4)], indent=2))
    rows = read_json(spark, path, wrapped=True)
    got = events(rows)
    assert [(r.event_id, r.source_ip, r.event_type) for r in got] == [(f"evt_{i}", f"192.168.1.{i}", "data_access") for i in range(4)]
    assert all(r.attributes["response_code"] == "403" and r.message.startswith("SQL injection") for r in got)
    assert not any("certainty" in k or k.startswith(("time_features", "frame")) for r in got for k in r.attributes)
    from threatframe.operators import signature

    found = {r.anomaly_type for r in signature.detect(normalize.normalize(rows.events)).collect()}
    assert "sql_injection" in found


WIN = ('<Event xmlns="http://schemas.microsoft.com/win/2004/08/events/event"><System><EventID Qualifiers="0">4625</EventID><TimeCreated SystemTime="2024-01-06T10:00:00.1234567Z"/>'
       '<Level>0</Level><Computer>pc</Computer></System><EventData><Data Name="TargetUserName">bob</Data><Data Name="IpAddress">1.2.3.4</Data></EventData>'
       '<RenderingInfo Culture="en"><Message>An account failed to log on.</Message></RenderingInfo></Event>')


def test_windows_xml(spark, tmp_path):
    path = write(tmp_path, "win.xml", f"<?xml version='1.0'?>\n<Events>\n{WIN}\n{WIN.replace('4625', '4624')}\n<Event><System></Event></Events>")
    got = read_logs(spark, path)
    rows = {r.attributes["event_id"]: r for r in got.events.collect()}
    assert got.rejected.count() == 1
    r = rows["4625"]
    assert (r.user_id, r.source_ip, r.event_type, r.outcome, r.message) == ("bob", "1.2.3.4", "authentication", "failure", "An account failed to log on.")
    assert r.event_id == "win_4625_1704535200.123456" and r.attributes["computer"] == "pc" and r.raw_log.startswith("<Event")
    assert rows["4624"].outcome == "success"


def test_syslog_xml(spark, tmp_path):
    path = write(tmp_path, "sys.xml", "<syslog><Entry><Timestamp>2024-01-06 10:00:00</Timestamp><Message>m1</Message><Severity>3</Severity></Entry>"
                 "<Entry><timestamp>2024-01-06</timestamp><msg>m2</msg><host>h</host></Entry></syslog>")
    rows = {r.message: r for r in read_logs(spark, path).events.collect()}
    assert rows["m1"].attributes == {"message": "m1", "severity": "3", "facility": "0", "hostname": "unknown"}
    assert rows["m2"].attributes["hostname"] == "h" and rows["m2"].attributes["severity"] == "6"
    assert rows["m1"].event_id == "syslog_1704535200.0"
    out = normalize.normalize(read_logs(spark, path).events)
    assert {r.message: r.severity_normalized for r in out.collect()} == {"m1": "high", "m2": "low"}


def test_generic_xml(spark, tmp_path):
    log = lambda i: (f'<Log><EventID>00{i}</EventID><Timestamp>2024-01-06T10:00:0{i}</Timestamp><SourceIP>1.1.1.{i}</SourceIP><UserID>u{i}</UserID><Service>ssh</Service>'  # noqa: E731
                     f'<Attributes kind="k"><Attribute name="url">/x?{i}</Attribute><Attribute name="code">0{i}</Attribute></Attributes></Log>')
    path = write(tmp_path, "gen.xml", f"<Logs>{log(1)}\n{log(2)}</Logs>")
    rows = events(read_logs(spark, path))
    assert [(r.event_id, r.user_id, r.source_ip, r.service) for r in rows] == [(f"00{i}", f"u{i}", f"1.1.1.{i}", "ssh") for i in (1, 2)]
    assert rows[1].attributes["url"] == "/x?2" and rows[1].attributes["code"] == "02" and rows[1].attributes["Attributes_kind"] == "k"
    lines = write(tmp_path, "lines.xml", "<a><user>x</user><time>2024-01-06</time></a>\nnoise\n<a><user>y</user></a>\n<a><user>\n")
    got = read_logs(spark, lines)
    assert sorted(r.user_id for r in got.events.collect()) == ["x", "y"] and got.rejected.count() == 1
    df = spark.createDataFrame([("<r><app>web</app></r>",), ("junk",)], "value string")
    assert [r.service for r in generic_events(df).events.collect()] == ["web"] and generic_events(df).rejected.count() == 1


def test_cef(spark, tmp_path):
    path = write(tmp_path, "x.log", "CEF:0|v|p|1.0|100|Login|5|src=1.1.1.1 duser=bob a=1 a=2=3 rt=2024-01-06T10:00:00Z odd\nnot cef\n\nCEF:0|v|p\n")
    got = read_logs(spark, path, "cef")
    r = got.events.first()
    assert (r.event_id, r.source_ip, r.user_id, str(r.ts)) == ("100", "1.1.1.1", "bob", "2024-01-06 10:00:00")
    assert r.attributes["a"] == "2=3" and r.attributes["name"] == "Login" and got.rejected.count() == 2


def test_formats(spark):
    assert [format_of(p) for p in ("a.json", "B.XML", "c.evtx", "d.log")] == ["json", "xml", "xml", "json"]
    with pytest.raises(ValueError):
        read_logs(spark, "x", "csv")


def test_events_and_knowledge_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('{"time": "2024-01-06T10:00:00.25Z", "user": "bob", "service": "ssh", "message": "Login failed", "src_ip": "1.1.1.1"}',)], "value string")
    rows = json_events(df).events
    for fmt in ("parquet", "json"):
        tables.write_events(rows, str(tmp_path / fmt), fmt)
        back = tables.read_events(spark, str(tmp_path / fmt), fmt).first()
        assert (back.event_id, back.user_id, back.ts, back.attributes) == tuple(rows.select("event_id", "user_id", "ts", "attributes").first())
    tables.write_events(rows, str(tmp_path / "xml"), "xml")
    back = read_logs(spark, str(tmp_path / "xml"), "xml").events.first()
    assert (back.user_id, back.source_ip, back.event_type, str(back.ts), back.attributes["message"]) == ("bob", "1.1.1.1", "authentication", "2024-01-06 10:00:00.250000", "Login failed")
    tables.write_knowledge(spark, str(tmp_path / "kb"))
    nodes, edges = tables.read_graph(spark, str(tmp_path / "kb"))
    assert nodes.count() == 28 and {r.attack for r in graph.related_attacks(spark.createDataFrame([("multiple_failed_logins",)], "indicator string"), edges).collect()} == {"brute_force"}
    assert spark.read.json(str(tmp_path / "kb" / "rules")).count() == 22 == len(rules.RULES)


def test_xml_leaves_keep_their_text(spark):
    from threatframe.sources.xml_logs import generic_events

    element = """<?xml version="1.0"?><Log id="007"><User>007</User><Service>1.10</Service><Code> 1e5 </Code><Flag>true</Flag><Raw><![CDATA[0x1 < 2]]></Raw><Note>a="1" &gt; b</Note></Log>"""
    row = generic_events(spark.createDataFrame([(element,)], "value string")).events.first()
    assert row.user_id == "007" and row.service == "1.10"
    got = row.attributes
    assert {k: got[k].strip() for k in ("User", "Service", "Code", "Flag", "Raw", "Note", "id")} == {"User": "007", "Service": "1.10", "Code": "1e5", "Flag": "true", "Raw": "0x1 < 2", "Note": 'a="1" > b', "id": "007"}
