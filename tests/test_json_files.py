"""JSON files of any layout, cut by many tasks, against the json library."""

import json
import random

import pytest
from pyspark.sql import functions as F

from threatframe.sources import json_files
from threatframe.sources.json_logs import read_json


@pytest.fixture
def small_splits(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def record(i, r):
    odd = r.choice(['a"b', "x}y{", "[,]", "\\", '{"q":"}"}', 'é\n"', "", "}\n{", '\\"'])
    return {"user": f"u{i}", "t": odd, "n": {"k": [{"z": i}, [1, {"y": "}"}]], "e": {}}, "m": [{"Records": 1}] if r.random() < 0.2 else None}


def lined(rows, by=1):
    return "\n".join(json.dumps(rows[i : i + by] if by > 1 else rows[i]) for i in range(0, len(rows), by))


LAYOUTS = {
    "lines": lined,
    "line ends of two characters": lambda rows: lined(rows).replace("\n", "\r\n") + "\r\n",
    "objects over lines": lambda rows: "\n".join(json.dumps(x, indent=1) for x in rows),
    "array": json.dumps,
    "array over lines": lambda rows: json.dumps(rows, indent=2) + "\n",
    "array of lines": lambda rows: "[\n" + ",\n".join(map(json.dumps, rows)) + "\n]\n",
    "commas before": lambda rows: "[" + "\n,".join(map(json.dumps, rows)) + "]",
    "arrays in lines": lambda rows: lined(rows, 3),
    "mixed": lambda rows: json.dumps(rows[:5], indent=2) + "\n" + lined(rows[5:9]) + "\n[]\n" + json.dumps(rows[9:12]) + "\n" + "\n".join(json.dumps(x, indent=1) for x in rows[12:]),
    "trail": lambda rows: json.dumps({"a": [{"b": 1}], "Records": rows, "z": [{"c": 2}]}),
    "trail over lines": lambda rows: json.dumps({"Records": rows, "z": {"c": [2, {}]}}, indent=1),
    "trails in lines": lambda rows: "\n".join(json.dumps({"Records": rows[i : i + 4]}) for i in range(0, len(rows), 4)),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(spark, tmp_path, small_splits, layout):
    split = 5000 if layout in ("array", "mixed") else 90
    r = random.Random(split + len(layout))
    rows = [record(i, r) for i in range(25)]
    path = tmp_path / "in.json"
    path.write_bytes(LAYOUTS[layout](rows).encode())
    small_splits(split)
    got = read_json(spark, str(path), flavour="cloudtrail" if layout.startswith("trail") else None)
    form = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(form(json.loads(x.raw_log)) for x in got.events.select("raw_log").collect()) == sorted(map(form, rows))
    assert got.rejected.collect() == []


def test_broken_parts_are_rejected_and_nothing_else(spark, tmp_path, small_splits):
    good = lambda i: json.dumps({"user": f"u{i}"})
    text = "\n".join([good(0), '{"user": "cut', good(1), '{"a": {"b": 1}', good(2), "}", "junk", good(3), '{"a": [', good(4), "[" + good(5) + "] x", good(6), '{"a": }', '"open', good(7)])
    (tmp_path / "lines.json").write_text(text)
    (tmp_path / "array.json").write_text("[\n" + ",\n".join([good(8), "5", '{"a": }', good(9), '"s"']) + "\n]")
    for split in (40, 10_000):
        small_splits(split)
        got = read_json(spark, str(tmp_path))
        assert sorted(x.user_id for x in got.events.collect()) == ["u0", "u1", "u2", "u3", "u4", "u6", "u7", "u8", "u9"]
        rejected = sorted(x.value.rstrip(",") for x in got.rejected.collect())
        assert rejected == sorted(['{"user": "cut', '{"a": {"b": 1}', "}", "junk", '{"a": [', "[" + good(5) + "] x", '{"a": }', '"open', "5", '{"a": }', "s"])


def test_one_long_line_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "big.json"
    rows = [{"user": f"u{i}", "pad": "x" * 40} for i in range(60_000)]
    path.write_text(json.dumps(rows))
    small_splits(400_000)
    pieces = json_files.pieces(spark, str(path), None)
    assert pieces.select("block").distinct().count() >= 8 and pieces.agg(F.max(F.length("value"))).first()[0] < 200
    texts = json_files.texts(spark, str(path))
    assert texts.count() == 60_000 and texts.agg(F.max(F.length("value"))).first()[0] < 200
    assert read_json(spark, str(path)).events.select("user_id").distinct().count() == 60_000


def test_records_longer_than_allowed_are_rejected_in_parts(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(json_files, "MOST", 500)
    big = {"user": "big", "items": [{"n": i} for i in range(200)]}
    (tmp_path / "a.json").write_text(lined([{"user": "a"}, big, {"user": "b"}]))
    small_splits(100)
    got = read_json(spark, str(tmp_path))
    assert sorted(x.user_id for x in got.events.collect()) == ["a", "b"] and got.rejected.count() > 5


def test_files_without_records(spark, tmp_path):
    for name, text in {"empty": "", "blank": " \n\n", "numbers": "[1, 2, 3]", "nothing": "[]", "words": "a b\nc"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = read_json(spark, str(tmp_path))
    assert got.events.count() == 0 and sorted(x.value for x in got.rejected.collect()) == ["1", "2", "3", "a b", "c"]


def test_texts_are_cut_in_one_pass(spark):
    from threatframe.sources.json_logs import cut_records

    rows = [('{"a": 1}, {"b": "x, y"}', True), ('{"a": 1} {', True), ('[{"c": 1}, {"d": [2]}]', False), ('{"e":\n 1}', False),
            ('{"f": 1\r\n[{"g": 1}]\n\n', False), ("null, 7", True), ('{"Records": [{"h": 1}]}', False), ("[1", False), (None, False), (" ", True)]
    texts = spark.createDataFrame(rows, "value string, listed boolean")
    got = cut_records(texts, "Records")
    assert "Union" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["value"] for r in got.collect()) == sorted(
        ['{"a":1}', '{"b":"x, y"}', '{"a": 1} {', '{"c":1}', '{"d":[2]}', '{"e":\n 1}', '{"f": 1', '{"g":1}', "7", '{"h":1}', "[1"])
