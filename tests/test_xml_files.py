"""XML files of any layout, cut by many tasks, against a scan of the whole text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from threatframe.sources import xml_files
from threatframe.sources.xml_logs import element_paths, file_kinds, kind_of, read_xml


@pytest.fixture
def splits(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def found(spark, path, names):
    rows = xml_files.texts(spark, str(path), names).collect()
    return sorted(r.value for r in rows if r.record), sorted(r.value for r in rows if not r.record)


ODD = ["", "<!-- <Log><User>no</User></Log> -->", "<![CDATA[</Log><Log>]]>", "<?pi <Log> ?>", '<a x="1>2" y=\'"\'/>', "<Entry>field</Entry>", "a > b", "<Logs/>", "<b x='>'>é</b>", "\n  "]


def test_all_layouts_and_splits(spark, tmp_path, splits):
    r = random.Random(5)
    records = []
    for i in range(120):
        tag = r.choice(["Log", "Log", "Entry", "n:record"])
        inside = "".join(o if tag != "Entry" else o.replace("Entry", "Other") for o in r.choices(ODD, k=3))
        kind = r.random()
        records.append(f'<{tag} i="{i}>"/>' if kind < 0.1 else f"<{tag}\n i='{i}'>{inside}<User>u{i}</User></{tag} >")
    outside = ["", "\n", " ", "<!-- <Log/> -- > <Entry> -->", "<?x <Log/>?>", "<group a='<'/>".replace("<'", "x'"), "<Group>", "</Group>"]
    text = "<?xml version='1.0'?><!DOCTYPE Logs [<!ELEMENT Log (a)>\n<!-- <Log/> -->]>\n<Logs>" + "".join(r.choice(outside) + x for x in records) + "</Logs>\n"
    (tmp_path / "a.xml").write_text(text)
    for split in (37, 150, 1000, 100_000):
        splits(split)
        assert found(spark, tmp_path / "a.xml", ["Log", "Entry", "record"]) == (sorted(records), [])


def test_rejected_texts_nested_and_open_records(spark, tmp_path, splits):
    texts = {
        "junk": ("<Logs>\n<Log>1</Log>\njunk line\n<Log>2</Log><x>lost</x></Logs>tail", ["<Log>1</Log>", "<Log>2</Log>"], ["junk line", "lost", "tail"]),
        "nested": ("<Logs><Log>a<Log>b</Log>c</Log></Logs>", ["<Log>ac</Log>", "<Log>b</Log>"], []),
        "root of that name": ("<Log v='1'>\n<Entry>1</Entry> junk\n<Entry>2</Entry></Log>", ["<Entry>1</Entry>", "<Entry>2</Entry>"], ["junk"]),
        "root alone": ("<Log><User>x</User></Log>", ["<Log><User>x</User></Log>"], []),
        "never closed": ("<Logs><Log>1<Log>2</Log><Log>3</Log></Logs>", ["<Log>2</Log>", "<Log>3</Log>"], ["<Log>1</Logs>"]),
        "closed without being open": ("<Logs><Log>1</Log></Log><Log>2</Log></Logs>", ["<Log>1</Log>", "<Log>2</Log>"], ["</Log>"]),
        "quote never closed": ("<Logs><Log a='1><b/></Log><Log>2</Log></Logs>", ["<Log>2</Log>", "<Log a='1><b/></Log>"], []),
        "end cut off": ("<Logs><Log>1</Log><Log>2</Lo", ["<Log>1</Log>"], ["<Log>2</Lo>"]),
        "empty": ("", [], []),
    }
    for split in (5, 16, 10_000):
        splits(split)
        for n, (name, (text, good, bad)) in enumerate(texts.items()):
            path = tmp_path / f"{n}.xml"
            path.write_text(text)
            assert found(spark, path, ["Log", "Entry"]) == (sorted(good), sorted(bad)), (name, split)


def test_mixed_tags_comments_and_prefixes_of_the_root(spark, tmp_path):
    (tmp_path / "mixed.xml").write_text("<Logs><Log><User>a</User></Log><!-- <Log><User>no</User></Log> --><Event><User>b</User></Event>\nodd\n<Entry><User>c</User></Entry></Logs>")
    (tmp_path / "prefix.xml").write_text('<x:Logs xmlns:x="urn:x"><x:Log><x:User>d</x:User></x:Log><x:Log x:User="e"/></x:Logs>')
    got = read_xml(spark, str(tmp_path))
    assert sorted(r.user_id for r in got.events.collect()) == ["a", "b", "c", "d", "e"]
    assert [r.value for r in got.rejected.collect()] == ["odd"]


def test_shape_comes_from_all_records(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<G><Log><User>a</User><n:A n:name="url" xmlns:n="u">7</n:A></Log></G>\n<G><p:Log><p:user>b</p:user><B>1</B><B k="2">3</B></p:Log><Log><User>c</User><bad></Log><Log/></G>')
    got = read_xml(spark, str(tmp_path / "a.xml"), kind="generic")
    rows = {r.user_id: r.attributes for r in got.events.collect()}
    assert set(rows) == {"a", "b", None} and (rows["a"]["A"], rows["a"]["A_name"]) == ("7", "url") and (rows["b"]["B"], rows["b"]["B_k"]) == ("3", "2")
    assert [r.value for r in got.rejected.collect()] == ["<Log><User>c</User><bad></Log>"]


def test_element_paths():
    assert element_paths('<x:a x:k="1" xmlns:x="u">t<b/><b> <c>1</c></b></x:a>') == {("", "@k"), ("", "#"), ("b", ""), ("b", "*"), ("b/c", ""), ("b/c", "#")}
    assert element_paths("<a><b></a>") == element_paths("") == set()


def test_one_long_line_is_read_by_many_tasks(spark, tmp_path, splits):
    path = tmp_path / "big.xml"
    path.write_text("<Logs>" + "".join(f"<Log><User>u{i}</User><pad>{'x' * 20}</pad></Log>" for i in range(40_000)) + "</Logs>")
    splits(300_000)
    assert xml_files.pieces(spark, str(path), ["Log"]).select("block").distinct().count() >= 6
    got = xml_files.texts(spark, str(path), ["Log"])
    assert got.filter("record").count() == 40_000 == got.count() and got.agg(F.max(F.length("value"))).first()[0] < 100


def test_records_longer_than_allowed_are_rejected_in_parts(spark, tmp_path, splits, monkeypatch):
    monkeypatch.setattr(xml_files, "MOST", 300)
    (tmp_path / "a.xml").write_text("<Logs><Log>a</Log><Log>" + "<b>1</b>" * 200 + "</Log><Log>c</Log></Logs>")
    splits(100)
    good, bad = found(spark, tmp_path / "a.xml", ["Log"])
    assert good == ["<Log>a</Log>", "<Log>c</Log>"] and len(bad) > 5 and "".join(bad).count("<b>1</b>") >= 180


def test_plain_pieces_are_only_those_that_change_nothing(spark, tmp_path):
    r = random.Random(1)
    text = "".join(r.choice(["<", ">", "/", '"', "'", " ", "a", "Log", "--", "!", "]]", "[", "?", "<Log", "</Log>", "<b x='", "<!--", "-->", "<![CDATA["]) for _ in range(6000))
    (tmp_path / "a.xml").write_text(text)
    names = frozenset(["Log"])
    for row in xml_files.pieces(spark, str(tmp_path / "a.xml"), ["Log"]).filter("plain").collect():
        for state in xml_files.STATES:
            one, two = xml_files.Outline(state, names), xml_files.Outline(state, names)
            one.plain()
            two.take(row.value + ">")
            assert (one.state, one.closes, one.stack) == (two.state, two.closes, two.stack), (state, row.value)
    assert re.search("Log", text)


def test_kinds_of_files(spark, tmp_path):
    files = {
        "lines": ("<a><user>x</user></a>\n<a><user>y</user></a>\n", ("lines", ())),
        "lines with declaration": ("<?xml version='1.0'?>\n<a x='1'/>\nnoise\n<a/>", ("lines", ())),
        "one line": ("<Logs><Log><u>1</u></Log><Log/></Logs>\n", ("generic", ("Log",))),
        "over lines": ("<!-- <Event/> -->\n<Logs>\n<Log>\n</Log>\n<Entry/>\n</Logs>", ("generic", ("Log", "Entry"))),
        "closed over lines": ("<a>\n</a>\n<b>\n</b>", ("generic", ("a",))),
        "windows": ("<?xml version='1.0'?><Events><Event>\n</Event></Events>", ("windows", ("Event",))),
        "syslog": ("<syslog><Entry/></syslog>", ("syslog", ("Entry",))),
        "envelope": ("<s:Envelope><Entry/></s:Envelope>", ("syslog", ("Entry",))),
        "junk": ("no tags", ("generic", ())),
    }
    for name, (text, _) in files.items():
        (tmp_path / f"{name}.xml").write_text(text)
    got = {r["file"].rsplit("/", 1)[-1].replace("%20", " ")[:-4]: kind_of(r, "auto", None) for r in file_kinds(spark, str(tmp_path)).collect()}
    assert got == {name: kind for name, (_, kind) in files.items()}


def test_the_kind_of_a_file_is_found_without_its_pieces_in_one_task(spark, tmp_path):
    from threatframe.sources import xml_logs

    (tmp_path / "one.xml").write_text("<Logs>" + "<Log><EventID>1</EventID></Log>" * 50 + "</Logs>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large files
    try:
        found = xml_logs.file_kinds(spark, str(tmp_path))
        plan = found._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [(r["root"]["tag"], r["root"]["whole"], r["tags"]) for r in found.collect()] == [("Logs", True, ["Log"])]
    # pieces are joined where they are read and not dealt by file
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
