"""XML logs: Windows events, syslog entries, generic elements, one element per line, text columns."""

from __future__ import annotations

from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from threatframe.config import XML_EVENT_TAGS
from threatframe.operators.typing import windows_event_type
from threatframe.sources.common import EVENT_SCHEMA, Ingest, as_events, epoch_text, text_timestamp
from threatframe.sources.json_logs import flatten, levels
from threatframe.sources.xml_files import texts

OPTIONS = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "columnNameOfCorruptRecord": "_corrupt_record",
           "inferSchema": "false"}
WINDOWS = ("System struct<EventID: string, TimeCreated: struct<_SystemTime: string, _VALUE: string>, Level: string, "
           "Computer: string>, EventData struct<Data: array<struct<_Name: string, _VALUE: string>>>, "
           "RenderingInfo struct<Message: string>, _corrupt_record string")
# a private-use character, taken out of the values again
MARK = "\ue000"
SYSLOG_TAGS = {"timestamp": ["Timestamp", "timestamp"], "message": ["Message", "message", "msg"],
               "severity": ["Severity", "severity", "priority"], "facility": ["Facility", "facility"],
               "hostname": ["Hostname", "hostname", "host"]}


def parse_once(rows: DataFrame, parsed: Column) -> DataFrame:
    """(value, x): the parsed form through a generator, so that filters on it do not parse again."""
    return rows.select("value", F.explode_outer(F.array(parsed)).alias("x"))


def _parsed(rows: DataFrame, schema: str, source: str) -> tuple[DataFrame, DataFrame]:
    rows = parse_once(rows, F.from_xml("value", schema, OPTIONS))
    bad = F.col("x._corrupt_record").isNotNull() | F.col("x").isNull()
    return rows.filter(~bad), rows.filter(bad).select(F.lit(source).alias("source"), "value")


def windows_events(rows: DataFrame, column: str = "value") -> Ingest:
    """Events from a column of ``<Event>`` elements."""
    good, rejected = _parsed(rows.select(F.col(column).alias("value")), WINDOWS, "xml_windows_event")
    system = F.col("x.System")
    number = F.coalesce(system["EventID"], F.lit("0"))
    ts = text_timestamp(F.coalesce(system["TimeCreated"]["_SystemTime"], system["TimeCreated"]["_VALUE"]))
    message = F.coalesce(F.col("x.RenderingInfo.Message"), F.lit(""))
    pairs = F.filter(F.coalesce(F.col("x.EventData.Data"), F.array().cast("array<struct<_Name:string,_VALUE:string>>")),
                     lambda d: d["_Name"].isNotNull())
    data = F.transform(pairs, lambda d: F.struct(d["_Name"].alias("key"), d["_VALUE"].alias("value")))
    fixed = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in {
        "event_id": number, "level": F.coalesce(system["Level"], F.lit("0")),
        "computer": F.coalesce(system["Computer"], F.lit("unknown")), "message": message}.items()])

    def named(*names):
        hits = F.filter(pairs, lambda d: F.lower(d["_Name"]).isin(*names))
        return F.nullif(F.try_element_at(hits, F.lit(-1))["_VALUE"], F.lit(""))

    good = good.filter(system.isNotNull())
    kind = windows_event_type(number)
    events = as_events(
        good, event_id=F.concat_ws("_", F.lit("win"), number, epoch_text(ts)), ts=ts, raw_log=F.col("value"),
        source_format=F.lit("xml_windows_event"), user_id=named("targetusername", "subjectusername"),
        source_ip=named("ipaddress", "clientaddress"), event_type=kind, message=message,
        outcome=F.when(number == "4624", "success").when(number == "4625", "failure"),
        attributes=F.map_from_entries(F.concat(fixed, data)))
    return Ingest(events, rejected)


def syslog_events(rows: DataFrame, column: str = "value") -> Ingest:
    """Events from a column of ``<Entry>`` elements."""
    tags = [t for names in SYSLOG_TAGS.values() for t in names]
    rows = rows.select(F.col(column).alias("value"))
    # tags differing only in case need two schemas, since column names ignore case
    lower = [t for t in tags if t.islower()]
    upper = [t for t in tags if not t.islower()]
    parsed = parse_once(rows, F.struct(F.from_xml("value", _strings(upper), OPTIONS).alias("u"),
                                       F.from_xml("value", _strings(lower), OPTIONS).alias("l"))).select("value", "x.*")
    bad = F.col("u._corrupt_record").isNotNull()
    rejected = parsed.filter(bad).select(F.lit("xml_syslog").alias("source"), "value")

    def first(field, default=None):
        values = [F.col("l" if t.islower() else "u")[t] for t in SYSLOG_TAGS[field]]
        return F.coalesce(*values, *([F.lit(default)] if default is not None else []))

    ts = text_timestamp(first("timestamp"))
    fields = {"message": first("message", ""), "severity": first("severity", "6"), "facility": first("facility", "0"),
              "hostname": first("hostname", "unknown")}
    events = as_events(
        parsed.filter(~bad), event_id=F.concat(F.lit("syslog_"), epoch_text(ts)), ts=ts, raw_log=F.col("value"),
        source_format=F.lit("xml_syslog"), event_type=F.lit("unknown"), message=fields["message"],
        attributes=F.create_map(*[c for k, v in fields.items() for c in (F.lit(k), v)]))
    return Ingest(events, rejected)


def _strings(names: list[str]) -> str:
    return ", ".join(f"{n} string" for n in [*names, "_corrupt_record"])


def flat_struct(schema: T.StructType, column: str) -> list[tuple[str, Column]]:
    """Leaves of a parsed element as (name, text): ``a_b`` for nested elements, ``a_key`` for attributes.

    Of repeated elements the last one counts, besides one entry per ``name`` attribute, which
    :func:`generic_events` adds.
    """
    leaves = []

    def walk(data_type, value: Column, prefix: str):
        if isinstance(data_type, T.ArrayType):
            walk(data_type.elementType, F.try_element_at(value, F.lit(-1)), prefix)
        elif isinstance(data_type, T.StructType):
            for field in data_type.fields:
                if field.name == "_VALUE":
                    leaves.append((prefix.rstrip("_"), value[field.name]))
                else:
                    walk(field.dataType, value[field.name], prefix + field.name.lstrip("_") + "_")
        else:
            leaves.append((prefix.rstrip("_"), value.cast("string")))

    for field in schema.fields:
        if field.name != "_corrupt_record":
            walk(field.dataType, F.col(column)[field.name], field.name.lstrip("_") + "_")
    return leaves


def named_values(schema: T.StructType, column: str) -> list[Column]:
    """Arrays of (name attribute, text) of repeated elements such as ``<Attribute name="x">1</Attribute>``."""
    found = []

    def walk(data_type, value: Column):
        if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType):
            names = {f.name.lower(): f.name for f in data_type.elementType.fields}
            if "_name" in names and "_value" in names:
                found.append(F.transform(value, lambda e: F.struct(e[names["_name"]].alias("key"), e[names["_value"]].alias("value"))))
        elif isinstance(data_type, T.StructType):
            for field in data_type.fields:
                walk(field.dataType, value[field.name])

    for field in schema.fields:
        walk(field.dataType, F.col(column)[field.name])
    return [F.filter(F.coalesce(a, F.array().cast("array<struct<key:string,value:string>>")), lambda e: e["key"].isNotNull()) for a in found]


def marked(value: Column) -> Column:
    """The element with a mark before every text and attribute value, so that a parser which infers types leaves them as text."""
    body = F.regexp_replace(value, r"(?s)<\?.*?\?>", "")
    body = F.regexp_replace(body, r"(?s)>(\s*)([^<\s][^<]*)<", f">$1{MARK}$2<")
    return F.regexp_replace(F.regexp_replace(body, r"<!\[CDATA\[", f"<![CDATA[{MARK}"), r"(\s[\w:.-]+\s*=\s*[\"'])", f"$1{MARK}")


def generic_events(rows: DataFrame, column: str = "value", schema: T.StructType | None = None) -> Ingest:
    """Events from a column of elements of any shape.

    Values keep the text they have. With ``schema`` (see :func:`infer_schema`) the element is parsed to
    that shape, without it to a variant whose leaves are text.
    """
    rows = rows.select(F.col(column).alias("value"))
    if schema is not None:
        fields = [f for f in schema.fields if f.name != "_corrupt_record"]
        full = T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])
        parsed = parse_once(rows, F.from_xml("value", _ddl(full), OPTIONS))
        bad = F.col("x._corrupt_record").isNotNull() | F.col("x").isNull()
        entries = F.array(*[F.struct(F.lit(n).alias("key"), F.trim(v).alias("value")) for n, v in flat_struct(T.StructType(fields), "x")])
        flat = F.map_from_entries(F.filter(F.concat(entries, *named_values(T.StructType(fields), "x")), lambda e: e["value"].isNotNull()))
    else:
        checked = parse_once(rows, F.from_xml("value", "_corrupt_record string", OPTIONS))
        # in a lambda: the code that Spark generates for this parser alone does not compile, and all of the stage would be interpreted
        text = F.when(F.col("x").isNotNull() & F.col("x._corrupt_record").isNull(), marked(F.col("value")))
        parsed = parse_once(checked, F.transform(F.array(text), lambda t: F.struct(
            t.isNull().alias("bad"), F.from_xml(t, F.lit("variant"), {"ignoreNamespace": "true"}).alias("x")))[0])
        parsed = parsed.select("value", "x.bad", "x.x")
        bad = F.col("bad")
        leaves = F.transform_values(flatten(F.col("x"), levels(F.col("value"), "<"), separator="_"), lambda k, v: F.replace(v, F.lit(MARK), F.lit("")))
        flat = F.transform_keys(leaves, lambda k, v: F.regexp_replace(F.replace(k, F.lit("__"), F.lit("_")), "_VALUE$|^_", ""))
    rejected = parsed.filter(bad).select(F.lit("xml_generic").alias("source"), "value")
    good = parsed.filter(~bad).withColumn("_flat", flat)
    lower = F.transform_keys("_flat", lambda k, v: F.lower(F.element_at(F.split(k, "_"), -1)))
    good = good.withColumn("_low", lower)

    def first(*names):
        return F.coalesce(*[F.nullif(F.col("_low")[n], F.lit("")) for n in names])

    ts = text_timestamp(first("timestamp", "time", "date", "created"))
    kind = first("eventtype")
    events = as_events(
        good, event_id=F.coalesce(F.col("_flat")["EventID"], F.concat(F.lit("xml_"), epoch_text(ts))), ts=ts, raw_log=F.col("value"),
        source_format=F.lit("xml_generic"), user_id=first("username", "user", "userid"),
        source_ip=first("ip", "ipaddress", "sourceip", "clientip"), service=first("service", "application", "app"),
        event_type=F.coalesce(kind, F.lit("unknown")), message=F.col("_flat")["message"], attributes=F.col("_flat"))
    return Ingest(events, rejected)


def _ddl(data_type: T.DataType) -> str:
    if isinstance(data_type, T.StructType):
        return ", ".join(f"`{f.name}` {_nested(f.dataType)}" for f in data_type.fields)
    return _nested(data_type)


def _nested(data_type: T.DataType) -> str:
    if isinstance(data_type, T.StructType):
        return "struct<" + ", ".join(f"`{f.name}`: {_nested(f.dataType)}" for f in data_type.fields) + ">"
    if isinstance(data_type, T.ArrayType):
        return f"array<{_nested(data_type.elementType)}>"
    return "string"


def element_paths(value: str) -> set[tuple[str, str]]:
    """What an element holds, by names without prefix: (path, mark) with the mark empty for an element, ``@name`` for an attribute, ``#`` for
    text and ``*`` for an element that its parent has several times. Nothing for what is no XML."""
    found, path, children = set(), [], []

    def start(tag, attributes):
        if children:
            path.append(local(tag))
            place = "/".join(path)
            found.add((place, "*" if path[-1] in children[-1] else ""))
            children[-1].add(path[-1])
        children.append(set())
        found.update(("/".join(path), f"@{local(a)}") for a in attributes if a.split(":")[0] != "xmlns")

    def end(tag):
        children.pop()
        if path:
            path.pop()

    def text(data):
        if data.strip():
            found.add(("/".join(path), "#"))

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    try:
        parser.Parse(value, True)
    except expat.ExpatError:
        return set()
    return found


def infer_schema(rows: DataFrame, column: str = "value") -> T.StructType:
    """Shape of a column of elements, all leaves as text. One pass; only the distinct paths of the elements reach the driver."""
    def run(batches):
        for batch in batches:
            yield pd.DataFrame(sorted(set().union(*map(element_paths, batch["value"]))), columns=["path", "mark"])

    marks: dict[str, set[str]] = {"": set()}
    shown: dict[str, str] = {}  # names that differ only in case are one field
    for path, mark in sorted(rows.select(F.col(column).alias("value")).filter("value IS NOT NULL").mapInPandas(run, "path string, mark string").distinct().collect()):
        shown.setdefault(path.lower(), path)
        marks.setdefault(path.lower(), set()).add(mark)
    inner: dict[str, list[str]] = {}
    for path in marks:
        if path:
            inner.setdefault(path.rpartition("/")[0], []).append(path)

    def shape(path: str) -> T.DataType:
        fields = {}
        for mark in sorted(m for m in marks[path] if m[:1] == "@"):
            fields.setdefault(f"_{mark[1:]}".lower(), T.StructField(f"_{mark[1:]}", T.StringType()))
        for child in inner.get(path, []):
            fields.setdefault(child.rpartition("/")[2], T.StructField(shown[child].rpartition("/")[2], shape(child)))
        if fields and "#" in marks[path] or not path and "#" in marks[path]:
            fields.setdefault("_value", T.StructField("_VALUE", T.StringType()))
        whole = T.StructType(list(fields.values())) if fields or not path else T.StringType()
        return T.ArrayType(whole) if "*" in marks[path] else whole

    return shape("")


def line_events(spark: SparkSession, path: str, files: list[str] | None = None) -> Ingest:
    """Events from files with one element per line; other lines are skipped."""
    lines = spark.read.text(path)
    if files is not None:
        lines = lines.filter(F.col("_metadata.file_path").isin(files))
    return generic_events(lines.select(F.trim("value").alias("value")).filter(F.col("value").startswith("<")))


def file_kinds(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its root tag, whether the root is closed in its line, how many lines begin with a tag, and which tags of
    events are there. Files are read in pieces that end with ``>``, so a file of one line is read by many tasks; two passes."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    pieces = spark.read.text(path, lineSep=">").select("value", F.col("_metadata.file_path").alias("file"), place.alias("place"))
    tag = F.nullif(F.regexp_extract("value", r"^[^<]*<([A-Za-z_][\w:.-]*)", 1), F.lit(""))
    there = [F.when(F.max(F.col("value").rlike(rf"^[^<]*<(?:[\w.-]+:)?{t}(?:[\s/]|$)")), F.lit(t)) for t in dict.fromkeys(("Event", "Entry", *XML_EVENT_TAGS))]
    begins = F.sum(F.col("value").rlike(r"\n[ \t\r]*<").cast("int")) + F.min_by(F.col("value").rlike(r"^\ufeff?[ \t]*<").cast("int"), "place")
    heads = pieces.groupBy("file").agg(F.min_by(tag, F.when(tag.isNotNull(), F.col("place"))).alias("root"), F.min(F.when(tag.isNotNull(), F.col("place"))).alias("at"),
                                       begins.alias("begins"), F.array_compact(F.array(*there)).alias("tags"))
    # one row per file: the pieces stay where they are read, as those of a large file are too many for one task
    both = pieces.join(F.broadcast(heads), "file")
    closing = F.col("value").endswith(F.concat(F.lit("</"), "root"))
    closed = F.min(F.when(closing | ((F.col("place") == F.col("at")) & F.col("value").endswith("/")), F.col("place")))
    feed = F.min(F.when((F.col("place") > F.col("at")) & F.contains("value", F.lit("\n")), F.col("place")))
    # a line feed in the text before the closing tag is in the same piece, and ends the line first
    whole = F.coalesce(closed < feed, closed.isNotNull())
    out = both.groupBy("file").agg(F.first("root").alias("tag"), whole.alias("whole"), F.first("begins").alias("begins"), F.first("tags").alias("tags"))
    return out.select("file", F.struct(F.coalesce("tag", F.lit("")).alias("tag"), "whole").alias("root"), "begins", "tags")


def kind_of(row, kind: str, tag: str | None) -> tuple[str, tuple[str, ...]]:
    """Kind and element tags of a file (without prefixes), from its row of :func:`file_kinds`; what is given (not ``auto``, not None) stays."""
    root, whole_line = (row["root"]["tag"], row["root"]["whole"]) if row["root"] else ("", False)
    if kind == "auto":
        if root.endswith("Event") or "Events" in root:
            kind = "windows"
        elif "syslog" in root.lower() or root.endswith("Envelope"):
            kind = "syslog"
        else:
            kind = "lines" if whole_line and row["begins"] > 1 else "generic"
    if kind == "lines":
        return kind, ()
    likely = {"windows": ["Event"], "syslog": ["Entry"]}.get(kind, XML_EVENT_TAGS)
    found = tuple(t for t in likely if t in row["tags"])
    tags = (local(tag),) if tag else found or ((likely[0],) if kind != "generic" else (local(root),) if root else ())
    return kind, tags


def local(tag: str) -> str:
    """The name without its prefix."""
    return tag.rsplit(":", 1)[-1]


def read_xml(spark: SparkSession, path: str, kind: str = "auto", tag: str | None = None) -> Ingest:
    """Events from XML files. ``kind``: windows, syslog, generic, lines, or auto by the root tag of each file. A file may hold events under
    several tags. A file without a tag has no events. Text outside of events is rejected (see :mod:`threatframe.sources.xml_files`)."""
    groups: dict[tuple, list[str]] = {}
    for row in file_kinds(spark, path).collect():
        groups.setdefault(kind_of(row, kind, tag), []).append(row["file"])
    parts = []
    for (of, tags), files in sorted(groups.items()):
        if of == "lines":
            parts.append(line_events(spark, path, files))
            continue
        if not tags:
            junk = spark.read.text(path).filter(F.col("_metadata.file_path").isin(files)).filter(F.trim("value") != "")
            parts.append(Ingest(spark.createDataFrame([], EVENT_SCHEMA), junk.select(F.lit("xml_generic").alias("source"), "value")))
            continue
        rows = texts(spark, path, list(tags), files)
        source = {"windows": "xml_windows_event", "syslog": "xml_syslog"}.get(of, "xml_generic")
        parts.append(Ingest(spark.createDataFrame([], EVENT_SCHEMA), rows.filter("NOT record").select(F.lit(source).alias("source"), "value")))
        for name in tags if of == "generic" else [None]:
            named = rows.filter("record") if name is None else rows.filter(F.col("record") & (F.col("name") == name))
            if of == "generic":
                shape = infer_schema(named)
                parts.append(generic_events(named, schema=shape if shape.fields else None))
            else:
                parts.append(windows_events(named) if of == "windows" else syslog_events(named))
    if not parts:
        return Ingest(spark.createDataFrame([], EVENT_SCHEMA), spark.createDataFrame([], "source string, value string"))
    events, rejected = parts[0].events, parts[0].rejected
    for part in parts[1:]:
        events, rejected = events.unionByName(part.events), rejected.unionByName(part.rejected)
    return Ingest(events, rejected)
