"""JSON logs: lines, arrays, single objects, CloudTrail, Windows events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threatframe.config import CLOUDTRAIL_SCHEMA, MESSAGE_FIELDS, TIMESTAMP_FIELDS, WINDOWS_JSON_SCHEMA
from threatframe.functions.text import once
from threatframe.operators.typing import event_typing
from threatframe.sources import json_files
from threatframe.sources.common import Ingest, as_events, number_timestamp, promoted, text_timestamp

SCHEMAS = {"cloudtrail": CLOUDTRAIL_SCHEMA, "windows": WINDOWS_JSON_SCHEMA}


def path_get(record: Column, path: str, kind: str = "string") -> Column:
    """Value at a dotted path of a variant, or null."""
    steps = "".join(f"['{step}']" for step in path.split("."))
    return F.try_variant_get(record, "$" + steps, kind)


def strict(text: Column) -> Column:
    """The text as a variant if it is one JSON value and nothing else, or null.

    Parsing alone ends with the first value and ignores what follows. Here the text is the first item of an array whose second
    is the text's hash; that one is only found where the value ends with the text.
    """
    return unpaired(text, paired(text))


def paired(text: Column) -> Column:
    """The array of the text and its hash, or null."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]")))


def unpaired(text: Column, pair: Column) -> Column:
    """The value of :func:`paired` if the hash is found behind it."""
    return F.when(F.try_variant_get(pair, "$[1]", "bigint") == F.xxhash64(text), F.try_variant_get(pair, "$[0]", "variant"))


def levels(text: Column, *openings: str) -> Column:
    """A bound of the nesting depth: how many opening characters there are, 1 at least."""
    rest = text
    for opening in openings:
        rest = F.replace(rest, F.lit(opening), F.lit(""))
    return F.greatest(F.lit(1), F.length(text) - F.length(rest))


def flatten(record: Column, depth: int | Column | None = None, separator: str = ".") -> Column:
    """Leaves of a variant object as a map from dotted and indexed keys (``a.b``, ``a[0].c``) to text.

    Arrays directly inside arrays and what lies deeper than ``depth`` (default: nothing does) stay as JSON text, so
    nothing is lost. One expression, no shuffle.
    """
    depth = levels(record.cast("string"), "{", "[") if depth is None else F.lit(depth)

    def entries(value, prefix, parent_is_array):
        objects = F.try_variant_get(value, "$", "map<string,variant>")
        arrays = F.try_variant_get(value, "$", "array<variant>")
        below = F.transform(F.map_entries(objects), lambda e: F.struct(
            F.concat(prefix, F.lit(separator), e["key"]).alias("key"), e["value"].alias("value"), F.lit(False).alias("in_array")))
        items = F.transform(arrays, lambda v, i: F.struct(
            F.concat(prefix, F.lit("["), i.cast("string"), F.lit("]")).alias("key"), v.alias("value"), F.lit(True).alias("in_array")))
        own = F.array(F.struct(prefix.alias("key"), value.alias("value"), parent_is_array.alias("in_array")))
        return F.when(objects.isNotNull(), below).when(arrays.isNotNull() & ~parent_is_array, items).otherwise(own)

    top = F.transform(F.map_entries(F.try_variant_get(record, "$", "map<string,variant>")), lambda e: F.struct(
        e["key"].alias("key"), e["value"].alias("value"), F.lit(False).alias("in_array")))
    kind = "array<struct<key: string, value: variant, in_array: boolean>>"

    def opens(e):
        # the first character spares most values the look inside; text may begin like an object
        found = F.try_variant_get(e["value"], "$", "map<string,variant>").isNotNull() | (
            ~e["in_array"] & F.try_variant_get(e["value"], "$", "array<variant>").isNotNull())
        return F.substring(e["value"].cast("string"), 1, 1).isin("{", "[") & found

    def state(entries_):
        return F.struct(entries_.alias("entries"), F.coalesce(F.exists(entries_, opens), F.lit(False)).alias("nested"))

    def open_level(at, _):
        # most records are flat or nearly so: a level is only opened where there is one, and nothing is done after the last
        opened = F.flatten(F.transform(at["entries"], lambda e: entries(e["value"], e["key"], e["in_array"])))
        return F.when(at["nested"], state(opened.cast(kind))).otherwise(at)

    # a loop inside the expression keeps it small: each level refers to the one before it three times
    top = F.aggregate(F.sequence(F.lit(1), depth), state(top.cast(kind)), open_level)["entries"]
    return F.map_from_entries(F.transform(top, lambda e: F.struct(e["key"].alias("key"), e["value"].cast("string").alias("value"))))


def unwrap(attributes: Column) -> Column:
    """Undo the nesting of exported events: ``attributes.x.value`` becomes ``x``; derived parts go."""
    kept = F.map_filter(attributes, lambda k, v: ~k.rlike(r"^(attributes\..*\.certainty$|time_features\.|frame\.)"))
    return F.transform_keys(kept, lambda k, v: F.regexp_replace(k, r"^attributes\.(.*)\.value$", "$1"))


def json_events(lines: DataFrame, column: str = "value", schema: dict[str, str] | None = None, wrapped: bool = False,
                source_format: str = "json", depth: int | None = None) -> Ingest:
    """Events from a column of JSON objects as text, on a batch or a stream.

    ``schema`` maps standard fields (timestamp, message, user, source_ip) to paths tried first. Text that is not one object
    and nothing else is rejected.
    """
    schema = schema or {}
    # through generators, so that the filters below use the parsed record instead of parsing again, and run where it was parsed: a filter
    # on the text alone would go below a shuffle, into the few tasks that read the table, and would make the text there a second time
    text = F.col("t.value")
    rows = lines.select(F.explode(F.array(F.struct(F.col(column).alias("value"), paired(F.col(column)).alias("pair")))).alias("t"))
    rows = rows.filter(F.trim(text) != "").select(text.alias("value"), F.explode_outer(F.array(unpaired(text, F.col("t.pair")))).alias("record"))
    # a value that begins like an object is one
    is_record = F.col("record").isNotNull() & F.ltrim("value", F.lit(" \t\r\n")).startswith("{")
    rejected = rows.filter(~is_record).select(F.lit(source_format).alias("source"), "value")
    rows = rows.filter(is_record)

    # the first timestamp field that is there decides, whether or not it can be read
    paths = [f"$['{name}']" for name in TIMESTAMP_FIELDS]
    if "timestamp" in schema:
        given = "$" + "".join(f"['{step}']" for step in schema["timestamp"].split("."))
        paths = [given + "['@SystemTime']", given, *paths]
    found = [F.when(F.try_variant_get("record", path, "string").isNotNull(), F.struct(
        F.try_variant_get("record", path, "string").alias("text"),
        F.schema_of_variant(F.try_variant_get("record", path, "variant")).alias("kind"))) for path in paths]
    rows = rows.withColumn("_ts", F.coalesce(*found)).withColumn("_flat", flatten(F.col("record"), levels(F.col("value"), "{", "[") if depth is None else depth))
    if wrapped:
        rows = rows.withColumn("_flat", unwrap(F.col("_flat")))
    flat = F.col("_flat")
    ts = F.when(F.col("_ts.kind") == "STRING", text_timestamp(F.col("_ts.text"))).otherwise(number_timestamp(F.col("_ts.text")))

    def at(field):
        return [F.nullif(path_get(F.col("record"), schema[field]), F.lit(""))] if field in schema else []

    message = F.coalesce(*at("message"), *[path_get(F.col("record"), n) for n in MESSAGE_FIELDS],
                         *([flat["message"]] if wrapped else []), F.col("value"))
    rows = rows.withColumn("_message", message).withColumn("_t", event_typing(F.col("_message")))
    event_type, outcome = F.col("_t.event_type"), F.col("_t.outcome")
    event_id = F.substring(F.sha2(F.col("record").cast("string"), 256), 1, 16)
    if wrapped:
        event_id = F.coalesce(path_get(F.col("record"), "event_id"), event_id)
        outcome = F.coalesce(flat["outcome"], outcome)
        event_type = F.coalesce(path_get(F.col("record"), "event_type"), event_type)
    events = as_events(
        rows, event_id=event_id, ts=ts, raw_log=F.col("value"), source_format=F.lit(source_format),
        source_ip=F.coalesce(promoted(flat, "source_ip"), *at("source_ip")), destination_ip=promoted(flat, "destination_ip"),
        user_id=F.coalesce(promoted(flat, "user_id"), *at("user")), service=promoted(flat, "service"),
        event_type=event_type, outcome=outcome, message=F.col("_message"),
        attributes=F.map_filter(flat, lambda k, v: ~k.isin(TIMESTAMP_FIELDS)))
    return Ingest(events, rejected)


def is_value(text: Column) -> Column:
    """Whether the text is one JSON value and nothing else."""
    return F.coalesce(F.try_variant_get(paired(text), "$[1]", "bigint") == F.xxhash64(text), F.lit(False))


def objects(text: Column, member: str | None = None) -> Column:
    """The elements of an array (or of the array ``member``) as an array of texts, or the text alone."""
    inner = F.when(is_value(text), F.get_json_object(text, f"$.{member}")) if member else F.lit(None).cast("string")
    # an array with anything after it is left whole, and rejected as a record
    return once(F.coalesce(inner, text), lambda body: F.coalesce(
        F.when(F.ltrim(body).startswith("[") & is_value(body), F.from_json(body, "array<string>")), F.array(body)))


def records(documents: DataFrame, column: str = "value", member: str | None = None) -> DataFrame:
    """One row per object: elements of an array (or of the array ``member``), or the object itself.

    Elements keep the text they have in the file, including the order of their fields.
    """
    return documents.select(F.explode(objects(F.col(column), member)).alias("value"))


def cut_records(texts: DataFrame, member: str | None = None) -> DataFrame:
    """One row per record of the texts of :func:`threatframe.sources.json_files.texts`; what is no value goes on as its lines."""
    value = F.col("value")
    wrapped = F.concat(F.lit("["), value, F.lit("]"))
    elements = F.when(F.col("listed") & is_value(wrapped), F.from_json(wrapped, "array<string>"))
    lines = F.when(~F.contains(value, F.lit("\n")) | (~F.col("listed") & is_value(value)), F.array(value)).otherwise(F.transform(F.split(value, "\n"), lambda x: F.trim(F.replace(x, F.lit("\r"), F.lit("")))))
    # one pass: each text is parsed as an element or as lines, not as both by the two sides of a union
    filled = lambda all_: F.filter(all_, lambda v: F.trim(v) != "")
    parts = once(elements, lambda cut: F.when(cut.isNotNull(), filled(cut)).otherwise(
        F.flatten(F.transform(filled(lines), lambda v: objects(v, member)))))
    return texts.select(F.explode(parts).alias("value"))


def read_json(spark: SparkSession, path: str, layout: str = "auto", schema: dict[str, str] | None = None,
              wrapped: bool = False, flavour: str | None = None) -> Ingest:
    """Events from JSON files.

    ``layout`` is ``lines`` (one value per line: no look at the structure, nothing is shuffled), ``document`` (a file is one
    array or object and is read as a whole, for small files) or ``auto``: lines, arrays, objects over several lines, one after
    another, in files of any size, see :mod:`threatframe.sources.json_files`. ``flavour`` is None, ``cloudtrail`` or ``windows``.
    """
    member = "Records" if flavour == "cloudtrail" else None
    if layout == "auto":
        rows = cut_records(json_files.texts(spark, path, member), member)
    else:
        rows = records(spark.read.text(path, wholetext=layout == "document").filter(F.trim("value") != ""), member=member)
    return json_events(rows, schema=schema or SCHEMAS.get(flavour or ""), wrapped=wrapped,
                       source_format=f"json_{flavour}" if flavour else "json")
