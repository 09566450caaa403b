"""Common Event Format lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threatframe.sources.common import Ingest, as_events, number_timestamp, text_timestamp

# The seven header fields and the extension part
PATTERN = r"^CEF:(\d+)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|(.*)"
HEADER = {"device_vendor": 2, "device_product": 3, "signature_id": 5, "name": 6, "severity": 7}


def cef_events(lines: DataFrame, column: str = "value") -> Ingest:
    """Events from a column of CEF lines; extensions are blank-separated ``key=value`` pairs, the last of equal keys counts."""
    rows = lines.select(F.trim(column).alias("value")).filter(F.col("value") != "")
    fits = F.col("value").rlike(PATTERN)
    rejected = rows.filter(~fits).select(F.lit("cef").alias("source"), "value")
    part = lambda i: F.regexp_extract("value", PATTERN, i)
    pairs = F.filter(F.split(part(8), " "), lambda p: p.contains("="))
    good = rows.filter(fits).withColumn("_ext", F.map_from_entries(F.transform(pairs, lambda p: F.struct(
        F.substring_index(p, "=", 1).alias("key"), F.regexp_replace(p, "^[^=]*=", "").alias("value")))))
    ext = F.col("_ext")
    header = F.create_map(*[c for name, i in HEADER.items() for c in (F.lit(name), part(i))])
    rt = ext["rt"]
    ts = F.coalesce(text_timestamp(rt), F.when(rt.rlike(r"^\d{10}(\d{3})?$"), number_timestamp(rt)))
    events = as_events(
        good, event_id=part(5), ts=ts, raw_log=F.col("value"), source_format=F.lit("cef"), source_ip=F.nullif(ext["src"], F.lit("")),
        destination_ip=F.nullif(ext["dst"], F.lit("")), user_id=F.nullif(ext["duser"], F.lit("")), event_type=F.lit("unknown"),
        message=F.coalesce(ext["msg"], part(6)), attributes=F.map_concat(header, ext))
    return Ingest(events, rejected)


def read_cef(spark: SparkSession, path: str) -> Ingest:
    return cef_events(spark.read.text(path))
