"""One entry point for all log formats."""

from __future__ import annotations

from pyspark.sql import SparkSession

from threatframe.sources.cef import read_cef
from threatframe.sources.common import Ingest
from threatframe.sources.json_logs import read_json
from threatframe.sources.xml_logs import read_xml


def format_of(path: str) -> str:
    """Format by extension; JSON where it tells nothing."""
    return "xml" if path.lower().endswith((".xml", ".evtx")) else "json"


def read_logs(spark: SparkSession, path: str, format: str = "auto", **options) -> Ingest:
    """Events and rejected rows from log files: json, xml, cloudtrail, windows_json, cef, or auto."""
    chosen = format_of(path) if format in ("auto", None) else format
    readers = {
        "json": lambda: read_json(spark, path, **options),
        "cloudtrail": lambda: read_json(spark, path, flavour="cloudtrail", **options),
        "windows_json": lambda: read_json(spark, path, flavour="windows", **options),
        "xml": lambda: read_xml(spark, path, **options),
        "cef": lambda: read_cef(spark, path),
    }
    if chosen not in readers:
        raise ValueError(f"Unsupported file format: {chosen}")
    return readers[chosen]()
