"""Shared steps of the readers: rejected rows, timestamps, field promotion, the event schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from threatframe.config import PROMOTED_FIELDS

EVENT_COLUMNS = ["event_id", "ts", "ts_missing", "raw_log", "source_format", "source_ip", "destination_ip", "user_id",
                 "service", "event_type", "outcome", "message", "attributes"]
EVENT_SCHEMA = ("event_id string, ts timestamp, ts_missing boolean, raw_log string, source_format string, source_ip string, "
                "destination_ip string, user_id string, service string, event_type string, outcome string, message string, "
                "attributes map<string,string>")


@dataclass(frozen=True)
class Ingest:
    """What a reader returns: the events, and the rows it could not read (``source``, ``value``)."""

    events: DataFrame
    rejected: DataFrame

    def quality(self) -> DataFrame:
        """Parsed and rejected rows with success rate, per source format."""
        parsed = self.events.groupBy("source_format").agg(F.count(F.lit(1)).alias("parsed"))
        failed = self.rejected.groupBy(F.col("source").alias("source_format")).agg(F.count(F.lit(1)).alias("errors"))
        both = parsed.join(failed, "source_format", "full")
        ok, bad = F.coalesce("parsed", F.lit(0)), F.coalesce("errors", F.lit(0))
        return both.select("source_format", ok.alias("parsed"), bad.alias("errors"), (ok / (ok + bad)).alias("success_rate"))


def text_timestamp(value: Column) -> Column:
    """Timestamp from text: ISO forms with or without zone, ``2024/01/06 10:00:00``, ``06/Jan/2024:10:00:00``."""
    text = F.trim(value)
    return F.coalesce(
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp")),
        F.when(text.rlike(r"^\d{4}/"), F.try_to_timestamp(text, F.lit("y/M/d H:m:s"))),
        F.when(text.rlike(r"^\d{1,2}/[A-Za-z]"), F.try_to_timestamp(text, F.lit("d/MMM/y:H:m:s"))))


def number_timestamp(value: Column) -> Column:
    """Timestamp from seconds, or milliseconds above 1e12, since 1970."""
    number = value.try_cast("double")
    seconds = F.when(number > 1e12, number / 1000).otherwise(number)
    return F.when(F.abs(seconds) < 1e11, F.timestamp_micros(F.round(seconds * 1e6).cast("bigint")))


def promoted(attributes: Column, field: str) -> Column:
    """First non-empty value among the known names of a field."""
    return F.coalesce(*[F.nullif(attributes[name], F.lit("")) for name in PROMOTED_FIELDS[field]])


def epoch_text(ts: Column) -> Column:
    """Seconds since 1970 as text with the digits that matter, such as ``1704535200.5``."""
    micros = F.unix_micros(ts)
    fraction = F.regexp_replace(F.lpad((micros % 1_000_000).cast("string"), 6, "0"), "0+$", "")
    return F.concat(F.floor(micros / 1_000_000).cast("string"), F.lit("."),
                    F.when(fraction == "", "0").otherwise(fraction))


def as_events(df: DataFrame, **columns: Column) -> DataFrame:
    """Select the event columns; columns that are not given are null."""
    columns.setdefault("ts_missing", columns["ts"].isNull())
    types = dict(part.strip().split(" ", 1) for part in EVENT_SCHEMA.split(", "))
    return df.select(*[columns.get(name, F.lit(None)).cast(types[name]).alias(name) for name in EVENT_COLUMNS])
