"""Classifying events: type, outcome, message kind, severity, category, calendar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from threatframe.config import (EVENT_CATEGORIES, LOGIN_FAILURE_WORDS, LOGIN_SUCCESS_WORDS, LOGIN_WORDS,
                                MESSAGE_KINDS, SEVERITY_WORDS, TYPE_WORDS, WINDOWS_EVENT_IDS)
from threatframe.functions.scoring import lookup


def has_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def event_typing(message: Column) -> Column:
    """Struct (event_type, outcome) from words of the message; the first group with a hit decides.

    A login message that tells neither failure nor success stays ``unknown``.
    """
    low = F.lower(message)
    login = has_any(low, LOGIN_WORDS)
    failed, succeeded = has_any(low, LOGIN_FAILURE_WORDS), has_any(low, LOGIN_SUCCESS_WORDS)
    kind = F.when(login & (failed | succeeded), "authentication").when(login, "unknown")
    for event_type, words in TYPE_WORDS:
        kind = kind.when(has_any(low, words), event_type)
    outcome = F.when(login & failed, "failure").when(login & succeeded, "success")
    return F.struct(kind.otherwise("unknown").alias("event_type"), outcome.alias("outcome"))


def windows_event_type(event_id: Column) -> Column:
    """Event type of a Windows security event number."""
    number = F.when(event_id.rlike("^[0-9]+$"), event_id.try_cast("bigint"))
    kind = None
    for event_type, ids in WINDOWS_EVENT_IDS.items():
        kind = F.when(number.isin(ids), event_type) if kind is None else kind.when(number.isin(ids), event_type)
    return kind.otherwise("unknown")


def message_kind(message: Column) -> Column:
    """Struct (kind, semantic_type, outcome, indicators) of the first message kind with a hit, or null."""
    low = F.lower(message)
    chain = None
    for kind, phrases, semantic_type, outcome, indicators in MESSAGE_KINDS:
        value = F.struct(F.lit(kind).alias("kind"), F.lit(semantic_type).alias("semantic_type"),
                         F.lit(outcome).alias("outcome"),
                         F.array(*[F.lit(i) for i in indicators]).cast("array<string>").alias("indicators"))
        test = has_any(low, phrases)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain


def kind_indicators(kind: Column) -> Column:
    """Indicators that belong to a message kind; empty for an unknown one."""
    values = F.array().cast("array<string>")
    for name, _, _, _, indicators in MESSAGE_KINDS:
        if indicators:
            values = F.when(kind == name, F.array(*[F.lit(i) for i in indicators])).otherwise(values)
    return values


def severity(value: Column) -> Column:
    """Severity as critical / high / medium / low / info / unknown from numbers 0-7 or words."""
    low = F.lower(value)
    number = low.try_cast("bigint")
    numeric = (
        F.when(number <= 2, "critical").when(number == 3, "high").when(number == 4, "medium")
        .when(number <= 6, "low").otherwise("info")
    )
    chain = F.when(low.rlike("^[0-9]+$"), numeric)
    for name, words in SEVERITY_WORDS.items():
        chain = chain.when(low.isin(words), name)
    return chain.otherwise("unknown")


def severity_enum(normalized: Column) -> Column:
    return F.when(normalized != "unknown", F.upper(normalized))


def category(event_type: Column) -> Column:
    return lookup(event_type, EVENT_CATEGORIES, "unknown")


def calendar(ts: Column, business_excludes_weekend: bool = False) -> Column:
    """Struct of calendar features (Monday is day 0)."""
    hour, day = F.hour(ts), F.weekday(ts)
    business = (hour >= 9) & (hour < 17)
    if business_excludes_weekend:
        business = business & (day < 5)
    return F.struct(
        hour.alias("hour"), day.alias("day_of_week"), (day >= 5).alias("is_weekend"),
        business.alias("is_business_hours"), ((hour < 6) | (hour >= 22)).alias("is_night"),
        F.minute(ts).alias("minute"), F.month(ts).alias("month"))
