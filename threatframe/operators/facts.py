"""Facts: events as (type, subject, predicate, value) rows, and queries over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threatframe.operators.typing import calendar

COLUMNS = ["fact_id", "fact_type", "subject", "predicate", "value_str", "value_num", "value_bool", "certainty",
           "source_event_id", "ts", "metadata", "derived_from"]


def fact_id(fact_type: Column, subject: Column, predicate: Column, value: Column) -> Column:
    """Id from the content alone, so equal facts get equal ids in every run."""
    return F.substring(F.md5(F.concat_ws(":", fact_type, subject, predicate, value)), 1, 12)


def fact(fact_type, subject: Column, predicate, value: Column, kind: str = "str", *, certainty: Column | None = None,
         event_id: Column | None = None, ts: Column | None = None, metadata: Column | None = None) -> Column:
    """One fact as a struct; ``kind`` tells which typed column takes the value: str, num or bool."""
    fact_type, predicate = F.lit(fact_type), F.lit(predicate)
    text = value.cast("string")
    return F.struct(
        fact_id(fact_type, subject, predicate, text).alias("fact_id"), fact_type.alias("fact_type"),
        subject.alias("subject"), predicate.alias("predicate"), text.alias("value_str"),
        (value.cast("double") if kind == "num" else F.lit(None).cast("double")).alias("value_num"),
        (value.cast("boolean") if kind == "bool" else F.lit(None).cast("boolean")).alias("value_bool"),
        (F.lit(1.0) if certainty is None else certainty.cast("double")).alias("certainty"),
        (F.lit(None).cast("string") if event_id is None else event_id).alias("source_event_id"),
        (F.lit(None).cast("timestamp") if ts is None else ts).alias("ts"),
        (F.lit(None).cast("map<string,string>") if metadata is None else metadata).alias("metadata"),
        F.array().cast("array<string>").alias("derived_from"))


def from_events(events: DataFrame, frequency: list[str] | None = None) -> DataFrame:
    """All facts of the events in one projection: type, calendar, source, user and frequency facts.

    ``frequency`` names feature columns that are present in ``events``.
    """
    own = {"event_id": F.col("event_id"), "ts": F.col("ts")}
    user, ip = F.col("user_id"), F.col("source_ip")
    rows = [fact("event", F.coalesce(user, F.lit("system")), "event_type", F.col("event_type"), **own)]
    for name in ("hour", "day_of_week", "is_weekend", "is_business_hours", "is_night", "minute", "month"):
        rows.append(fact("temporal", F.col("event_id"), name, F.col(f"_c.{name}"),
                         "bool" if name.startswith("is_") else "num", **own))
    rows.append(F.when(ip.isNotNull(), fact("network", ip, "source_of", F.col("event_id"), **own,
                                            metadata=F.create_map(F.lit("user_id"), user))))
    rows.append(F.when(user.isNotNull(), fact("user", user, "generated_event", F.col("event_id"), **own,
                                              metadata=F.create_map(F.lit("source_ip"), ip))))
    for name in frequency or []:
        rows.append(fact("frequency", F.col("event_id"), name, F.col(name), "num", **own))
    ready = events.withColumn("_c", calendar(F.col("ts")))
    return ready.select(F.inline_outer(F.array(*rows))).filter(
        F.col("fact_id").isNotNull() & F.col("value_str").isNotNull()).select(*COLUMNS)


def query(facts: DataFrame, fact_type: str | None = None, subject: str | None = None, predicate: str | None = None,
          value=None, event_id: str | None = None, fact_id: str | None = None) -> DataFrame:
    """Facts that meet all given parts. On a table partitioned by ``fact_type`` the type prunes files."""
    wanted = {"fact_type": fact_type, "subject": subject, "predicate": predicate,
              "source_event_id": event_id, "fact_id": fact_id}
    if value is not None:
        wanted["value_str"] = str(value).lower() if isinstance(value, bool) else str(value)
    for column, given in wanted.items():
        if given is not None:
            facts = facts.filter(F.col(column) == given)
    return facts


def recent(facts: DataFrame, n: int = 10) -> DataFrame:
    return facts.orderBy(F.desc("ts"), "fact_id").limit(n)


def assert_facts(known: DataFrame, new: DataFrame) -> DataFrame:
    """Union; of facts with the same id the most certain one stays (the earliest among equals)."""
    both = known.unionByName(new)
    rest = [c for c in COLUMNS if c != "fact_id"]
    place = F.struct((-F.col("certainty")).alias("c"), "ts", "source_event_id")
    best = both.groupBy("fact_id").agg(F.min_by(F.struct(*rest), place).alias("best"))
    return best.select("fact_id", "best.*").select(*COLUMNS)


def retract(facts: DataFrame, retractions: DataFrame) -> DataFrame:
    return facts.join(retractions.select("fact_id"), "fact_id", "left_anti").select(*facts.columns)


def statistics(facts: DataFrame) -> DataFrame:
    """Facts, subjects and predicates per type, and a row ``all``."""
    rows = facts.select("subject", "predicate", F.explode(F.array("fact_type", F.lit("all"))).alias("fact_type"))
    return rows.groupBy("fact_type").agg(
        F.count(F.lit(1)).alias("n_facts"), F.count_distinct("subject").alias("n_subjects"),
        F.count_distinct("predicate").alias("n_predicates"))
