import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from threatframe.session import build_session

    session = build_session("local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                              "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


def make_events(spark, rows):
    """Log events from dicts; ``t`` is seconds after 2024-01-06 00:00 UTC (a Saturday)."""
    from pyspark.sql import functions as F

    names = ["user_id", "source_ip", "destination_ip", "service", "event_type", "outcome", "raw_log", "message"]
    data = [(str(r.get("event_id", f"e{i:05d}")), float(r["t"]), {k: str(v) for k, v in r.get("attributes", {}).items()},
             *[r.get(n) for n in names]) for i, r in enumerate(rows)]
    schema = "event_id string, t double, attributes map<string,string>, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame(data, schema)
    ts = F.timestamp_micros(F.lit(1704499200000000) + F.round(F.col("t") * 1_000_000).cast("bigint"))
    return df.select("event_id", ts.alias("ts"), *names, "attributes", F.lit("json").alias("source_format"))
