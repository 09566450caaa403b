"""Jobs for spark-submit: ``python -m threatframe.plans.jobs analyze|explain|status ...``.

Each job reads and writes DataFrames; none brings results to the driver except the few lines
``explain`` and ``status`` are asked to show.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from threatframe.operators import explain, rules as rule_ops
from threatframe.plans.analysis import LAYERS, analyze
from threatframe.session import build_session, configure
from threatframe.sources.logs import read_logs
from threatframe.sources.tables import find_anomaly, read_anomalies, read_events, write_anomalies, write_events


def run_analysis(spark: SparkSession, path: str, out: str, format: str = "auto", layers=LAYERS, mode: str = "errorifexists", **options) -> None:
    """Read logs, store events and rejected rows, analyse the stored events, store anomalies and metrics."""
    configure(spark)
    ingest = read_logs(spark, path, format)
    write_events(ingest.events, f"{out}/events", mode=mode)
    ingest.rejected.write.mode(mode).json(f"{out}/rejected")
    ingest.quality().write.mode(mode).json(f"{out}/quality")
    anomalies, metrics = analyze(read_events(spark, f"{out}/events"), layers, **options)
    write_anomalies(anomalies, f"{out}/anomalies", mode=mode)
    metrics.write.mode(mode).json(f"{out}/metrics")


def explanations(spark: SparkSession, results: str, anomaly_id: str | None = None) -> DataFrame:
    """Why, how and summary text of stored anomalies, or of one of them."""
    anomalies = read_anomalies(spark, results)
    if anomaly_id:
        anomalies = find_anomaly(anomalies, anomaly_id)
    return anomalies.select("anomaly_id", "anomaly_type", "threat_score", "certainty", "explanation",
                            explain.why().alias("why"), explain.how().alias("how"))


def status(spark: SparkSession) -> DataFrame:
    """Numbers of rules by category and priority and of signatures by type."""
    return rule_ops.knowledge_statistics(spark)


def main(args: list[str]) -> int:
    if not args or args[0] not in ("analyze", "explain", "status"):
        print(__doc__)
        return 2
    spark = build_session()
    if args[0] == "analyze":
        run_analysis(spark, args[1], args[2], *(args[3:4] or ["auto"]))
        top = read_anomalies(spark, f"{args[2]}/anomalies").orderBy(F.desc("threat_score"), "anomaly_id")
        top.select("anomaly_id", "anomaly_type", "threat_score", "certainty", "affected_users", "source_ips").show(10, truncate=False)
    elif args[0] == "explain":
        explanations(spark, *args[1:3]).orderBy(F.desc("threat_score"), "anomaly_id").show(10, truncate=False)
    else:
        status(spark).orderBy("kind", "name").show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
