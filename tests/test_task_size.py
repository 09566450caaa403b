"""More rows give more tasks, not larger ones."""

from pyspark.sql import functions as F

from threatframe.operators import ordered
from threatframe.plans import demo
from threatframe.session import configure

FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def most(df):
    """Rows of the largest partition."""
    return max(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())


def test_a_task_reads_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(demo, "ROWS_PER_TASK", 100)
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 5000, 1, cores)
    got = demo.spread(rows)
    assert got.rdd.getNumPartitions() == 50 and sorted(r[0] for r in got.collect()) == list(range(5000))
    assert demo.spread(spark.range(0, 50, 1, cores)).rdd.getNumPartitions() == cores


def test_runs_are_bounded_and_windows_sort_one_run_a_task(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS", 100)
    # half of the rows are of one key
    rows = spark.range(5000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id", F.lit(1).alias("v"))
    total = ordered.running(rows, ["k"], ["id"], {"s": ("sum", F.col("v"))})
    assert most(total) < 300
    assert {r["id"]: r["s"] for r in total.collect()} == {i: i // 2 + 1 if i % 2 == 0 else 1 for i in range(5000)}
    back = ordered.look_back(rows, ["k"], ["id"], {"p": ("id", 1)})
    assert most(back) < 300
    assert {r["id"]: r["p"] for r in back.collect()} == {i: i - 2 if i % 2 == 0 and i else None for i in range(5000)}


def test_shuffles_begin_with_enough_partitions(spark):
    spark.conf.unset(FIRST)
    assert int(configure(spark).conf.get(FIRST)) >= 200
    spark.conf.set(FIRST, "1000")
    assert configure(spark).conf.get(FIRST) == "1000"
    spark.conf.unset(FIRST)
    configure(spark)


def test_parsing_stays_behind_the_shuffle_that_deals_the_rows(spark):
    from threatframe.sources.json_logs import json_events
    from threatframe.sources.xml_logs import generic_events

    rows = spark.range(0, 40, 1, 1).repartition(4)
    json = json_events(rows.select(F.to_json(F.struct("id", F.lit("u").alias("user"))).alias("value"))).events
    xml = generic_events(rows.select(F.concat(F.lit("<Log><UserID>"), "id", F.lit("</UserID></Log>")).alias("value"))).events
    for events in (json, xml):
        plan = events._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("RoundRobinPartitioning"):]
        assert "Filter" not in below and "from_xml" not in below and "parseJson" not in below
        assert events.count() == 40


def test_odd_texts_are_rejected_as_before(spark):
    from threatframe.sources.json_logs import json_events
    from threatframe.sources.xml_logs import generic_events

    texts = ['{"a": 1}', ' \t\n{"a": 1} ', '[{"a": 1}]', '"{"', "7", "{", '{"a": 1} x', "", "  ", None]
    got = json_events(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(r["raw_log"] for r in got.events.collect()) == sorted(texts[:2])
    assert sorted(r["value"] for r in got.rejected.collect()) == sorted(texts[2:7])
    texts = ["<a><b>1</b></a>", "<a>", "no", "", None]
    got = generic_events(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [r["attributes"] for r in got.events.collect()] == [{"b": "1"}]
    assert {r["value"] for r in got.rejected.collect()} == set(texts[1:])


def test_payloads_are_read_behind_the_shuffle_and_steps_need_no_shuffle_of_their_own(spark):
    from conftest import make_events
    from threatframe.functions import text
    from threatframe.operators import explain, merge, signature, statistical

    events = make_events(spark, [{"t": i, "user_id": f"u{i % 3}", "source_ip": "1", "raw_log": "nmap -sS 10.0.0.0/8", "attributes": {"payload_size": 900 if i == 7 else i % 5 + 1}}
                                 for i in range(60)])
    outliers = statistical.payload_outliers(events.repartition(4))
    plan = outliers._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan[plan.index("RoundRobinPartitioning"):plan.index("RoundRobinPartitioning") + 300].split("Subquery")[0]
    assert [r["event_id"] for r in outliers.collect()] == ["e00007"]
    trace = explain.trace_text(explain.reasoning_steps(merge.merge(signature.detect(events))))
    assert trace._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert trace.count() == 3
    assert text.fixed(F.col("v"))._jc.toString().count("round(") == 1
    shown = spark.createDataFrame([(92.25,), (0.05,), (None,), (99.96,)], "v double").select(text.fixed(F.col("v")), text.percent(F.col("v") / 100))
    assert [tuple(r) for r in shown.collect()] == [("92.2", "92.2%"), ("0.1", "0.1%"), (None, None), ("100.0", "100.0%")]
