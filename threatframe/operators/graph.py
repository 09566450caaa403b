"""Security graph: nodes and edges as DataFrames, chains, indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from threatframe.config import GRAPH_INDICATES, GRAPH_IS_A, GRAPH_NODES, GRAPH_PRECEDES

NODE_SCHEMA = "name string, category string, description string, attributes map<string,string>"
EDGE_SCHEMA = "src string, relation string, dst string"


def nodes(spark: SparkSession) -> DataFrame:
    rows = [(name, category, "", {}) for category, names in GRAPH_NODES.items() for name in names]
    return spark.createDataFrame(rows, NODE_SCHEMA)


def edges(spark: SparkSession) -> DataFrame:
    rows = []
    for parent, children in GRAPH_IS_A.items():
        for child in children:
            rows += [(child, "is_a", parent), (parent, "has_part", child)]
    rows += [(a, "indicates", b) for a, b in GRAPH_INDICATES]
    for a, b in GRAPH_PRECEDES:
        rows += [(a, "precedes", b), (b, "follows", a)]
    return spark.createDataFrame(rows, EDGE_SCHEMA)


def related(edges_: DataFrame, relation: str) -> DataFrame:
    return edges_.filter(F.col("relation") == relation).select("src", "dst")


def add_edges(edges_: DataFrame, new: DataFrame) -> DataFrame:
    return edges_.unionByName(new).distinct()


def related_attacks(observed: DataFrame, edges_: DataFrame, column: str = "indicator") -> DataFrame:
    """Rows with an indicator, once per attack it indicates."""
    pairs = related(edges_, "indicates").select(F.col("src").alias(column), F.col("dst").alias("attack"))
    return observed.join(pairs, column)


def attack_chains(edges_: DataFrame, starts: DataFrame, depth: int = 3) -> DataFrame:
    """Paths along ``precedes`` from each start to the given depth or a dead end, without revisits."""
    step = related(edges_, "precedes").groupBy("src").agg(F.array_sort(F.collect_set("dst")).alias("next"))
    paths = starts.select(F.array("attack").alias("path"), F.lit(True).alias("open")).distinct()
    done = []
    for _ in range(depth):
        tip = F.element_at("path", -1)
        grown = paths.withColumn("src", tip).join(step, "src", "left")
        done.append(grown.filter("next IS NULL").select("path"))
        grown = grown.filter("next IS NOT NULL").select("path", F.explode("next").alias("to"))
        paths = grown.filter(~F.expr("array_contains(path, to)")).select(
            F.concat("path", F.array("to")).alias("path"), F.lit(True).alias("open"))
    return reduce(lambda a, b: a.unionByName(b), [*done, paths.select("path")]).select(
        F.element_at("path", 1).alias("start"), "path", F.size("path").alias("length"))


def common_indicators(attacks: DataFrame, edges_: DataFrame, case: str = "case_id") -> DataFrame:
    """Indicators shared by all attacks of a case; ``attacks`` holds (case, attack)."""
    wanted = attacks.select(case, "attack").distinct()
    n = wanted.groupBy(case).agg(F.count(F.lit(1)).alias("n_attacks"))
    pairs = related(edges_, "indicates")
    links = pairs.select(F.col("dst").alias("attack"), F.col("src").alias("indicator")).union(
        pairs.select(F.col("src").alias("attack"), F.col("dst").alias("indicator"))).distinct()
    shared = wanted.join(links, "attack").groupBy(case, "indicator").agg(F.count(F.lit(1)).alias("n"))
    return shared.join(n, case).filter("n = n_attacks").select(case, "indicator", "n_attacks")
