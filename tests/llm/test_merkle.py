"""Merkle manifests against a plain tree."""

import collections
import hashlib
import random
import zlib

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from threatframe.llm import merkle, queries
from threatframe.llm.common import table
from threatframe.session import Scratch

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain(hashes, arity):
    """Top and the siblings (left, right) on the way of each node."""
    ways, below, now = [[] for _ in hashes], [[i] for i in range(len(hashes))], list(hashes)
    while len(now) > 1:
        nodes, owners = [], []
        for at in range(0, len(now), arity):
            run = now[at : at + arity]
            for j in range(len(run)):
                for leaf in below[at + j]:
                    ways[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            nodes.append(digest(*run))
            owners.append(sum(below[at : at + arity], []))
        now, below = nodes, owners
    return now[0], ways


def brute(rows, arity=16):
    """(doc_id, leaf, subroot, root, way) of each row, and its number."""
    leaf, groups = [digest(*map(field, r)) for r in rows], collections.defaultdict(list)
    for k, r in enumerate(rows):
        groups[r[1]].append(k)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, ways = {}, {}
    for name in names:
        order = sorted(groups[name], key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf[k]))
        subroots[name], own = plain([leaf[k] for k in order], arity)
        ways.update(zip(order, own, strict=True))
    root, outer = plain([subroots[n] for n in names], arity)
    above = dict(zip(names, outer, strict=True))
    return [(r[0], leaf[k], subroots[r[1]], root, ways[k] + above[r[1]]) for k, r in enumerate(rows)]


def made(spark, rows, **settings):
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, row int, grp string").repartition(5)
    out = merkle.manifest(frame, COLUMNS, **settings)
    return [(r.id, r.leaf, r.subroot, r.root, [(p.left, p.right) for p in r.path]) for r in out.collect()]


def test_query_like_sql(spark):
    name = "op13_merkle_manifest"
    status, *_ = compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert status == "ok", status


def test_query_by_definition(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select(*COLUMNS).collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op13_merkle_manifest"](spark, SF).collect()}
    assert len(got) == len(rows)
    small = {i: i + 32 for i in range(65, 91)}
    for row, (doc_id, leaf, subroot, root, way) in zip(rows, brute(rows), strict=True):
        seen = leaf if zlib.crc32(str(doc_id).encode()) % 5 or row[4] is None else digest(*map(field, (*row[:4], row[4].translate(small))))
        for left, right in way:
            seen = digest(left, seen, right)
        assert tuple(got[doc_id]) == (doc_id, leaf, subroot, root, digest(*(a + b for a, b in way)), seen, seen == root)
    assert {r.verified for r in got.values()} == {True, False}


@pytest.mark.parametrize("arity,ids,sources", [(16, 10**4, 3), (2, 300, 40), (3, 2**62, 2), (16, 10**9, 500)])
def test_places_and_levels(spark, arity, ids, sources):
    """Dense and scattered ids of both signs, null ones and repeated ones, a group with a third of all rows, groups of one leaf."""
    r = random.Random(arity + sources)
    names = [None, "", *(f"s{i}é" for i in range(sources))]
    rows = []
    for i in range(700):
        doc_id = None if r.random() < 0.05 else r.randint(-ids, ids)
        rows.append((doc_id, r.choice(names) if i % 3 else "hot", r.choice(["en", None]), i, f"text {i}"))
    rows += [r.choice(rows) for _ in range(60)] + [(5, "hot", "en", 1, "same")] * 90 + [(5, "hot", "en", i, "other") for i in range(40)] + [(None, "lone", None, None, None)]
    key = lambda x: (str(x[0]), *x[1:4], x[4])
    assert sorted(made(spark, rows, arity=arity), key=key) == sorted(brute(rows, arity), key=key)


def test_cases(spark):
    assert made(spark, []) == []
    one = (3, "a", None, None, None)
    assert made(spark, [one]) == [(3, digest("1:3", "1:a", "---"), *[digest("1:3", "1:a", "---")] * 2, [])]
    rows = [(1, None, None, None, ""), (1, None, None, None, None), (2, "", "en", 0, "x" * 300_000), (2**63 - 1, "", "en", 0, "y"), (-(2**63), "", "en", 0, "é")]
    assert sorted(made(spark, rows), key=str) == sorted(brute(rows), key=str)


def test_fold_finds_any_change(spark):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    out = merkle.manifest(frame, COLUMNS, F.when(F.col("doc_id") == 7, F.sha2(F.lit("forged"), 256)))
    good = out.select("id", (merkle.fold(F.coalesce("changed", "leaf"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert {x.id for x in good if not x.ok} == {7} and len(good) == 40


def test_directory_windows_are_bounded(spark):
    """However many ids a group has, siblings in the directory are at most 1,024."""
    tables = Scratch(spark)
    leaves = spark.range(0, 300_000, 3).select(F.lit("g").alias("grp"), "id", F.col("id").alias("row"), F.lit("x").alias("leaf"), F.lit(None).cast("string").alias("changed"))
    placed = merkle.places(leaves, tables)
    assert placed.where("place <> id div 3").count() == 0
    level = spark.read.parquet(f"{tables.folder}/level0")
    assert level.groupBy("grp", "parent").count().agg(F.max("count")).first()[0] <= 1 << merkle.FAN_BITS
