"""The conversation trie against a trie made of dictionaries."""

import collections
import hashlib
import random
import zlib

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from threatframe.llm import prefix_trie, queries
from threatframe.llm.common import table
from threatframe.session import Scratch

SF = "/root/testdata/sf0.01"


def turn_key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def sequences(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, turn_key(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}


def brute(seqs):
    nodes = collections.defaultdict(list)
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids, leaves, saved = collections.Counter(p[:-1] for p in nodes if p), collections.Counter(), collections.Counter()
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += p not in kids
    out = []
    for p, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p))))
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(spark, rows, **settings):
    tables = Scratch(spark)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, conv int, digest string")
    turns = prefix_trie.numbered_turns(frame, tables)
    out = prefix_trie.trie(turns, turns.select("conv").distinct(), tables, **settings)
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_query_like_sql(spark):
    name = "op12_conversation_trie"
    status, *_ = compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert status == "ok", status


def test_query_by_definition(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    own = sequences(rows)
    grafted = {c: own.get(c - c % 100, [])[: zlib.crc32(str(c).encode()) % 6] + t[zlib.crc32(str(c).encode()) % 6 :] for c, t in own.items()}
    got = sorted((tuple(r) for r in queries.QUERIES["op12_conversation_trie"](spark, SF).collect()), key=str)
    assert got == brute(grafted)


@pytest.mark.parametrize("seed", range(3))
def test_branches_copies_and_long_conversations(spark, seed, monkeypatch):
    """Shared beginnings of all lengths, many equal conversations, one with a third of all turns over several super blocks."""
    monkeypatch.setattr(prefix_trie, "SUPER", 8)
    monkeypatch.setattr(prefix_trie, "CHUNK", 5)
    r, rows = random.Random(seed), []
    stems = [[(r.choice(["user", "bot"]), r.choice(["a", "bé", "", "ccc"])) for _ in range(14)] for _ in range(4)]
    for c in range(60):
        stem = r.choice(stems)[: r.randint(0, 14)]
        turns = stem + [("user", f"own{c}" if r.random() < 0.5 else "end")] * r.randint(0, 3)
        rows += [(1000 - c, t, *x) for t, x in enumerate(turns)]
    rows += [(5000 + c, t, *x) for c in range(40) for t, x in enumerate(stems[0][:9])]
    rows += [(7, 3 * t, "user", f"t{t % 5}") for t in range(170)] + [(8, t, "user", f"t{t % 5}") for t in range(101)]
    r.shuffle(rows)
    assert made(spark, rows, block=[1, 4, 5][seed]) == brute(sequences(rows))


def test_cases(spark):
    rows = [(1, None, "user", "n"), (1, 0, None, None), (1, 1, "", ""), (2, 0, "u", "x"), (2, 0, "u", "x"), (2, 0, "a", "y"), (None, 0, "u", "lost"), (-3, 5, "u", "x"), (3, -2, "u", "x" * 200_000), (3, 9, "u", "x"), (2**62, 2**62, "u", "z")]
    assert made(spark, rows) == brute(sequences(rows))
    assert made(spark, rows[6:7]) == [] and made(spark, []) == []
    # conversations without turns are members of the root
    tables = Scratch(spark)
    turns = spark.createDataFrame([], "conv long, pos long, digest binary, size long")
    assert [tuple(x)[:7] for x in prefix_trie.trie(turns, spark.range(5).select(F.col("id").alias("conv")), tables).collect()] == [(0, 0, None, 5, 0, 1, 0)]
