"""Prefix trie of conversations by fixed-length block hashing.

A turn is known by the first 128 bits of a SHA-256 digest of role and text; texts are read once and never shuffled. A prefix is known by its
depth and two sums (exclusive or) of 64-bit hashes of (place, digest), so that sums of parts make the sum of the whole and a conversation
with a third of all turns is added up in parts.

Blocks first: the turns of a conversation are cut into blocks of ``block`` turns, and conversations are grouped by where a block
begins and ends, that is by successive block digests: one row for each different block. Where all conversations that go on from
a prefix do so with the same block, the block's turns are a chain of nodes with the members of the block, and nothing more is
compared. Only where the blocks after one prefix differ are these different blocks (not their conversations) opened,
and their turn boundaries are grouped by the prefix that ends there.

A node belongs to its smallest member. A conversation owns the nodes of a last part of its turns, from depth s on, as smaller members only drop out
on the way down. So sums over subtrees need no walk: with X the characters of a conversation's turns before depth s, the sum over a
subtree of (members - 1) * characters is the members' X, less the owner's, less (members - 1) times the characters before the node;
a leaf counts at its owner. Both are sums over members, made by blocks again.

Null role or text is empty. Turns follow their numbers, null first, equal numbers by digest. Rows without a conversation id belong to
none and are left out. A conversation that was given no turns is a member of the root. Repeated rows are turns of their own. Other
columns are not read. Without any conversation the result is empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatframe.operators.ordered import running
from threatframe.session import Scratch

SUPER = 1024  # blocks added up at a time
CHUNK = 1000  # ids of a piece of a list that is hashed
NODE = ["d", "a", "b"]


def numbered_turns(conversations: DataFrame, tables: Scratch) -> DataFrame:
    """(conv, pos, digest, size) of every turn, ``pos`` from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").alias("conv"), F.col("turn"), F.unhex(digest).alias("digest"), F.length(text).cast("long").alias("size"))
    rows = running(tables.write("digests", rows), ["conv"], ["turn", "digest"], {"pos": ("sum", F.lit(1).cast("long"))}, inclusive=False)
    return tables.write("turns", rows.select("conv", F.coalesce("pos", F.lit(0)).alias("pos"), "digest", "size"))


def blocks_of(turns: DataFrame, block: int, tables: Scratch) -> DataFrame:
    """(conv, k, n, a0, b0, c0, a1, b1, c1, turns): hash sums and characters before and after each block of a conversation, and its turns."""
    hashed = turns.select("conv", "pos", F.xxhash64(F.lit(1), "pos", "digest").alias("a"), F.xxhash64(F.lit(2), "pos", "digest").alias("b"), "size")
    rows = hashed.groupBy("conv", F.floor(F.col("pos") / block).alias("k"))
    sums = [F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("size").alias("c")]
    rows = tables.write("sums", rows.agg(*sums, F.sort_array(F.collect_list(F.struct("pos", "a", "b", "size"))).alias("turns")).withColumn("s", F.floor(F.col("k") / SUPER)))

    def earlier(keys: list[str], order: str) -> list[Column]:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(f(x).over(window), F.lit(0).cast("long")).alias(f"{x}0") for f, x in ((F.bit_xor, "a"), (F.bit_xor, "b"), (F.sum, "c"))]

    out = rows.select("*", *earlier(["conv", "s"], "k"))
    if (rows.agg(F.max("s")).first()[0] or 0) > 0:  # what all blocks before the block's super block come to
        supers = rows.groupBy("conv", "s").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("c").alias("c"))
        supers = supers.select("conv", "s", *[x.alias(f"{n}s") for x, n in zip(earlier(["conv"], "s"), "abc", strict=True)]).where("s > 0")
        out = out.join(supers, ["conv", "s"], "left")
        part = {n: F.coalesce(f"{n}s", F.lit(0).cast("long")) for n in "abc"}
        out = out.withColumns({"a0": F.col("a0").bitwiseXOR(part["a"]), "b0": F.col("b0").bitwiseXOR(part["b"]), "c0": F.col("c0") + part["c"]})
    after = [F.col("a0").bitwiseXOR(F.col("a")).alias("a1"), F.col("b0").bitwiseXOR(F.col("b")).alias("b1"), (F.col("c0") + F.col("c")).alias("c1")]
    out = tables.write("blocks", out.select("conv", "k", F.size("turns").alias("n"), "a0", "b0", "c0", *after, "turns"))
    tables.drop("sums")
    return out


def opened(kinds: DataFrame, *carried: str) -> DataFrame:
    """A row for each turn of each block: (d, a, b, pa, pb, size, c) with the sums of the prefixes that end with and before it, and the characters before."""
    def until(x: str, i: Column) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), i), F.col(f"{x}0"), lambda acc, t: acc.bitwiseXOR(t[x]))

    def prefix(t: Column, i: Column) -> Column:
        chars = F.aggregate(F.slice("turns", F.lit(1), i), F.col("c0"), lambda acc, y: acc + y["size"])
        return F.struct((t["pos"] + 1).alias("d"), until("a", i + 1).alias("a"), until("b", i + 1).alias("b"), until("a", i).alias("pa"), until("b", i).alias("pb"), t["size"].alias("size"), chars.alias("c"))

    return kinds.select(*carried, F.explode(F.transform("turns", prefix)).alias("node")).select("node.*", *carried)


def summed(kinds: DataFrame, **sums: Column) -> DataFrame:
    """Nodes of the blocks ``kinds`` (one row for each different block) with the aggregates ``sums`` over the blocks that go through them.

    A block that is the only one after its prefix gives its nodes as they are; blocks that differ are opened and grouped by prefix.
    """
    start = ["k", "a0", "b0"]
    siblings = kinds.groupBy(*start).agg(F.count(F.lit(1)).alias("siblings"))
    alone = kinds.join(siblings.where("siblings = 1").select(*start), start, "left_semi")
    apart = kinds.join(siblings.where("siblings > 1").select(*start), start, "left_semi")
    one = [F.first(c).alias(c) for c in ("pa", "pb", "size", "c")]
    grouped = opened(apart, *sums).groupBy(*NODE).agg(*one, *[f.alias(name) for name, f in sums.items()])
    return opened(alone, *sums).select(*grouped.columns).unionByName(grouped)


def hashed_ends(ends: DataFrame, partitions: int) -> DataFrame:
    """(d, a, b, ends_sha256): digest of the ids of the conversations that end at a node, ascending, comma-joined.

    Ids are sorted in even ranges, joined to pieces there, and only the pieces of a node meet, one after the other.
    """

    def pieces(batches):
        for batch in batches:
            keys = batch[NODE].to_numpy()
            starts = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)] if len(keys) else np.zeros(0, dtype=bool)
            place = np.arange(len(keys)) - np.maximum.accumulate(np.where(starts, np.arange(len(keys)), 0)) if len(keys) else starts
            part = np.cumsum(starts | (place % CHUNK == 0))
            yield batch.groupby(part, sort=False).agg(d=("d", "first"), a=("a", "first"), b=("b", "first"), low=("conv", "first"), ids=("conv", lambda x: ",".join(map(str, x))))

    def digests(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for d, a, b, ids in batch[[*NODE, "ids"]].itertuples(index=False):
                if node == (d, a, b):
                    state.update(b"," + ids.encode())
                    continue
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (d, a, b), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    ranged = ends.select(*NODE, "conv").repartitionByRange(partitions, *NODE, "conv").sortWithinPartitions(*NODE, "conv")
    joined = ranged.mapInPandas(pieces, "d long, a long, b long, low long, ids string")
    return joined.repartition(partitions, *NODE).sortWithinPartitions(*NODE, "low").mapInPandas(digests, "d long, a long, b long, ends_sha256 string")


def trie(turns: DataFrame, conversations: DataFrame, tables: Scratch, block: int = 4) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: conv, pos (from 0 without gaps), digest, size; ``conversations``: conv, all of them once.
    """
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks_of(turns, block, tables)
    end_of = ["k", "a1", "b1"]
    kinds = blocks.groupBy(*end_of).agg(*[F.first(c).alias(c) for c in ("a0", "b0", "c0", "turns")], F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"))
    kinds = tables.write("kinds", kinds)
    last = F.max(F.struct("k", (F.col("k") * block + F.col("n")).alias("d"), F.col("a1").alias("a"), F.col("b1").alias("b"), F.col("c1").alias("c")))
    ends = conversations.select("conv").join(blocks.groupBy("conv").agg(last.alias("last")), "conv", "left")
    zero = F.lit(0).cast("long")
    ends = tables.write("ends", ends.select("conv", *[F.coalesce(f"last.{c}", zero).alias(c) for c in ("d", "a", "b", "c")]))

    root = ends.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in (*NODE, "pa", "pb", "size", "c")], "n_convs", "conv_id")
    nodes = summed(kinds, n_convs=F.sum("n_convs"), conv_id=F.min("conv_id"))
    nodes = tables.write("nodes", nodes.select(*root.columns).unionByName(root))

    # conversations that own nodes: first depth, characters and prefix before it, and whose that prefix is
    owners = nodes.groupBy("conv_id").agg(F.min(F.struct("d", "c", "pa", "pb")).alias("first")).select(F.col("conv_id").alias("conv"), "first.*")
    parents = nodes.select(F.col("d").alias("pd"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent"))
    owners = owners.withColumn("pd", F.col("d") - 1).join(parents, ["pd", "pa", "pb"], "left")
    owners = tables.write("owners", owners.select("conv", F.col("d").alias("s"), F.col("c").alias("x"), "parent"))
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    children = tables.write("children", children)
    leaves = nodes.join(children, NODE, "left_anti").select(F.col("conv_id").alias("conv"), F.lit(1).cast("long").alias("leaf"))
    members = ends.join(owners, "conv", "left").join(leaves, "conv", "left")
    members = tables.write("members", members.select("conv", F.coalesce("x", "c").alias("x"), F.coalesce("leaf", zero).alias("leaf")))

    by_block = blocks.select("conv", *end_of).join(members, "conv").groupBy(*end_of).agg(F.sum("x").alias("x"), F.sum("leaf").alias("leaf"))
    carried = kinds.select(*end_of, "a0", "b0", "c0", "turns").join(by_block, end_of)
    below = summed(carried, x=F.sum("x"), leaf=F.sum("leaf")).select(*NODE, "x", "leaf")
    below = below.unionByName(members.agg(F.sum("x").alias("x"), F.sum("leaf").alias("leaf")).where("x is not null").select(*[zero.alias(c) for c in NODE], "x", "leaf"))

    # all that is known of a node meets in one shuffle
    known = ["c", "n_convs", "conv_id", "n_children", "x", "leaf", "ends_sha256"]
    types = {c: "string" if c == "ends_sha256" else "long" for c in known}
    parts = [nodes, children, below, hashed_ends(ends, partitions)]
    rows = None
    for part in parts:
        own = part.select(*NODE, *[F.col(c) if c in part.columns else F.lit(None).cast(types[c]).alias(c) for c in known])
        rows = own if rows is None else rows.unionByName(own)
    rows = rows.groupBy(*NODE).agg(*[F.max(c).alias(c) for c in known])
    own = owners.select(F.col("conv").alias("conv_id"), "s", F.col("x").alias("own_x"), "parent")
    rows = rows.join(own, "conv_id")
    saved = F.col("x") - F.col("own_x") - (F.col("n_convs") - 1) * F.col("c")
    parent = F.when(F.col("d") == F.col("s"), F.col("parent")).otherwise(F.col("conv_id"))
    return rows.select("conv_id", F.col("d").alias("depth"), parent.alias("parent_conv_id"), "n_convs", F.coalesce("n_children", zero).alias("n_children"), F.col("leaf").alias("n_leaves"),
                       saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
